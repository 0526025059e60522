"""The sample projection written out per centre and pack: the yardstick for project_sample."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelproj.functions import if_else
from panelproj.operators.project import (
    COMBO,
    _finish,
    centre_facts,
    district_mapping,
    nearest_district_donor,
    ratio_of_means,
    sample_share,
)
from panelproj.operators.relational import fill_from_group, na_join
from panelproj.operators.standardize import PLACE
from panelproj.sources import materialize


def project_sample_by_centre(
    facts: DataFrame, universe: DataFrame, *, ratio_key: Sequence[str] = ("sample_dist",), coverage: float = 0.8
) -> DataFrame:
    """The same projection written out per centre and pack.

    Its intermediate result grows with centres x packs x months.
    """
    facts = materialize(centre_facts(facts), "centre-facts")
    universe = materialize(universe.select(*PLACE, "pchc", "est", "flag_sample"), "universe")
    mapping = materialize(nearest_district_donor(district_mapping(universe)), "district-donors")
    donor_combos = facts.filter(F.col("packid").isNotNull()).select(*PLACE, *COMBO).distinct()
    rows = na_join(mapping, universe, PLACE, "left")
    rows = na_join(rows, donor_combos, ["province", ("sample_city", "city"), ("sample_dist", "district")], "left")
    rows = na_join(rows, facts, [*PLACE, "pchc", *COMBO], "left")
    for m in ("sales", "units"):
        absent = (F.col("flag_sample") == 1) & F.col(m).isNull()
        rows = rows.withColumn(m, if_else(absent, F.lit(0.0), F.col(m)))
    pool = [*ratio_key, *COMBO]
    rows = ratio_of_means(rows, [*pool, "flag_sample"], {"sales_rate": "sales", "units_rate": "units"}, "est")
    rows = sample_share(rows, pool)
    # Within a pool the rate is one number per flag; the sampled rows' rate comes first.
    rows = materialize(rows, "centre-rows")
    known = {r: F.min_by(r, F.when(F.col(r).isNotNull(), -F.col("flag_sample"))) for r in ("sales_rate", "units_rate")}
    rows = fill_from_group(rows, pool, known)
    keep = (F.col("flag_sample") == 1) | (F.col("share") >= coverage)
    for m in ("sales", "units"):
        rows = rows.withColumn(m, if_else(keep, F.col(m), F.col("est") * F.col(f"{m}_rate")))
    return _finish(rows, facts, universe)
