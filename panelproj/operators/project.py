"""Project the sample to the universe: within provinces by district, then across cities by tier."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelproj.functions import not_in, ratio, sum_known
from panelproj.operators.nearest import nearest_in_block
from panelproj.operators.relational import fill_from_group, na_anti, na_join, sum_by, union_strict, weighted_quantile
from panelproj.operators.standardize import PLACE
from panelproj.sources import materialize

COMBO = ["market", "packid", "date"]
RESULT = ["date", *PLACE, "market", "packid", "flag_sample"]


def centre_facts(facts: DataFrame) -> DataFrame:
    return sum_by(facts, [*PLACE, "pchc", *COMBO], ["sales", "units"])


def district_mapping(universe: DataFrame) -> DataFrame:
    """Mean centre size and number of sampled centres per district."""
    return universe.groupBy(*PLACE).agg(F.avg("est").alias("est"), F.sum("flag_sample").alias("sample"))


def nearest_district_donor(districts: DataFrame) -> DataFrame:
    """(place, sample_city, sample_dist): a sampled district serves itself, any other
    takes the sampled district of its province with the closest mean size.

    Of several equally close donors the first by (city, larger size) decides the
    donor *name*; all equally close donors of that name stay.
    """
    districts = materialize(districts, "district-sizes")
    sampled = districts.filter(F.col("sample") > 0)
    own = sampled.select(*PLACE, F.col("city").alias("sample_city"), F.col("district").alias("sample_dist"))
    donors = sampled.select(
        "province",
        F.col("city").alias("sample_city"),
        F.col("district").alias("sample_dist"),
        F.col("est").alias("sample_est"),
    )
    asking = districts.filter(~(F.col("sample") > 0)).select(*PLACE, "est")
    close = nearest_in_block(asking, donors, "province", "est", "sample_est")
    first_name = F.min_by("sample_dist", F.struct("sample_city", -F.col("sample_est"), "sample_dist"))
    named = close.groupBy(*PLACE).agg(first_name.alias("__name"))
    borrowed = na_join(close, named, PLACE, "inner").filter(F.col("sample_dist") == F.col("__name"))
    return union_strict(own, borrowed.select(*PLACE, "sample_city", "sample_dist"))


def _finish(rows: DataFrame, facts: DataFrame, universe: DataFrame) -> DataFrame:
    """Append the facts of centres outside the universe, keep positive rows, sum by district."""
    outside = na_anti(facts, universe, ["pchc"]).withColumn("flag_sample", F.lit(1))
    columns = [*RESULT, "sales", "units"]
    return sum_by(
        union_strict(rows.select(*columns), outside.select(*columns)).filter((F.col("units") > 0) & (F.col("sales") > 0)),
        RESULT,
        ["sales", "units"],
    )


def project_sample(
    facts: DataFrame, universe: DataFrame, *, ratio_key: Sequence[str] = ("sample_dist",), coverage: float = 0.8
) -> DataFrame:
    """District facts: the sampled centres' own sales plus estimates for the others.

    An unsampled centre gets est x (sales / est of the sampled centres whose district
    has the donor's name), per market, pack and month, unless `coverage` of the
    centres in that pool are sampled. `ratio_key` may be widened to
    ("sample_city", "sample_dist") to keep equally named districts apart.

    Everything is computed per district and pack, never per centre and pack: within a
    pool the ratio is one number, so the unsampled centres of a district contribute
    ratio x their summed size. Sizes must be positive and known.

    The facts per centre, the universe and the donor list are written once to the
    shared folder, because each of them feeds several joins.
    """
    facts = materialize(centre_facts(facts), "centre-facts")
    universe = materialize(universe.select(*PLACE, "pchc", "est", "flag_sample"), "universe")
    mapping = materialize(nearest_district_donor(district_mapping(universe)), "district-donors")
    sampled = F.col("flag_sample") == 1
    sizes = universe.groupBy(*PLACE).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(sampled, 1).otherwise(0)).alias("n_sampled"),
        sum_known(F.when(sampled, F.col("est"))).alias("est_sampled"),
        sum_known(F.when(~sampled, F.col("est"))).alias("est_rest"),
    )
    members = na_join(facts, universe.filter(sampled).select(*PLACE, "pchc"), [*PLACE, "pchc"], "left_semi")
    sold = sum_by(members, [*PLACE, *COMBO], ["sales", "units"])
    donor_combos = facts.filter(F.col("packid").isNotNull()).select(*PLACE, *COMBO).distinct()

    # One row per (district, donor, market, pack, month).
    pairs = na_join(mapping, sizes, PLACE, "inner")
    grid = na_join(
        pairs, donor_combos, ["province", ("sample_city", "city"), ("sample_dist", "district")], "inner"
    )
    pool = [*ratio_key, *COMBO]
    rates = na_join(grid, sold, [*PLACE, *COMBO], "left").groupBy(*pool).agg(
        ratio(sum_known("sales"), F.sum("est_sampled")).alias("sales_rate"),
        ratio(sum_known("units"), F.sum("est_sampled")).alias("units_rate"),
        (F.sum("n_sampled") / F.sum("n")).alias("share"),
    )
    estimated = (
        na_join(grid.filter(F.col("est_rest") > 0).select(*PLACE, *pool, "est_rest"), rates.filter(F.col("share") < coverage), pool)
        .withColumns(
            {
                "sales": F.col("est_rest") * F.col("sales_rate"),
                "units": F.col("est_rest") * F.col("units_rate"),
                "flag_sample": F.lit(0),
            }
        )
    )
    own = members.withColumn("flag_sample", F.lit(1)).filter(F.col("packid").isNotNull())
    columns = [*RESULT, "sales", "units"]
    return _finish(union_strict(estimated.select(*columns), own.select(*columns)), facts, universe)


def ratio_of_means(df: DataFrame, keys: Sequence[str], rates: dict[str, str], base: str) -> DataFrame:
    """Write mean(measure) / mean(base) of each group to its rows."""
    return fill_from_group(df, keys, {name: ratio(F.avg(m), F.avg(base)) for name, m in rates.items()})


def sample_share(df: DataFrame, keys: Sequence[str], flag: str = "flag_sample") -> DataFrame:
    """Write the share of flagged rows of each group to its rows."""
    return fill_from_group(df, keys, {"share": F.sum(flag) / F.count(F.lit(1))})


def tier_districts(universe: DataFrame, tiers: DataFrame, default_tier: float = 1.0) -> DataFrame:
    """Summed size per district and tier; a city listed with several tiers appears in each."""
    tiered = na_join(universe, tiers, ["city"], "left").withColumn("tier", F.coalesce("tier", F.lit(default_tier)))
    return sum_by(tiered.filter(F.col("est").isNotNull()), [*PLACE, "tier"], ["est"])


def donor_facts(
    sample: DataFrame, tiers: DataFrame, exclude_provinces: Sequence[str], default_tier: float = 1.0
) -> DataFrame:
    kept = sample.filter(not_in("province", exclude_provinces))
    tiered = na_join(kept, tiers, ["city"], "left").withColumn("tier", F.coalesce("tier", F.lit(default_tier)))
    return sum_by(tiered, ["date", *PLACE, "tier", "market", "packid"], ["sales", "units"])


_DONOR = {c: f"donor_{c}" for c in PLACE}


def nearest_tier_donor(districts: DataFrame, donors: DataFrame) -> DataFrame:
    """(district, donor district, slope): the donors of the same tier closest in size, all ties.

    `donors` holds (place, tier) keys of districts with facts.
    """
    offered = na_join(districts, donors.select(*PLACE, "tier").distinct(), [*PLACE, "tier"], "left_semi")
    offered = materialize(offered.withColumnsRenamed(_DONOR | {"est": "donor_est"}), "offered")
    slope = ratio("est", "donor_est")
    finite = ~(slope.isNull() | (F.abs(slope) == float("inf")))
    return nearest_in_block(districts, offered, "tier", "est", "donor_est").withColumn(
        "slope", F.when(finite, slope).otherwise(1.0)
    )


def slope_cap(pairs: DataFrame, facts: DataFrame, q: float = 0.9) -> DataFrame:
    """One row: the slope quantile over target x donor pack x all months.

    Every donor pack stands for as many rows as there are months anywhere, whether it
    sold in them or not, so the rows are counted instead of built.
    """
    packs = facts.select(*PLACE, "tier", "market", "packid").distinct().groupBy(*PLACE, "tier").agg(F.count("*").alias("packs"))
    months = facts.agg(F.count_distinct(F.coalesce("date", F.lit("")))).scalar()
    counted = na_join(pairs, packs, [(_DONOR[c], c) for c in PLACE] + ["tier"], "inner")
    weighed = counted.groupBy("slope").agg(F.sum("packs").alias("packs")).withColumn("rows", F.col("packs") * months)
    return weighted_quantile(weighed, "slope", "rows", q)


def project_nation(
    sample: DataFrame,
    universe: DataFrame,
    tiers: DataFrame,
    *,
    exclude_provinces: Sequence[str] = (),
    q: float = 0.9,
    default_tier: float = 1.0,
) -> DataFrame:
    """Append scaled donor facts for every city without a sample.

    `exclude_provinces` give no donors but still receive projections. The slope cap is
    taken before sampled cities leave the target list. The sample, the district sizes
    and the donor pairs are written once to the shared folder.
    """
    sample = materialize(sample.select(*RESULT, "sales", "units"), "sample")
    tiers = materialize(tiers, "tiers")
    districts = materialize(tier_districts(universe, tiers, default_tier), "districts")
    facts = na_join(
        donor_facts(sample, tiers, exclude_provinces, default_tier), districts.select(*PLACE, "tier"), [*PLACE, "tier"], "left_semi"
    )
    facts = materialize(facts, "donor-facts")
    pairs = materialize(nearest_tier_donor(districts, facts), "tier-donors")
    cap = slope_cap(pairs, facts, q)
    missing = na_anti(pairs, sample, ["city"]).withColumn("slope", F.least(F.col("slope"), cap.scalar()))
    donated = facts.withColumnsRenamed(_DONOR)
    scaled = na_join(donated, missing.select(*PLACE, "tier", *_DONOR.values(), "slope"), [*_DONOR.values(), "tier"], "inner")
    projected = (
        scaled.groupBy("date", *PLACE, "market", "packid")
        .agg(*[sum_known(F.col(m) * F.col("slope")).alias(m) for m in ("sales", "units")])
        .filter((F.col("sales") > 0) & (F.col("units") > 0))
        .withColumn("flag_sample", F.lit(0))
    )
    return union_strict(projected.select(*RESULT, "sales", "units"), sample)
