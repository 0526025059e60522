"""Universe, city tiers, product master and tender lookups."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelproj.functions import (
    first_known,
    if_else,
    is_in,
    last_known,
    pad_code,
    row_order,
    safe_int,
    strip_pattern,
    substring_between,
    sum_known,
)
from panelproj.operators.relational import fill_from_group, first_of_equal, flag_membership, lookup_matched, na_join, tag_rows, union_strict
from panelproj.operators.standardize import CITY_SUFFIX, PLACE, PROVINCE_SUFFIX
from panelproj.sources import materialize

MASTER_COLUMNS = [
    "corp", "corp_cn", "type", "atc3", "atc4", "atc3_cn", "molecule", "molecule_cn", "product", "product_cn", "pack", "route",
]

# Source column -> attribute, for the three product sources and the name list.
PANEL_ATTRIBUTES = {
    "Corp_Desc": "corp", "MNF_TYPE": "type", "ATC3_Code": "atc3", "ATC4_Code": "atc4", "Molecule_Desc": "molecule",
    "Prd_desc": "product", "Pck_Desc": "pack", "Pack_ID": "packid",
}
MASTER_ATTRIBUTES = {
    "CORP_NAME_EN": "corp", "MNF_TYPE": "type", "ATC3_CODE": "atc3", "ATC4_CODE": "atc4", "ATC3": "atc3_cn", "MOLE_NAME_EN": "molecule",
    "MOLE_NAME_CH": "molecule_cn", "PROD_DESC": "product", "PROD_NAME_CH": "product_cn", "PCK_DESC": "pack", "NFC1_NAME_CH": "route",
    "PACK_ID": "packid",
}
SUPPLEMENT_ATTRIBUTES = {"Pack Code": "packid", "Prod_CN_Name": "product_cn", "NFCI Description": "route"}
NAME_ATTRIBUTES = {"PACK_ID": "packid", "PROD_NAME_CH": "product_cn", "NFC1_NAME_CH": "route"}
DISABLED_MARK = "禁用"


def attribute_source(df: DataFrame, columns: Mapping[str, str], strip: Mapping[str, str] | None = None) -> DataFrame:
    """Distinct renamed attributes of one source; `strip` removes a pattern from a column first.

    A position in the files (`_pos`) is kept: the first one of equal rows.
    """
    strip = strip or {}
    renamed = [(strip_pattern(F.col(f"`{c}`"), strip[c]) if c in strip else F.col(f"`{c}`")).alias(n) for c, n in columns.items()]
    return first_of_equal(df, renamed)


def registered_centres(registry: DataFrame) -> DataFrame:
    """One row per centre with positive size: first known place (by `_pos` if the registry has it), summed size."""
    columns = [
        strip_pattern("province", PROVINCE_SUFFIX).alias("province"),
        strip_pattern("city", CITY_SUFFIX).alias("city"),
        F.col("district"),
        F.col("pchc"),
        F.col("est"),
    ]
    rows = first_of_equal(registry, columns)
    order = ["_pos"] if "_pos" in registry.columns else [*PLACE, "est"]
    return (
        rows.filter(F.col("est") > 0)
        .groupBy("pchc")
        .agg(*[first_known(c, order).alias(c) for c in PLACE], sum_known("est").alias("est"))
    )


def build_universe(facts: DataFrame, registry: DataFrame) -> DataFrame:
    """All centres with complete place and size, flagged when they are in the sample.

    Facts come before the registry in row order, so a sampled centre keeps its fact
    place. Facts are reduced to their distinct places before they are stacked.
    """
    sampled = facts.groupBy("pchc", *PLACE).agg(F.min("date").alias("date"))
    stacked = tag_rows([sampled, registered_centres(registry)])
    order = ["_src", "date", *PLACE]
    universe = stacked.groupBy("pchc").agg(
        F.min_by("province", row_order(order)).alias("province"),
        first_known("city", order).alias("city"),
        first_known("district", order).alias("district"),
        first_known("est", order).alias("est"),
    )
    return flag_membership(universe.dropna(subset=[*PLACE, "est"]), facts, ["pchc"], "flag_sample")


def city_tier(raw: DataFrame, order_by: Sequence[str], default: float = 5.0) -> DataFrame:
    """(city, tier): a missing tier takes the city's first known one, then the default."""
    known = raw.groupBy("city").agg(first_known("city_tier", order_by).alias("__known"))
    return (
        na_join(raw, known, ["city"], "inner")
        .select("city", F.coalesce("city_tier", "__known", F.lit(default)).alias("tier"))
        .distinct()
    )


def product_master(sources: Sequence[DataFrame], corporations: DataFrame, fallback_names: DataFrame) -> DataFrame:
    """One row per pack from several partial sources, earlier sources first, and in a source
    earlier rows (`_pos`, if all sources have it; else in the order of their contents).

    Local-language names spread within their class, molecule and product before the
    first known value of each attribute is taken; `fallback_names` fills what is left
    and keeps its multiplicity.
    """
    placed = all("_pos" in s.columns for s in sources)
    stacked = tag_rows(sources)
    given = [c for c in MASTER_COLUMNS if c != "corp_cn"]
    content = ["_pos"] if placed else ["packid", *[c for c in given if c in stacked.columns]]
    stacked = stacked.withColumns({c: F.lit(None).cast("string") for c in given if c not in stacked.columns})
    rows = na_join(stacked, corporations.select("name", F.col("namec").alias("corp_cn")), [("corp", "name")], "left")
    rows = materialize(rows, "product-rows")
    order = ["_src", *content]
    fills = {"atc3_cn": "atc3", "molecule_cn": "molecule", "product_cn": "product"}
    filled = rows.withColumnsRenamed({name: f"__{name}" for name in fills})
    for name, group in fills.items():
        known = rows.groupBy(group).agg(first_known(name, order).alias(name))
        filled = na_join(filled, known, [group], "inner")
    rows, order = filled, ["_src", *[f"__{c}" if c in fills else c for c in content]]
    master = rows.groupBy("packid").agg(*[first_known(c, [*order, c]).alias(c) for c in MASTER_COLUMNS])
    names = fallback_names.select("packid", F.col("product_cn").alias("__name"), F.col("route").alias("__route"))
    return (
        na_join(master, names, ["packid"], "left")
        .withColumns({"product_cn": F.coalesce("product_cn", "__name"), "route": F.coalesce("route", "__route")})
        .drop("__name", "__route")
    )


def tender_packs(
    parts: DataFrame,
    products: DataFrame,
    *,
    city_of_province: Mapping[str, str],
    national: str = "National",
    label: str = "中标产品",
) -> DataFrame:
    """Packs that won a tender, nationally and in the tracked provinces' main cities.

    `parts` carries `sheet`, `province`, `molecule_cn` and a numeric or text `pack_id`.
    The molecule is looked up by the 5-character product prefix.
    """
    coded = parts.withColumn("packid", pad_code(safe_int("pack_id"))).filter(F.col("packid").isNotNull())
    columns = ["city", "molecule_cn", "packid", "sheet"]
    everywhere = coded.withColumn("city", F.lit(national)).select(*columns).distinct()
    city: Column = F.lit(None).cast("string")
    for province, name in city_of_province.items():
        city = F.when(F.col("province") == province, F.lit(name)).otherwise(city)
    tracked = coded.filter(is_in("province", list(city_of_province))).withColumn("city", city).select(*columns).distinct()
    molecules = products.select(substring_between("packid", 1, 5).alias("prodid"), "molecule").distinct()
    won = union_strict(everywhere, tracked).withColumns(
        {"tender_win": F.lit(label), "prodid": substring_between("packid", 1, 5)}
    )
    return (
        lookup_matched(won, molecules, ["prodid"], "molecule")
        .select("city", "molecule", "packid", "tender_win", "sheet")
        .distinct()
    )


def tender_rounds(
    packs: DataFrame,
    *,
    labels: Mapping[int, str],
    merge_national: tuple[str, str],
    national: str = "National",
    exclude_molecules: Sequence[str] = (),
) -> DataFrame:
    """Tender round by (city, molecule); one round is merged into another nationally."""
    name: Column = F.lit(None).cast("string")
    for sheet, text in labels.items():
        name = F.when(F.col("sheet") == sheet, F.lit(text)).otherwise(name)
    merged, into = merge_national
    rounds = packs.withColumn("tender_round", name)
    rounds = rounds.withColumn(
        "tender_round",
        if_else(
            (F.col("tender_round") == merged) & (F.col("city") == national), F.lit(into), F.col("tender_round")
        ),
    )
    if exclude_molecules:
        # A missing molecule compares as unknown and is dropped as well.
        rounds = rounds.filter(~F.col("molecule").isin(list(exclude_molecules)))
    return rounds.select("city", "molecule", "tender_round").distinct()


def newest_attributes(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], **how: Sequence[str]) -> DataFrame:
    """Harmonise attributes within a key.

    `last` takes the newest row's value even when it is missing, `last_known` and
    `first_known` skip missing values. Missing order values come last; rows equal in
    `order_by` are ordered by the value.
    """
    kept = {f"__o{i}": F.col(c) for i, c in enumerate(order_by)}
    ordered = df.withColumns(kept)
    names = list(kept)
    values = {c: F.max_by(c, row_order([*names, c])) for c in how.get("last", ())}
    values |= {c: last_known(c, [*names, c]) for c in how.get("last_known", ())}
    values |= {c: first_known(c, [*names, c]) for c in how.get("first_known", ())}
    return fill_from_group(ordered, keys, values).drop(*names)
