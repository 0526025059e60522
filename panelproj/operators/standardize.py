"""From raw panel exports to the canonical fact table."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelproj.functions import (
    first_known,
    if_else,
    is_in,
    not_in,
    pad_code,
    ratio,
    remap_prefix,
    row_order,
    strip_pattern,
    substring_between,
    sum_known,
)
from panelproj.operators.relational import first_of_equal, lookup_matched, spread, sum_by, tag_rows

# Administrative suffixes, the label for a municipality's own
# districts with the city it stands for, and two pack-code prefix successions.
PROVINCE_SUFFIX = "省|市"
CITY_SUFFIX = "市"
MUNICIPALITY = {"市辖区": "北京"}
CODE_SUCCESSION = {"47775": "58906", "06470": "64895"}

FACT_COLUMNS = [
    "year", "date", "quarter", "province", "city", "district", "pchc", "market", "packid", "units", "sales",
]
FACT_KEYS = FACT_COLUMNS[:-2]
PLACE = ["province", "city", "district"]


def derived_units(volume: str = "volume", value: str = "value", price: str = "price") -> Column:
    """Reported volume, or value / price where the volume is missing."""
    return F.coalesce(F.col(volume), ratio(value, price))


def clean_city(c: str, municipality: Mapping[str, str] = MUNICIPALITY) -> Column:
    out = strip_pattern(c, CITY_SUFFIX)
    for label, city in municipality.items():
        out = if_else(F.col(c) == label, F.lit(city), out)
    return out


def raw_transactions(
    raw: DataFrame,
    *,
    place: Mapping[str, str] | None = None,
    municipality: Mapping[str, str] = MUNICIPALITY,
    units: Column | None = None,
    keep_price: bool = False,
) -> DataFrame:
    """Cleaned, renamed and de-duplicated raw rows.

    Identical transactions collapse (the duplicates are removed by all output
    columns at once). `place` gives constant province/city for single-city files
    that carry no place columns. A position in the files (`_pos`) is kept: the first one
    of identical transactions.
    """
    if place is None:
        where = [
            strip_pattern("province", PROVINCE_SUFFIX).alias("province"),
            clean_city("city", municipality).alias("city"),
            F.col("county").alias("district"),
        ]
    else:
        where = [F.lit(v).alias(k) for k, v in place.items()]
        where += [F.col("county").alias("district")] if "county" in raw.columns else []
    columns = [
        F.col("year").cast("string").alias("year"),
        "quarter",
        strip_pattern(F.col("month").cast("string"), "/").alias("date"),
        *where,
        F.col("hospital_name").alias("hospital"),
        substring_between("atc4_code", 1, 4).alias("atc3"),
        F.col("molecule_desc").alias("molecule"),
        pad_code("packcode").alias("packid"),
        *([F.col("price")] if keep_price else []),
        (derived_units() if units is None else units).alias("units"),
        F.col("value").alias("sales"),
    ]
    return first_of_equal(raw, columns)


def standardize_panel(
    raw: DataFrame,
    place_map: DataFrame,
    market_def: DataFrame,
    *,
    projects: Sequence[str] | None = None,
    quarters: Sequence[str] | None = None,
    exclude_provinces: Sequence[str] = (),
    require_code: bool = False,
    place: Mapping[str, str] | None = None,
    municipality: Mapping[str, str] = MUNICIPALITY,
    succession: Mapping[str, str] = CODE_SUCCESSION,
) -> DataFrame:
    """Raw export -> canonical facts of known centres and markets.

    The lookups keep their multiplicity: a molecule listed in two markets yields two
    facts, a centre name that stands for two centres yields both.
    """
    if projects is not None:
        raw = raw.filter(is_in("project", projects))
    if quarters is not None:
        raw = raw.filter(is_in("quarter", quarters))
    if require_code:
        raw = raw.filter(F.col("packcode").isNotNull())
    if exclude_provinces:
        raw = raw.filter(not_in("province", exclude_provinces))
    rows = raw_transactions(raw, place=place, municipality=municipality, keep_price=place is not None)
    keys = [k for k in [*PLACE, "hospital"] if k in rows.columns]
    rows = lookup_matched(rows, place_map.select(*PLACE, "hospital", "pchc"), keys, "pchc")
    rows = lookup_matched(rows, market_def.select("atc3", "molecule", "market"), ["atc3", "molecule"], "market")
    return (
        rows.withColumn("packid", remap_prefix("packid", succession))
        .filter((F.col("units") > 0) & (F.col("sales") > 0))
        .select(*FACT_COLUMNS, *[c for c in ("_pos",) if c in rows.columns])
    )


def place_map(registry: DataFrame, name_columns: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Centre code by (place, name) from several name columns; the first code wins per name."""
    known = registry.filter(F.col("pchc").isNotNull())
    parts = [
        known.filter(F.col(n).isNotNull())
        .groupBy(*PLACE, F.col(n).alias("hospital"))
        .agg(F.min_by("pchc", row_order(order_by)).alias("pchc"))
        for n in name_columns
    ]
    return tag_rows(parts).select(*PLACE, "hospital", "pchc").distinct()


def centre_places(places: DataFrame) -> DataFrame:
    """First known place per centre, by position (`_pos`) or else with names in code order."""
    order = ["_pos"] if "_pos" in places.columns else [*PLACE, "hospital"]
    return places.groupBy("pchc").agg(*[first_known(c, order).alias(c) for c in PLACE])


def market_definition(listing: DataFrame, exclude_atc3: Sequence[str] = ("A10C", "A10D")) -> DataFrame:
    return listing.filter(not_in("atc3", exclude_atc3)).select("atc3", "molecule", "market").distinct()


def combine_panels(*facts: DataFrame, parts: int | None = None) -> DataFrame:
    """Stack the sources, give every centre its first known place, sum to the fact key.

    The row order behind "first" is: source position, then the row's position in its files
    if all facts carry it (`_pos`), else the fact's business key. A transaction present in
    two sources counts twice. The facts move once, dealt by centre: it is part of the fact
    key, so they are placed and summed where they are, and none are written between. Facts
    of one place leave a task together, which takes fewer bytes. With `parts`, large facts
    are dealt into twice as many: a task sorts its facts and groups them as well. A centre's
    facts are in one task.
    """
    placed = all("_pos" in f.columns for f in facts)
    stacked = tag_rows(facts).select(*FACT_COLUMNS, "_src", *(["_pos"] if placed else []))
    dealt = spread(stacked.sortWithinPartitions(F.xxhash64(*PLACE)), parts and 2 * parts, "pchc")
    order = ["_src", "_pos"] if placed else ["_src", "date", "market", "packid", *PLACE]
    centre = Window.partitionBy("pchc").orderBy(*[F.col(c).asc_nulls_last() for c in order])
    whole = centre.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    unified = dealt.withColumns({c: F.first(c, ignorenulls=True).over(whole) for c in PLACE})
    return sum_by(unified, FACT_KEYS, ["units", "sales"]).withColumn("flag", F.lit(0))


def channel_extract(
    raw: DataFrame,
    market_def: DataFrame,
    *,
    name_pattern: str,
    channel: str,
    place: Mapping[str, str] | None = None,
    quarters: Sequence[str] | None = None,
    municipality: Mapping[str, str] = MUNICIPALITY,
) -> DataFrame:
    """Facts of a second channel, recognised by the site name; units are value / price."""
    if quarters is not None:
        raw = raw.filter(is_in("quarter", quarters))
    raw = raw.filter(F.col("hospital_name").rlike(name_pattern))
    rows = raw_transactions(
        raw, place=place, municipality=municipality, units=ratio("value", "price"), keep_price=True
    )
    rows = lookup_matched(rows, market_def.select("atc3", "molecule", "market"), ["atc3", "molecule"], "market")
    return sum_by(rows, ["date", *PLACE, "market", "packid"], ["sales", "units"]).withColumns(
        {"channel": F.lit(channel), "flag_sample": F.lit(1)}
    )
