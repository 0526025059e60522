"""Data-quality reports on the assembled delivery."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelproj.functions import half_even, is_in, ratio, substring_between, sum_known
from panelproj.operators.dims import newest_attributes
from panelproj.operators.periods import DELIVERED, order_keys
from panelproj.operators.relational import exclude_class, keep_repeated, lookup_matched, na_join, sort_rows
from panelproj.operators.reshape import pivot_longer_split, pivot_wider

ATTRIBUTES = [
    "packid", "market", "atc3", "atc4", "category_1", "category_2", "molecule", "product_name", "product", "product_cn",
    "pack", "pack_form", "pack_strength", "pack_size", "route", "corp", "corp_cn", "manufacture_type", "originator",
]


def _present(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c in df.columns]


def uniformity_report(delivery: DataFrame) -> DataFrame:
    """Attribute combinations of packs that have more than one in a market, after harmonising."""
    ordered, order = order_keys(delivery, {0: DELIVERED})
    rows = newest_attributes(
        ordered,
        ["packid"],
        order,
        last=_present(delivery, ["product_name", "product", "corp", "corp_cn"]),
        first_known=_present(delivery, ["route"]),
    )
    return keep_repeated(rows.select(*_present(rows, ATTRIBUTES)).distinct(), ["packid", "market"])


def duplicate_key_check(delivery: DataFrame) -> DataFrame:
    """Attribute combinations that share (pack, market, city, date), as delivered."""
    columns = _present(delivery, [*ATTRIBUTES, "city", "date", "tender_round"])
    return keep_repeated(delivery.select(*columns).distinct(), ["packid", "market", "city", "date"])


def tender_coverage(tenders: DataFrame, delivery: DataFrame, *, sheet: int, molecules: Sequence[str] | None = None) -> DataFrame:
    """Does a winning pack, or at least its product, occur in the delivery of the city?"""
    asked = tenders.filter(F.col("sheet") == sheet)
    if molecules is not None:
        asked = asked.filter(is_in("molecule", molecules))
    asked = asked.withColumn("prodid", substring_between("packid", 1, 5))
    packs = delivery.select("city", "molecule", "packid").distinct().withColumn("flag_bid", F.lit(1))
    products = (
        delivery.select("city", "molecule", substring_between("packid", 1, 5).alias("prodid"))
        .distinct()
        .withColumn("flag_prod", F.lit(1))
    )
    found = na_join(asked, packs, ["city", "molecule", "packid"], "left")
    found = na_join(found, products, ["city", "molecule", "prodid"], "left")
    pack, product = F.col("flag_bid").isNotNull(), F.col("flag_prod").isNotNull()
    return found.withColumn(
        "existence",
        F.when(pack & product, "有").when(~pack & product, "Pack没有，产品有").when(~pack & ~product, "没有"),
    )


def benchmark_extract(
    external: DataFrame,
    market_def: DataFrame,
    *,
    ids: Sequence[str],
    years: Sequence[str] | None = None,
    tcm_class: str = "V03B",
    tcm_products: Sequence[str] = (),
    measures: Sequence[str] = ("UNIT", "SU", "RENMINBI"),
) -> DataFrame:
    """External wide panel -> long rows with a market, positive value and volume."""
    wide = [c for c in external.columns if c.upper().endswith(tuple(m.upper() for m in measures)) and c not in ids]
    long = pivot_longer_split(external, ids, wide, ("date", "measure"), "value")
    rows = pivot_wider(long, [*ids, "date"], "measure", ["value"], members=measures)
    rows = rows.withColumnsRenamed({"UNIT": "units", "SU": "counting_units", "RENMINBI": "value_lc"})
    rows = lookup_matched(rows, market_def.select("atc3", "molecule", "market"), ["atc3", "molecule"], "market")
    rows = rows.filter((F.col("units") > 0) & (F.col("value_lc") > 0))
    if years is not None:
        rows = rows.filter(F.substring("date", 1, 4).isin(list(years)))
    return exclude_class(rows, "atc3", tcm_class, "product", tcm_products)


def price_check_matrix(
    delivery: DataFrame, *, dates: Sequence[str] | None = None, sort: bool = True, as_lists: bool = True
) -> DataFrame:
    """Rounded average price per pack and quarter, best-selling packs of a market first.

    A cell is the sorted array of its prices. With as_lists=False it is the one price,
    and several are an error. One grouping gives all cells; without `dates` the distinct
    quarters are read first.
    """
    ids = _present(delivery, ["channel", "city", "market", "molecule", "product_name", "packid"])
    quarters = delivery.filter(F.col("period_type") == "QTR")
    price = half_even(ratio("value_lc", "units"))
    if dates is None:
        dates = sorted(r["date"] for r in quarters.select("date").distinct().collect())

    def cell(date: str) -> Column:
        value = F.when(F.col("date") == date, price)
        if as_lists:
            return F.array_sort(F.collect_set(value))
        several = F.raise_error(F.concat(F.lit(f"several prices in {date} of "), F.min("packid"))).cast("double")
        return F.when(F.min(value) < F.max(value), several).otherwise(F.max(value))

    matrix = quarters.groupBy(*ids).agg(*[cell(d).alias(d) for d in dates], sum_known("value_lc").alias("__sales"))
    if sort:
        matrix = sort_rows(matrix, "channel", "city", "market", "-__sales")
    return matrix.drop("__sales")
