"""Average prices at six levels and the fallback from detailed to general."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelproj.functions import month_to_quarter, ratio
from panelproj.operators.relational import na_join, sum_by
from panelproj.sources import materialize

# Most detailed first.
PRICE_LEVELS = {
    "price_city_quarter": ["province", "city", "quarter"],
    "price_city_year": ["province", "city", "year"],
    "price_province_quarter": ["province", "quarter"],
    "price_province_year": ["province", "year"],
    "price_pack_quarter": ["quarter"],
    "price_pack_year": ["year"],
}


def _totals(facts: DataFrame) -> DataFrame:
    return sum_by(facts, ["packid", "quarter", "year", "province", "city"], ["sales", "units"])


def price_levels(facts: DataFrame) -> dict[str, DataFrame]:
    """One price table per level, all from the same pre-aggregate (written once to the shared folder)."""
    totals = materialize(_totals(facts), "price-totals")
    return {
        name: sum_by(totals, ["packid", *keys], ["sales", "units"]).select(
            "packid", *keys, ratio("sales", "units").alias(name)
        )
        for name, keys in PRICE_LEVELS.items()
    }


def price_level_table(facts: DataFrame) -> DataFrame:
    """All six levels in one frame and one pass (grouping sets over the pre-aggregate)."""
    totals = _totals(facts)
    columns = ["packid", "quarter", "year", "province", "city"]
    sets = [["packid", *keys] for keys in PRICE_LEVELS.values()]
    ids = {}
    for name, keys in zip(PRICE_LEVELS, sets, strict=True):
        ids[name] = sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in keys)
    level = F.coalesce(*[F.when(F.col("gid") == i, F.lit(name)) for name, i in ids.items()])
    return (
        totals.groupingSets(sets, *columns)
        .agg(F.grouping_id().alias("gid"), ratio(F.sum("sales"), F.sum("units")).alias("price"))
        .select(level.alias("level"), *columns, "price")
    )


def update_price(facts: DataFrame, price_source: DataFrame) -> DataFrame:
    """Give each fact the most detailed known price and restate units as sales / price.

    The fallback is resolved once per (pack, city, quarter), then joined to the facts.
    """
    facts = materialize(facts, "unpriced")
    dated = facts.withColumns({"year": F.substring("date", 1, 4), "quarter": month_to_quarter("date")})
    keys = ["packid", "province", "city", "quarter", "year"]
    resolved = dated.select(*keys).distinct()
    for name, table in price_levels(price_source).items():
        resolved = na_join(resolved, table, ["packid", *PRICE_LEVELS[name]], "left")
    resolved = resolved.select(*keys, F.coalesce(*PRICE_LEVELS).alias("price")).filter(F.col("price") > 0)
    return (
        na_join(dated, resolved, keys, "inner")
        .withColumn("units", ratio("sales", "price"))
        .filter((F.col("units") > 0) & (F.col("sales") > 0))
        .select(
            "channel", "year", "date", "quarter", "province", "city", "district", "market", "packid", "flag_sample",
            "price", "units", "sales",
        )
    )
