"""Growth roll-forward, moving annual totals and the assembled delivery."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelproj.functions import is_in, pad_code, quarter_shift, ratio, sum_known
from panelproj.operators.delivery import DELIVERY_COLUMNS, MEASURES
from panelproj.operators.dims import newest_attributes
from panelproj.operators.relational import na_join, replace_slice, sort_rows, sum_by, tag_rows, union_strict
from panelproj.sources import materialize

VALUE_MEASURES = ["value_lc", "value_lc_raw"]


def lead_growth(df: DataFrame, keys: Sequence[str], period: str = "date", tie_break: Sequence[str] = ()) -> DataFrame:
    """Growth of value and units from each row to the next row of its key in period order, a missing period last.

    Works on delivery rows, where a key has a handful of periods.
    """
    following = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in (period, *tie_break)])
    growth = df.select(
        *keys,
        ratio(F.lead("value_lc").over(following), "value_lc").alias("growth_sales"),
        ratio(F.lead("units").over(following), "units").alias("growth_units"),
    )
    return growth.filter(F.col("growth_sales").isNotNull())


def external_growth(external: DataFrame, previous: str, current: str, packid: str = "pack_id") -> DataFrame:
    """Pack growth of a wide external panel; only packs with finite growth of both measures."""
    growth = external.select(
        F.col(packid).alias("packid"),
        ratio(f"{current}_RENMINBI", f"{previous}_RENMINBI").alias("growth_sales_sup"),
        ratio(f"{current}_UNIT", f"{previous}_UNIT").alias("growth_units_sup"),
    )
    for c in ("growth_sales_sup", "growth_units_sup"):
        growth = growth.filter(F.abs(c) < float("inf"))
    return growth


def _apply_growth(rows: DataFrame, current: str) -> DataFrame:
    scaled: dict[str, Column] = {
        m: F.col(m) * F.col("growth_sales" if m in VALUE_MEASURES else "growth_units") for m in MEASURES if m in rows.columns
    }
    out = rows.withColumns(scaled).withColumns({"quarter": F.lit(current[4:]), "date": F.lit(current)})
    out = out.filter((F.col("value_lc") > 0) & (F.col("units") > 0))
    return out.drop(*[c for c in out.columns if c.startswith("growth_")])


def growth_rollforward(
    current: DataFrame,
    history: DataFrame,
    external: DataFrame,
    *,
    missing_city: str,
    proxy_city: str,
    quarter: str,
    channel: str = "CHC",
    keys: Sequence[str] = ("market", "category_2", "packid"),
) -> DataFrame:
    """The missing city's new quarter: its last quarter times the proxy city's pack growth,
    or the external panel's where the proxy has none."""
    previous = quarter_shift(quarter, -1)
    quarterly = (F.col("period_type") == "QTR")
    past = history.filter(quarterly & (F.col("date") == previous)).withColumn("packid", pad_code("packid"))
    proxy = (F.col("channel") == channel) & (F.col("city") == proxy_city)
    recent = current.filter(quarterly & (F.col("date") == quarter))
    columns = [*keys, "date", "value_lc", "units"]
    growth = lead_growth(
        union_strict(past.filter(proxy).select(*columns), recent.filter(proxy).select(*columns)), keys, tie_break=("value_lc", "units")
    )
    rows = na_join(past.filter(F.col("city") == missing_city), growth, keys, "left")
    rows = na_join(rows, external_growth(external, previous, quarter), ["packid"], "left")
    rows = rows.withColumns(
        {
            "growth_sales": F.coalesce("growth_sales", "growth_sales_sup"),
            "growth_units": F.coalesce("growth_units", "growth_units_sup"),
        }
    )
    return _apply_growth(rows, quarter)


def self_rollforward(
    history: DataFrame,
    *,
    molecule: str,
    quarter: str,
    keys: Sequence[str] = ("channel", "city", "category_2", "molecule"),
) -> DataFrame:
    """New quarter of a residual class: its last quarter times its own last growth."""
    previous, before = quarter_shift(quarter, -1), quarter_shift(quarter, -2)
    residual = history.filter((F.col("period_type") == "QTR") & (F.col("molecule") == molecule))
    residual = residual.filter(is_in("date", [before, previous])).withColumn("packid", pad_code("packid"))
    growth = lead_growth(residual, keys, tie_break=("packid", "value_lc"))
    return _apply_growth(na_join(residual.filter(F.col("date") == previous), growth, keys, "left"), quarter)


def complete_quarter(current: DataFrame, missing_city: str, *recomputed: DataFrame) -> DataFrame:
    return replace_slice(current, "city", [missing_city], *recomputed)


# Row orders of the inputs: a delivered table, rows of a quarter as they are made, grouped rows.
DELIVERED = ["channel", "-period_type", "date", "city_en", "market", "packid"]
MADE = ["channel", "date", "city", "market", "packid"]
GROUPED = [c for c in DELIVERY_COLUMNS if c not in MEASURES]


def order_keys(df: DataFrame, orders: Mapping[int, Sequence[str]]) -> tuple[DataFrame, list[str]]:
    """Add sort columns that give each input (`_src`, or all rows if there is none) its own row order.

    Returns the frame and the names to order by. Period types are QTR and MAT; "-period_type"
    puts QTR first. Text sorts as text, so numbers only break ties.
    """
    given = {src: [k for k in keys if k.lstrip("-") in df.columns] for src, keys in orders.items()}

    def key(name: str) -> Column:
        if name == "-period_type":
            return F.when(F.col("period_type") == "QTR", "0").when(F.col("period_type") == "MAT", "1")
        return F.col(name).cast("string")

    tagged, names = "_src" in df.columns, []
    for i in range(max(len(keys) for keys in given.values())):
        value: Column = F.lit(None).cast("string")
        for src, keys in given.items():
            if i < len(keys):
                value = F.when(F.col("_src") == src, key(keys[i])).otherwise(value) if tagged else key(keys[i])
        df = df.withColumn(f"_k{i}", value)
        names.append(f"_k{i}")
    return df, ["_src", *names] if tagged else names


def moving_annual_total(history: DataFrame, current: DataFrame, *, quarter: str) -> DataFrame:
    """Sum of the current and the three previous quarters, newest attributes per city and pack.

    The four quarters feed the attributes and the sums, so they are written once.
    """
    periods = [quarter_shift(quarter, -i) for i in (1, 2, 3)]
    past = history.filter((F.col("period_type") == "QTR") & is_in("date", periods)).withColumn("packid", pad_code("packid"))
    four = materialize(tag_rows([past, current]), "four-quarters")
    ordered, order = order_keys(four, {0: DELIVERED, 1: MADE})
    rows = newest_attributes(
        ordered,
        ["city", "packid"],
        order,
        last=[c for c in ("product_name", "product", "corp", "corp_cn") if c in past.columns],
        first_known=[c for c in ("route",) if c in past.columns],
        last_known=[c for c in ("tender_round",) if c in past.columns],
    ).withColumns(
        {"period_type": F.lit("MAT"), "year": F.lit(quarter[:4]), "quarter": F.lit(quarter[4:]), "date": F.lit(quarter)}
    )
    keys = [c for c in DELIVERY_COLUMNS if c in rows.columns and c not in MEASURES]
    return sum_by(rows, keys, [m for m in MEASURES if m in rows.columns])


def quarter_index(date: str = "date") -> Column:
    """Quarters of "2020Q4" as consecutive numbers; anything else is missing."""
    text = F.col(date)
    number = F.substring(text, 1, 4).try_cast("int") * 4 + F.substring(text, 6, 1).try_cast("int") - 1
    return F.when(text.rlike("^[0-9]{4}Q[1-4]$"), number)


def moving_annual_series(history: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Moving annual totals of every quarter from the first to the last one of the data, in one pass.

    A quarter's rows count for the total of that quarter and of the three after it, so a key
    has a total wherever it had rows in the last four quarters, and a missing quarter adds
    nothing. `n_quarters` tells how many of the four have rows of the key. Growth compares
    with the total four quarters earlier by the period's value, not by its row: NULL where
    the key has no total then.
    """
    quarters = history.filter(F.col("period_type") == "QTR").withColumn("__q", quarter_index()).filter(F.col("__q").isNotNull())
    sums = quarters.groupBy(*keys, "__q").agg(*[sum_known(m).alias(m) for m in measures])
    ends = quarters.agg(F.max("__q").alias("__end"))  # one row
    spread = sums.crossJoin(F.broadcast(ends)).withColumn("__to", F.explode(F.sequence("__q", F.least(F.col("__q") + 3, "__end"))))
    totals = spread.groupBy(*keys, "__to").agg(F.count(F.lit(1)).alias("n_quarters"), *[sum_known(m).alias(m) for m in measures])
    year_before = Window.partitionBy(*keys).orderBy("__to").rangeBetween(-4, -4)
    growth = [ratio(m, F.first(m).over(year_before)).alias(f"{m}_growth") for m in measures]
    label = F.concat(F.floor(F.col("__to") / 4).cast("string"), F.lit("Q"), (F.col("__to") % 4 + 1).cast("string"))
    return totals.select(*keys, label.alias("date"), "n_quarters", *measures, *growth)


def assemble_delivery(history: DataFrame, current: DataFrame, mat: DataFrame, *, sort: bool = True) -> DataFrame:
    """History, new quarter and moving totals with the newest attributes per pack, in delivery order.

    The stacked rows feed the attributes and the table, so they are written once.
    """
    stacked = materialize(tag_rows([history.withColumn("packid", pad_code("packid")), current, mat]), "stacked")
    ordered, order = order_keys(stacked, {0: DELIVERED, 1: MADE, 2: GROUPED})
    rows = newest_attributes(
        ordered,
        ["packid"],
        order,
        last=[c for c in ("product_name", "product", "corp", "corp_cn") if c in stacked.columns],
        last_known=[c for c in ("product_cn",) if c in stacked.columns],
        first_known=[c for c in ("route",) if c in stacked.columns],
    ).select(*[c for c in DELIVERY_COLUMNS if c in stacked.columns])
    if not sort:
        return rows
    return sort_rows(rows, "channel", "-period_type", "date", "city_en", "market", "packid")
