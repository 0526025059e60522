"""Quantiles from sketches that are kept for each period and merged later.

A period's values are read once, when the period is new; a cap over many periods merges
their sketches. `relational.weighted_quantile` is the exact form. With size k the share of
values below a sketched quantile is off by about 2.7 / k (99 % of the time, more for
several merges never), whatever the number of values.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIZE = 800


def period_sketches(df: DataFrame, value: str, period: str | Sequence[str], size: int = SIZE) -> DataFrame:
    """One row a period: its number of known values and their sketch (binary, mergeable)."""
    keys = [period] if isinstance(period, str) else list(period)
    known = df.filter(F.col(value).isNotNull()).withColumn(value, F.col(value).cast("double"))
    return known.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(value, size).alias("sketch"))


def merged_quantile(sketches: DataFrame, q: float, *, size: int = SIZE) -> DataFrame:
    """One row: `quantile` over all periods given, and `n`, the values behind it."""
    merged = sketches.agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", size).alias("sketch"))
    return merged.select(F.kll_sketch_get_quantile_double("sketch", F.lit(q)).alias("quantile"), "n")


def rank_error(df: DataFrame, value: str, quantile: DataFrame, q: float) -> DataFrame:
    """One row: how far the shares of values below and up to a quantile lie from q, 0 if q is between them."""
    known = df.filter(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("v"))
    against = known.join(F.broadcast(quantile.select("quantile")), F.lit(True))  # one row
    shares = against.agg((F.count_if(F.col("v") < F.col("quantile")) / F.count("v")).alias("low"), (F.count_if(F.col("v") <= F.col("quantile")) / F.count("v")).alias("high"))
    return shares.select(F.greatest(F.col("low") - q, q - F.col("high"), F.lit(0.0)).alias("rank_error"))
