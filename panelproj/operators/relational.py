"""Joins, unions and group fills with explicit missing-value rules.

Sizes are left to adaptive execution: a side is broadcast only when its measured
size is under the session's threshold, otherwise both sides are shuffled and skewed
partitions are split. Group fills aggregate first (with map-side combine) and join
the one-row-per-key result back, so a hot key is never gathered in one task.
"""

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelproj.functions.missing import is_in, not_in, sum_known
from panelproj.sources import materialize

Keys = Sequence[str | tuple[str, str]]
REPEATS = 10_000  # rows that one row of a repeated join becomes at most


def na_join(left: DataFrame, right: DataFrame, on: Keys, how: str = "inner") -> DataFrame:
    """Equi-join in which a missing key matches a missing key.

    `on` lists names, or (left, right) pairs; the right-hand keys are dropped.
    """
    pairs = [(k, k) if isinstance(k, str) else k for k in on]
    renamed = right.withColumnsRenamed({r: f"__key_{i}" for i, (_, r) in enumerate(pairs)})
    conditions = [F.col(l).eqNullSafe(F.col(f"__key_{i}")) for i, (l, _) in enumerate(pairs)]
    joined = left.join(renamed, reduce(Column.__and__, conditions), how)
    if how in ("left_semi", "left_anti"):
        return joined
    return joined.drop(*[f"__key_{i}" for i in range(len(pairs))])


def spread(df: DataFrame, parts: int | None, *keys: str) -> DataFrame:
    """Hash-partitioned by the keys into so many parts; unchanged where no number is given.

    A number that grows with the rows bounds what one task sorts or groups, whatever the
    session's number of shuffle partitions.
    """
    return df.repartition(parts, *keys) if parts else df


def spread_evenly(df: DataFrame, parts: int | None) -> DataFrame:
    """Dealt by turns into so many parts; unchanged where no number is given."""
    return df.repartition(parts) if parts else df


def na_join_repeated(left: DataFrame, right: DataFrame, on: Keys, parts: int | None = None) -> DataFrame:
    """Inner `na_join` with a right side whose rows repeat: the same rows, with their repeats.

    Equal right rows meet the left ones once, with their number, cut into pieces of REPEATS;
    the joined rows are dealt evenly into so many parts and multiply there. So a few frequent
    keys keep all cores busy, and no task sorts or buffers the rows that they make.
    """
    times, one = "__times", "__one"
    counted = right.groupBy(*right.columns).agg(F.count(F.lit(1)).alias(times))
    pieces = F.transform(F.sequence(F.lit(0), F.col(times) - 1, F.lit(REPEATS).cast("long")), lambda i: F.least(F.col(times) - i, F.lit(REPEATS)).cast("int"))
    joined = spread_evenly(na_join(left, counted.withColumn(times, F.explode(pieces)), on, "inner"), parts)
    return joined.withColumn(one, F.explode(F.array_repeat(F.lit(0), F.col(times)))).drop(times, one)


def lookup_matched(left: DataFrame, right: DataFrame, on: Keys, found: str) -> DataFrame:
    """Look a column up and keep the rows for which it is known."""
    return na_join(left, right.filter(F.col(found).isNotNull()), on, "inner")


def na_anti(left: DataFrame, right: DataFrame, on: Keys) -> DataFrame:
    """Rows of `left` whose key does not occur in `right`."""
    rights = [k if isinstance(k, str) else k[1] for k in on]
    return na_join(left, right.select(*rights).distinct(), on, "left_anti")


def flag_membership(left: DataFrame, right: DataFrame, on: Keys, flag: str) -> DataFrame:
    """Add a 0/1 column telling whether the key occurs in `right`."""
    rights = [k if isinstance(k, str) else k[1] for k in on]
    marked = right.select(*rights).distinct().withColumn("__hit", F.lit(1))
    return (
        na_join(left, marked, on, "left")
        .withColumn(flag, F.coalesce(F.col("__hit"), F.lit(0)))
        .drop("__hit")
    )


def union_strict(*frames: DataFrame) -> DataFrame:
    """Union by name; absent columns become NULL, differing types are an error."""
    types: dict[str, str] = {}
    for frame in frames:
        for name, dtype in frame.dtypes:
            if types.setdefault(name, dtype) != dtype:
                raise TypeError(f"column {name!r} is {types[name]} in one input and {dtype} in another")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def tag_rows(frames: Sequence[DataFrame]) -> DataFrame:
    """Union that records the position of each row's input as `_src`."""
    return union_strict(*[f.withColumn("_src", F.lit(i)) for i, f in enumerate(frames)])


def replace_slice(df: DataFrame, column: str, members: Sequence, *new: DataFrame) -> DataFrame:
    """Drop the rows of some members and append recomputed ones."""
    return union_strict(df.filter(not_in(column, members)), *new)


def sum_by(df: DataFrame, keys: Sequence[str | Column], measures: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[sum_known(m).alias(m) for m in measures])


def fill_from_group(df: DataFrame, keys: Sequence[str], values: Mapping[str, Column]) -> DataFrame:
    """Write one aggregate per group to all rows of the group (replacing same-named columns)."""
    per_group = df.groupBy(*keys).agg(*[v.alias(n) for n, v in values.items()])
    order = list(df.columns) + [n for n in values if n not in df.columns]
    return na_join(df.drop(*values), per_group, keys, "inner").select(*order)


def first_of_equal(df: DataFrame, columns: Sequence[str | Column], at: str = "_pos") -> DataFrame:
    """Distinct rows of some columns, with the first position of equal ones if the frame has positions."""
    if at not in df.columns:
        return df.select(*columns).distinct()
    placed = df.select(*columns, at)
    return placed.groupBy(*[f"`{c}`" for c in placed.columns if c != at]).agg(F.min(at).alias(at))


def keep_repeated(df: DataFrame, keys: Sequence[str], count: str = "n") -> DataFrame:
    """Rows whose key occurs more than once, with the number of occurrences."""
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count)).filter(F.col(count) > 1)
    return na_join(df, repeated, keys, "inner")


def keep_minimum(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Rows that hold the group's smallest value; all ties stay."""
    least = df.groupBy(*keys).agg(F.min(value).alias("__least"))
    return na_join(df, least, keys, "inner").filter(F.col(value) == F.col("__least")).drop("__least")


def exclude_class(df: DataFrame, class_col: str, class_value: str, product_col: str, allowed: Sequence[str]) -> DataFrame:
    """Drop one class except for the products of an allow-list."""
    return df.filter(~((F.col(class_col) == class_value) & ~is_in(product_col, allowed)))


def drop_by_prefix(df: DataFrame, prefix: str) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.lower().startswith(prefix.lower())])


def sort_rows(df: DataFrame, *keys: str) -> DataFrame:
    """Global sort, missing values last; a leading '-' means descending."""
    return df.orderBy(
        *[F.col(k[1:]).desc_nulls_last() if k.startswith("-") else F.col(k).asc_nulls_last() for k in keys]
    )


def weighted_quantile(df: DataFrame, value: str, frequency: str, q: float, bins: int = 256) -> DataFrame:
    """One row: linearly interpolated quantile of values given with their counts, exact.

    The values are reduced to (value, count) pairs and written once. Approximate
    quantiles cut them into bins whose counts (at most `bins` numbers) reach the driver
    and tell which one or two bins hold the wanted ranks; only those are sorted.
    """
    pairs = df.filter(F.col(value).isNotNull()).groupBy(F.col(value).cast("double").alias("v"))
    pairs = materialize(pairs.agg(F.sum(frequency).cast("bigint").alias("n")), "quantile-pairs")
    empty = pairs.agg(F.lit(None).cast("double").alias("quantile"))
    cuts = pairs.agg(F.percentile_approx("v", [i / bins for i in range(1, bins)], 10000)).first()[0]
    if not cuts:
        return empty
    edges = F.array(*[F.lit(c) for c in sorted(set(cuts))])
    binned = pairs.withColumn("bin", F.size(F.filter(edges, lambda c: c < F.col("v"))))
    counts = sorted((r["bin"], r["n"]) for r in binned.groupBy("bin").agg(F.sum("n").alias("n")).collect())
    position = (sum(n for _, n in counts) - 1) * q
    low, high = math.floor(position), math.ceil(position)
    offsets, before = {}, 0
    for bin_id, n in counts:
        if before <= high and low < before + n:
            offsets[bin_id] = before
        before += n
    start: Column = F.lit(0)
    for bin_id, offset in offsets.items():
        start = F.when(F.col("bin") == bin_id, F.lit(offset)).otherwise(start)
    in_bin = Window.partitionBy("bin").orderBy("v")
    ranked = binned.filter(F.col("bin").isin(list(offsets))).withColumn("through", start + F.sum("n").over(in_bin))
    ends = ranked.agg(
        F.min(F.when(F.col("through") > low, F.col("v"))).alias("low"),
        F.min(F.when(F.col("through") > high, F.col("v"))).alias("high"),
    )
    return ends.select((F.col("low") + (F.col("high") - F.col("low")) * (position - low)).alias("quantile"))
