"""Checks on inputs and results: lookups that multiply rows, rows in several sources, restated history."""

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from panelproj.operators.relational import Keys, na_join, spread, tag_rows

AUDIT = "lookup string, rows_in bigint, rows_out bigint, unmatched bigint, multiplied bigint"


class LookupAudit:
    """Lookups that count what they do while the plan runs.

    The counts are metrics of the job that computes the rows, so they cost no job of their
    own. `report` waits for that job; run an action on the last frame first.
    """

    def __init__(self) -> None:
        self._seen: list[tuple[str, Observation, Observation]] = []

    def lookup(self, left: DataFrame, right: DataFrame, on: Keys, name: str, *, keep_unmatched: bool = True) -> DataFrame:
        """Join that keeps the lookup's multiplicity, without sorting the rows; `right` holds the keys and the columns to look up."""
        before, after = Observation(f"{name}: rows in"), Observation(f"{name}: rows out")
        rights = [k if isinstance(k, str) else k[1] for k in on]
        counts = right.groupBy(*rights).agg(F.count(F.lit(1)).alias("__n"))
        joined = na_join(left.observe(before, F.count(F.lit(1)).alias("rows_in")), na_join(right, counts, rights).hint("shuffle_hash"), on, "left")
        many = F.col("__n") > 1
        joined = joined.observe(
            after,
            F.count(F.lit(1)).alias("rows_out"),
            F.count_if(F.col("__n").isNull()).alias("unmatched"),
            # each of a row's n matches is one n-th of the row
            F.coalesce(F.round(F.sum(F.when(many, 1 / F.col("__n")))), F.lit(0.0)).cast("bigint").alias("multiplied"),
        )
        self._seen.append((name, before, after))
        return (joined if keep_unmatched else joined.filter(F.col("__n").isNotNull())).drop("__n")

    def report(self, spark: SparkSession) -> DataFrame:
        """lookup, rows_in, rows_out (unmatched rows stay in it), unmatched, multiplied (rows with several matches)."""
        rows = []
        for name, before, after in self._seen:
            got = _counts(before) | _counts(after)
            rows.append((name, *(got.get(c, 0) for c in ("rows_in", "rows_out", "unmatched", "multiplied"))))
        return spark.createDataFrame(rows, AUDIT)


def _counts(seen: Observation) -> dict:
    """The metrics of a plan; adaptive execution drops a part that turned out to have no rows, and its metrics with it."""
    try:
        return seen.get
    except Py4JJavaError:
        return {}


def cross_source_duplicates(sources: Sequence[DataFrame], keys: Sequence[str], parts: int | None = None) -> DataFrame:
    """Keys that occur in several sources, with their count in each (`n_0`, `n_1`, ...) and `surplus`.

    A bag intersection in one shuffle: `surplus` counts the rows beyond those of the source
    that has the key most often, that is what would go if the sources were merged by maximum. `parts` is the number of
    partitions of that shuffle where the sources are large.
    """
    names = [f"n_{i}" for i in range(len(sources))]
    tagged = tag_rows([s.select(*keys) for s in sources])
    counts = spread(tagged, parts, *keys).groupBy(*keys).agg(*[F.count_if(F.col("_src") == i).alias(n) for i, n in enumerate(names)])
    total: Column = sum((F.col(n) for n in names[1:]), F.col(names[0]))
    most = F.greatest(*names) if len(names) > 1 else F.col(names[0])
    return counts.withColumn("surplus", total - most).filter(F.col("surplus") > 0)


def restatement_report(old: DataFrame, new: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Keys whose rows differ between two versions: added, gone or changed, with the sums before and after.

    Versions are stacked and grouped once, so a missing key equals a missing key. Rows of
    one key are compared by their number and sums.
    """
    stacked = tag_rows([old.select(*keys, *measures), new.select(*keys, *measures)])
    version = lambda i, value: F.when(F.col("_src") == i, value)
    sums = [F.sum(version(i, F.col(m))).alias(f"{m}_{when}") for m in measures for i, when in enumerate(("before", "after"))]
    n = [F.count_if(F.col("_src") == i).alias(f"rows_{when}") for i, when in enumerate(("before", "after"))]
    grouped = stacked.groupBy(*keys).agg(*n, *sums)
    same: Column = F.col("rows_before") == F.col("rows_after")
    for m in measures:
        same = same & F.col(f"{m}_before").eqNullSafe(F.col(f"{m}_after"))
    status = F.when(F.col("rows_before") == 0, "added").when(F.col("rows_after") == 0, "gone").when(~same, "changed")
    return grouped.withColumn("status", status).filter(F.col("status").isNotNull())
