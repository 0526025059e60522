"""Impute a market that a region does not report, from its nearest centres elsewhere."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelproj.functions import sum_known
from panelproj.operators.nearest import knn_join
from panelproj.operators.relational import na_join, spread, sum_by
from panelproj.operators.reshape import pivot_wider
from panelproj.operators.standardize import PLACE
from panelproj.sources import materialize


def centre_months(facts: DataFrame, months: Sequence[str] | None = None, parts: int | None = None) -> DataFrame:
    """Centre x month sales, 0 where nothing was sold.

    Rows are de-duplicated without market and units first, so a pack listed in two
    markets counts once. `parts` is the number of partitions for large facts; they are dealt by
    centre, so that a task holds wide rows of its own centres only.
    """
    once = spread(facts.select("date", *PLACE, "pchc", "packid", "sales"), parts, *PLACE, "pchc").distinct()
    monthly = sum_by(once, [*PLACE, "pchc", "date"], ["sales"])
    return pivot_wider(monthly, [*PLACE, "pchc"], "date", ["sales"], members=months, fill=0.0)


def scaled_features(matrix: DataFrame, is_target: Column, months: Sequence[str]) -> DataFrame:
    """Divide each month by its standard deviation over the donors; a constant month weighs nothing.

    Reads one row of deviations (one number per month) to the driver.
    """
    spread = matrix.filter(~is_target).agg(*[F.stddev_samp(f"`{m}`").alias(m) for m in months]).first()
    scaled = {m: (F.col(f"`{m}`") / spread[m]) if spread[m] else F.lit(0.0) for m in months}
    return matrix.withColumns(scaled)


def knn_neighbours(
    facts: DataFrame, *, target: str, target_column: str = "province", k: int = 3, months: Sequence[str] | None = None, parts: int | None = None
) -> DataFrame:
    """(place, pchc, rank, knn_pchc, distance) for every centre of the target region."""
    matrix = materialize(centre_months(facts, months, parts), "centre-months")
    months = [c for c in matrix.columns if c not in (*PLACE, "pchc")]
    is_target = F.coalesce(F.col(target_column) == target, F.lit(False))
    scaled = scaled_features(matrix, is_target, months)
    # A centre is asked for at each of its places; missing parts of a place count as well.
    unit = F.to_json(F.array(*PLACE, "pchc"), {"ignoreNullFields": "false"})
    asked = scaled.filter(is_target).withColumn("__unit", unit)
    pairs = knn_join(asked.select(F.col("__unit").alias("pchc"), *[f"`{m}`" for m in months]), scaled.filter(~is_target), months, "pchc", k)
    asked = asked.select("__unit", *PLACE, "pchc")
    return na_join(asked, pairs, [("__unit", "target")], "inner").withColumnRenamed("donor", "knn_pchc").drop("__unit")


def knn_weights(neighbours: DataFrame, k: int = 3, normalize: str = "sequential") -> DataFrame:
    """Inverse-distance weights, one row per neighbour.

    `sequential` divides the first weight by the sum, the second by the sum that
    already holds the changed first, and so on (the weights then do not add up to 1);
    `proper` divides all by the original sum. With fewer than k neighbours the sums are
    of those that exist.
    """
    unit = [*PLACE, "pchc"]
    raw = neighbours.withColumn("w", 1 / (F.col("distance") + 1))
    if normalize == "proper":
        total = F.sum("w").over(Window.partitionBy(*unit))
        return raw.select(*unit, "rank", "knn_pchc", (F.col("w") / total).alias("knn_weight"))
    ranks = range(1, k + 1)
    wide = raw.groupBy(*unit).agg(
        *[F.max(F.when(F.col("rank") == r, F.col("w"))).alias(f"w{r}") for r in ranks],
        *[F.max(F.when(F.col("rank") == r, F.col("knn_pchc"))).alias(f"p{r}") for r in ranks],
    )
    for r in ranks:
        total = sum((F.coalesce(F.col(f"w{i}"), F.lit(0.0)) for i in ranks[1:]), F.col("w1"))
        wide = wide.withColumn(f"w{r}", F.col(f"w{r}") / total)
    entries = [
        F.struct(F.lit(r).alias("rank"), F.col(f"p{r}").alias("knn_pchc"), F.col(f"w{r}").alias("knn_weight"))
        for r in ranks
    ]
    return wide.select(*unit, F.inline(F.array(*entries))).filter(F.col("knn_pchc").isNotNull())


def knn_impute(
    facts: DataFrame,
    *,
    target: str,
    market: str,
    target_column: str = "province",
    k: int = 3,
    normalize: str = "sequential",
    months: Sequence[str] | None = None,
    parts: int | None = None,
) -> DataFrame:
    """Facts of the missing market for the target's centres, flag 1."""
    facts = materialize(facts, "panel")
    weights = knn_weights(
        knn_neighbours(facts, target=target, target_column=target_column, k=k, months=months, parts=parts), k, normalize
    ).drop("rank")
    outside = ~F.coalesce(F.col(target_column) == target, F.lit(False))
    offered = facts.filter(outside & (F.col("market") == market))
    keys = ["year", "date", "quarter"]
    offered = sum_by(offered, [*keys, F.col("pchc").alias("knn_pchc"), "market", "packid"], ["units", "sales"])
    return (
        na_join(weights, offered, ["knn_pchc"], "inner")
        .groupBy(*keys, *PLACE, "pchc", "market", "packid")
        .agg(*[sum_known(F.col(m) * F.col("knn_weight")).alias(m) for m in ("units", "sales")])
        .withColumn("flag", F.lit(1))
    )
