"""Nearest-donor joins.

Scalar case: targets and donors meet on their sorted values, never pairwise. Within
a block the donors' quantiles cut the value range into bins; each bin is scanned in
order by its own task and takes the neighbouring bins' edge donors from a table with
one row per bin.

Vector case: exact k nearest neighbours with pivot cells. A triangle-inequality bound
per target decides which cells can hold a neighbour; cells are packed and split into blocks
of bounded size, and only the k best candidates per block leave a task.
"""

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelproj.operators.relational import na_join, spread
from panelproj.sources import materialize


def value_bins(points: DataFrame, by: str, per_bin: int = 4096, most: int = 1024) -> DataFrame:
    """Add `bin`: quantile ranges of `v` within each block, as many as the block's size asks for.

    Of `most` - 1 quantiles every n-th is a cut, so that a bin holds about `per_bin`
    points while the block has at most per_bin x most of them.
    """
    quantiles = F.percentile_approx("v", [i / most for i in range(1, most)], F.lit(10000))
    blocks = points.groupBy(by).agg(F.count(F.lit(1)).alias("points"), quantiles.alias("cuts"))
    step = F.greatest(F.ceil(F.lit(most) * per_bin / F.col("points")), F.lit(1))
    blocks = blocks.select(by, F.filter("cuts", lambda _, i: (i + 1) % step == 0).alias("cuts"))
    binned = na_join(points, blocks, [by], "inner")
    return binned.withColumn("bin", F.size(F.filter("cuts", lambda c: c < F.col("v")))).drop("cuts")


def nearest_values(targets: DataFrame, donors: DataFrame, by: str, value: str, per_bin: int = 4096) -> DataFrame:
    """(by, value, donor_value): each target value's nearest donor values in its block.

    Two donor values at the same distance are both returned. Blocks without donors
    give no row. The bins follow targets and donors together, so targets far outside the
    donors' range are spread as well.
    """
    asked = targets.select(by, F.col(value).alias("v")).distinct()
    offered = donors.select(by, F.col(value).alias("v")).distinct()
    points = asked.withColumn("donor", F.lit(None).cast("double")).unionByName(offered.withColumn("donor", F.col("v")))
    points = value_bins(points, by, per_bin)
    in_order = Window.partitionBy(by).orderBy("bin")
    spans = points.groupBy(by, "bin").agg(F.min("donor").alias("low"), F.max("donor").alias("high"))
    spans = spans.withColumns(
        {
            "below": F.max("high").over(in_order.rowsBetween(Window.unboundedPreceding, -1)),
            "above": F.min("low").over(in_order.rowsBetween(1, Window.unboundedFollowing)),
        }
    ).drop("low", "high")
    up = Window.partitionBy(by, "bin").orderBy("v")
    down = Window.partitionBy(by, "bin").orderBy(F.col("v").desc())
    scanned = points.withColumns(
        {"below_in": F.max("donor").over(up), "above_in": F.min("donor").over(down)}
    ).filter(F.col("donor").isNull())
    near = na_join(scanned, spans, [by, "bin"], "inner").select(
        by,
        "v",
        F.coalesce("below_in", "below").alias("below"),
        F.coalesce("above_in", "above").alias("above"),
    )
    to_below, to_above = F.col("v") - F.col("below"), F.col("above") - F.col("v")
    chosen = F.array_distinct(
        F.array_compact(
            F.array(
                F.when(F.col("above").isNull() | (to_below <= to_above), F.col("below")),
                F.when(F.col("below").isNull() | (to_above <= to_below), F.col("above")),
            )
        )
    )
    return near.select(by, F.col("v").alias(value), F.explode(chosen).alias("donor_value"))


def nearest_in_block(targets: DataFrame, donors: DataFrame, by: str, value: str, donor_value: str) -> DataFrame:
    """Join every target to all donors of its block at the smallest absolute distance.

    `donors` names its block `by` too and its value `donor_value`; its other columns
    must differ from the targets'. Both sides are read several times, so give written frames
    or cheap selections of them.
    """
    near = nearest_values(targets, donors.select(by, F.col(donor_value).alias(value)), by, value)
    paired = na_join(targets, near, [by, value], "inner")
    return na_join(
        paired.withColumnRenamed("donor_value", donor_value), donors, [by, donor_value], "inner"
    )


MATRIX = 4_000_000  # numbers in one array of differences (32 MB)
MOST_TASKS = 4096  # of one join


def _gaps(vectors: np.ndarray, others: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Distances of all vectors to all others, in chunks of bounded memory: (first row, distances)."""
    step = max(1, MATRIX // max(1, others.size))
    for lo in range(0, len(vectors), step):
        part = vectors[lo : lo + step]
        yield lo, np.sqrt(((part[:, None, :] - others[None, :, :]) ** 2).sum(axis=2))


def _within_kth(vectors: np.ndarray, others: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs that can be among a vector's k nearest, with their exact distance, in chunks: (first row, rows, columns, distances).

    Products of the vectors tell which pairs these are, with a slack far above their rounding.
    """
    last, sizes = min(k, len(others)) - 1, (others**2).sum(axis=1)
    step, few = max(1, MATRIX // len(others)), max(1, MATRIX // max(1, others.shape[1]))
    for lo in range(0, len(vectors), step):
        part = vectors[lo : lo + step]
        lengths = (part**2).sum(axis=1)
        rough = lengths[:, None] + sizes - 2 * (part @ others.T)
        bound = np.partition(rough, last, axis=1)[:, last] + 1e-9 * (lengths + sizes.max())
        row, column = np.nonzero(~(rough > bound[:, None]))
        gaps = [np.sqrt(((part[row[i : i + few]] - others[column[i : i + few]]) ** 2).sum(axis=1)) for i in range(0, len(row), few)]
        yield lo, row, column, np.concatenate(gaps)


def _bins(pivots: np.ndarray, counts: np.ndarray, block: int) -> Callable[[Column], Column]:
    """The bin of a cell: cells in the order of their distance from the first pivot, about a block of donors together.

    A target is sent once to a bin, however many of its cells it asks for.
    """
    order = np.argsort(np.sqrt(((pivots - pivots[0]) ** 2).sum(axis=1)), kind="stable")
    bins = np.empty(len(pivots), dtype=int)
    bins[order] = (np.cumsum(counts[order]) - counts[order]) // block
    numbers = F.array(*[F.lit(int(b)) for b in bins])
    return lambda cell: F.get(numbers, cell)


def _assign(pivots: np.ndarray):
    """Batch function: nearest pivot of each vector."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            found = [(gaps.argmin(axis=1), gaps.min(axis=1)) for _, gaps in _gaps(np.stack(batch["vec"].to_numpy()), pivots)]
            yield batch.assign(cell=np.concatenate([c for c, _ in found]).astype("int32"), gap=np.concatenate([g for _, g in found]))

    return run


def _candidate_cells(pivots: np.ndarray, counts: np.ndarray, radii: np.ndarray, k: int):
    """Batch function: the cells that can hold one of the k nearest donors of a target."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            rows: list[np.ndarray] = []
            for _, gaps in _gaps(np.stack(batch["vec"].to_numpy()), pivots):
                farthest = gaps + radii
                order = np.argsort(farthest, axis=1, kind="stable")
                enough = (np.cumsum(counts[order], axis=1) < k).sum(axis=1)
                last = order[np.arange(len(order)), np.minimum(enough, order.shape[1] - 1)]
                bound = farthest[np.arange(len(order)), last]
                # A hair of slack keeps rounding from excluding a donor at the bound.
                inside = gaps - radii <= (bound * (1 + 1e-9) + 1e-9)[:, None]
                rows.extend(np.flatnonzero(row).astype("int32") for row in inside)
            yield batch.assign(cells=rows)

    return run


def _block_best(k: int):
    """Cogroup function: the k best donors of one block for each target of one block."""

    def run(targets: pd.DataFrame, donors: pd.DataFrame) -> pd.DataFrame:
        if targets.empty or donors.empty:
            return pd.DataFrame({"target": pd.Series(dtype=object), "donor": pd.Series(dtype=object), "distance": pd.Series(dtype=float)})
        donors = donors.sort_values("donor", kind="stable")
        names, asked = donors["donor"].to_numpy(), targets["target"].to_numpy()
        space, parts = np.stack(donors["vec"].to_numpy()), []
        for lo, row, column, gaps in _within_kth(np.stack(targets["vec"].to_numpy()), space, k):
            # Donors are in name order, so their position breaks ties by name.
            order = np.lexsort((column, gaps, row))
            row, column, gaps = row[order], column[order], gaps[order]
            best = np.arange(len(row)) - np.searchsorted(row, row) < k
            parts.append(pd.DataFrame({"target": asked[lo + row[best]], "donor": names[column[best]], "distance": gaps[best]}))
        return pd.concat(parts, ignore_index=True)

    return run


def knn_join(
    targets: DataFrame, donors: DataFrame, features: Sequence[str], key: str, k: int = 3, *, cells: int | None = None, block: int = 16384
) -> DataFrame:
    """(target, rank, donor, distance): exact k nearest donors by Euclidean distance.

    Ties go to the smaller donor key. Runs jobs while building: `cells` pivot vectors (by
    default the square root of the number of donors, at most 4096) and cell statistics
    reach the driver; both sides are written once to the shared folder so the statistics
    describe exactly the rows that are joined.
    """
    spark = targets.sparkSession
    vec = F.array(*[F.col(f"`{c}`").cast("double") for c in features]).alias("vec")
    donors = donors.select(F.col(key).alias("donor"), vec)
    targets = targets.select(F.col(key).alias("target"), vec)
    cells = max(1, min(math.isqrt(donors.count()), 4096)) if cells is None else cells
    pivot_rows = donors.orderBy(F.xxhash64("donor"), "donor").limit(cells).select("vec").collect()
    result = "target string, donor string, distance double"
    if not pivot_rows:
        return spark.createDataFrame([], "target string, rank int, donor string, distance double")
    pivots = np.array([r.vec for r in pivot_rows])

    located = "donor string, vec array<double>, cell int, gap double"
    stored = materialize(donors.mapInPandas(_assign(pivots), located), "knn-donors")
    stats = {r.cell: (r.n, r.radius) for r in stored.groupBy("cell").agg(F.count("*").alias("n"), F.max("gap").alias("radius")).collect()}
    counts = np.array([stats.get(i, (0, 0.0))[0] for i in range(len(pivots))])
    radii = np.array([stats.get(i, (0, 0.0))[1] for i in range(len(pivots))])

    bin_of = _bins(pivots, counts, block)
    stored = stored.select("donor", "vec", bin_of(F.col("cell")).alias("bin"))
    wanted = "target string, vec array<double>, cells array<int>"
    asking = targets.mapInPandas(_candidate_cells(pivots, counts, radii, k), wanted)
    asking = materialize(asking.select("target", "vec", F.explode(F.array_distinct(F.transform("cells", bin_of))).alias("bin")), "knn-targets")
    size = lambda df: {r.bin: r.n for r in df.groupBy("bin").agg(F.count("*").alias("n")).collect()}
    askers, offers = size(asking), size(stored)

    def splits(sizes: dict) -> Column:
        pairs = [F.lit(v) for number, n in sizes.items() for v in (number, -(-int(n) // block))]
        return F.coalesce(F.create_map(*pairs)[F.col("bin")], F.lit(1)) if pairs else F.lit(1)

    donor_splits, target_splits = splits(offers), splits(askers)
    keys = ["bin", "donor_block", "target_block"]
    left = asking.withColumns(
        {
            "target_block": F.pmod(F.xxhash64("target"), target_splits).cast("int"),
            "donor_block": F.explode(F.sequence(F.lit(0), donor_splits - 1)),
        }
    )
    right = stored.withColumns(
        {
            "donor_block": F.pmod(F.xxhash64("donor"), donor_splits).cast("int"),
            "target_block": F.explode(F.sequence(F.lit(0), target_splits - 1)),
        }
    )
    # Few bytes stand for much work here, so the number of tasks follows the blocks that meet.
    parts = min(sum(-(-n // block) * -(-offers.get(b, 0) // block) for b, n in askers.items()), MOST_TASKS)
    left, right = spread(left, parts, *keys), spread(right, parts, *keys)
    best = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(_block_best(k), result)
    ranked = Window.partitionBy("target").orderBy("distance", "donor")
    return (
        best.withColumn("rank", F.row_number().over(ranked))
        .filter(F.col("rank") <= k)
        .select("target", "rank", "donor", "distance")
    )
