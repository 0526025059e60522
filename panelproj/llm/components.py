"""Connected components of a graph given as edges, by alternating star contractions."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelproj.llm.shared import checkpointed


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) of every node with an edge (a, b); root is the smallest node of its component.

    Each round hangs every node's larger neighbours, then its smaller ones, on the smallest node
    near it; rounds needed grow with the logarithm of a component's size. Neighbours are never
    collected: a round is an aggregation to the minimum and a join, which Spark splits if one
    node holds many edges. Rounds are written to the checkpoint folder.
    """
    edges = checkpointed(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    for _ in range(most_rounds):
        # larger neighbours go to the minimum of a node and all its neighbours
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        # smaller neighbours and the node itself go to the smallest of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        edges = checkpointed(small.where("a <> b").distinct())
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
