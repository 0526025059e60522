"""Mixing sources to target weights: blocks of equal size, apportioned by Sainte-Laguë.

Sources weigh 5, 2, 1 in turn by their order and share ``volume`` times all words; none gets
more than ``most_copies`` times its size, what is above is shared again by weight. Targets are
whole blocks of ``block`` words: sources get blocks by the highest quotients target / (2a + 1),
and so do the shards of a source, so every shard has an integer quota and a source's quotas add
up. A shard lays its documents end to end in a seeded order, as often as copies are allowed,
cuts this row of words into blocks and takes the first ones up to its quota; so a document is
taken whole, in part, or again, and never more often than allowed.

The highest quotients are found without listing them all: with a divisor a little too large
every cell's sure seats are known, with one a little too small its possible ones, and only the
few seats between (at most about two for each cell) are ranked.

A shard holds about ``shard_docs`` documents, so a source with a third of all rows is many
shards; windows run over shards and over the small tables of sources and shards alone. Texts
are read once for their sizes and are not moved.

Defined cases: a null text has size 0; null sources are one source and come last; rows without
id or with equal ids are placed by their text too, so equal rows are separate documents; sources
without words have target 0; extra columns are ignored; an empty table gives an empty result.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelproj.llm.shared import checkpointed

WEIGHTS = (5, 2, 1)
WORD = r"[^\x20\x09-\x0D]++"


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, volume: float = 1.5, most_copies: int = 2) -> DataFrame:
    """source, source_size, source_docs and target of every source. sizes: source, size."""
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_docs"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), place % len(weights))
    ranked = by_source.withColumn("place", place).withColumn("weight", weight).withColumn("most", F.col("source_size") * most_copies)
    # sources by the level of shared words at which they are full: those before the level are full, the rest share
    order = Window.orderBy(F.col("most") / F.col("weight"), "place")
    full = F.coalesce(F.sum("most").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    open_weight = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    everything = F.sum("source_size").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    leveled = ranked.withColumn("level", (everything * volume - full) / open_weight)
    fits = F.when(F.col("level") <= F.col("most") / F.col("weight"), F.col("level"))
    level = F.first(fits, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    leveled = leveled.withColumn("level", level)
    target = F.when(F.col("level").isNull(), F.col("most").cast("double")).otherwise(F.least(F.col("most").cast("double"), F.col("level") * F.col("weight")))
    return leveled.select("source", "source_size", "source_docs", "place", target.alias("target"))


def sainte_lague(cells: DataFrame, group: list[str], share: str, seats: Column, tie: str) -> DataFrame:
    """cells with their ``quota``: each group's seats go to its cells by the highest quotients share / (2a + 1), ties by ``tie``.

    Within a group: with divisor sum / (seats - n/2) rounding gives at most the seats, with
    sum / (seats + n/2) at least. Quotients between the two are ranked.
    """
    over = Window.partitionBy(*group)
    n, total = F.count(F.lit(1)).over(over), F.sum(share).over(over)
    known = cells.withColumn("seats", seats).withColumn("n_cells", n).withColumn("total_share", total)
    rounded = lambda q: F.floor(q + F.lit(0.5))
    some = (F.col("total_share") > 0) & (F.col("seats") > 0)
    sure = F.when(some & (F.col("seats") > F.col("n_cells") / 2 + 1), rounded(F.col(share) * (F.col("seats") - F.col("n_cells") / 2 - 1) / F.col("total_share"))).otherwise(F.lit(0))
    possible = F.when(some, rounded(F.col(share) * (F.col("seats") + F.col("n_cells") / 2 + 1) / F.col("total_share"))).otherwise(F.lit(0))
    known = known.withColumn("sure", F.greatest(sure, F.lit(0)).cast("long")).withColumn("possible", possible.cast("long"))
    known = known.withColumn("rest", F.col("seats") - F.sum("sure").over(over))
    claims = known.where("possible > sure").withColumn("a", F.explode(F.sequence("sure", F.col("possible") - 1)))
    claims = claims.withColumn("rank", F.row_number().over(over.orderBy((F.col(share) / (2 * F.col("a") + 1)).desc(), tie)))
    won = claims.where("rank <= rest").groupBy(*group, tie).agg(F.count(F.lit(1)).alias("won"))
    keys = [F.col(f"k.{c}").eqNullSafe(F.col(f"w.{c}")) for c in [*group, tie]]
    joined = known.alias("k").join(won.alias("w"), keys, "left")
    return joined.select(*[F.col(f"k.{c}").alias(c) for c in cells.columns], (F.col("k.sure") + F.coalesce(F.col("w.won"), F.lit(0))).alias("quota"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, volume: float = 1.5, most_copies: int = 2, block: int = 64, shard_docs: int = 4096, seed: str = "mix") -> DataFrame:
    """doc_id, source, size, source_size, target (the source's) and taken (words, repeats counted) of every document."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.md5(F.concat_ws(":", F.lit(seed), F.col("doc_id").cast("string"), text).cast("binary")).alias("draw"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
    )
    rows = checkpointed(rows)
    sources = checkpointed(targets(rows, weights, volume, most_copies))
    all_seats = F.round(F.sum("target").over(Window.partitionBy("everything")) / block).cast("long")
    quotas = sainte_lague(sources.withColumn("everything", F.lit(0)), ["everything"], "target", all_seats, "place").withColumnRenamed("quota", "source_quota").drop("everything")
    quotas = quotas.withColumn("shards", F.ceil(F.col("source_docs") / shard_docs))
    number = F.conv(F.substring("draw", 1, 15), 16, 10).cast("long")
    placed = rows.alias("r").join(quotas.alias("q"), F.col("r.source").eqNullSafe(F.col("q.source")))
    placed = placed.select("r.*", "q.place", "q.source_size", "q.target", "q.source_quota", (number % F.col("q.shards")).alias("shard"))
    cells = placed.groupBy("place", "shard").agg(F.sum("size").alias("shard_size"), F.first("source_quota").alias("source_quota"))
    cells = sainte_lague(cells.withColumn("shard_share", F.col("shard_size").cast("double")), ["place"], "shard_share", F.col("source_quota"), "shard")
    chosen = placed.join(cells.select("place", "shard", "shard_size", (F.col("quota") * block).alias("words")), ["place", "shard"])
    order = Window.partitionBy("place", "shard").orderBy("draw", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    chosen = chosen.withColumn("before", F.coalesce(F.sum("size").over(order), F.lit(0)))
    taken = F.lit(0)
    for copy in range(most_copies):
        taken = taken + F.least(F.greatest(F.col("words") - copy * F.col("shard_size") - F.col("before"), F.lit(0)), F.col("size"))
    return chosen.select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"))


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, md5(concat_ws(':', 'mix', CAST(doc_id AS VARCHAR), coalesce(text, ''))) AS draw,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
per_source AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS source_docs FROM sized GROUP BY source),
placed AS (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS place, 2 * source_size AS most FROM per_source),
weighed AS (SELECT *, CAST([5, 2, 1][CAST(place % 3 AS INTEGER) + 1] AS DOUBLE) AS weight FROM placed),
leveled AS (
  SELECT *, (sum(source_size) OVER () * CAST(1.5 AS DOUBLE)
             - coalesce(sum(most) OVER (ORDER BY most / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY most / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lv
  FROM weighed),
water AS (SELECT min_by(lv, place_in) AS lv FROM (SELECT lv, row_number() OVER (ORDER BY most / weight, place) AS place_in, most / weight AS full_at FROM leveled) WHERE lv <= full_at),
targeted AS (SELECT source, source_size, source_docs, place, least(CAST(most AS DOUBLE), coalesce((SELECT lv FROM water), 1e300) * weight) AS target FROM leveled),
blocks AS (SELECT CAST(round(sum(target) / 64) AS BIGINT) AS seats FROM targeted),
source_claims AS (
  SELECT place, row_number() OVER (ORDER BY target / (2 * a + 1) DESC, place) AS rank
  FROM targeted, range(0, CAST(target / 64 AS BIGINT) + 3) AS r(a) WHERE target > 0),
source_quota AS (SELECT t.*, (SELECT count(*) FROM source_claims c, blocks b WHERE c.place = t.place AND c.rank <= b.seats) AS quota,
                        CAST(ceil(source_docs / 4096.0) AS BIGINT) AS shards FROM targeted t),
docs AS (SELECT s.*, q.place, q.source_size, q.target, q.quota, CAST('0x' || substr(draw, 1, 15) AS BIGINT) % q.shards AS shard
         FROM sized s JOIN source_quota q ON s.source IS NOT DISTINCT FROM q.source),
cells AS (SELECT place, shard, CAST(sum(size) AS BIGINT) AS shard_size, any_value(quota) AS quota FROM docs GROUP BY place, shard),
cell_claims AS (
  SELECT place, shard, quota, row_number() OVER (PARTITION BY place ORDER BY shard_size / (2 * a + 1) DESC, shard) AS rank
  FROM cells, range(0, CAST(quota AS BIGINT) + 1) AS r(a) WHERE shard_size > 0),
cell_quota AS (SELECT place, shard, count(*) FILTER (rank <= quota) AS own FROM cell_claims GROUP BY place, shard),
streams AS (
  SELECT d.*, c.shard_size, coalesce(cq.own, 0) * 64 AS words,
         coalesce(sum(size) OVER (PARTITION BY d.place, d.shard ORDER BY draw, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM docs d JOIN cells c ON d.place = c.place AND d.shard = c.shard LEFT JOIN cell_quota cq ON d.place = cq.place AND d.shard = cq.shard)
SELECT doc_id, size, source_size, target,
       CAST(least(greatest(words - before, 0), size) + least(greatest(words - shard_size - before, 0), size) AS BIGINT) AS taken
FROM streams
"""
