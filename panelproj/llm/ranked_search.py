"""Ranked lexical search over a length-stratified index.

The impact of a term on a document's score depends on its frequency tf and on the document's
length normaliser m alone. So documents are grouped into strata of equal m, and within a stratum
a posting is filed by tf: an impact is computed once for each (m, tf) instead of once a posting.

* Index: one row for a block of at most about ``block_docs`` documents of one stratum, with its
  postings ordered by tf and, for every term, the highest tf. A stratum of many documents is
  several blocks, dealt by a hash of the document.
* Bounds: a stratum's bound for an item is the score of a document that has every term of the
  item at the stratum's highest tf. Strata are ordered by it for each item.
* First visit: the strata of highest bound, until they hold ``first_docs`` documents, give a
  score that the item's last reported document reaches at least. Second visit: only the strata
  whose bound reaches that score. Both are exact, whatever the bounds.
* Scoring a block: impacts (documents x terms) times weights (terms x items), in blocks of
  bounded size. All numbers are integers below 2^53, so products of doubles are exact; a block
  that could exceed this is computed in 64-bit integers.

Items are searched in batches of bounded number, each a pass over the documents that keeps the
postings of the batch's terms. Every task reports its best documents for each item, and the
shares of all tasks are ranked; nothing else leaves a task.

Defined cases: a null text has no term; documents without a term are not counted; an item
without a term, or whose terms no document has, gives no row; equal scores are ordered by
doc_id, null last, then by a hash of the text; repeated rows are documents of their own, each
counted and listed; repeated item rows give a ranking each; a null item_id is an item like others; extra columns are
ignored; an empty table on either side gives an empty result.
"""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelproj.llm.shared import written

SEPARATORS = bytes(c if chr(c).isalnum() or c >= 0x80 else 0x20 for c in range(256))
EXACT = 2**53
LAST_ID = 2**63 - 1


def _terms(text: bytes) -> list[bytes]:
    return text.translate(SEPARATORS).lower().split()


def _doc_key() -> Column:
    return F.xxhash64(F.col("text").cast("string"))


def _weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def _impact(tf: np.ndarray, m: np.ndarray | int) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def tokenised(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """doc_id, doc_key, n, terms (places in the vocabulary) and tfs of every document with a term."""
    place = {t: i for i, t in enumerate(vocabulary)}

    def count(batches):
        for batch in batches:
            sizes, lengths, terms, tfs = [], [], [], []
            for text in batch.column(2).cast(pa.large_binary()):
                found = _terms(text.as_py() or b"")
                counted = Counter(map(place.get, found))
                counted.pop(None, None)
                sizes.append(len(found))
                lengths.append(len(counted))
                terms.extend(counted)
                tfs.extend(counted.values())
            ends = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.array(x, np.int32))) for x in (terms, tfs)]
            rows = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.array(sizes, np.int64)), *lists], ["doc_id", "doc_key", "n", "terms", "tfs"])
            yield rows.filter(pc.greater(rows.column("n"), 0))

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _doc_key().alias("doc_key"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(count, "doc_id long, doc_key long, n long, terms array<int>, tfs array<int>")


BLOCK = "m long, copies array<long>, doc_ids array<long>, doc_keys array<long>, tfs array<int>, ends array<int>, terms array<int>, docs array<int>, top_terms array<int>, top_tfs array<int>"


def _inverted(table: pa.Table) -> pa.Table:
    """The index row of a block: postings (term, place of the document) ordered by tf, with the end of each tf."""
    lists = table.column("terms").combine_chunks()
    doc = np.repeat(np.arange(table.num_rows), pc.list_value_length(lists).to_numpy())
    term, tf = lists.flatten().to_numpy(), table.column("tfs").combine_chunks().flatten().to_numpy()
    order = np.lexsort((doc, term, tf))
    term, tf, doc = term[order], tf[order], doc[order]
    levels, firsts = np.unique(tf, return_index=True)
    top = np.lexsort((tf, term))
    last = np.flatnonzero(np.concatenate((np.diff(term[top]) != 0, [True]))) if len(top) else top
    row = {
        "m": table.column("m")[0].as_py(), "copies": table.column("copies"), "doc_ids": table.column("doc_id"), "doc_keys": table.column("doc_key"), "tfs": levels, "ends": np.append(firsts[1:], len(tf))[: len(levels)],
        "terms": term, "docs": doc, "top_terms": term[top][last], "top_tfs": tf[top][last],
    }
    schema = {"copies": pa.int64(), "doc_ids": pa.int64(), "doc_keys": pa.int64()}
    columns = {"m": pa.array([row.pop("m")], pa.int64())}
    for name, values in row.items():
        values = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else pa.array(values, pa.int32())
        columns[name] = pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values.cast(schema.get(name, pa.int32())))
    return pa.table(columns)


def stratified_index(counted: DataFrame, n: int, total: int, block_docs: int) -> DataFrame:
    """The index rows of tokenised documents: blocks of equal m."""
    m = F.expr(f"25L + (75L * n * {n}L) div {total}L")
    docs = counted.withColumn("m", m).groupBy("m", "doc_id", "doc_key").agg(F.count(F.lit(1)).alias("copies"), F.first("terms").alias("terms"), F.first("tfs").alias("tfs"))
    docs = written(docs)
    # one row a stratum; its size is known when the join is planned, so that a frequent length does not deal the documents
    blocks = written(docs.groupBy("m").agg(F.ceil(F.count(F.lit(1)) / block_docs).alias("blocks")))
    dealt = docs.join(blocks, "m").withColumn("block", F.pmod(F.xxhash64("doc_id", "doc_key"), F.col("blocks")))
    return dealt.groupBy("m", "block").applyInArrow(lambda table: _inverted(table), BLOCK)


def _rows(batch: pa.RecordBatch):
    """The rows of a batch, their lists as arrays; a missing id is the largest."""
    names = batch.schema.names
    for i in range(batch.num_rows):
        row = {}
        for name, column in zip(names, batch.columns, strict=True):
            value = column[i]
            if not pa.types.is_list(column.type):
                row[name] = value.as_py()
                continue
            values = value.values
            if name == "doc_ids":
                row["no_id"] = values.is_null().to_numpy(zero_copy_only=False)
                values = values.fill_null(LAST_ID)
            row[name] = values.to_numpy(zero_copy_only=False).astype(np.int64)
        yield row


class _Items:
    """The terms, weights and multiplicities of a batch of items, as they are sent to tasks."""

    def __init__(self, item_terms: list[list[bytes]]) -> None:
        self.counts = [Counter(t) for t in item_terms]
        self.vocabulary = sorted({t for c in self.counts for t in c})

    def weighted(self, df: dict[int, int], n: int) -> np.ndarray:
        """(terms x items) weight times multiplicity."""
        place = {t: i for i, t in enumerate(self.vocabulary)}
        out = np.zeros((len(self.vocabulary), len(self.counts)), np.int64)
        for item, counts in enumerate(self.counts):
            for term, times in counts.items():
                out[place[term], item] = times * _weight(n, df.get(place[term], 0))
        return out


def _strata(index: DataFrame, weights: np.ndarray) -> DataFrame:
    """m, item, bound and the number of documents of each stratum with a bound above zero."""

    def bounds(batches):
        for batch in batches:
            m, item, bound, docs = [], [], [], []
            for row in _rows(batch):
                scores = _impact(row["top_tfs"], row["m"]) @ weights[row["top_terms"]]
                some = np.flatnonzero(scores > 0)
                m += [row["m"]] * len(some)
                item += some.tolist()
                bound += scores[some].tolist()
                docs += [row["docs"]] * len(some)
            yield pa.RecordBatch.from_pydict({"m": pa.array(m, pa.int64()), "item": pa.array(item, pa.int32()), "bound": pa.array(bound, pa.int64()), "docs": pa.array(docs, pa.int64())})

    tops = index.select("m", "top_terms", "top_tfs", F.size("doc_ids").cast("long").alias("docs"))
    return tops.mapInArrow(bounds, "m long, item int, bound long, docs long").groupBy("m", "item").agg(F.max("bound").alias("bound"), F.sum("docs").alias("docs"))


def _best(index: DataFrame, visits: DataFrame, weights: np.ndarray, top: int) -> DataFrame:
    """item, doc_id, doc_key, copies and score: every task's best documents for each item; visits: m, items (the items that visit the stratum)."""
    limit = int(np.abs(weights).sum(axis=0).max(initial=0)) * 1_000_000
    kind = np.float64 if limit < EXACT else np.int64
    wide = weights.astype(kind)

    def scored(row: dict):
        items = np.unique(row["items"])
        impacts = np.repeat(_impact(row["tfs"], row["m"]), np.diff(row["ends"], prepend=0))
        terms, place = np.unique(row["terms"], return_inverse=True)
        matrix = np.zeros((len(row["doc_ids"]), len(terms)), kind)
        matrix[row["docs"], place] = impacts
        scores = matrix @ wide[np.ix_(terms, items)]
        ids, no_id, keys, copies = (row[c] for c in ("doc_ids", "no_id", "doc_keys", "copies"))
        for column, item in enumerate(items.tolist()):
            some = np.flatnonzero(scores[:, column] > 0)
            if len(some) > top:
                values = scores[some, column]
                some = some[values >= np.partition(values, len(some) - top)[len(some) - top]]
            yield item, list(zip((-scores[some, column].astype(np.int64)).tolist(), no_id[some].tolist(), ids[some].tolist(), keys[some].tolist(), copies[some].tolist(), strict=True))

    def best(batches):
        held: dict[int, list] = {}
        for batch in batches:
            for row in _rows(batch):
                for item, found in scored(row):
                    held[item] = sorted(held.get(item, []) + found)[:top]
        rows = [(item, None if no_id else doc, key, copies, -score) for item, some in held.items() for score, no_id, doc, key, copies in some]
        names = ("item", "doc_id", "doc_key", "copies", "score")
        types = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
        columns = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], list(names))

    rows = index.select("m", "copies", "doc_ids", "doc_keys", "tfs", "ends", "terms", "docs").join(visits, "m")
    return rows.mapInArrow(best, "item int, doc_id long, doc_key long, copies long, score long")


def _order() -> list[Column]:
    return [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("doc_key")]


def _search(docs: DataFrame, items: _Items, top: int, block_docs: int, first_docs: int) -> DataFrame | None:
    """item (its place in the batch), rank, doc_id and score."""
    counted = written(tokenised(docs, items.vocabulary))
    n, total = counted.agg(F.count(F.lit(1)), F.sum("n")).first()
    if not n:
        return None
    df = {r["term"]: r["df"] for r in counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).collect()}  # one row a term of the batch
    weights = items.weighted(df, n)
    index = written(stratified_index(counted, n, total, block_docs))
    strata = written(_strata(index, weights))

    by_bound = Window.partitionBy("item").orderBy(F.desc("bound"), "m")
    before = F.sum("docs").over(by_bound.rowsBetween(Window.unboundedPreceding, -1))
    first = strata.withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < first_docs).select("m", "item", "bound")
    listed = lambda some: some.groupBy("m").agg(F.collect_list("item").alias("items"))
    found = written(_best(index, listed(first), weights, top))
    ranked = F.sum("copies").over(Window.partitionBy("item").orderBy(*_order()).rowsBetween(Window.unboundedPreceding, 0))
    reached = found.withColumn("up_to", ranked).where(F.col("up_to") >= top).groupBy("item").agg(F.max("score").alias("reached"))
    rest = strata.join(first.select("m", "item"), ["m", "item"], "left_anti").join(reached, "item", "left")
    rest = rest.where(F.col("reached").isNull() | (F.col("bound") >= F.col("reached"))).select("m", "item")
    every = found.unionByName(_best(index, listed(rest), weights, top))
    window = Window.partitionBy("item").orderBy(*_order())
    each = every.withColumn("place", F.row_number().over(window)).where(F.col("place") <= top)
    each = each.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.least("copies", F.lit(top).cast("long")))))
    ranks = each.withColumn("rank", F.row_number().over(window.orderBy(*_order(), "copy"))).where(F.col("rank") <= top)
    return written(ranks.select("item", "rank", "doc_id", "score"))


def ranked_search(docs: DataFrame, queries: DataFrame, top: int = 10, block_docs: int = 512, first_docs: int = 4096, batch_items: int = 1000) -> DataFrame:
    """item_id, rank, doc_id and score of the best documents for each query; queries: item_id, text."""
    spark = docs.sparkSession
    asked = written(queries.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")))
    n_batches = max(1, math.ceil(asked.count() / batch_items))
    dealt = asked.withColumn("batch", F.pmod(F.xxhash64("item_id", "text"), F.lit(n_batches)))
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for batch in range(n_batches):  # a stated number of queries comes to the driver at a time
        rows = dealt.where(F.col("batch") == batch).orderBy("item_id", "text").collect()
        items = _Items([_terms((r["text"] or "").encode()) for r in rows])
        if not items.vocabulary:
            continue
        found = _search(docs, items, top, block_docs, first_docs)
        if found is None:
            break
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)], "item int, item_id long")
        out = out.unionByName(found.join(names, "item").select("item_id", "rank", "doc_id", "score"))
    return out


ORACLE = r"""
WITH terms AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM documents),
asked AS (
    SELECT item_id, term, count(*) AS times FROM (
        SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM benchmark) GROUP BY item_id, term),
counted AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY doc_id, term),
lengths AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM counted GROUP BY doc_id),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM lengths),
weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w
    FROM (SELECT term, count(*) AS df FROM counted GROUP BY term), totals),
scores AS (
    SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // total)))) AS BIGINT) AS score
    FROM asked JOIN weights USING (term) JOIN counted USING (term) JOIN lengths USING (doc_id), totals GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 10"""
