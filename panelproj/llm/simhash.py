"""Near duplicates by SimHash fingerprints, linked through BK-trees.

A BK-tree keeps fingerprints with children keyed by their integer Hamming distance to the
parent; a search with radius r at a node of distance d follows only the edges d - r to d + r.

One tree over all fingerprints would have no size bound, and random 64-bit values lie so close
to distance 32 from each other that a search visits most of it. So the trees are shards: two
fingerprints within 3 bits agree on at least two of five blocks of bits, and each of the ten
pairs of blocks deals every fingerprint to one shard by the bits of those two blocks. Shards are
moved to the tasks that search them (a shuffle) and not broadcast, since together they hold
every fingerprint. A shard of more than ``capacity`` fingerprints is cut into groups, and each
two groups meet in a task of their own: one builds the tree, both are searched.

Equal fingerprints are one node, whatever the number of copies. A shard gives one edge for each
linked fingerprint (to the smallest one it is connected with inside the shard), not all pairs.

Defined cases: a null text is empty; no word gives fingerprint zero, linked like any other;
fewer words than a shingle make one shingle of all; null ids are never the smallest id (a
component of null ids only has a null id); equal rows and repeated ids give a row each; extra
columns are ignored; an empty table gives an empty result.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelproj.llm.components import components
from panelproj.llm.shared import checkpointed, free_name

BLOCKS = [(0, 13), (13, 13), (26, 13), (39, 13), (52, 12)]  # first bit, bits


def fingerprint(text: bytes, shingle: int) -> int:
    """Unsigned 64 bits: each is set if more than half of the shingles' XXH64 (seed 42) have it."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, 42)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], 42) for a, b in zip(starts[: len(words) - shingle + 1].tolist(), (ends[shingle - 1 :] - 1).tolist(), strict=True)], np.uint64)
    set_bits = np.zeros(64, np.int64)
    for lo in range(0, len(hashes), 4096):
        bits = np.unpackbits(hashes[lo : lo + 4096].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        set_bits += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * set_bits > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """doc_id, row_key (a hash of id and text) and fingerprint (as a signed long) of every document."""

    def sign(batches):
        for batch in batches:
            got = [fingerprint((t.as_py() or "").encode(), shingle) for t in batch.column(2)]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "row_key": batch.column(1), "fingerprint": np.array(got, np.uint64).view(np.int64)})

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _row_key().alias("row_key"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(sign, "doc_id long, row_key long, fingerprint long")


def _row_key():
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))


class BKTree:
    """Fingerprints by insertion; searches go down the tree with many queries at once."""

    def __init__(self, values: list[int]) -> None:
        self.values, self.children = values, [{} for _ in values]
        for i in range(1, len(values)):
            at = 0
            while True:
                d = (values[at] ^ values[i]).bit_count()
                below = self.children[at].get(d)
                if below is None:
                    self.children[at][d] = i
                    break
                at = below

    def within(self, queries: np.ndarray, radius: int):
        """(node, indexes of the queries within the radius of it), node by node."""
        todo = [(0, np.arange(len(queries)))] if self.values else []
        while todo:
            node, some = todo.pop()
            d = np.bitwise_count(queries[some] ^ np.uint64(self.values[node])).astype(np.int64)
            near = some[d <= radius]
            if len(near):
                yield node, near
            for key, child in self.children[node].items():
                go = some[np.abs(d - key) <= radius]
                if len(go):
                    todo.append((child, go))


def _linked(tree: np.ndarray, others: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Each fingerprint that has a link, with the smallest one connected to it among these."""
    queries = np.concatenate((tree, others))
    parent = list(range(len(queries)))

    def top(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for node, near in BKTree(tree.tolist()).within(queries, radius):
        a = top(node)
        for j in near.tolist():
            b = top(j)
            if a != b:
                parent[b] = a
    tops = np.fromiter((top(i) for i in range(len(queries))), np.int64, len(queries))
    least = np.full(len(queries), np.iinfo(np.int64).max)
    signed = queries.view(np.int64)
    np.minimum.at(least, tops, signed)
    roots = least[tops]
    return signed[roots != signed], roots[roots != signed]


def links(distinct: DataFrame, radius: int = 3, capacity: int = 4096) -> DataFrame:
    """Edges (a, b) that connect all fingerprints within the radius of each other."""
    keys, n = [], 0
    for i, (first, bits) in enumerate(BLOCKS):
        for second, more in BLOCKS[i + 1 :]:
            one = F.shiftrightunsigned(F.col("fingerprint"), first).bitwiseAND((1 << bits) - 1)
            two = F.shiftrightunsigned(F.col("fingerprint"), second).bitwiseAND((1 << more) - 1)
            keys.append(F.lit(n << 26).cast("long") + one * F.lit(1 << more).cast("long") + two)
            n += 1
    dealt = distinct.select("fingerprint", F.explode(F.array(*keys)).alias("shard"))
    sizes = dealt.groupBy("shard").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    groups = F.ceil(F.col("size") / capacity).cast("int")
    mine = F.pmod(F.xxhash64("fingerprint"), groups).cast("int")
    # of the groups of one shard, each two meet: the lower one (and a group with itself) gives the tree
    cells = F.transform(F.sequence(F.lit(0), groups - 1), lambda g: F.struct(F.least(g, F.col("mine")).alias("i"), F.greatest(g, F.col("mine")).alias("j")))
    rows = dealt.join(sizes, "shard").withColumn("mine", mine).withColumn("cell", F.explode(cells))
    rows = rows.select("shard", "cell.i", "cell.j", (F.col("mine") == F.col("cell.i")).alias("in_tree"), "fingerprint")
    n_parts = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(n_parts, "shard", "i", "j").sortWithinPartitions("shard", "i", "j")

    def search(batches):
        left = None
        for batch in batches:
            table = pa.Table.from_batches([batch]) if left is None else pa.concat_tables([left, pa.Table.from_batches([batch])])
            done, left = _search(table, last=False)
            if done is not None:
                yield from done.to_batches()
        if left is not None:
            done, _ = _search(left, last=True)
            if done is not None:
                yield from done.to_batches()

    def _search(table: pa.Table, last: bool):
        shard, i, j = (table.column(k).to_numpy() for k in range(3))
        in_tree, values = table.column(3).to_numpy(), table.column(4).to_numpy().view(np.uint64)
        if not len(shard):
            return None, None
        starts = np.flatnonzero(np.concatenate(([True], (shard[1:] != shard[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1]))))
        ends = np.append(starts[1:], len(shard))
        rest = None if last else table.slice(starts[-1])
        if not last:
            starts, ends = starts[:-1], ends[:-1]
        found = []
        for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
            part, tree = values[a:b], in_tree[a:b]
            if b - a == 2 and tree.all():
                if (int(part[0]) ^ int(part[1])).bit_count() <= radius:
                    signed = np.sort(part.view(np.int64))
                    found.append((signed[1:], signed[:1]))
            else:
                found.append(_linked(part[tree], part[~tree], radius))
        if not found:
            return None, rest
        return pa.table({"a": np.concatenate([x for x, _ in found]), "b": np.concatenate([x for _, x in found])}), rest

    return rows.mapInArrow(search, "a long, b long")


def _rooted(docs: DataFrame, shingle: int, radius: int, capacity: int) -> tuple[DataFrame, DataFrame]:
    """Documents with fingerprints; fingerprints with the root of their component and its smallest id."""
    if not 0 <= radius <= 3:
        raise ValueError("shards by two of five blocks find links of at most 3 bits")
    signed = checkpointed(fingerprints(docs, shingle))
    distinct = checkpointed(signed.groupBy("fingerprint").agg(F.min("doc_id").alias("least_id")))
    roots = components(links(distinct.select("fingerprint"), radius, capacity))
    rooted = distinct.join(roots, F.col("fingerprint") == F.col("node"), "left").select("fingerprint", "least_id", F.coalesce("root", "fingerprint").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return signed, rooted.join(least, "root").select("fingerprint", "root", "component_id")


def simhash_components(docs: DataFrame, shingle: int = 3, radius: int = 3, capacity: int = 4096) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (the smallest doc_id that links reach) of every document."""
    signed, rooted = _rooted(docs, shingle, radius, capacity)
    return signed.join(rooted, "fingerprint").select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, shingle: int = 3, radius: int = 3, capacity: int = 4096) -> DataFrame:
    """One document of each component, with all its columns: the one with the smallest id, null ids last, then by a hash of the row; of equal rows one stays."""
    signed, rooted = _rooted(docs, shingle, radius, capacity)
    chosen = signed.join(rooted, "fingerprint").groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "row_key")).alias("best"))
    own, best = free_name("own_key", docs), free_name("best_key", docs)
    keyed = docs.withColumn(own, _row_key())
    kept = keyed.join(chosen.select(F.col("best.row_key").alias(best)), F.col(own) == F.col(best), "left_semi")
    return kept.dropDuplicates([own, "doc_id"]).drop(own)
