"""Near duplicates by MinHash, with candidates from an LSH forest.

A document is the set of its two-word shingles. Documents with equal sets are one class; a class
has a signature of 80 one-byte MinHash values. The forest holds several sorted orders of the
classes: tree t sorts by the signature rotated to its t-th group of eight values, so a longer
common prefix of two labels means more agreeing values.

* Regions: classes of a tree that share the first four values of their labels.
* Candidates are the longest-common-prefix neighbours: the classes of one region whose
  signatures agree in at least ``least_agreement`` of all values and whose set sizes allow the
  similarity. At the very limit of 0.8 this misses one pair in eighty, at 0.85 one in three thousand.
* Links are confirmed on the full sets, in two passes. First each class with the hub of its
  region, or with its most agreeing neighbour where the hub is less certain; classes that this
  connects share a label. This pass only looks for short cuts: where a class would meet more
  than ``capacity`` others, a region is cut at the next value, and so on down the whole label.
  Then, in regions that are not cut, rounds of one pair a class with another component, and last
  all candidates whose components still differ. So a large group of near copies becomes a few
  pairs for each member, not all its pairs. 1,024 parities of each set rule out pairs that differ
  in too many hashes to be links, never a link. A region of more than
  ``region_rows`` is dealt to blocks that meet two by two, so no task gets it whole. Components
  are those of all links.

The one lossy part is the forest itself: a pair is a candidate if its labels share a region in
some tree, however many others do. The tests and the README give the recall against brute force.

Confirmation compares sets of 64-bit shingle hashes; classes are told apart by 128 bits.

Defined cases: a null, empty or blank text has an empty set, is linked with nothing and is its
own component; one word is one shingle; null ids are never the smallest id, and a component of
null ids only has a null id; repeated rows are one class, each with its own output row; extra
columns are ignored; an empty table gives an empty result.
"""

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelproj.llm import textbytes
from panelproj.llm.components import components
from panelproj.llm.shared import with_membership, written

U64 = np.uint64
TREES, STEP = 10, 8
VALUES = TREES * STEP
PARITIES = 1024  # bits after a signature's values
ROUNDS = 3  # of joining components by one pair a class, before all pairs that are left
MORE = 0.1  # links found, as a share of the classes, from which another round is worth its pass over the regions
LEAST_DEPTH = 4
DEPTHS = (16, VALUES)  # depths at which very common prefixes are cut before the shuffle
REGION_ROWS = 20_000
SURE = 0.85  # agreement with a hub
MEETING_SETS, MEETING_BYTES = 4096, 32_000_000
ONE_WORD = U64(0xD6E8FEB86659FD93)
_rng = np.random.default_rng(20)
FLIPS, FACTORS = _rng.integers(0, 2**64, VALUES, np.uint64), _rng.integers(0, 2**63, VALUES, np.uint64) * U64(2) + U64(1)


def _sets(column: pa.Array):
    """Per slice: first row, number of rows, and the distinct shingle hashes in rows' order with the row of each."""
    roller = textbytes.Roller()
    data, offsets = textbytes.buffer_of(column)
    for lo, hi in textbytes.slices(offsets):
        part = data[offsets[lo] : offsets[hi]]
        part = np.where((part >= 65) & (part <= 90), part + np.uint8(32), part)
        words = textbytes.Words(part, offsets[lo : hi + 1] - offsets[lo])
        keys, row = words.keys(roller, part), words.row
        pair = row[1:] == row[:-1]
        single = words.counts[row] == 1
        both = textbytes.mix(keys[:-1] + textbytes.mix(keys[1:] ^ ONE_WORD))[pair]
        hashes = np.concatenate((both, textbytes.mix(keys[single] + ONE_WORD)))
        rows = np.concatenate((row[:-1][pair], row[single]))
        order = np.lexsort((hashes, rows))
        hashes, rows = hashes[order], rows[order]
        new = np.concatenate(([True], (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])))[: len(rows)]
        yield lo, hi - lo, hashes[new], rows[new]


def _signature(hashes: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """A row of MinHash bytes for each run of hashes that begins at one of firsts."""
    out = np.empty((len(firsts), VALUES), np.uint8)
    for k in range(VALUES):
        least = np.minimum.reduceat((hashes ^ FLIPS[k]) * FACTORS[k], firsts)
        out[:, k] = textbytes.mix(least) >> U64(56)
    return out


def _parities(hashes: np.ndarray, rows: np.ndarray, n: int, block: int = 2048) -> np.ndarray:
    """Per row: whether the set holds an odd number of hashes of each class. Two sets differ in as many hashes as bits at least."""
    out = np.zeros((n, PARITIES // 8), np.uint8)
    for lo in range(0, n, block):
        hi = min(lo + block, n)
        a, b = np.searchsorted(rows, (lo, hi))
        place = (rows[a:b] - lo) * PARITIES + (hashes[a:b] % U64(PARITIES)).astype(np.int64)
        out[lo:hi] = np.packbits(np.bincount(place, minlength=(hi - lo) * PARITIES) & 1).reshape(hi - lo, -1)
    return out


def _row_key() -> Column:
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, row_key, k (a struct of 128 bits that names the set), n_shingles and signature (values, then parities) of every document."""

    def sign(batches):
        for batch in batches:
            column = batch.column(2)
            n = batch.num_rows
            sizes, names = np.zeros(n, np.int64), np.zeros((2, n), U64)
            bytes_ = np.zeros((n, VALUES + PARITIES // 8), np.uint8)
            for lo, count, hashes, rows in _sets(column):
                sizes[lo : lo + count] = np.bincount(rows, minlength=count)
                some = np.flatnonzero(sizes[lo : lo + count])
                if not len(some):
                    continue
                firsts = np.searchsorted(rows, some)
                names[0, lo + some] = np.add.reduceat(textbytes.mix(hashes + ONE_WORD), firsts)
                names[1, lo + some] = np.add.reduceat(textbytes.mix(hashes ^ FLIPS[0]), firsts)
                bytes_[lo + some, :VALUES] = _signature(hashes, firsts)
                bytes_[lo : lo + count, VALUES:] = _parities(hashes, rows, count)
            packed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(bytes_.shape[1]), n, [None, pa.py_buffer(bytes_.tobytes())]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(x.view(np.int64)) for x in names], pa.array(sizes), packed], ["doc_id", "row_key", "k1", "k2", "n_shingles", "signature"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _row_key().alias("row_key"), F.col("text").cast("string").alias("text"))
    signed = texts.mapInArrow(sign, "doc_id long, row_key long, k1 long, k2 long, n_shingles long, signature binary")
    return signed.select("doc_id", "row_key", F.struct("k1", "k2").alias("k"), "n_shingles", "signature")


def _rotated(classes: DataFrame) -> DataFrame:
    """region (of the least depth), tree, label, parities and the columns of classes, for every class and tree."""
    classes = classes.withColumn("parities", F.substring("signature", VALUES + 1, PARITIES // 8))
    rotated = [F.struct(F.lit(t).alias("tree"), F.concat(F.substring("signature", STEP * t + 1, VALUES - STEP * t), F.substring("signature", 1, STEP * t)).alias("label")) for t in range(TREES)]
    rows = classes.withColumn("at", F.explode(F.array(*rotated))).select("*", "at.tree", "at.label").drop("at", "signature")
    return rows.withColumn("region", _prefix(LEAST_DEPTH))


def _prefix(depth: int) -> Column:
    return F.xxhash64("tree", F.substring("label", 1, depth))


def _forest(classes: DataFrame) -> DataFrame:
    """The rows of _rotated by region, where very large regions are cut at deeper prefixes."""
    rows = _rotated(classes)
    # a region cut at the last depth has equal signatures of very many sets: parts that differ from tree to tree
    cuts = [lambda depth=depth: _prefix(depth) for depth in DEPTHS]
    cuts.append(lambda: F.xxhash64("region", F.pmod(F.xxhash64("k", "tree"), F.ceil(F.col("size") / REGION_ROWS))))
    for cut in cuts:
        hot = written(rows.groupBy("region").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > REGION_ROWS))
        if hot.isEmpty():
            break
        rows = rows.join(hot, "region", "left").withColumn("region", F.when(F.col("size").isNull(), F.col("region")).otherwise(cut())).drop("size")
    spread = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(spread, "region").sortWithinPartitions("region", "label", "k")


def _whole_regions(classes: DataFrame, region_rows: int) -> DataFrame:
    """The rows of _rotated by region, none cut; classes have a column root.

    In a region of more than region_rows, the classes outside its largest component (asks) and
    all its classes are dealt to blocks, and each block of the one meets each of the other.
    """
    rows = _rotated(classes)
    hot = written(rows.groupBy("region").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > region_rows))
    if hot.isEmpty():
        rows = rows.withColumn("asks", F.lit(None).cast("boolean"))
    else:
        by_root = rows.join(hot, "region").groupBy("region", "size", "root").agg(F.count(F.lit(1)).alias("n"))
        largest = by_root.groupBy("region", "size").agg(F.max(F.struct("n", "root")).alias("most"))
        blocks = lambda n: F.ceil(n / region_rows).cast("int")
        largest = written(largest.select("region", F.col("most.root").alias("main"), blocks(F.col("size")).alias("blocks"), blocks(F.col("size") - F.col("most.n")).alias("asking")))
        rows = rows.join(largest, "region", "left")
        dealt = lambda n: F.pmod(F.xxhash64("k"), F.greatest(n, F.lit(1))).cast("int")
        cell = lambda block, asking, asks: F.struct(block.alias("block"), asking.alias("part"), F.lit(asks).cast("boolean").alias("asks"))
        own, part = dealt(F.col("blocks")), dealt(F.col("asking"))
        # sequences only where there are classes that ask; else the region is one component
        offered = F.transform(F.sequence(F.lit(0), F.col("asking") - 1), lambda i: cell(own, i, False))
        asked = F.when(F.col("root") != F.col("main"), F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda i: cell(i, part, True)))
        none = F.array().cast("array<struct<block:int,part:int,asks:boolean>>")
        cells = F.when(F.col("main").isNull(), F.array(cell(F.lit(0), F.lit(0), None))).when(F.col("asking") > 0, F.concat(offered, F.coalesce(asked, none))).otherwise(none)
        rows = rows.withColumn("c", F.explode(cells)).withColumn("asks", F.col("c.asks"))
        rows = rows.withColumn("region", F.when(F.col("main").isNull(), F.col("region")).otherwise(F.xxhash64("region", "c.block", "c.part"))).drop("c", "main", "blocks", "asking")
    spread = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(spread, "region").sortWithinPartitions("region")


def _runs(labels: np.ndarray, fits: Callable[[int, int], bool], block: int):
    """Ranges of sorted labels that share a prefix, cut one value deeper until they fit; equal labels are cut to blocks."""
    common = (labels[1:] == labels[:-1]).cumprod(axis=1, dtype=np.uint8).sum(axis=1) if len(labels) > 1 else np.zeros(0, np.int64)
    todo = [(0, len(labels), LEAST_DEPTH)]
    while todo:
        lo, hi, depth = todo.pop()
        if depth > VALUES:  # blocks that overlap by half, so that neighbouring blocks have common members
            half = max(1, block // 2)
            yield from ((a, min(a + 2 * half, hi)) for a in range(lo, max(lo + 1, hi - half), half))
            continue
        cuts = [lo, *(lo + 1 + np.flatnonzero(common[lo : hi - 1] < depth)).tolist(), hi]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b - a > 1 and not fits(a, b):
                todo.append((a, b, depth + 1))
            elif b - a > 1:
                yield a, b


def _agreeing(labels: np.ndarray, sizes: np.ndarray, rows: np.ndarray, percent: int, least_agreement: float):
    """For blocks of some rows: the rows, and the number of equal values with each row of the run, zero where no candidate."""
    step = max(1, 4_000_000 // (len(labels) * VALUES))
    for lo in range(0, len(rows), step):
        some = rows[lo : lo + step]
        equal = (labels[some, None, :] == labels[None, :, :]).sum(axis=2, dtype=np.int16)
        size = sizes[some, None]
        fits = (100 * np.minimum(size, sizes[None, :]) >= percent * np.maximum(size, sizes[None, :])) & (equal >= least_agreement * VALUES)
        fits[np.arange(len(some)), some] = False
        yield some, np.where(fits, equal, 0)


def _by_region(batches, look):
    """Apply look to the whole regions of batches sorted by region."""
    waiting: list[pa.RecordBatch] = []
    rows = 0

    def done(table: pa.Table):
        region = table.column("region").to_numpy()
        if not len(region):
            return
        bounds = np.concatenate(([0], np.flatnonzero(region[1:] != region[:-1]) + 1, [len(region)]))
        for i in np.flatnonzero(np.diff(bounds) > 1).tolist():
            found = look(table.slice(bounds[i], bounds[i + 1] - bounds[i]))
            if found is not None:
                yield from found.to_batches()

    for batch in batches:
        waiting.append(batch)
        rows += batch.num_rows
        if rows >= REGION_ROWS:
            table = pa.Table.from_batches(waiting)
            region = table.column("region").to_numpy()
            whole = len(region) - int((region[::-1] != region[-1]).argmax()) if region[0] != region[-1] else 0
            yield from done(table.slice(0, whole))
            waiting, rows = table.slice(whole).to_batches(), table.num_rows - whole
    if waiting:
        yield from done(pa.Table.from_batches(waiting))


def _labels(table: pa.Table) -> np.ndarray:
    column = table.column("label").combine_chunks().cast(pa.binary())
    _, where, data = column.buffers()
    first = np.frombuffer(where, np.int32)[column.offset]
    return np.frombuffer(data, np.uint8)[first : first + VALUES * len(column)].reshape(-1, VALUES)


PAIR = "a struct<k1:long,k2:long>, b struct<k1:long,k2:long>"


def _pairs_table(table: pa.Table, a: list, b: list, agree: list) -> pa.Table | None:
    if not a:
        return None
    k = table.column("k").combine_chunks()
    a, b = (k.take(pa.array(np.concatenate(x))) for x in (a, b))
    return pa.table({"a": a, "b": b, "agreement": pa.array(np.concatenate(agree).astype(np.int32))})


def _nearest(forest: DataFrame, percent: int, capacity: int, least_agreement: float) -> DataFrame:
    """a, b, agreement and hub: each class that has candidates with the most agreeing one of each region, and with the region's hub, which agrees with most others."""

    def look(table: pa.Table):
        labels, sizes = _labels(table), table.column("n_shingles").to_numpy()
        a, b, agree, hub = [], [], [], []
        for lo, hi in _runs(labels, lambda x, y: y - x <= capacity, capacity):
            total = np.zeros(hi - lo, np.int64)
            for some, equal in _agreeing(labels[lo:hi], sizes[lo:hi], np.arange(hi - lo), percent, least_agreement):
                best = equal.argmax(axis=1)
                most = equal[np.arange(len(best)), best]
                total += equal.sum(axis=0)
                a.append(lo + some[most > 0])
                b.append(lo + best[most > 0])
                agree.append(most[most > 0])
                hub.append(np.zeros(len(a[-1]), bool))
            centre = int(total.argmax())
            to_hub = next(_agreeing(labels[lo:hi], sizes[lo:hi], np.array([centre]), percent, least_agreement))[1][0]
            some = np.flatnonzero(to_hub)
            a.append(lo + some)
            b.append(np.full(len(some), lo + centre))
            agree.append(to_hub[some])
            hub.append(np.ones(len(some), bool))
        found = _pairs_table(table, a, b, agree)
        return found.append_column("hub", pa.array(np.concatenate(hub))) if found is not None else None

    return forest.select("region", "label", "k", "n_shingles").mapInArrow(lambda batches: _by_region(batches, look), PAIR + ", agreement int, hub boolean")


def _across(regions: DataFrame, percent: int, least_agreement: float, best: bool = False) -> DataFrame:
    """a, b and agreement of all candidates in different components, each in the first tree where it meets; regions as of _whole_regions.

    best: of each class that asks only the most agreeing one in a region. Pairs whose parities
    differ too much to be links are left out: sets differ in one hash for each differing bit at least.
    """

    def look(table: pa.Table):
        roots = np.stack([x.to_numpy() for x in table.column("root").combine_chunks().flatten()], axis=1)
        root, counts = np.unique(roots, axis=0, return_inverse=True, return_counts=True)[1:]
        root = root.reshape(-1)
        if len(counts) == 1:
            return None
        labels, sizes, asks, tree = _labels(table), table.column("n_shingles").to_numpy(), table.column("asks"), table.column("tree")[0].as_py()
        sets = np.frombuffer(b"".join(table.column("parities").to_pylist()), np.uint64).reshape(len(sizes), -1)
        before = [g for g in range(TREES) if (tree + g) % TREES < tree]
        # all that are not in the region's largest component are compared with all of the region
        minor = root != counts.argmax() if asks.null_count else asks.to_numpy()
        a, b, agree = [], [], []
        for some, equal in _agreeing(labels, sizes, np.flatnonzero(minor), percent, least_agreement):
            equal[root[some][:, None] == root[None, :]] = 0
            i, j = np.nonzero(equal)
            x, most = some[i], equal[i, j]
            keep = (100 + percent) * np.bitwise_count(sets[x] ^ sets[j]).sum(axis=1, dtype=np.int64) <= (100 - percent) * (sizes[x] + sizes[j])
            if best:
                order = np.flatnonzero(keep)[np.lexsort((-most[keep], i[keep]))]
                keep = order[np.flatnonzero(np.diff(i[order], prepend=-1))]
            else:
                met = (labels[x] == labels[j]).reshape(-1, TREES, STEP)[:, before, :LEAST_DEPTH].all(axis=2).any(axis=1)
                keep &= ~met & (~minor[j] | (x < j) if asks.null_count else True)
            a.append(x[keep])
            b.append(j[keep])
            agree.append(most[keep])
        return _pairs_table(table, a, b, agree)

    columns = ["region", "label", "k", "n_shingles", "root", "asks", "tree", "parities"]
    return regions.select(*columns).mapInArrow(lambda batches: _by_region(batches, look), PAIR + ", agreement int")


def _joined(docs: DataFrame, classes: DataFrame, labels: DataFrame, links: DataFrame, percent: int, least_agreement: float, region_rows: int) -> DataFrame:
    """More links: all that connect components of the given ones, found by one pair a class first, so that a large group of near copies is one component before the pairs between components are confirmed."""
    labelled = classes.join(labels.withColumnRenamed("node", "k"), "k", "left").select("k", "n_shingles", "signature", F.coalesce("label", "k").alias("label"))
    rooted = written(labelled.withColumnRenamed("label", "root"))
    more = links.limit(0)
    for _ in range(ROUNDS):
        best = _across(_whole_regions(rooted, region_rows), percent, least_agreement, best=True)
        pairs = _distinct(best.groupBy("a").agg(F.max(F.struct("agreement", "b")).alias("most")).select("a", "most.b"))
        found = _confirmed(docs, pairs, classes, percent)
        joining = found.count()
        if not joining:
            break
        more = more.unionByName(found)
        roots = components(_contracted(links.unionByName(more), labels)).withColumnRenamed("node", "label")
        rooted = written(labelled.join(roots, "label", "left").select("k", "n_shingles", "signature", F.coalesce("root", "label").alias("root")))
        if joining < MORE * rooted.count():
            break
    rest = _distinct(_across(_whole_regions(rooted, region_rows), percent, least_agreement))
    return more.unionByName(_confirmed(docs, rest, classes, percent))


def _first_pairs(found: DataFrame) -> DataFrame:
    """One pair of each class: with the hub that agrees most if that is almost certainly a link, else with the neighbour that agrees most."""
    most = lambda which: F.max(F.when(which, F.struct("agreement", "b")))
    both = found.groupBy("a").agg(most(F.col("hub")).alias("hub"), most(~F.col("hub")).alias("near"))
    sure = F.col("hub.agreement") >= SURE * VALUES
    return _distinct(both.select("a", F.when(sure, F.col("hub.b")).otherwise(F.coalesce("near.b", "hub.b")).alias("b")))


def _labels_of(links: DataFrame) -> DataFrame:
    """node and label of every class with a link: a class it is connected with. Stars around a hub get one label, so that few edges are left between labels."""
    both = written(links.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(links.select(F.col("b").alias("node"), F.col("a").alias("other"))))
    least = both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("label"))
    spread = both.join(least.withColumnRenamed("node", "other"), "other").groupBy("node").agg(F.min("label").alias("label"))
    return written(spread)


def _contracted(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """The edges between different labels, as edges of labels; a class without a label is its own."""
    for end in ("a", "b"):
        named = labels.withColumnRenamed("node", end).withColumnRenamed("label", "label_of_end")
        edges = edges.join(named, end, "left").withColumn(end, F.coalesce("label_of_end", end)).drop("label_of_end")
    return edges.where("a <> b").select("a", "b")


def _distinct(pairs: DataFrame) -> DataFrame:
    return written(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


MEETING = "at struct<k1:long,k2:long>, part long, own boolean, k struct<k1:long,k2:long>, shingles binary"


def _meetings(pairs: DataFrame) -> DataFrame:
    """k and meetings (at, part, own): where the set of each class is needed.

    The set of the class with fewer pairs goes to the other one. A class that very many
    others go to is met in several parts, with its own set in each.
    """
    ends = pairs.select(F.explode(F.array("a", "b")).alias("k")).groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    both = pairs.join(ends.select(F.col("k").alias("a"), F.col("n").alias("n_a")), "a").join(ends.select(F.col("k").alias("b"), F.col("n").alias("n_b")), "b")
    goes, stays = F.struct(F.col("n_a").alias("n"), F.col("a").alias("k")), F.struct(F.col("n_b").alias("n"), F.col("b").alias("k"))
    sent = both.select(F.least(goes, stays).alias("goes"), F.greatest(goes, stays).alias("stays"))
    parts = F.ceil(F.col("stays.n") / MEETING_SETS)
    sent = sent.select(F.col("goes.k").alias("k"), F.col("stays.k").alias("at"), parts.alias("parts"))
    others = sent.select("k", F.struct("at", F.pmod(F.xxhash64("k"), F.col("parts")).alias("part"), F.lit(False).alias("own")).alias("m"))
    own = sent.select(F.col("at").alias("k"), "parts").distinct()
    own = own.select("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    own = own.select("k", F.struct(F.col("k").alias("at"), "part", F.lit(True).alias("own")).alias("m"))
    return others.unionByName(own).groupBy("k").agg(F.collect_list("m").alias("meetings"))


def _confirmed(docs: DataFrame, pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets reach the similarity. Sets are made from the text of one document of a class and move once a pair."""
    wanted = written(_meetings(pairs).join(classes.select("k", "doc_id", "row_key"), "k"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _row_key().alias("row_key"), F.col("text").cast("string").alias("text"))
    # only the texts that are asked for move; what is asked grows with the documents, so it is never sent to all tasks
    texts = with_membership(texts, wanted, "asked").where("asked OR doc_id IS NULL").drop("asked")
    same = texts["doc_id"].eqNullSafe(wanted["doc_id"]) & (texts["row_key"] == wanted["row_key"])
    found = texts.join(wanted.hint("merge"), same).select("k", "meetings", "text")

    def hashed(batches):
        for batch in batches:
            for lo, count, hashes, rows in _sets(batch.column(2)):
                ends = np.searchsorted(rows, np.arange(count + 1))
                sets = pa.array([hashes[x:y].tobytes() for x, y in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)], pa.binary())
                lists = batch.column(1).slice(lo, count)
                which = np.repeat(np.arange(count), pc.list_value_length(lists).to_numpy())
                fields, k = lists.flatten().flatten(), batch.column(0).slice(lo, count)
                block = np.cumsum(np.diff(ends)[which] * 8) // MEETING_BYTES
                for some in np.split(np.arange(len(which)), np.flatnonzero(np.diff(block)) + 1):
                    at, rows_of = pa.array(some), pa.array(which[some])
                    yield pa.RecordBatch.from_arrays([*(f.take(at) for f in fields), k.take(rows_of), sets.take(rows_of)], ["at", "part", "own", "k", "shingles"])

    def meet(batches):
        here, own = None, None
        for batch in batches:
            a, b = [], []
            for at, part, is_own, k, shingles in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                some = np.frombuffer(shingles, U64)
                if is_own:  # the first of its meeting; equal rows of a document repeat it
                    here, own = (at, part), some
                    continue
                if here != (at, part):
                    raise ValueError("a set came to a meeting without its host")
                place = np.searchsorted(own, some)
                common = int((own[np.minimum(place, len(own) - 1)] == some).sum())
                if 100 * common >= percent * (len(own) + len(some) - common):
                    a.append(k)
                    b.append(at)
            kind = pa.struct([("k1", pa.int64()), ("k2", pa.int64())])
            yield pa.RecordBatch.from_arrays([pa.array(a, kind), pa.array(b, kind)], ["a", "b"])

    spread = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sets = found.mapInArrow(hashed, MEETING)
    met = sets.repartition(spread, "at", "part").sortWithinPartitions("at", "part", F.desc("own"))
    return written(met.mapInArrow(meet, PAIR).distinct())


def near_duplicates(docs: DataFrame, percent: int = 80, capacity: int = 512, least_agreement: float = 0.7, region_rows: int = REGION_ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id that links reach) and kept of every document."""
    signed = written(signatures(docs))
    one = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key")
    grouped = signed.where("n_shingles > 0").groupBy("k").agg(F.min(one).alias("one"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature"))
    classes = written(grouped.select("k", F.col("one.doc_id").alias("doc_id"), F.col("one.row_key").alias("row_key"), "n_shingles", "signature"))

    nearest = written(_nearest(_forest(classes.select("k", "n_shingles", "signature")), percent, capacity, least_agreement))
    links = _confirmed(docs, _first_pairs(nearest), classes, percent)
    labels = _labels_of(links)
    more = _joined(docs, classes, labels, links, percent, least_agreement, region_rows)

    roots = components(_contracted(links.unionByName(more), labels))
    labelled = classes.select("k", "doc_id").join(labels.withColumnRenamed("node", "k"), "k", "left").select("k", "doc_id", F.coalesce("label", "k").alias("label"))
    rooted = labelled.join(roots.withColumnRenamed("node", "label"), "label", "left").select("k", "doc_id", F.coalesce("root", "label").alias("root"))
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    component = rooted.join(least, "root").select("k", "component_id")
    out = signed.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("k")).alias("k")).join(component, "k", "left")
    component_id = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component_id.alias("component_id"), F.col("doc_id").eqNullSafe(component_id).alias("kept"))


# The exact result; the forest's is the same where it misses no candidate that matters.
ORACLE = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents),
shingles AS (
    SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) < 2 THEN w ELSE [w[i] || ' ' || w[i + 1] for i in range(1, len(w))] END)) AS s FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
sized AS (SELECT * FROM shingles JOIN sizes USING (doc_id)),
links AS (
    SELECT a.doc_id AS x, b.doc_id AS y FROM sized a JOIN sized b ON a.s = b.s AND a.doc_id < b.doc_id AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
edges AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reached AS (SELECT x, y FROM edges UNION SELECT r.x, e.y FROM reached r JOIN edges e ON r.y = e.x)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(least_id, d.doc_id)) AS component_id,
       least(d.doc_id, coalesce(least_id, d.doc_id)) = d.doc_id AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN (SELECT x AS doc_id, min(y) AS least_id FROM reached GROUP BY x) USING (doc_id)"""
