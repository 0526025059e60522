"""Spelling variants: words one edit apart, found by PartEnum signatures over letter multisets.

A word is the multiset of its letters, as a binary vector with a place for each (letter, k): set
if the letter occurs at least k times. Replacing one code point changes two places, inserting or
deleting one changes one place, so near words lie within Hamming distance two:

* partition: places are dealt to ``parts`` parts by a hash of the place;
* enumerate: vectors at distance d agree on all but d of the parts, so each way to leave d parts
  out gives a signature, the hash of what is left. Words of equal length need d = 2; a word and
  one a code point longer need d = 1, with fewer parts. Signatures carry the shorter length;
* one edit leaves the first or the second half of the shorter word unchanged, so every signature
  is keyed once with each half. This loses no pair and keeps anagrams of one multiset apart;
* equi-join: signatures are shuffled by their key and sorted, and words that share a key meet;
* verify: pairs that differ by exactly one inserted, deleted or replaced code point stay.

A form is the near word of largest count (ties: the smallest in code-point order) if that count
is at least ``ratio`` times the word's own; a root is where following forms ends. Counts grow by
``ratio`` at each step, so paths are short; they are followed by doubling, each round a join.

A group is all words with one length, one half and one multiset but for the left-out parts. Its
pairs are looked at in blocks in the task that has it and only verified pairs leave the task.

Defined cases: a null text has no words; a null doc_id counts as the empty text in the noise
key; repeated rows count each; extra columns are ignored; an empty table gives an empty result.
Words with a null are left out.
"""

from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelproj.llm.shared import written
from panelproj.llm.textbytes import mix

U64 = np.uint64
LETTERS = r"A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
STEP = U64(0x9E3779B97F4A7C15)
GROUP_ROWS = 200_000
WIDE = 64  # longer words are compared one pair at a time
MOST_ROUNDS = 8


def with_noise(run: Column, doc_id: Column, every: int) -> Column:
    """The run without one code point where ``every`` divides the checksum of doc_id and run: a reproducible stand-in for typing errors."""
    key = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = F.pmod(key, F.char_length(run)).cast("int")
    return F.when(key % every == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))).otherwise(run)


def word_counts(docs: DataFrame, least_length: int = 7, least_count: int = 2, noise_every: int | None = None) -> DataFrame:
    """word and n of the letter runs of all texts, A-Z lower-cased, with at least so many code points and occurrences."""
    runs = F.regexp_extract_all(F.col("text").cast("string"), F.lit(f"[{LETTERS}]{{{least_length},}}+"), F.lit(0))
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.explode(runs).alias("run")).select("doc_id", F.translate("run", UPPER, LOWER).alias("run"))
    word = F.col("run") if noise_every is None else with_noise(F.col("run"), F.col("doc_id"), noise_every)
    words = found.select(word.alias("word")).where(F.char_length("word") >= least_length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


def _points(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words, and the length of each."""
    lengths = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), "<u4"), lengths


def _place_hashes(points: np.ndarray, row: np.ndarray) -> np.ndarray:
    """A hash of (letter, k) for each code point, k being its occurrence in the word; in the order of rows."""
    order = np.lexsort((points, row))
    sorted_points = points[order]
    new = np.concatenate(([True], (row[1:] != row[:-1]) | (sorted_points[1:] != sorted_points[:-1])))
    firsts = np.flatnonzero(new)
    k = np.arange(len(points)) - np.repeat(firsts, np.diff(np.append(firsts, len(points))))
    return mix((sorted_points.astype(U64) << U64(32)) + k.astype(U64) + STEP)


def _part_sums(hashes: np.ndarray, row: np.ndarray, n: int, parts: int) -> np.ndarray:
    sums = np.zeros(n * parts, U64)
    np.add.at(sums, row * parts + (hashes % U64(parts)).astype(np.int64), hashes)
    return sums.reshape(n, parts)


def _half_hashes(points: np.ndarray, starts: np.ndarray, lengths: np.ndarray, short: np.ndarray) -> list[np.ndarray]:
    """Hashes of the first floor(short / 2) and of the last ceil(short / 2) code points of each word."""
    inside = np.arange(len(points)) - np.repeat(starts, lengths)
    left = np.repeat(short // 2, lengths)
    from_end = np.repeat(lengths, lengths) - inside  # 1 for the last
    out = []
    for side, place, kept in ((1, inside, inside < left), (2, from_end, from_end <= np.repeat(short - short // 2, lengths))):
        values = np.where(kept, mix((points.astype(U64) << U64(32)) + (place.astype(U64) << U64(2)) + U64(side)), U64(0))
        sums = np.concatenate(([U64(0)], np.cumsum(values, dtype=U64)))
        out.append(mix((sums[starts + lengths] - sums[starts]) ^ (STEP >> U64(side))))
    return out


def _signatures(words: pa.Array, parts: int, fewer: int) -> np.ndarray:
    """A row of keys for each word; the lowest bit of a key tells words of equal length (0) from words a code point apart (1)."""
    points, lengths = _points(words)
    n = len(lengths)
    starts = np.cumsum(lengths) - lengths
    row = np.repeat(np.arange(n), lengths)
    hashes = _place_hashes(points, row)
    keys = []

    def add(sums: np.ndarray, out: int, short: np.ndarray, kind: int) -> None:
        halves = _half_hashes(points, starts, lengths, short)
        total = sums.sum(axis=1, dtype=U64) + short.astype(U64) * STEP
        for which in combinations(range(sums.shape[1]), out):
            rest = mix(total - sums[:, list(which)].sum(axis=1, dtype=U64)) + U64(sum(1 << w for w in which))
            keys.extend((mix(rest ^ half) & ~U64(1)) | U64(kind) for half in halves)

    add(_part_sums(hashes, row, n, parts), 2, lengths, 0)
    sums = _part_sums(hashes, row, n, fewer)
    add(sums, 1, lengths, 1)
    add(sums, 1, lengths - 1, 1)
    return np.stack(keys, axis=1)


def _one_edit(a: str, b: str) -> bool:
    """Whether two texts, the shorter one first, differ by exactly one code point."""
    if len(b) - len(a) > 1 or a == b:
        return False
    first = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[first + (len(a) == len(b)) :] == b[first + 1 :]


def _near_pairs(keys: np.ndarray, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the pairs, shorter word first, that share a key and are one edit apart; keys are sorted."""
    points, lengths = _points(words)
    narrow = lengths <= WIDE
    width = int(lengths[narrow].max(initial=0)) + 1
    table = np.zeros((len(lengths), width), np.uint8 if points.max(initial=0) < 255 else np.uint32)
    row = np.repeat(np.arange(len(lengths)), lengths)
    inside = np.arange(len(points)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    in_table = narrow[row]
    table[row[in_table], inside[in_table]] = points[in_table] + 1  # zero is the end
    found: list[tuple[np.ndarray, np.ndarray]] = []
    at, step = np.arange(len(keys)), 0
    while len(at):
        step += 1
        at = at[at < len(keys) - step]
        at = at[keys[at] == keys[at + step]]
        for lo in range(0, len(at), GROUP_ROWS):
            i, j = at[lo : lo + GROUP_ROWS], at[lo : lo + GROUP_ROWS] + step
            i, j = np.where(lengths[i] <= lengths[j], i, j), np.where(lengths[i] <= lengths[j], j, i)
            right = (lengths[j] - lengths[i]) == (keys[i] & U64(1)).astype(np.int64)
            i, j = i[right], j[right]
            fits = narrow[j]
            for a, b in zip(i[~fits].tolist(), j[~fits].tolist(), strict=True):
                if _one_edit(words[a].as_py(), words[b].as_py()):
                    found.append((np.array([a]), np.array([b])))
            i, j = i[fits], j[fits]
            same = lengths[i] == lengths[j]
            for x, y, equal in ((i[same], j[same], True), (i[~same], j[~same], False)):
                if not len(x):
                    continue
                differ = table[x] != table[y]
                if equal:
                    near = differ.sum(axis=1) == 1
                else:
                    shifted = table[x][:, :-1] != table[y][:, 1:]
                    last = np.where(shifted.any(axis=1), width - 2 - shifted[:, ::-1].argmax(axis=1), -1)
                    near = last < differ.argmax(axis=1)
                found.append((x[near], y[near]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def near_words(words: DataFrame, parts: int = 4, fewer: int = 3) -> DataFrame:
    """word, near and near_n: every word with each word one edit away and that word's n; words: distinct word, n."""

    def sign(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 20_000):
                some = batch.slice(lo, 20_000)
                keys = _signatures(some.column(0).cast(pa.string()), parts, fewer)
                which = np.repeat(np.arange(len(keys)), keys.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1).view(np.int64)), some.column(0).take(pa.array(which)), some.column(1).take(pa.array(which))], ["key", "word", "n"])

    def pairs(table: pa.Table) -> list[pa.RecordBatch]:
        keys, some = table.column("key").to_numpy().view(U64), table.column("word").combine_chunks().cast(pa.string())
        # a key that no neighbour has needs no look
        same = keys[1:] == keys[:-1]
        shared = np.flatnonzero(np.concatenate(([False], same)) | np.concatenate((same, [False]))) if len(keys) else np.zeros(0, np.int64)
        some, n = some.take(pa.array(shared)), table.column("n").take(pa.array(shared))
        i, j = _near_pairs(keys[shared], some)
        a, b = pa.array(np.concatenate((i, j))), pa.array(np.concatenate((j, i)))
        return pa.table({"word": some.take(a), "near": some.take(b), "near_n": n.take(b)}).to_batches()

    def meet(batches):
        waiting: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            waiting.append(batch)
            rows += batch.num_rows
            if rows < GROUP_ROWS:
                continue
            table = pa.Table.from_batches(waiting)
            keys = table.column("key").to_numpy()
            whole = int(np.searchsorted(keys == keys[-1], True))  # the last key may go on
            yield from pairs(table.slice(0, whole))
            waiting = table.slice(whole).to_batches()
            rows = table.num_rows - whole
        if waiting:
            yield from pairs(pa.Table.from_batches(waiting))

    spread = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = words.where("word is not null").select("word", F.col("n").cast("long").alias("n")).mapInArrow(sign, "key long, word string, n long")
    met = keyed.repartition(spread, "key").sortWithinPartitions("key").mapInArrow(meet, "word string, near string, near_n long")
    return met.groupBy("word", "near").agg(F.first("near_n").alias("near_n"))


def _roots(forms: DataFrame) -> DataFrame:
    """word and root of every word with a form, by doubling the steps."""
    paths = written(forms.select("word", F.col("form").alias("root")))
    for _ in range(MOST_ROUNDS):
        further = paths.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = paths.join(further, "root", "left")
        paths = written(joined.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        moved = paths.where("moved").limit(1).count()
        paths = paths.drop("moved")
        if not moved:
            return paths
    raise RuntimeError("forms do not end")  # counts grow by the ratio at each step


def spelling_variants(words: DataFrame, ratio: int = 10, parts: int = 4, fewer: int = 3) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word; words: distinct word, n."""
    if ratio < 2:
        raise ValueError("forms end only if a form is more frequent than its word")
    words = written(words.select("word", F.col("n").cast("long").alias("n")))
    near = near_words(words, parts, fewer)
    most = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.max("near_n").alias("form_n"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    known = words.join(most, "word", "left")
    worthy = F.col("form_n") >= ratio * F.col("n")
    known = written(known.select("word", F.when(worthy, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(worthy, F.col("form_n")).alias("form_n")))
    rooted = known.join(_roots(known.where("form is not null")), "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


# The checksum's table comes from its polynomial (3988292384); letters of the runs have one or two bytes.
ORACLE = r"""
WITH RECURSIVE steps AS (
    SELECT i, i AS c, 0 AS step FROM (SELECT unnest(range(0, 256)) AS i)
    UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, step + 1 FROM steps WHERE step < 8),
remainders AS (SELECT list(c ORDER BY i) AS t FROM steps WHERE step = 8),
runs AS (
    SELECT doc_id, run, count(*) AS k FROM (
        SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]{7,}')) AS run FROM documents)
    GROUP BY doc_id, run),
bytes AS (
    SELECT run, k, flatten([CASE WHEN unicode(c) < 128 THEN [unicode(c)] ELSE [192 + (unicode(c) >> 6), 128 + (unicode(c) & 63)] END
                            for c in string_split(doc_id || ':' || run, '')]) AS b FROM runs),
hashed AS (
    SELECT run, k, xor(list_reduce(list_concat([4294967295::BIGINT], b), lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8)), 4294967295::BIGINT) AS h
    FROM bytes, remainders),
words AS (
    SELECT word, CAST(sum(k) AS BIGINT) AS n FROM (
        SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, k FROM hashed)
    WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2),
shorter AS (
    SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
one_less AS (SELECT s.word AS long, w.word AS short FROM shorter s JOIN words w ON w.word = s.rest),
links AS (
    SELECT a.word, b.word AS near FROM shorter a JOIN shorter b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
    UNION SELECT long, short FROM one_less UNION SELECT short, long FROM one_less),
most AS (
    SELECT l.word, count(*) OVER (PARTITION BY l.word) AS n_near, l.near, w.n AS near_n FROM links l JOIN words w ON w.word = l.near
    QUALIFY row_number() OVER (PARTITION BY l.word ORDER BY w.n DESC, l.near) = 1),
formed AS (
    SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 10 * n THEN near END AS form, CASE WHEN near_n >= 10 * n THEN near_n END AS form_n
    FROM words LEFT JOIN most USING (word)),
paths AS (
    SELECT word, form AS place, 1 AS step FROM formed WHERE form IS NOT NULL
    UNION ALL SELECT p.word, f.form, step + 1 FROM paths p JOIN formed f ON f.word = p.place WHERE f.form IS NOT NULL)
SELECT word, form, coalesce(root, word) AS root, n, n_near, form_n
FROM formed LEFT JOIN (SELECT word, arg_max(place, step) AS root FROM paths GROUP BY word) USING (word)"""
