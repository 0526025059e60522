"""Removal of word passages that occur earlier in the corpus, by fixed-block anchors.

Every window of 2b words contains one whole block of b words that starts at a multiple of b,
so the blocks of all documents are an index through which every repeat of 2b words can be found:

1. index the non-overlapping blocks of b = window / 2 words, and probe them with every rolling
   window of b words of every document (keys met by bucket, see ``repeats``);
2. extend each hit to all windows of the full length around it, and ask which of those windows
   start earlier: neighbouring windows with an earlier start join to maximal exact repeats;
3. remove the words these repeats cover.

The index keys are 46 bits wide: a false hit costs a needless extension, never a result. The
windows themselves are compared by 64-bit keys.

Defined cases: a null text is empty; texts shorter than the window lose nothing; rows without
doc_id come after all others; rows with equal doc_id are ordered by their text, and of equal
rows one is the first; extra columns are ignored; an empty table gives an empty result. Every
input row gives one output row.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelproj.llm import repeats, textbytes

ONE, TWO, FLAGS = np.uint64(1), np.uint64(2), np.uint64(3)
PLANES = 6  # 48 bits: 46 of the key, and two flags
LOW = np.uint64(16)


def _ordered(table: pa.Table) -> pa.Table:
    return table.sort_by([("doc_id", "ascending"), ("text", "ascending")])


def _sliced(table: pa.Table):
    """First and last row, bytes, words, and prefix sums of the words' keys, slice by slice."""
    roller = textbytes.Roller()
    data, offsets = textbytes.buffer_of(table.column("text"))
    for lo, hi in textbytes.slices(offsets):
        part = data[offsets[lo] : offsets[hi]]
        words = textbytes.Words(part, offsets[lo : hi + 1] - offsets[lo])
        yield lo, hi, part, words, roller.prefix(words.keys(roller, part)), roller


def _grams(roller, words, prefix, length: int) -> tuple[np.ndarray, np.ndarray]:
    starts = textbytes.window_starts(words.first, length)
    return starts, roller.keys(prefix, starts, starts + length)


def _narrow(keys: np.ndarray) -> np.ndarray:
    """46 bits at the top, two bits for flags below, and zeros."""
    return (keys >> np.uint64(18)) << np.uint64(18)


def substring_dedup(docs: DataFrame, window: int = 20, with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 (kept words joined by one space); with_text adds the kept text."""
    block = window // 2
    texts, buckets = repeats.chunked(docs)
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())] + ([("kept_text", pa.string())] if with_text else []))

    def probe_keys(slices) -> np.ndarray:
        """A chunk's distinct rolling windows, flagged where they are blocks or occur again."""
        found = []
        for _, _, _, words, prefix, roller in slices:
            starts, keys = _grams(roller, words, prefix, block)
            inside = starts - words.first[words.row[starts]] if len(starts) else starts
            keys = _narrow(keys) | ((inside % block == 0).astype(np.uint64) << LOW)
            found.append(_folded(np.sort(keys)))
        return _folded(np.sort(np.concatenate(found)))

    def probes(key: tuple, table: pa.Table) -> pa.Table:
        return pa.Table.from_batches([repeats.dealt(key[0].as_py(), probe_keys(_sliced(table)), buckets, PLANES)])

    def hits(keys: np.ndarray, chunks: np.ndarray) -> np.ndarray:
        """Keys that are a block somewhere and occur more than once."""
        plain = _narrow(keys)
        head = np.flatnonzero(~repeats.same_before(plain))
        if not len(head):
            return np.zeros(0, dtype=bool)
        size = np.diff(np.append(head, len(keys)))
        flags = np.bitwise_or.reduceat(keys >> LOW, head)
        return np.repeat((flags & ONE != 0) & ((size > 1) | (flags & TWO != 0)), size)

    def near_hits(slices, answers: pa.Table) -> list[tuple[np.ndarray, np.ndarray]]:
        """Starts and keys of the full windows with a hit inside, slice by slice."""
        sent = probe_keys(slices)
        hit = repeats.Among(_narrow(sent[repeats.told(answers, sent, buckets)]))
        out = []
        for _, _, _, words, prefix, roller in slices:
            starts, keys = _grams(roller, words, prefix, window)
            near = _around(roller, words, prefix, starts, hit, block, window)
            out.append((starts[near], keys[near]))
        return out

    def extended(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.Table.from_batches([], schema=repeats.REQUEST_SCHEMA)
        keys = np.unique(np.concatenate([k for _, k in near_hits(list(_sliced(table)), answers)]))
        return pa.Table.from_batches([repeats.dealt(key[0].as_py(), keys, buckets)])

    def later(keys: np.ndarray, chunks: np.ndarray) -> np.ndarray:
        """A key's chunks but the first: there every window with it has an earlier start."""
        return repeats.same_before(keys)

    def removed(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.Table.from_batches([], schema=schema)
        table, kind = _ordered(table), answers.column("kind").to_numpy()
        slices = list(_sliced(table))
        near = near_hits(slices, answers.filter(pa.array(kind == 0)))
        every = np.concatenate([keys for _, keys in near])
        sent, at_first, which = np.unique(every, return_index=True, return_inverse=True)
        late_ones = repeats.told(answers.filter(pa.array(kind == 1)), sent, buckets)[which]
        # of equal windows in this chunk all but the first are later ones
        again = np.ones(len(every), dtype=bool)
        again[at_first] = False
        late_ones |= again
        at, counts, gone, digests, kept_texts = 0, [], [], [], []
        for (lo, hi, data, words, _, _), (starts, _) in zip(slices, near, strict=True):
            rows, part, late = hi - lo, data.tobytes(), late_ones[at : at + len(starts)]
            at += len(starts)
            stay = np.flatnonzero(~textbytes.covered(starts[late], window, len(words.starts)))
            left = np.bincount(words.row[stay], minlength=rows)
            counts += words.counts.tolist()
            gone += (words.counts - left).tolist()
            begins, ends = words.starts[stay].tolist(), words.ends[stay].tolist()
            edges = np.concatenate(([0], np.cumsum(left))).tolist()
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                text = b" ".join([part[s:e] for s, e in zip(begins[a:b], ends[a:b], strict=True)])
                digests.append(hashlib.sha256(text).hexdigest())
                if with_text:
                    kept_texts.append(text.decode())
        columns = [table.column("doc_id"), pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(digests, pa.string())]
        return pa.table(columns + ([pa.array(kept_texts, pa.string())] if with_text else []), schema=schema)

    asked = texts.groupBy("chunk").applyInArrow(probes, repeats.REQUEST)
    found = repeats.answered(asked, hits, PLANES)
    windows = texts.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(extended, repeats.REQUEST)
    earlier = repeats.answered(windows, later)
    both = found.withColumn("kind", F.lit(0)).unionByName(earlier.withColumn("kind", F.lit(1)))
    columns = "doc_id long, n_words long, n_removed long, kept_sha256 string" + (", kept_text string" if with_text else "")
    return texts.groupBy("chunk").cogroup(both.groupBy("chunk")).applyInArrow(removed, columns)


def _folded(keys: np.ndarray) -> np.ndarray:
    """One key of each sorted run of equal ones: block if any is, repeated if there are several."""
    plain = _narrow(keys)
    head = np.flatnonzero(~repeats.same_before(plain))
    if not len(head):
        return keys
    flags = np.bitwise_or.reduceat((keys >> LOW) & FLAGS, head)
    flags |= (np.diff(np.append(head, len(keys))) > 1).astype(np.uint64) << ONE
    return plain[head] | (flags << LOW)


def _around(roller, words, prefix, starts: np.ndarray, hit: repeats.Among, block: int, window: int) -> np.ndarray:
    """Of the full windows' starts: those with a hit of block length inside, as indexes."""
    small, keys = _grams(roller, words, prefix, block)
    small = small[hit(_narrow(keys))]
    n = len(words.starts) + 1
    steps = np.bincount(np.maximum(small - (window - block), words.first[words.row[small]]) if len(small) else small, minlength=n) - np.bincount(small + 1, minlength=n)
    return np.flatnonzero((np.cumsum(steps[:-1]) > 0)[starts])


ORACLE = r"""
WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
    SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM words WHERE len(w) >= 20)),
later AS (
    SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS place FROM windows) WHERE place > 1),
gone AS (SELECT doc_id, list(DISTINCT i + k) AS places FROM later, (SELECT unnest(range(0, 20)) AS k) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(len(places), 0) AS n_removed,
       sha256(array_to_string([w[p] for p in range(1, len(w) + 1) if places IS NULL OR NOT list_contains(places, p)], ' ')) AS kept_sha256
FROM words LEFT JOIN gone USING (doc_id)"""
