"""Removal of byte strings that occur more than once, by blockwise sorting with a difference cover.

The cover D (mod 133) holds a pair of members at every distance, so for any two positions i, j
of their documents some shift s < 133 puts both i + s and j + s on the cover. Hence two equal
strings of 200 bytes hold two equal strings of 200 - 132 = 68 bytes that start on the cover:

1. cover sample: the suffixes that start on the cover are cut into buckets and each bucket is
   sorted on its own, to the depth of 68 bytes; a sample suffix gets a tie where another one
   equals it to that depth. This is nine hundredths of all suffixes;
2. suffixes whose cover samples have no tie are settled: no other suffix agrees with them to
   200 bytes. The rest, those with a long tie, are sorted bucket by bucket to the full depth;
   equal neighbours are repeats;
3. bytes covered by a repeat are removed.

Suffixes are sorted by 64-bit keys of their first 68 or 200 bytes instead of the bytes
themselves: equal strings meet all the same, and the order of unequal ones is of no use here.
Memory is bounded by a chunk of text (16 MB, or one longer document) and by a bucket of keys.
Sample ties use 48 bits: a false tie costs work, not a result.

Defined cases: a null text is empty; texts under the length lose nothing; equal rows, null or
repeated ids are separate documents; extra columns are ignored; an empty table gives an empty
result. Every input row gives one output row.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelproj.llm import repeats, textbytes

# A perfect difference set; each distance mod 133 occurs once.
COVER = [0, 1, 3, 17, 21, 58, 65, 73, 100, 105, 111, 124]
PERIOD = 133
PLANES = 6
REPEATED = np.uint64(1) << np.uint64(16)


def suffix_dedup(docs: DataFrame, length: int = 200, with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256; with_text adds the kept bytes."""
    depth = length - PERIOD + 1
    if depth < 8:
        raise ValueError(f"length must be at least {PERIOD + 7}")
    texts, buckets = repeats.chunked(docs)
    on_cover = np.zeros(PERIOD, dtype=bool)
    on_cover[COVER] = True
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())] + ([("kept", pa.binary())] if with_text else []))

    def pieces(table: pa.Table):
        data, offsets = textbytes.buffer_of(table.column("text"))
        for lo, hi in textbytes.slices(offsets):
            yield data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]

    def summed(table: pa.Table):
        """Row edges and prefix sums, piece by piece; never kept for a whole chunk."""
        roller = textbytes.Roller()
        for part, edges in pieces(table):
            yield edges, roller.prefix(textbytes.BYTE_VALUES[part]), roller

    def samples(edges: np.ndarray, prefix: np.ndarray, roller: textbytes.Roller) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Positions on the cover, the begin of their row, and their keys."""
        at = textbytes.window_starts(edges, depth)
        begin = np.repeat(edges[:-1], np.maximum(np.diff(edges) - depth + 1, 0))
        chosen = on_cover[(at - begin) % PERIOD]
        at, begin = at[chosen], begin[chosen]
        return at, begin, _narrow(roller.keys(prefix, at, at + depth))

    def sample_keys(table: pa.Table) -> np.ndarray:
        """A chunk's distinct cover samples, flagged where they occur again."""
        return _folded(np.sort(np.concatenate([samples(*piece)[2] for piece in summed(table)])))

    def sample_requests(key: tuple, table: pa.Table) -> pa.Table:
        return pa.Table.from_batches([repeats.dealt(key[0].as_py(), sample_keys(table), buckets, PLANES)])

    def ties(keys: np.ndarray, chunks: np.ndarray) -> np.ndarray:
        plain = _narrow(keys)
        same = repeats.same_before(plain)
        return (keys & REPEATED != 0) | same | np.append(same[1:], False) if len(keys) else same

    def tied_suffixes(table: pa.Table, answers: pa.Table) -> list[tuple[np.ndarray, np.ndarray]]:
        """Starts of full length whose cover sample has a tie, and their keys, piece by piece."""
        sent = sample_keys(table)
        tied, out = repeats.Among(_narrow(sent[repeats.told(answers, sent, buckets)])), []
        for edges, prefix, roller in summed(table):
            at, begin, keys = samples(edges, prefix, roller)
            hit = tied(keys)
            n = int(edges[-1]) + 1
            steps = np.bincount(np.maximum(at[hit] - PERIOD + 1, begin[hit]), minlength=n) - np.bincount(at[hit] + 1, minlength=n)
            starts = textbytes.window_starts(edges, length)
            starts = starts[(np.cumsum(steps[:-1]) > 0)[starts]]
            out.append((starts, _whole(roller.keys(prefix, starts, starts + length))))
        return out

    def long_ties(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.Table.from_batches([], schema=repeats.REQUEST_SCHEMA)
        keys = np.concatenate([k for _, k in tied_suffixes(table, answers)])
        return pa.Table.from_batches([repeats.dealt(key[0].as_py(), _marked(np.sort(keys)), buckets)])

    def repeated(keys: np.ndarray, chunks: np.ndarray) -> np.ndarray:
        plain = _whole(keys)
        same = repeats.same_before(plain)
        return (keys != plain) | same | np.append(same[1:], False) if len(keys) else same

    def removed(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.Table.from_batches([], schema=schema)
        kind = answers.column("kind").to_numpy()
        tied = tied_suffixes(table, answers.filter(pa.array(kind == 0)))
        keys = np.concatenate([k for _, k in tied])
        order = np.argsort(keys)
        keys = keys[order]
        several = np.zeros(len(keys), dtype=bool)
        several[order] = repeats.told(answers.filter(pa.array(kind == 1)), _marked(keys), buckets)[np.cumsum(~repeats.same_before(keys)) - 1]
        at, sizes, gone, spans, digests, kept = 0, [], [], [], [], []
        for (part, edges), (starts, _) in zip(pieces(table), tied, strict=True):
            mask = textbytes.covered(starts[several[at : at + len(starts)]], length, len(part))
            at += len(starts)
            rows = textbytes.row_sums(mask, edges)
            sizes.append(np.diff(edges))
            gone.append(rows)
            spans.append(textbytes.run_counts(mask, edges))
            left, ends = part[~mask].tobytes(), np.concatenate(([0], np.cumsum(np.diff(edges) - rows))).tolist()
            texts_left = [left[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
            digests += [hashlib.sha256(x).hexdigest() for x in texts_left]
            if with_text:
                kept += texts_left
        columns = [table.column("doc_id"), *(pa.array(np.concatenate(x), pa.int64()) for x in (sizes, gone, spans)), pa.array(digests, pa.string())]
        return pa.table(columns + ([pa.array(kept, pa.binary())] if with_text else []), schema=schema)

    asked = texts.groupBy("chunk").applyInArrow(sample_requests, repeats.REQUEST)
    found = repeats.answered(asked, ties, PLANES)
    suffixes = texts.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(long_ties, repeats.REQUEST)
    several = repeats.answered(suffixes, repeated)
    both = found.withColumn("kind", F.lit(0)).unionByName(several.withColumn("kind", F.lit(1)))
    columns = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if with_text else "")
    return texts.groupBy("chunk").cogroup(both.groupBy("chunk")).applyInArrow(removed, columns)


def _narrow(keys: np.ndarray) -> np.ndarray:
    """47 bits at the top; the flag below them and the rest are zero."""
    return (keys >> np.uint64(17)) << np.uint64(17)


def _folded(keys: np.ndarray) -> np.ndarray:
    """One key of each sorted run of equal ones, flagged if there are several or any has the flag."""
    plain = _narrow(keys)
    head = np.flatnonzero(~repeats.same_before(plain))
    if not len(head):
        return keys
    several = (np.diff(np.append(head, len(keys))) > 1) | (np.bitwise_or.reduceat(keys, head) & REPEATED != 0)
    return plain[head] | np.where(several, REPEATED, np.uint64(0))


def _whole(keys: np.ndarray) -> np.ndarray:
    """63 bits; the lowest one is a flag."""
    return (keys >> np.uint64(1)) << np.uint64(1)


def _marked(keys: np.ndarray) -> np.ndarray:
    plain = _whole(keys)
    head = np.flatnonzero(~repeats.same_before(plain))
    if not len(head):
        return keys
    several = (np.diff(np.append(head, len(keys))) > 1) | (np.bitwise_or.reduceat(keys, head) & np.uint64(1) != 0)
    return plain[head] | several.astype(np.uint64)
