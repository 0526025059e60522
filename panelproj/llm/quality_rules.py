"""Document quality: heuristic base rules and a hashed n-gram log-likelihood ratio.

The ratio compares two multinomials over hashed byte n-grams: the trusted target (every
document marked good) and the raw corpus (every document). A document's score is the
mean of log(p_target / p_raw) over its n-grams, so it does not depend on length; documents below
one fixed threshold are rejected. The log ratios are rounded to multiples of 2^-20 and summed as
whole numbers: a score is the same however rows are batched.

Counting is one pass (a task folds its documents into one vector of counts, the vectors are
summed by n-gram), scoring a second one. The table of counts grows with the square root of the
corpus's bytes, as vocabularies do, up to one place for each possible n-gram.

Defined cases: a null text is empty; a text without n-grams scores 0 (base rules reject it
anyway); without any trusted document nothing is known about the target and only base rules
decide; null or repeated ids and equal rows are scored on their own; extra columns are ignored.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelproj.llm import textbytes
from panelproj.llm.shared import bounded_sample, with_membership

BUCKET_BITS = 14
ORDER = 3
SCALE = 1 << 20
LEAST_SCORE = -0.4
SYMBOL = np.zeros(256, dtype=bool)
SYMBOL[list(b"#*$%&|<>")] = True


def trusted_ids(labels: DataFrame, most: int | None = None) -> DataFrame:
    """The documents that every label calls good; with a bound, so many of them at most, by hash of the id."""
    good = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("q")).where("q = 1")
    return good.select("doc_id") if most is None else bounded_sample(good.select("doc_id"), most)


def table_bits(size: int) -> int:
    """Bits of the hash table for so many bytes of text: the square root of their number."""
    return min(max(BUCKET_BITS, (size.bit_length() + 1) // 2), 8 * ORDER)


def _grams(data: np.ndarray, offsets: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams that lie within a row, and the row offsets among them."""
    starts = textbytes.window_starts(offsets, ORDER)
    code = np.zeros(len(starts), np.uint64)
    for i in range(ORDER):
        code = (code << np.uint64(8)) | data[starts + i].astype(np.uint64)
    sizes = np.maximum(np.diff(offsets) - ORDER + 1, 0)
    return ((code * np.uint64(textbytes.BASE)) >> np.uint64(64 - bits)).astype(np.int64), np.concatenate(([0], np.cumsum(sizes)))


def _parts(column: pa.Array):
    data, offsets = textbytes.buffer_of(column)
    for lo, hi in textbytes.slices(offsets):
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]


def log_ratios(docs: DataFrame, trusted: DataFrame) -> np.ndarray | None:
    """log(p_target / p_raw) by hashed n-gram, in units of 1 / SCALE; None without trusted text."""
    bits = table_bits(docs.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0)
    marked = with_membership(docs.select("doc_id", "text"), trusted, "good").select("text", "good")

    def count(batches):
        raw, target = np.zeros(1 << bits, np.int64), np.zeros(1 << bits, np.int64)
        for batch in batches:
            good = batch.column(1).to_numpy(zero_copy_only=False)
            for lo, hi, data, offsets in _parts(batch.column(0)):
                grams, edges = _grams(data, offsets, bits)
                raw += np.bincount(grams, minlength=len(raw))
                target += np.bincount(grams[np.repeat(good[lo:hi], np.diff(edges))], minlength=len(raw))
        full = np.flatnonzero(raw)
        yield pa.RecordBatch.from_pydict({"gram": full, "raw": raw[full], "target": target[full]})

    rows = marked.mapInArrow(count, "gram long, raw long, target long").groupBy("gram").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas()
    raw, target = np.zeros(1 << bits), np.zeros(1 << bits)
    raw[rows["gram"]], target[rows["gram"]] = rows["raw"], rows["target"]
    if not target.sum():
        return None
    smooth = 1.0
    ratio = np.log((target + smooth) / (target.sum() + smooth * len(target))) - np.log((raw + smooth) / (raw.sum() + smooth * len(raw)))
    return np.round(ratio * SCALE).astype(np.int64)


RESULT = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, score double, kept boolean"


def _judge(texts: DataFrame, trusted: DataFrame, least_score: float, least_words: int, most_repeated: int):
    """A function from a column of texts to parts of the result, as (first row, last row, columns)."""
    ratios = log_ratios(texts, trusted)

    def judged(column: pa.Array, roller: textbytes.Roller):
        for lo, hi, data, offsets in _parts(column):
            words = textbytes.Words(data, offsets)
            n = words.counts
            repeated = repeated_words(roller, words, words.keys(roller, data))
            failed = (n < least_words) | (100 * repeated > most_repeated * n)
            score = np.zeros(hi - lo)
            if ratios is not None:
                grams, edges = _grams(data, offsets, len(ratios).bit_length() - 1)
                score = textbytes.row_sums(ratios[grams], edges) / np.maximum(np.diff(edges), 1) / SCALE
            yield (
                lo,
                hi,
                {
                    "n_words": n,
                    "word_chars": textbytes.row_sums(words.solid & ((data & 0xC0) != 0x80), offsets),
                    "n_symbols": textbytes.row_sums(SYMBOL[data], offsets),
                    "n_dup_lines": duplicate_lines(roller, data, offsets, words.solid),
                    "n_repeat_words": repeated,
                    "base_failed": failed,
                    "score": score,
                    "kept": ~failed & (score >= least_score),
                },
            )

    return judged


def quality_rules(docs: DataFrame, trusted: DataFrame, least_score: float = LEAST_SCORE, least_words: int = 10, most_repeated: int = 20) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score and kept of every document."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    judged = _judge(texts, trusted, least_score, least_words, most_repeated)

    def measure(batches):
        roller = textbytes.Roller()
        for batch in batches:
            for lo, hi, columns in judged(batch.column(1), roller):
                yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0).slice(lo, hi - lo), **columns})

    return texts.mapInArrow(measure, RESULT)


def good_documents(docs: DataFrame, trusted: DataFrame, least_score: float = LEAST_SCORE, least_words: int = 10, most_repeated: int = 20) -> DataFrame:
    """The documents that the rules keep, with all their columns."""
    judged = _judge(docs.select("doc_id", F.col("text").cast("string").alias("text")), trusted, least_score, least_words, most_repeated)
    at = docs.columns.index("text")

    def keep(batches):
        roller = textbytes.Roller()
        for batch in batches:
            for lo, hi, columns in judged(batch.column(at), roller):
                yield batch.slice(lo, hi - lo).filter(pa.array(columns["kept"]))

    return docs.mapInArrow(keep, docs.schema)


def repeated_words(roller: textbytes.Roller, words: textbytes.Words, keys: np.ndarray, length: int = 5) -> np.ndarray:
    """Words in windows that occur twice or more in their row, by row."""
    starts = textbytes.window_starts(words.first, length)
    windows = roller.keys(roller.prefix(keys), starts, starts + length)
    windows = textbytes.mix(windows + words.row[starts].astype(np.uint64) * np.uint64(textbytes.BASE)) if len(starts) else windows
    _, at, count = np.unique(windows, return_inverse=True, return_counts=True)
    mask = textbytes.covered(starts[count[at] > 1], length, len(words.starts))
    return textbytes.row_sums(mask, words.first)


def duplicate_lines(roller: textbytes.Roller, data: np.ndarray, offsets: np.ndarray, solid: np.ndarray) -> np.ndarray:
    """Lines with a word that equal an earlier line of their row, by row."""
    rows = len(offsets) - 1
    breaks = np.flatnonzero(data == 10)
    starts = np.unique(np.concatenate((offsets[:-1][np.diff(offsets) > 0], breaks + 1)))
    starts = starts[starts < len(data)]
    ends = np.append(starts[1:], len(data))
    ends = ends - ((ends > starts) & (data[ends - 1] == 10)) if len(starts) else ends
    total = np.concatenate(([0], np.cumsum(solid)))
    some = total[ends] > total[starts]
    starts, ends = starts[some], ends[some]
    row = np.searchsorted(offsets, starts, side="right") - 1
    keys = roller.keys(roller.prefix(textbytes.BYTE_VALUES[data]), starts, ends) + (ends - starts).astype(np.uint64)
    keys = textbytes.mix(keys + row.astype(np.uint64) * np.uint64(textbytes.BASE))
    _, first = np.unique(keys, return_index=True)
    return np.bincount(row, minlength=rows) - np.bincount(row[first], minlength=rows)
