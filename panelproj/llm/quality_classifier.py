"""A quality classifier from trusted positives and unlabelled text (positive-unlabelled learning).

Only documents labelled good are used as labels; all training-fold documents are the unlabelled
web text. A first model (positive against unlabelled) ranks documents; the class prior is
estimated from it as the least ratio of the two tails over thresholds, over every document. The
final model minimises the non-negative unbiased risk

    prior * E_P[loss(g)] + max(0, E_U[loss(-g)] - prior * E_P[loss(-g)])

with the logistic loss, by gradient steps on the driver over bounded samples (``most`` rows of
each kind, chosen by hash of the id). Scores of all documents come from one pass.

Features describe the text alone: lengths, shares of character classes, repetition of words,
windows and lines. They are computed once and written to the checkpoint folder; a document's
row is 18 numbers.

Defined cases: a null or empty text has features of an empty one and gets a score; null ids are
in the held-out fold and never train; conflicting labels of one id do not count as good; without
any positive the score is 0.5 for all; extra columns are ignored; an empty table gives an empty
result; every input row gives one output row.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelproj.llm import textbytes
from panelproj.llm.quality_rules import duplicate_lines, repeated_words
from panelproj.llm.shared import bounded_sample, checkpointed

CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "symbol": b"#*$%&|<>",
    "bang": b"!?",
    "stop": b".,;:",
    "quote": b"\"'`()[]{}",
    "space": b" \t",
    "line": b"\r\n",
}
N_FEATURES = len(CLASSES) + 10


def held_out():
    """True in the fold that never trains."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0


def features_of(data: np.ndarray, offsets: np.ndarray, roller: textbytes.Roller) -> np.ndarray:
    words = textbytes.Words(data, offsets)
    keys = words.keys(roller, data)
    size, n = np.diff(offsets), words.counts
    per_byte, per_word = 1 / np.maximum(size, 1), 1 / np.maximum(n, 1)
    out = [np.log1p(size), np.log1p(n), size * per_word]
    for chars in CLASSES.values():
        table = np.zeros(256, dtype=bool)
        table[list(chars)] = True
        out.append(textbytes.row_sums(table[data], offsets) * per_byte)
    out.append(textbytes.row_sums(data >= 128, offsets) * per_byte)
    lengths = (words.ends - words.starts).astype(np.float64)
    squares = np.concatenate(([0], np.cumsum(lengths**2)))
    out.append(np.sqrt((squares[words.first[1:]] - squares[words.first[:-1]]) * per_word))
    same = np.concatenate(([False], (keys[1:] == keys[:-1]) & (words.row[1:] == words.row[:-1]))) if len(keys) else np.zeros(0, bool)
    out.append(textbytes.row_sums(same, words.first) * per_word)
    in_row = textbytes.mix(keys + words.row.astype(np.uint64) * np.uint64(textbytes.BASE))
    _, first = np.unique(in_row, return_index=True)
    out.append(np.bincount(words.row[first], minlength=len(n)) * per_word)
    out.append(repeated_words(roller, words, keys) * per_word)
    lines = textbytes.row_sums(data == 10, offsets) + 1
    out.append(duplicate_lines(roller, data, offsets, words.solid) / lines)
    out.append(np.log1p(n / lines))
    return np.stack(out, axis=1).astype(np.float32)


def features(docs: DataFrame) -> DataFrame:
    """doc_id, held_out and the features of every document."""

    def measure(batches):
        roller = textbytes.Roller()
        for batch in batches:
            data, offsets = textbytes.buffer_of(batch.column(2))
            for lo, hi in textbytes.slices(offsets):
                got = features_of(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], roller)
                rows = pa.ListArray.from_arrays(np.arange(0, got.size + 1, got.shape[1], dtype=np.int32), got.reshape(-1))
                yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0).slice(lo, hi - lo), "held_out": batch.column(1).slice(lo, hi - lo), "x": rows})

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(measure, "doc_id long, held_out boolean, x array<float>")


def design(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Standardised features, their squares and a constant."""
    z = np.clip((x - mean) / scale, -6, 6)
    return np.concatenate((z, z * z / 6, np.ones((len(x), 1))), axis=1)


def _sigmoid(g: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(g, -40, 40)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None, steps: int = 600, rate: float = 0.05, decay: float = 1e-4) -> np.ndarray:
    """Weights by Adam: of the non-negative unbiased risk, or of positive against unlabelled if no prior is given."""
    w, m, v = np.zeros(positive.shape[1]), np.zeros(positive.shape[1]), np.zeros(positive.shape[1])
    for t in range(1, steps + 1):
        p, u = _sigmoid(positive @ w), _sigmoid(unlabelled @ w)
        up = -positive.T @ (1 - p) / len(p)  # gradient of E_P[loss(g)]
        down = unlabelled.T @ u / len(u)  # of E_U[loss(-g)]
        if prior is None:
            grad = (up + down) / 2
        else:
            negative = np.mean(np.logaddexp(0, unlabelled @ w)) - prior * np.mean(np.logaddexp(0, positive @ w))
            rest = down - prior * positive.T @ p / len(p)
            grad = prior * up + rest if negative >= 0 else -rest
        grad = grad + decay * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def _scored(rows: DataFrame, model: tuple[np.ndarray, np.ndarray, np.ndarray] | None, schema: str, keep: list[str]) -> DataFrame:
    """The kept columns and the score of every row."""

    def score(batches):
        for batch in batches:
            x = batch.column(batch.schema.get_field_index("x")).flatten().to_numpy().reshape(-1, N_FEATURES).astype(np.float64)
            got = np.full(len(x), 0.5) if model is None else _sigmoid(design(x, model[1], model[2]) @ model[0])
            yield pa.RecordBatch.from_pydict({c: batch.column(batch.schema.get_field_index(c)) for c in keep} | {"score": got})

    return rows.mapInArrow(score, schema)


def prior_of(scores: DataFrame, bins: int = 1000, doubt: float = 0.1) -> float:
    """The positives' share among unlabelled rows. scores: score, trusted, held_out.

    Above any threshold, the unlabelled tail divided by the positive tail is no less than the
    share. The threshold with the least upper confidence bound of that ratio is used.
    """
    cut = F.least(F.floor(F.col("score") * bins), F.lit(bins - 1)).cast("int").alias("bin")
    rows = scores.where("not held_out").groupBy(cut).agg(F.sum(F.col("trusted").cast("long")).alias("p"), F.count(F.lit(1)).alias("u")).toPandas()
    p, u = np.zeros(bins), np.zeros(bins)
    p[rows["bin"]], u[rows["bin"]] = rows["p"], rows["u"]
    many, all_ = max(p.sum(), 1), max(u.sum(), 1)
    p, u = p[::-1].cumsum() / many, u[::-1].cumsum() / all_
    slack = np.sqrt(np.log(4 / doubt) / (2 * many)) + np.sqrt(np.log(4 / doubt) / (2 * all_))
    best = np.argmin((u + slack) / np.maximum(p, 1e-12))
    return float(np.clip(u[best] / max(p[best], 1e-12), 0.05, 0.99))


def quality_scores(docs: DataFrame, labels: DataFrame, most: int = 20_000, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted (1 if score reaches the threshold) of every document."""
    rows = checkpointed(features(docs))
    good = labels.where(F.col("doc_id").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.min("quality").alias("q")).where("q = 1")
    good = good.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(True).alias("trusted"))
    marked = rows.join(good, "doc_id", "left").withColumn("trusted", F.coalesce("trusted", F.lit(False)))
    training = marked.where("not held_out")
    sample = lambda part: np.array([r["x"] for r in bounded_sample(part.select("doc_id", "x"), most, "x").collect()], np.float64)
    positive, unlabelled = sample(training.where("trusted")), sample(training)
    model = None
    if len(positive):
        both = np.concatenate((positive, unlabelled))
        mean, scale = both.mean(axis=0), both.std(axis=0) + 1e-3
        p, u = design(positive, mean, scale), design(unlabelled, mean, scale)
        first = (fit(p, u, None), mean, scale)
        prior = prior_of(_scored(training.select("x", "trusted", "held_out"), first, "trusted boolean, held_out boolean, score double", ["trusted", "held_out"]))
        model = (fit(p, u, prior), mean, scale)
    out = _scored(rows, model, "doc_id long, held_out boolean, score double", ["doc_id", "held_out"])
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
