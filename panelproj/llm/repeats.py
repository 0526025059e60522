"""Which window keys occur in more than one place, without a row per window.

Documents are dealt into chunks of neighbouring ids. A chunk sends its distinct keys, cut by
the keys' high bits into buckets, one row for each bucket that it has keys for; a bucket meets
the keys of all chunks and answers each chunk with one bit for each of its keys; the chunk
computes its keys again to read the bits. A key that a third
of all documents hold is sent once by each chunk, so no bucket grows hot, and rows never
outnumber windows. Lost tasks are computed again from the documents: nothing is kept outside
Spark's shuffles.

Keys are sent sorted and byte plane by byte plane, which the shuffle's codec shortens by the
bits that sorting makes predictable.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK_BYTES = 16 << 20
ACCURACY = 20


def chunked(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> tuple[DataFrame, int]:
    """doc_id, text (null: empty) and chunk, and the number of buckets to use.

    Chunks are ranges of doc_id, so a smaller chunk number means smaller ids; rows without an
    id come last and are dealt by their text. The cut points, one for each chunk, are all that
    reaches the driver.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // chunk_bytes))
    cuts = docs.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], ACCURACY * n).alias("cuts")).first()["cuts"] if n > 1 else []
    points = np.array(sorted(set(cuts or [])), np.int64)

    @F.pandas_udf("long")
    def position(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(points, ids.to_numpy()))

    known = position(F.coalesce(F.col("doc_id").cast("long"), F.lit(0)))
    chunk = F.when(F.col("doc_id").isNull(), F.lit(len(points) + 1) + F.pmod(F.xxhash64("text"), F.lit(n))).otherwise(known)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), chunk.cast("long").alias("chunk")), n


def pack(keys: np.ndarray, planes: int = 8) -> bytes:
    """Sorted keys as byte planes, the high byte first; fewer planes drop low bytes."""
    return np.ascontiguousarray(keys.astype(">u8").view(np.uint8).reshape(-1, 8).T[:planes]).tobytes()


def unpack(payload: bytes, planes: int = 8) -> np.ndarray:
    got = np.frombuffer(payload, np.uint8).reshape(planes, -1)
    wide = np.zeros((got.shape[1], 8), np.uint8)
    wide[:, :planes] = got.T
    return wide.reshape(-1).view(">u8").astype(np.uint64)


def _edges(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins among sorted keys, and their number."""
    of = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    return np.searchsorted(of, np.arange(buckets + 1, dtype=np.uint64))


def dealt(chunk: int, keys: np.ndarray, buckets: int, planes: int = 8) -> pa.RecordBatch:
    """One row for each bucket that the sorted keys reach."""
    edges = _edges(keys, buckets)
    full = np.flatnonzero(np.diff(edges))
    return pa.record_batch({"chunk": np.full(len(full), chunk, np.int64), "bucket": full.astype(np.int64), "keys": pa.array([pack(keys[edges[b] : edges[b + 1]], planes) for b in full], pa.binary())})


REQUEST = "chunk long, bucket long, keys binary"
REQUEST_SCHEMA = pa.schema([("chunk", pa.int64()), ("bucket", pa.int64()), ("keys", pa.binary())])
ANSWER = "chunk long, bucket long, bits binary"


def answered(requests: DataFrame, choose, planes: int = 8) -> DataFrame:
    """Bring the chunks' keys together by bucket. choose(keys, chunks) gets them ordered by key and chunk and gives one truth value for each."""

    def meet(table: pa.Table) -> pa.Table:
        lists = [unpack(x.as_py(), planes) for c in table.column("keys").chunks for x in c]
        sizes = [len(x) for x in lists]
        keys, chunks = np.concatenate(lists), np.repeat(table.column("chunk").to_numpy(), sizes)
        order = np.lexsort((chunks, keys))
        told = np.zeros(len(keys), dtype=bool)
        told[order] = choose(keys[order], chunks[order])
        bits = [np.packbits(x).tobytes() if x.any() else None for x in np.split(told, np.cumsum(sizes)[:-1])]
        return pa.table({"chunk": table.column("chunk"), "bucket": table.column("bucket"), "bits": pa.array(bits, pa.binary())}).drop_null()

    return requests.groupBy("bucket").applyInArrow(meet, ANSWER)


def told(answers: pa.Table, keys: np.ndarray, buckets: int) -> np.ndarray:
    """The answer to each of the sorted keys that a chunk has sent; buckets without an answer say no."""
    edges, out = _edges(keys, buckets), np.zeros(len(keys), dtype=bool)
    bits = [x for c in answers.column("bits").chunks for x in c]
    for b, row in zip(answers.column("bucket").to_pylist(), bits, strict=True):
        size = int(edges[b + 1] - edges[b])
        out[edges[b] : edges[b + 1]] = np.unpackbits(np.frombuffer(row.as_py(), np.uint8), count=size).astype(bool)
    return out


class Among:
    """Membership in a sorted set of keys: a bitmap by the high bits first, then a search."""

    def __init__(self, keys: np.ndarray) -> None:
        self.keys = keys
        self.seen = np.zeros(1 << 22, dtype=bool)
        self.seen[keys >> np.uint64(42)] = True

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys), dtype=bool)
        if not len(self.keys):
            return out
        maybe = np.flatnonzero(self.seen[keys >> np.uint64(42)])
        at = np.minimum(np.searchsorted(self.keys, keys[maybe]), len(self.keys) - 1)
        out[maybe] = self.keys[at] == keys[maybe]
        return out


def same_before(keys: np.ndarray) -> np.ndarray:
    """Of sorted keys: equal to the one before."""
    return np.concatenate(([False], keys[1:] == keys[:-1])) if len(keys) else np.zeros(0, dtype=bool)
