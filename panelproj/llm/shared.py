"""Cutting lineage in the folder that all executors share."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; where none is set, a new local one is used, which serves tests only."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", "")
        if not folder and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoint-"))
    return context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows, written to the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """The rows as a Parquet table in the shared folder: smaller than a checkpoint, and read by column."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/written-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_sample(rows: DataFrame, most: int, *ties: str) -> DataFrame:
    """At most so many rows, by hash of doc_id. Tasks pass on about twice as many in all, however many tasks there are."""
    n, wide = rows.count(), 1 << 30
    some = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(wide)) < max(1, 2 * most * wide // n)) if n > 2 * most else rows
    return some.orderBy(F.xxhash64("doc_id"), "doc_id", *ties).limit(most)


BITMAP_BYTES = 4096  # of one bucket of ids


def with_membership(rows: DataFrame, ids: DataFrame, flag: str, most_bytes: int = 64_000_000) -> DataFrame:
    """The rows with a column that tells whether their doc_id is among the ids; a null is not.

    The ids are sent as bitmaps, one for each 32,768 neighbouring ids, so that the rows need not
    move. Where the bitmaps exceed the bound (very many or widely scattered ids), rows and ids
    are shuffled instead; the answer is the same.
    """
    id_, bucket, bits = F.col("doc_id").cast("long"), free_name("id_bucket", rows), free_name("id_bits", rows)
    known = ids.select(id_.alias("doc_id")).where("doc_id IS NOT NULL")
    maps = known.groupBy(F.bitmap_bucket_number("doc_id").alias(bucket)).agg(F.bitmap_construct_agg(F.bitmap_bit_position("doc_id")).alias(bits))
    about = known.agg(F.approx_count_distinct(F.bitmap_bucket_number("doc_id")).alias("n")).first()["n"]
    if about * BITMAP_BYTES > most_bytes:
        other = free_name("id_known", rows)
        joined = rows.join(known.distinct().withColumnRenamed("doc_id", other), id_ == F.col(other), "left")
        return joined.withColumn(flag, F.col(other).isNotNull()).drop(other)
    place = F.bitmap_bit_position(id_).cast("int")
    byte = F.conv(F.hex(F.substring(bits, F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = F.floor(byte / F.pow(F.lit(2), place % 8)).cast("int") % 2 == 1
    joined = rows.withColumn(bucket, F.bitmap_bucket_number(id_)).join(F.broadcast(written(maps)), bucket, "left")
    return joined.withColumn(flag, F.coalesce(found, F.lit(False))).drop(bucket, bits)


def free_name(stem: str, *frames: DataFrame) -> str:
    """A column name that none of the frames has, in any case of letters."""
    taken = {c.lower() for df in frames for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem
