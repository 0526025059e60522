"""File sources and sinks: delimited text (any JVM charset) and Parquet."""

import tempfile
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by the cluster; a private one only when none is named (tests)."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="panelproj-")
        spark.conf.set("spark.checkpoint.dir", configured)
    return configured.rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write the frame to the shared folder and read it back (runs a job)."""
    path = f"{checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_raw_csv(spark: SparkSession, path: str | Sequence[str], schema: StructType, charset: str = "GB18030") -> DataFrame:
    """Raw panel export with a header line and an explicit charset and schema.

    A line that does not fit is an error; `ingest` reports such lines instead.
    """
    from panelproj.sources.ingest import POSITION, ingest

    read = ingest(spark, [path] if isinstance(path, str) else path, schema, charset=charset)
    first = read.problems.orderBy(*POSITION).select("file", "line", "column", "text", "reason").head()
    if first is not None:
        raise ValueError(f"{first['file']}, line {first['line']}, column {first['column']}: {first['text']!r} ({first['reason']})")
    return read.rows.drop(*POSITION)


def read_sheet(
    spark: SparkSession,
    path: str,
    schema: StructType,
    *,
    first_columns: int | None = None,
    skip_lines: int = 0,
    header: bool = True,
    strict: bool = True,
) -> DataFrame:
    """Exported worksheet: optionally only its first columns, below some leading lines.

    The first `skip_lines` lines of each file and, with `header`, the one after them are
    left out by their position; rows that look like them stay. A cell holds no line
    break. Text that does not fit its column's type is an error, or with strict=False
    missing.
    """
    lead = skip_lines + int(header)
    lines = spark.read.text(path).select("value", F.monotonically_increasing_id().alias("__at"), "_metadata.file_path", "_metadata.file_block_start")
    if lead:
        # A file's first block is read in order by one task, so its first lines have its lowest numbers.
        begin = lines.filter(F.col("file_block_start") == 0).groupBy("file_path").agg(F.min("__at").alias("__begin"))
        lines = lines.join(begin, "file_path").filter((F.col("file_block_start") != 0) | (F.col("__at") >= F.col("__begin") + lead))
    columns = ", ".join(f"`{f.name}` string" for f in schema)
    cells = lines.filter(F.length("value") > 0).select(F.from_csv("value", F.lit(columns)).alias("c"))

    def typed(name: str, kind) -> Column:
        cell = F.col("c")[name]
        value = cell.try_cast(kind)
        if strict:
            wrong = F.raise_error(F.concat(F.lit(f"column {name} cannot hold "), cell)).cast(kind)
            value = F.when(cell.isNotNull() & value.isNull(), wrong).otherwise(value)
        return value.alias(name)

    return cells.select(*[typed(f.name, f.dataType) for f in schema.fields[:first_columns]])


def read_parts(spark: SparkSession, paths: Sequence[str], ordinal: str = "sheet") -> DataFrame:
    """Several Parquet parts, folders or single files, each row tagged with its part number (from 1)."""
    parts = [spark.read.parquet(path).withColumn(ordinal, F.lit(i)) for i, path in enumerate(paths, start=1)]
    return reduce(DataFrame.unionByName, parts)


def write_report(df: DataFrame, path: str, sort_by: Sequence[str] = (), fmt: str = "parquet") -> None:
    """Report sink; with `sort_by` the files are in global order, missing values last. A leading '-' means descending."""
    if sort_by:
        df = df.orderBy(*[F.col(c[1:]).desc_nulls_last() if c.startswith("-") else F.col(c).asc_nulls_last() for c in sort_by])
    writer = df.write.mode("overwrite")
    writer.csv(path, header=True) if fmt == "csv" else writer.parquet(path)


def write_history(df: DataFrame, path: str, period: str = "date") -> None:
    """Delivery table partitioned by period; only the periods in `df` are replaced."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(period)
        .parquet(path)
    )
