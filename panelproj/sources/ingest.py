"""Delimited exports with the position of every row, and a report of what does not fit.

Every line gets `_src`, the place of its path in the given list, and `_row`, its number
within that source (files of a folder by name). Both are taken once, when the lines are
written to the shared folder, so they survive shuffles and lost executors, and "first"
and "last" mean what they mean in the files.

No line is lost: a line is a row, or it is rejected with a report of each cell that does
not fit, or it is blank or belongs to a file's leading lines.
"""

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, StringType, StructType

from panelproj.functions.missing import safe_double
from panelproj.sources.files import materialize

POSITION = ["_src", "_row"]
REASONS = {
    "encoding": "the line has bytes outside the charset",
    "cells": "the line has more or fewer cells than the schema, or an open quote",
    "type": "the cell's text does not fit the column's type",
    "missing": "a required cell is empty",
    "heading": "the file's heading does not name the schema's columns",
}
_PLAIN_CHARSETS = ("UTF-8", "US-ASCII")
_REPLACED = "�"
_PROBLEM = "struct<column:string,text:string,reason:string>"


@dataclass(frozen=True)
class Ingest:
    """Rows that fit (the schema's columns, `_src`, `_row`), rejected lines and the report on them.

    `rejected` has one row a line: `_src`, `_row`, file, line (from 1), text. `problems` has
    one row for each cell that does not fit: `_src`, `_row`, file, line, column, text, reason.
    """

    rows: DataFrame
    rejected: DataFrame
    problems: DataFrame


@contextmanager
def _java_charsets(spark: SparkSession) -> Iterator[None]:
    """Any JVM charset, for expressions that are made inside; the session keeps its settings."""
    names = ("spark.sql.legacy.javaCharsets", "spark.sql.legacy.codingErrorAction")
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        for name in names:
            spark.conf.set(name, "true")
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _lines(spark: SparkSession, path: str, src: int, charset: str) -> DataFrame:
    """The lines of a file or folder with the place where they were read."""
    read = spark.read.text(path).select(
        F.lit(src).alias("_src"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        "value",
    )
    if charset.upper() in _PLAIN_CHARSETS:
        return read.withColumn("readable", F.is_valid_utf8("value")).withColumn("value", F.make_valid_utf8("value"))
    with _java_charsets(spark):
        decoded = read.withColumn("value", F.decode(F.col("value").cast("binary"), charset))
    # A replacement character that the file itself holds is rejected too.
    return decoded.withColumn("readable", ~F.contains("value", F.lit(_REPLACED)))


def _value(cell: Column, kind: DataType) -> Column:
    if isinstance(kind, StringType):
        return cell
    return safe_double(cell) if isinstance(kind, DoubleType) else F.trim(cell).try_cast(kind)


def ingest(
    spark: SparkSession,
    paths: Sequence[str],
    schema: StructType,
    *,
    charset: str = "UTF-8",
    skip_lines: int = 0,
    header: bool = True,
    required: Sequence[str] = (),
    separator: str = ",",
) -> Ingest:
    """Read exports of one schema, in the order given.

    The first `skip_lines` lines of each file and, with `header`, the heading after them
    are left out by their position. A heading that does not name the schema's columns in
    their order rejects its whole file, since its cells would go to wrong columns.
    """
    lead = skip_lines + int(header)
    names = [f.name for f in schema]
    cells = ", ".join(f"`c{i}` string" for i in range(len(names)))
    options = {"sep": separator, "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    lines = reduce(DataFrame.unionByName, [_lines(spark, p, i, charset) for i, p in enumerate(paths)])
    parsed = lines.withColumn("c", F.from_csv("value", F.lit(f"{cells}, `_bad` string"), options))

    def problem(name: str, text: Column, reason: str, where: Column) -> Column:
        return F.when(where, F.struct(F.lit(name).alias("column"), text.alias("text"), F.lit(reason).alias("reason")))

    found = []
    for i, field in enumerate(schema):
        cell = F.col(f"c.c{i}")
        found.append(problem(field.name, cell, "type", cell.isNotNull() & _value(cell, field.dataType).isNull()))
        if field.name in required:
            found.append(problem(field.name, cell, "missing", cell.isNull()))
    none = F.lit(None).cast("string")
    of_line = F.when(~F.col("readable"), F.array(problem(None, none, "encoding", F.lit(True)))).when(
        F.col("c._bad").isNotNull(), F.array(problem(None, none, "cells", F.lit(True)))
    )
    heading = reduce(Column.__and__, [F.trim(F.col(f"c.c{i}")).eqNullSafe(F.lit(n)) for i, n in enumerate(names)]) & F.col("c._bad").isNull()
    parsed = parsed.select(
        "_src", "file", "block", "at", "value",
        (F.trim("value") == "").alias("blank"),
        F.coalesce(of_line, F.filter(F.array(*found), lambda p: p.isNotNull())).cast(f"array<{_PROBLEM}>").alias("found"),
        heading.alias("is_heading"),
        *[_value(F.col(f"c.c{i}"), f.dataType).alias(f"v{i}") for i, f in enumerate(schema)],
    )
    staged = materialize(parsed, "ingest")

    # One row a block of a file: where its first line stands in the file and in the source.
    blocks = staged.groupBy("_src", "file", "block").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = lambda *keys: F.coalesce(
        F.sum("n").over(Window.partitionBy(*keys).orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    blocks = blocks.select("_src", "file", "block", "first", before("_src").alias("in_src"), before("_src", "file").alias("in_file"))
    inside = F.col("at") - F.col("first")
    # Blocks and files are few and are sent to the lines, which need not move.
    placed = staged.join(F.broadcast(blocks), ["_src", "file", "block"]).withColumns({"_row": F.col("in_src") + inside, "line": F.col("in_file") + inside + 1})
    if header:
        wrong = placed.filter((F.col("line") == lead) & ~F.col("is_heading")).select("_src", "file").distinct().withColumn("wrong", F.lit(True))
        placed = placed.join(F.broadcast(wrong), ["_src", "file"], "left").withColumn("wrong", F.col("wrong").isNotNull())
    else:
        placed = placed.withColumn("wrong", F.lit(False))
    body = placed.filter((F.col("line") > lead) & ~F.col("blank"))
    fits = ~F.col("wrong") & (F.size("found") == 0)
    where = ["_src", "_row", "file", "line"]
    rejected = body.filter(~fits).select(*where, F.col("value").alias("text"))
    of_heading = placed.filter(F.col("wrong") & (F.col("line") == lead)).select(
        *where, none.alias("column"), F.col("value").alias("text"), F.lit("heading").alias("reason")
    )
    of_cells = body.filter(~F.col("wrong")).select(*where, F.explode("found").alias("p")).select(*where, "p.*")
    rows = body.filter(fits).select(*[F.col(f"v{i}").alias(n) for i, n in enumerate(names)], *POSITION)
    return Ingest(rows, rejected, of_cells.unionByName(of_heading))
