"""Published tables: written under a path of their own, then named in an append-only list.

A table counts only when the list names it, and a name is added by a job of its own that
commits one small file, so a table is there whole or not at all. Readers look the newest
path up once and keep reading it while the next one is written. Nothing is overwritten or
deleted; the owner of the folder removes old paths. One writer at a time.
"""

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.types import StructType

_ENTRY = "name string, key string, path string, n_rows bigint, schema string, number bigint"


class Manifest:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._list = f"{self.root}/_published"
        self._add([])
        self.entries: list[Row] = self._read()

    def _add(self, entries: Sequence[tuple]) -> None:
        self.spark.createDataFrame(list(entries), _ENTRY).coalesce(1).write.mode("append").json(self._list)

    def _read(self) -> list[Row]:
        """One entry a publication: stages and versions, not rows."""
        return sorted(self.spark.read.schema(_ENTRY).json(self._list).collect(), key=lambda e: e["number"])

    def refresh(self) -> None:
        self.entries = self._read()

    def newest(self, name: str, key: str | None = None) -> Row | None:
        """The last publication of a name, or of a name and key."""
        found = [e for e in self.entries if e["name"] == name and key in (None, e["key"])]
        return found[-1] if found else None

    def open(self, entry: Row) -> DataFrame:
        return self.spark.read.schema(StructType.fromJson(json.loads(entry["schema"]))).parquet(entry["path"])

    def publish(self, df: DataFrame, name: str, key: str, partition_by: Sequence[str] = ()) -> DataFrame:
        path = f"{self.root}/{name}/{uuid.uuid4().hex}"
        writer = df.write.partitionBy(*partition_by) if partition_by else df.write
        writer.parquet(path)
        written = self.spark.read.schema(df.schema).parquet(path)
        number = 1 + max((e["number"] for e in self.entries), default=0)
        self._add([(name, key, path, written.count(), df.schema.json(), number)])
        self.refresh()
        return written
