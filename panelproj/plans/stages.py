"""A run as named stages that are kept: a rerun starts at the first one that is not done."""

import hashlib
import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelproj.sources.manifest import Manifest


class StageStore:
    """Stages under one folder, each known by its name, its parameters and the stages before it.

    A stage that was published with the same key is read; any other is built and published.
    So a changed parameter or input builds the stages that depend on it again, and a run
    that was stopped goes on where it was. `built` lists the stages this run has built.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.manifest = Manifest(spark, root)
        self.built: list[str] = []
        self._keys: dict[str, str] = {}

    def source(self, name: str, version: str) -> None:
        """An input from outside, with what tells its versions apart (see `files_version`)."""
        self._keys[name] = version

    def stage(self, name: str, build: Callable[[], DataFrame], after: Sequence[str] = (), parameters: object = None) -> DataFrame:
        told = json.dumps([name, parameters, [self._keys[a] for a in after]], sort_keys=True, default=repr)
        key = self._keys[name] = hashlib.sha256(told.encode()).hexdigest()
        entry = self.manifest.newest(name, key)
        if entry is not None:
            return self.manifest.open(entry)
        self.built.append(name)
        return self.manifest.publish(build(), name, key)


def files_version(spark: SparkSession, *paths: str) -> str:
    """A hash of the names, sizes and times of all files under some paths; their contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
    one = F.xxhash64("path", "length", F.col("modificationTime").cast("long"))
    return files.agg(F.concat_ws(":", F.count(F.lit(1)), F.sum(one.cast("decimal(38,0)"))).alias("v")).first()["v"]
