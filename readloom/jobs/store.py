"""Stored stages of a run. A stage counts as done when its table was committed whole, under the settings it has."""

from __future__ import annotations

import re
from collections.abc import Callable
from time import sleep

from py4j.java_gateway import JavaObject
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def described(spark: SparkSession, path: str) -> str:
    """Whole path, size and time of change of a file: what tells it from a later one under its name."""
    status = _status(spark, path)
    return f"{status.getPath().toUri()} {status.getLen()} {status.getModificationTime()}"


def uri(spark: SparkSession, path: str) -> str:
    """The path of a file as Spark's file metadata says it, but for the slashes after the scheme (see same_uri)."""
    return re.sub(_SCHEME, "file:/", _status(spark, path).getPath().toUri().toString())


def same_uri(path: Column) -> Column:
    """Paths of file metadata in the form of uri()."""
    return F.regexp_replace(path, _SCHEME, "file:/")


_SCHEME = "^file:/+"


def _status(spark: SparkSession, path: str) -> JavaObject:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(hadoop)


class StageStore:
    def __init__(self, spark: SparkSession, folder: str, resume: bool = True):
        self.spark, self.folder, self.resume = spark, folder.rstrip("/"), resume
        self.reused: list[str] = []

    def path(self, stage: str, key: str) -> str:
        return f"{self.folder}/{stage}-{key}"

    def done(self, stage: str, key: str) -> bool:
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        mark = hadoop.Path(f"{self.path(stage, key)}/_SUCCESS")
        return bool(mark.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(mark))

    def run(self, stage: str, key: str, make: Callable[[], DataFrame]) -> DataFrame:
        """The stored table, made if it isn't there or resuming is off. What a broken run left has no mark and is
        overwritten; so is nothing else."""
        path = self.path(stage, key)
        if self.resume and self.done(stage, key):
            self.reused.append(stage)
        else:
            make().write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    def run_in_chunks(self, stage: str, key: str, chunks: DataFrame, make: Callable[[DataFrame], DataFrame], waves: int = 1) -> DataFrame:
        """The stored table of all chunks (unit_id, chunk_id, a row each), made from those that aren't committed yet.

        make gives the rows of some chunks, with their columns. Chunks are made in `waves`; each overwrites its own
        partitions alone, and its chunks are noted as committed once it is written, so what a broken run finished stays.
        """
        path, by = self.path(stage, key), ["unit_id", "chunk_id"]
        marks = f"{path}.chunks"
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        files = hadoop.Path(marks).getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not self.resume:
            for old in (marks, path):
                files.delete(hadoop.Path(old), True)
        left = chunks.select(*by)
        if files.exists(hadoop.Path(marks)):
            left = left.join(self.spark.read.schema("unit_id string, chunk_id string").parquet(marks), by, "left_anti")
        pending = left.orderBy(*by).collect()  # a row per chunk
        size = max(1, -(-len(pending) // max(1, waves)))
        for at in range(0, len(pending), size):
            some = self.spark.createDataFrame(pending[at : at + size], "unit_id string, chunk_id string")
            make(some).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
            some.coalesce(1).write.mode("append").parquet(marks)
        if not pending:
            self.reused.append(stage)
        if not files.exists(hadoop.Path(path)):  # no chunks at all
            return make(self.spark.createDataFrame([], "unit_id string, chunk_id string"))
        found = self.spark.read.parquet(path).schema  # which takes 0001 for a number
        schema = StructType([StructField(f.name, StringType()) if f.name in by else f for f in found.fields])
        return self.spark.read.schema(schema).parquet(path)

    def reset(self) -> None:
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        folder = hadoop.Path(self.folder)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)


def with_retries(check: Callable[[], bool], attempts: int = 5, seconds: float = 15.0) -> bool:
    """Whether check holds within so many attempts; an unreadable table counts as not yet there."""
    for i in range(attempts):
        try:
            if check():
                return True
        except AnalysisException:
            pass
        if i + 1 < attempts:
            sleep(seconds)
    return False
