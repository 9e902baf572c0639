"""Tables stored on the way, in the folder that all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a table that every task may get whole.
FEW = 100_000


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir. Only a session of one machine may go without and gets a folder of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = f"file:///tmp/checkpoints/{spark.sparkContext.applicationId}"
    return f"{folder.rstrip('/')}/readloom"


@contextmanager
def without_leftovers(spark: SparkSession) -> Iterator[None]:
    """Queries within remove their shuffle files as soon as they end, and not when the driver collects garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read back: lineage ends here, and a lost executor costs no rerun. Bases take
    about a quarter of a byte's bits, which zstd finds; shuffles that only led here leave the disk when it is written."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    with without_leftovers(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def few(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """df stored, to be broadcast if it has at most FEW rows, and how many rows it has."""
    kept = stored(df, name)
    rows = kept.count()
    return (F.broadcast(kept) if rows <= FEW else kept), rows


def stored_in_waves(parts: Iterable[DataFrame], name: str) -> DataFrame:
    """The rows of all parts, stored one part after another: what is shuffled for one is gone before the next."""
    path, schema, spark = "", None, None
    for part in parts:
        spark, schema = part.sparkSession, part.schema
        path = path or f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        with without_leftovers(spark):
            part.write.mode("append").option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


def waves(reads: DataFrame, rows: float, most: int) -> Iterator[DataFrame]:
    """reads dealt by read_id into parts of which each leads to about `most` of `rows` rows."""
    many = max(1, -(-int(rows) // most))
    for i in range(many):
        yield reads.where(F.pmod(F.xxhash64("read_id"), F.lit(many)) == i) if many > 1 else reads
