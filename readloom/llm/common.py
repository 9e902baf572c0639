"""What the corpus operators share: word rules, stage tables in the shared folder, bounded bitmaps."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share. A local session without one gets its own; a cluster must name it."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = f"file:///tmp/checkpoints/{spark.sparkContext.applicationId}"
    return path.rstrip("/")


def stage_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/readloom/{name}-{uuid.uuid4().hex}"


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Writes df to the shared folder and reads it back: lineage ends here, and a lost executor costs no rerun."""
    spark = df.sparkSession
    path = stage_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def short_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """While open, the session sends rows to Python in batches of at most `rows`, as rows that hold whole texts are
    long and both ends keep a batch in memory. Holds for what runs inside; afterwards the setting is as it was."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    if not 0 < int(before) <= rows:
        spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def word_count(text: Column) -> Column:
    """Number of words; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def key_bitmap(keys: DataFrame, column: str, bits: int = 1 << 26) -> bytes:
    """A bitmap of `bits` bits with those set that 64-bit keys fall on: bits / 8 bytes on the driver, whatever the
    number of keys. For thinning rows before an exact join; when it fills up it thins less, and no row is lost.

    bits must be a power of two. Null keys set nothing.
    """
    at = F.col(column).bitwiseAND(F.lit(bits - 1))
    words = (
        keys.where(F.col(column).isNotNull())
        .select(F.shiftright(at, 6).alias("word"), F.expr(f"shiftleft(1L, cast({column} & 63 as int))").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bit"))
    )
    out = np.zeros(bits // 64, dtype=np.int64)
    for batch in words.toArrow().to_batches():
        out[batch.column(0).to_numpy()] = batch.column(1).to_numpy()
    return out.tobytes()


def in_bitmap(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """bitmap: key_bitmap()'s bytes as int64. keys: int64."""
    at = keys & (bitmap.size * 64 - 1)
    return (bitmap[at >> 6].view(np.uint64) >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
