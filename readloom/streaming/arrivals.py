"""Reads that arrive as files while a sequencer runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def arriving(spark: SparkSession, folder: str, schema: T.StructType, files_at_once: int = 100) -> DataFrame:
    """Parquet files of a folder as a stream, each once."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).parquet(folder)


def counts_by_window(events: DataFrame, time: str, width: str, late: str, *by: str) -> DataFrame:
    """rows and total of `value` by tumbling windows of event time; what comes later than `late` is left out, and a
    window is given out once none of its rows can come any more."""
    keyed = events.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), *by)
    return keyed.agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("window_start"), *by, "n", "total")
