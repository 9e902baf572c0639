"""Text files whose lines have an order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def place(lines: DataFrame) -> DataFrame:
    """path, start (of the split), line (from 0 in the file), lines (of the file), value of lines as spark.read.text
    gives them.

    Spark reads a file in splits, each within one partition and in order. A line's place in its split comes from ids
    that grow by one, and the lines of a file's earlier splits from a prefix sum over a row per split. That table is broadcast: it
    grows with the number of splits, not with what they hold, and lines stay where they are, in their order.
    """
    read = lines.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("id"), "value")
    splits = read.groupBy("path", "start").agg(F.min("id").alias("first"), F.count("*").alias("own"))
    file = Window.partitionBy("path")
    earlier = F.sum("own").over(file.orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    splits = splits.select("path", "start", (F.coalesce(earlier, F.lit(0)) - F.col("first")).alias("shift"), F.sum("own").over(file).alias("lines"))
    return read.join(F.broadcast(splits), ["path", "start"]).select("path", "start", (F.col("id") + F.col("shift")).alias("line"), "lines", "value")
