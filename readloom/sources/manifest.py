"""Lists of input files."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def entries(lines: DataFrame, base: str | Column = "") -> DataFrame:
    """idx, path of lines (idx, line): trimmed, without blank lines and those that begin with #; relative paths stand
    under base. The last line counts with or without a line end."""
    path = F.trim(F.regexp_replace("line", r"[\t\r]", " "))
    base = F.lit(base) if isinstance(base, str) else base
    kept = lines.select("idx", path.alias("path")).where("path <> '' and not startswith(path, '#')")
    return kept.withColumn("path", F.when(F.col("path").startswith("/") | F.col("path").contains("://") | (base == ""), F.col("path")).otherwise(F.concat(base, F.lit("/"), F.col("path"))))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The entries of a manifest file, in order. Fails if there are none."""
    lines = spark.read.text(path).select(F.monotonically_increasing_id().alias("idx"), F.col("value").alias("line"))
    found = entries(lines.coalesce(1), os.path.dirname(path))
    if found.isEmpty():
        raise ValueError(f"{path} names no files")
    return found


def resolve(path: str) -> str:
    """An absolute path without links or ~."""
    return os.path.realpath(os.path.abspath(os.path.expanduser(path)))


def check_gzip(spark: SparkSession, paths: list[str]) -> int:
    """Reads every file to its end and returns the number of lines; Spark fails on a truncated or damaged one."""
    return spark.read.text(paths).select(F.length("value").alias("n")).agg(F.count("n")).first()[0]
