"""Files to units: pairs and single files, by what their headers say."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from readloom.functions.headers import direction, qname


def describe(headers: DataFrame) -> DataFrame:
    """idx, key, direction (and path, reads if there) of headers (idx, header, header_sample)."""
    rest = [c for c in headers.columns if c not in ("header", "header_sample")]
    return headers.select(*rest, qname(F.col("header")).alias("key"), direction(F.col("header"), F.col("header_sample")).alias("direction"))


def _by_key(files: DataFrame) -> DataFrame:
    count = lambda d: F.count_if(F.col("direction") == d)
    least = lambda d: F.min(F.when(F.col("direction") == d, F.col("idx")))
    unknown = F.col("direction") == "UNKNOWN"
    return files.groupBy("key").agg(
        count("R1").alias("n1"), count("R2").alias("n2"), count("UNKNOWN").alias("n0"), least("R1").alias("i1"), least("R2").alias("i2"),
        F.min(F.when(unknown, F.col("idx"))).alias("u1"), F.max(F.when(unknown, F.col("idx"))).alias("u2"),
    )


def conflicts(files: DataFrame) -> DataFrame:
    """key, problem of the keys whose files can't be made into units."""
    problem = (
        F.when(F.col("n1") > 1, "two R1").when(F.col("n2") > 1, "two R2")
        .when((F.col("n2") == 1) & (F.col("n1") == 0), "R2 without R1")
        .when(F.col("n0") > 2, "over two unmarked")
        .when((F.col("n0") == 2) & (F.col("n1") + F.col("n2") > 0), "unmarked pair of a marked key")
    )
    return _by_key(files).select("key", problem.alias("problem")).where("problem is not null")


def orphans(files: DataFrame) -> DataFrame:
    """key, idx of R2 files whose key has no R1 file."""
    r1 = files.where("direction = 'R1'").select("key")
    return files.where("direction = 'R2'").join(r1, "key", "left_anti").select("key", "idx")


def units(files: DataFrame) -> DataFrame:
    """unit_id, kind, key, idx1, idx2 of files (idx, key, direction) without conflicts.

    R1 and R2 of a key are a pair, R1 alone is single; one unmarked file is single, and of two the one listed first
    is R1. Numbers follow the manifest, of four digits or more. Keys are aggregated first, so the numbering sorts units, not files.
    """
    by = _by_key(files)
    marked = by.where("n1 = 1").select("key", F.when(F.col("n2") == 1, "PE").otherwise("SE").alias("kind"), F.col("i1").alias("idx1"), F.col("i2").alias("idx2"))
    bare = by.where("n0 between 1 and 2").select("key", F.when(F.col("n0") == 2, "PE").otherwise("SE").alias("kind"), F.col("u1").alias("idx1"), F.when(F.col("n0") == 2, F.col("u2")).alias("idx2"))
    number = F.row_number().over(Window.partitionBy("kind").orderBy("idx1"))
    return marked.unionByName(bare).select(F.format_string("%s%04d", "kind", number).alias("unit_id"), "kind", "key", "idx1", "idx2")


def sequencing_mode(unit_rows: DataFrame) -> DataFrame:
    """seq_mode: PE, SE or MIX, and the numbers of units."""
    pe, se = F.count_if(F.col("kind") == "PE"), F.count_if(F.col("kind") == "SE")
    return unit_rows.agg(F.when((pe > 0) & (se > 0), "MIX").when(pe > 0, "PE").otherwise("SE").alias("seq_mode"), pe.alias("pe_units"), se.alias("se_units"))


def count_mismatches(pairs: DataFrame, counts: DataFrame) -> DataFrame:
    """unit_id, reads1, reads2 of pairs (unit_id, idx1, idx2) whose files differ in reads; counts: idx, reads."""
    one = counts.select(F.col("idx").alias("idx1"), F.col("reads").alias("reads1"))
    two = counts.select(F.col("idx").alias("idx2"), F.col("reads").alias("reads2"))
    return pairs.where("idx2 is not null").join(one, "idx1").join(two, "idx2").where("reads1 <> reads2").select("unit_id", "reads1", "reads2")
