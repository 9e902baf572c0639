"""Chunks, pilots, mates by place, and what is left to do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def chunk_id(ordinal: Column, reads: int) -> Column:
    """Four digits or more; with reads = 0 all is one chunk."""
    number = (F.floor(ordinal / reads) if reads else F.lit(0)).cast("string")
    return F.lpad(number, F.greatest(F.lit(4), F.length(number)), F.lit("0"))


def read_counts(reads: DataFrame, *by: str) -> DataFrame:
    return reads.groupBy(*by).agg(F.count("*").alias("reads"))


def chunk_ids(chunked: DataFrame) -> DataFrame:
    """The distinct chunks, in order."""
    return chunked.select("unit_id", "chunk_id").distinct().orderBy("unit_id", "chunk_id")


def pilot(reads: DataFrame, fragments: int) -> DataFrame:
    """The first `fragments` of each unit by place: a filter, no sort; 0 keeps all."""
    return reads.where(F.col("ordinal") < fragments) if fragments else reads


def pilot_budget(chunks: DataFrame, fragments: int) -> DataFrame:
    """take, left_over of chunks (unit_id, chunk_id, reads): how many reads each chunk may give when earlier chunks of
    the unit come first. Works on one row per chunk."""
    before = F.coalesce(F.sum("reads").over(Window.partitionBy("unit_id").orderBy("chunk_id").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.greatest(F.lit(fragments) - before, F.lit(0))
    return chunks.withColumn("take", F.least("reads", left).cast("long")).withColumn("left_over", F.greatest(left - F.col("reads"), F.lit(0)).cast("long"))


def mates(one: DataFrame, two: DataFrame) -> DataFrame:
    """The i-th read of a unit's R1 with the i-th of its R2: qname1, seq1, qual1, qname2, seq2, qual2."""
    named = lambda df, i: df.select("unit_id", "ordinal", *[F.col(c).alias(f"{c}{i}") for c in ("qname", "seq", "qual")])
    return named(one, 1).join(named(two, 2), ["unit_id", "ordinal"])


def mate_name_mismatches(paired: DataFrame) -> DataFrame:
    return paired.where("qname1 <> qname2").select("unit_id", "ordinal", "qname1", "qname2")


def pending(expected: DataFrame, done: DataFrame, *by: str) -> DataFrame:
    """Expected rows that no done row matches."""
    return expected.join(done, list(by), "left_anti")
