"""Alignments as SAM text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The mandatory columns of the format, in order.
COLUMNS = ("qname", "flag", "rname", "pos", "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual")
_NUMBERS = {"flag": "int", "pos": "long", "mapq": "int", "pnext": "long", "tlen": "long"}


def read_sam(spark: SparkSession, path: str) -> DataFrame:
    """The mandatory columns, and tags by name (as TYPE:value); header lines are left out."""
    parts = spark.read.text(path).where("value <> '' and not startswith(value, '@')").select(F.split("value", "\t").alias("p"))
    own = [F.col("p")[i].cast(_NUMBERS.get(c, "string")).alias(c) for i, c in enumerate(COLUMNS)]
    tags = F.map_from_entries(F.transform(F.slice("p", 12, 1 << 20), lambda t: F.struct(F.substring(t, 1, 2), F.substring(t, 4, 1 << 20))))
    return parts.select(*own, tags.alias("tags"))


def write_sam(alignments: DataFrame, contigs: DataFrame, path: str, sample: str) -> None:
    """Writes a folder whose files, one after another, are a SAM file: part of the header, then the reads in order of
    contig and position. alignments: what coordinate_sorted() gives, as it is. A table that was stored in between has
    lost its order, as Spark reads files by size."""
    head = contigs.orderBy("tid").select(F.concat(F.lit("@SQ\tSN:"), "rname", F.lit("\tLN:"), "length").alias("value"))
    spark = alignments.sparkSession
    top = spark.createDataFrame([("@HD\tVN:1.6\tSO:coordinate",)], "value string").unionByName(head)
    top = top.unionByName(spark.createDataFrame([(f"@RG\tID:{sample}\tSM:{sample}\tLB:{sample}\tPL:illumina",)], "value string"))
    top.coalesce(1).write.mode("overwrite").text(f"{path}/header")
    tags = F.array_join(F.transform(F.array_sort(F.map_entries("tags")), lambda e: F.concat(e["key"], F.lit(":"), e["value"])), "\t")
    line = F.concat_ws("\t", *COLUMNS, F.when(F.size("tags") > 0, tags))
    alignments.select(line.alias("value")).write.mode("overwrite").text(f"{path}/reads")
