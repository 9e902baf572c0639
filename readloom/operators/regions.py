"""Looking up what stands over a stretch of a contig in alignments stored in coordinate order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.functions import alignment as A


def _last(df: DataFrame) -> DataFrame:
    return df.withColumn("last_", F.greatest(F.col("pos"), F.col("pos") + A.reference_length(F.col("cigar")) - 1))


def write_regions(ordered: DataFrame, path: str) -> None:
    """Writes alignments, as coordinate_sorted() gives them, to path, and to path.regions what each file covers of each
    contig: from its first position to the last base that any of its reads reaches, in stretches of 16 kb."""
    ordered.write.mode("overwrite").parquet(path)
    spark = ordered.sparkSession
    mapped = _last(spark.read.parquet(path).where(A.without(F.col("flag"), A.UNMAPPED)).select("rname", "pos", "cigar", F.col("_metadata.file_name").alias("file")))
    covered = mapped.groupBy("file", "rname", F.floor((F.col("pos") - 1) / 16384).alias("stretch")).agg(F.min("pos").alias("first"), F.max("last_").alias("last"))
    covered.repartitionByRange("rname", "first").sortWithinPartitions("rname", "first").write.mode("overwrite").parquet(f"{path}.regions")


def region(spark: SparkSession, path: str, rname: str, start: int, end: int) -> DataFrame:
    """The mapped alignments of write_regions() that reach into start to end (from 1, inclusive) of a contig. Only files
    whose stretches meet the region are opened; their names, not their rows, come to the driver."""
    files = spark.read.parquet(f"{path}.regions").where((F.col("rname") == rname) & (F.col("first") <= end) & (F.col("last") >= start)).select("file").distinct().collect()
    schema = spark.read.parquet(path).schema
    if not files:
        return spark.createDataFrame([], schema)
    found = spark.read.schema(schema).parquet(*sorted(f"{path}/{f['file']}" for f in files))
    inside = (F.col("rname") == rname) & (F.col("pos") <= end) & A.without(F.col("flag"), A.UNMAPPED)
    return _last(found.where(inside)).where(F.col("last_") >= start).drop("last_")
