"""Counts of reads and fragments and the summary of a sample."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.functions import alignment as A

# Columns of the summary, in order.
SUMMARY = (
    "sample", "library_type", "seq_mode", "pilot_fragments", "max_reads_per_chunk", "mapq", "raw_R1_reads", "raw_R2_reads", "raw_fragments",
    "trimmed_fragments", "merged_reads", "unpaired_reads", "mapped_reads_all", "mapped_reads_unique", "mapped_fragments_all", "mapped_fragments_unique",
    "endog", "duprate", "avg_readlen", "mapped_bp", "avg_depth", "pct_covered",
)


def raw_counts(raw: DataFrame, trimmed: DataFrame) -> DataFrame:
    """One row of six counts. raw: kind (PE or SE), mate, with a pair counted by its R1; trimmed: read_class, mate,
    with unmerged pairs counted by their first mate."""
    pe, se, first = F.col("kind") == "PE", F.col("kind") == "SE", F.col("mate") == 1
    before = raw.agg(F.count_if(first).alias("raw_R1_reads"), F.count_if(pe & first).alias("raw_R2_reads"), F.count_if(first & (pe | se)).alias("raw_fragments"))
    kind = F.col("read_class")
    after = trimmed.agg(
        F.count_if((kind != "unmerged") | (F.col("mate") == 1)).alias("trimmed_fragments"),
        F.count_if(kind == "merged").alias("merged_reads"),
        F.count_if(kind.isin("unpaired1", "unpaired2")).alias("unpaired_reads"),
    )
    return before.crossJoin(after)  # one row each


def fragment_counts(marked: DataFrame) -> DataFrame:
    """mapped_fragments_all, dup_fragments, mapped_fragments_unique in one pass over marked alignments."""
    counted = A.without(F.col("flag"), A.STATS_MASK) & A.represents_fragment(F.col("flag"))
    every, dup = F.count_if(counted), F.count_if(counted & A.has(F.col("flag"), A.DUPLICATE))
    return marked.agg(every.alias("mapped_fragments_all"), dup.alias("dup_fragments"), F.greatest(every - dup, F.lit(0)).alias("mapped_fragments_unique"))


def duplicate_rate(counts: DataFrame) -> DataFrame:
    rate = F.when(F.col("mapped_fragments_all") > 0, F.col("dup_fragments") / F.col("mapped_fragments_all")).otherwise(0.0)
    return counts.select("mapped_fragments_all", "dup_fragments", rate.alias("duprate"))


def endogenous(counts: DataFrame, raw_fragments: int) -> DataFrame:
    rate = F.when(F.lit(raw_fragments) > 0, F.col("mapped_fragments_unique") / F.lit(float(max(raw_fragments, 1)))).otherwise(0.0)
    return counts.select("mapped_fragments_unique", rate.alias("endog"))


def read_lengths(final: DataFrame) -> DataFrame:
    """avg_readlen, mapped_bp over reads with a sequence, soft clips included."""
    size = F.length("seq")
    return final.agg(F.coalesce(F.avg(F.when(size > 0, size)), F.lit(0.0)).alias("avg_readlen"), F.coalesce(F.sum(size), F.lit(0)).alias("mapped_bp"))


def mapping_statistics(marked: DataFrame) -> DataFrame:
    """All counts of the summary that come from alignments, in one pass: marked has duplicates flagged, not removed."""
    flag = F.col("flag")
    for_stats, dup = A.without(flag, A.STATS_MASK), A.has(flag, A.DUPLICATE)
    fragment, final = for_stats & A.represents_fragment(flag), A.without(flag, A.DEDUP_MASK)
    size = F.length("seq")
    every, twice = F.count_if(fragment), F.count_if(fragment & dup)
    return marked.agg(
        F.count_if(for_stats).alias("mapped_reads_all"), F.count_if(for_stats & ~dup).alias("mapped_reads_unique"), every.alias("mapped_fragments_all"),
        F.greatest(every - twice, F.lit(0)).alias("mapped_fragments_unique"), F.when(every > 0, twice / every).otherwise(0.0).alias("duprate"),
        F.coalesce(F.avg(F.when(final & for_stats & (size > 0), size)), F.lit(0.0)).alias("avg_readlen"), F.coalesce(F.sum(F.when(final & for_stats, size)), F.lit(0)).alias("mapped_bp"),
    )


def summary(settings: dict[str, object], raw: DataFrame, mapping: DataFrame, coverage: DataFrame) -> DataFrame:
    """The one row of SUMMARY from one-row parts; settings gives the columns that no part has."""
    row = raw.crossJoin(mapping).crossJoin(coverage)
    endog = F.when(F.col("raw_fragments") > 0, F.col("mapped_fragments_unique") / F.col("raw_fragments")).otherwise(0.0)
    row = row.withColumn("endog", endog)
    return row.select(*[F.col(c) if c in row.columns else F.lit(settings[c]).alias(c) for c in SUMMARY])


def trim_only_summary(settings: dict[str, object], raw: DataFrame) -> DataFrame:
    """The same row with 0 for what only mapping gives."""
    return raw.select(*[F.col(c) if c in raw.columns else F.lit(settings.get(c, 0)).alias(c) for c in SUMMARY])
