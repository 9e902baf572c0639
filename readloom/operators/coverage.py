"""Depth and coverage of contigs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from readloom.functions import alignment as A
from readloom.functions.cigars import Walk, matched_spans

BIN = 1 << 20


def depth_runs(spans: DataFrame, bin_size: int = BIN) -> DataFrame:
    """rname, start, end, depth: runs of equal depth above 0 of spans (rname, start, end, inclusive).

    Spans are cut at the borders of bins, so each bin is swept by itself from depth 0: starts and ends are aggregated
    by place, and one task never holds a contig.
    """
    first, last = F.expr(f"(start - 1) div {bin_size}"), F.expr(f"(end - 1) div {bin_size}")
    cut = spans.where("end >= start").select("rname", "start", "end", F.explode(F.sequence(first, last)).alias("bin"))
    cut = cut.select("rname", "bin", F.greatest(F.col("start"), F.col("bin") * bin_size + 1).alias("start"), F.least(F.col("end"), (F.col("bin") + 1) * bin_size).alias("end"))
    events = cut.select("rname", "bin", F.explode(F.array(F.struct(F.col("start").alias("at"), F.lit(1).alias("change")), F.struct((F.col("end") + 1).alias("at"), F.lit(-1).alias("change")))).alias("e"))
    places = events.groupBy("rname", "bin", "e.at").agg(F.sum("e.change").alias("change"))
    order = Window.partitionBy("rname", "bin").orderBy("at")
    swept = places.withColumn("depth", F.sum("change").over(order.rowsBetween(Window.unboundedPreceding, 0))).withColumn("next", F.lead("at").over(order))
    return swept.where("depth > 0").select("rname", F.col("at").alias("start"), (F.col("next") - 1).alias("end"), "depth")


def counted_reads(alignments: DataFrame, min_mapq: int = 0) -> DataFrame:
    """What coverage counts: mapped, primary or supplementary, not failed, no duplicates, of enough quality."""
    return alignments.where(A.without(F.col("flag"), A.COVERAGE_MASK)).where(F.col("mapq") >= min_mapq)


def covered_spans(used: DataFrame) -> DataFrame:
    """rname, start, end of the stretches under reads' bases: deletions in between aren't covered."""
    return used.select("rname", F.explode(matched_spans(F.col("pos"), F.col("cigar"))).alias("s")).select("rname", "s.start", "s.end")


def base_qualities(used: DataFrame) -> DataFrame:
    """rname, bases, total: how many bases of reads (rname, cigar, qual) stand over the contig, and their qualities
    together. Clipped and inserted bases don't; reads whose qualities don't fit their CIGAR are left out. A task hands on
    a row per contig and batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, walk = batch.column(0).dictionary_encode(), Walk(batch.column(1))
            qual = batch.column(2).cast(pa.large_string())
            at = np.frombuffer(qual.buffers()[1], np.int64)[qual.offset : qual.offset + len(qual) + 1]
            sums = np.concatenate([[0], np.cumsum(np.frombuffer(qual.buffers()[2] or b"", np.uint8)[at[0] : at[-1]].astype(np.int64) - 33)])
            needed = np.zeros(batch.num_rows, np.int64)
            np.maximum.at(needed, walk.row, walk.read_at + walk.size * np.isin(walk.op, list(b"MIS=X")))
            use = walk.matched() & (needed == np.diff(at))[walk.row]
            begin = (at[:-1] - at[0])[walk.row[use]] + walk.read_at[use]
            total = sums[begin + walk.size[use]] - sums[begin]
            of = names.indices.to_numpy(zero_copy_only=False)[walk.row[use]]
            bases, qualities = (np.bincount(of, weights=w, minlength=len(names.dictionary)).astype(np.int64) for w in (walk.size[use], total))
            yield pa.RecordBatch.from_arrays([names.dictionary, pa.array(bases), pa.array(qualities)], names=["rname", "bases", "total"])

    rows = used.select("rname", "cigar", "qual").mapInArrow(run, "rname string, bases long, total long")
    return rows.groupBy("rname").agg(F.sum("bases").alias("bases"), F.sum("total").alias("total"))


def coverage_by_contig(alignments: DataFrame, contigs: DataFrame, min_mapq: int = 0) -> DataFrame:
    """rname, startpos, endpos, numreads, covbases, coverage (percent), meandepth, meanbaseq, meanmapq of every contig,
    with zeros for those without reads. meanbaseq is the mean quality of the bases that cover it."""
    used = counted_reads(alignments, min_mapq)
    per = used.groupBy("rname").agg(F.count("*").alias("numreads"), F.avg("mapq").alias("meanmapq"))
    runs = depth_runs(covered_spans(used))
    bases = runs.groupBy("rname").agg(F.sum(F.col("end") - F.col("start") + 1).alias("covbases"), F.sum((F.col("end") - F.col("start") + 1) * F.col("depth")).alias("total"))
    quality = base_qualities(used).select("rname", F.try_divide("total", "bases").alias("meanbaseq"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    return contigs.join(per, "rname", "left").join(bases, "rname", "left").join(quality, "rname", "left").select(
        "rname", F.lit(1).cast("long").alias("startpos"), F.col("length").cast("long").alias("endpos"), zero("numreads").alias("numreads"), zero("covbases").alias("covbases"),
        (zero("covbases") * 100.0 / F.col("length")).alias("coverage"), (zero("total").cast("double") / F.col("length")).alias("meandepth"),
        F.coalesce("meanbaseq", F.lit(0.0)).alias("meanbaseq"), F.coalesce("meanmapq", F.lit(0.0)).alias("meanmapq"),
    )


def depth_histogram(alignments: DataFrame, min_mapq: int = 0) -> DataFrame:
    """depth, bases over all contigs, from depth 1."""
    return depth_runs(covered_spans(counted_reads(alignments, min_mapq))).groupBy("depth").agg(F.sum(F.col("end") - F.col("start") + 1).alias("bases"))


def weighted_coverage(coverage: DataFrame) -> DataFrame:
    """avg_depth, pct_covered: means over contigs by length; 0 without length."""
    size = F.col("endpos") - F.col("startpos") + 1
    mean = lambda c: F.coalesce(F.try_divide(F.sum(F.col(c) * size), F.sum(size)), F.lit(0.0))
    return coverage.agg(mean("meandepth").alias("avg_depth"), mean("coverage").alias("pct_covered"))
