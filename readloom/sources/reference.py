"""Reference genomes, whole and in pieces."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from readloom.operators.stored import stored


#: Longer lines are cut up.
_LINE = 1 << 14
_PIECE = "start long, nth long, name string, local long, bases string"


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines (start, value) of a partition, in order: nth contig that begins in the split (0: it began before), its
    name at its header, and where the line's bases begin among those of this contig in this split."""
    state: dict = {"start": None, "nth": 0, "local": 0}
    names = [x.split()[0] for x in _PIECE.split(", ")]
    for batch in batches:
        if not batch.num_rows:
            continue
        start = np.repeat(batch.column(0).to_numpy(), 1)
        text = pc.utf8_trim_whitespace(batch.column(1))
        long = pc.greater(pc.utf8_length(text), _LINE).to_numpy(zero_copy_only=False)
        if long.any():
            parts = [[x[i : i + _LINE] for i in range(0, max(1, len(x)), _LINE)] if big and not x.startswith(">") else [x] for x, big in zip(text.to_pylist(), long.tolist(), strict=True)]
            start, text = np.repeat(start, [len(p) for p in parts]), pa.array([x for p in parts for x in p], pa.string())
        head = pc.starts_with(text, ">").to_numpy(zero_copy_only=False)
        bases = pc.if_else(pa.array(head), "", pc.utf8_upper(text))
        size = pc.utf8_length(bases).to_numpy().astype(np.int64)
        fresh = np.ones(len(start), bool)
        fresh[1:] = start[1:] != start[:-1]
        fresh[0] = start[0] != state["start"]
        split = np.maximum.accumulate(np.where(fresh, np.arange(len(start)), -1))
        heads = np.cumsum(head)
        nth = np.where(split < 0, state["nth"] + heads, heads - (heads - head)[np.maximum(split, 0)])
        contig = np.maximum.accumulate(np.where(fresh | head, np.arange(len(start)), -1))
        before = np.cumsum(size) - size
        local = np.where(contig < 0, state["local"] + before, before - before[np.maximum(contig, 0)])
        state.update(start=start[-1], nth=int(nth[-1]), local=int(local[-1] + size[-1]))
        name = pc.struct_field(pc.extract_regex(text, r"^>(?P<n>\S*)"), 0)
        yield pa.RecordBatch.from_arrays([pa.array(start), pa.array(nth), pc.if_else(pa.array(head), name, None), pa.array(local), bases], names=names)


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """tid, rname, offset, bases: the lines of a FASTA file, each with its place among its contig's bases, from 0; a
    contig's header is a row without bases. Names end at the first white space; what stands before the first header is
    left out.

    Lines are read in order within their split, and what a split has to know of earlier ones, how many contigs begin
    there and how many bases its first one has by then, is a prefix sum over a row per split. No row holds a contig.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_block_start").alias("start"), "value")
    placed = stored(lines.mapInArrow(_pieces, _PIECE), "fasta")
    contigs = placed.groupBy("start", "nth").agg(F.max(F.col("local") + F.length("bases")).alias("size"))
    splits = contigs.groupBy("start").agg(F.max("nth").alias("heads"), F.max_by("size", "nth").alias("last"))
    order = Window.orderBy("start")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    group = F.sum(F.when(F.col("heads") > 0, 1).otherwise(0)).over(order.rowsBetween(Window.unboundedPreceding, 0))
    since = F.sum("last").over(Window.partitionBy("group").orderBy("start").rowsBetween(Window.unboundedPreceding, 0))
    known = splits.withColumn("group", group).withColumn("since", since)
    known = known.select("start", F.coalesce(F.sum("heads").over(earlier), F.lit(0)).alias("before"), F.coalesce(F.lag("since").over(order), F.lit(0)).alias("carried"))
    of = placed.join(F.broadcast(known), "start").withColumn("tid", F.col("before") + F.col("nth") - 1).where("tid >= 0")
    named = of.where("name is not null").select("tid", F.col("name").alias("rname"))
    offset = F.col("local") + F.when(F.col("nth") == 0, F.col("carried")).otherwise(0)
    return of.where("name is not null or bases <> ''").join(named, "tid").select("tid", "rname", offset.alias("offset"), "bases")


def lengths(lines: DataFrame) -> DataFrame:
    """tid, rname, length of read_fasta()'s contigs."""
    return lines.groupBy("tid", "rname").agg(F.max(F.col("offset") + F.length("bases")).alias("length"))


def _windows_of_lines(lines: DataFrame, step: int, overlap: int) -> DataFrame:
    size = F.length("bases")
    first = F.greatest(F.lit(0).cast("long"), F.floor((F.col("offset") - step - overlap) / step) + 1)
    each = lines.where(size > 0).select("rname", "offset", "bases", F.explode(F.sequence(first, F.floor((F.col("offset") + size - 1) / step))).alias("window"))
    parts = each.groupBy("rname", "window").agg(F.array_sort(F.collect_list(F.struct("offset", "bases"))).alias("parts"))
    begin = F.col("window") * step
    whole = F.array_join(F.transform("parts", lambda p: p["bases"]), "")
    return parts.select("rname", F.col("window").cast("int").alias("window"), (begin + 1).alias("start"), F.substring(whole, (begin - F.col("parts")[0]["offset"] + 1).cast("int"), F.lit(step + overlap)).alias("bases"))


def windows(contigs: DataFrame, step: int = 1024, overlap: int = 1024) -> DataFrame:
    """rname, window, start (from 1), bases: contigs in overlapping pieces, so that no task holds a whole contig.

    contigs: lines (rname, offset, bases), of which each piece takes those that it covers; or whole (rname, seq). A place in a string is found by walking to it, so contigs are cut in three rounds, each into 64 parts at most of
    the round before, and the walks stay short.
    """
    if "seq" not in contigs.columns:
        return _windows_of_lines(contigs, step, overlap)
    cut = contigs.where(F.length("seq") > 0).select("rname", F.lit(0).cast("long").alias("at"), F.col("seq").alias("bases"))
    for size, most in ((step * 4096, 1 << 31), (step * 64, step * 4096), (step, step * 64)):
        parts = F.explode(F.expr(f"sequence(0, cast((least(length(bases), {most}) - 1) div {size} as int))"))
        cut = cut.select("rname", "at", "bases", parts.alias("part")).select(
            "rname", F.expr(f"at + cast(part as bigint) * {size}").alias("at"), F.expr(f"substring(bases, part * {size} + 1, {size + overlap})").alias("bases")
        )
    return cut.select("rname", F.expr(f"cast(at div {step} as int)").alias("window"), (F.col("at") + 1).alias("start"), "bases")
