"""What trimming did: counts before and after, and quality and bases by cycle."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_BASES = ("A", "C", "G", "T")
_CYCLE = "unit_id string, cycle int, n long, a long, c long, g long, t long, quality long, q20 long, q30 long"


def by_cycle(reads: DataFrame) -> DataFrame:
    """unit_id, cycle (from 1), n, a, c, g, t (bases by letter), quality (the sum), q20, q30 (bases of that quality or
    more) of reads (unit_id, seq, qual). A task hands on a row per unit, cycle and batch."""
    names = [x.split()[0] for x in _CYCLE.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = batch.column(0).dictionary_encode()
            unit = units.indices.to_numpy(zero_copy_only=False)
            flat = []
            for i in (1, 2):
                column = batch.column(i).cast(pa.large_string())
                at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
                flat.append((np.frombuffer(column.buffers()[2] or b"", np.uint8)[at[0] : at[-1]], np.diff(at)))
            (seq, size), (qual, also) = flat
            if not np.array_equal(size, also):
                raise ValueError("bases and qualities of different lengths")
            longest = int(size.max(initial=0))
            cycle = np.arange(len(seq)) - np.repeat(np.cumsum(size) - size, size)
            cell = np.repeat(unit, size).astype(np.int64) * longest + cycle
            cells = len(units.dictionary) * longest
            score = qual.astype(np.int64) - 33
            count = lambda weights: np.bincount(cell, weights=weights, minlength=cells).astype(np.int64)  # noqa: E731, B023
            columns = [count(None), *[count(seq == ord(b)) for b in _BASES], count(score), count(score >= 20), count(score >= 30)]
            some = np.flatnonzero(columns[0])
            yield pa.RecordBatch.from_arrays([units.dictionary.take(pa.array(some // max(1, longest))), pa.array((some % max(1, longest) + 1).astype(np.int32)), *[pa.array(c[some]) for c in columns]], names=names)

    rows = reads.select("unit_id", "seq", "qual").mapInArrow(run, _CYCLE)
    return rows.groupBy("unit_id", "cycle").agg(*[F.sum(c).alias(c) for c in names[2:]])


def _totals(reads: DataFrame, cycles: DataFrame, when: str) -> DataFrame:
    counted = reads.groupBy("unit_id").agg(F.count("*").alias(f"reads_{when}"))
    sums = cycles.groupBy("unit_id").agg(F.sum("n").alias(f"bases_{when}"), F.sum("q20").alias(f"q20_{when}"), F.sum("q30").alias(f"q30_{when}"), F.sum(F.col("g") + F.col("c")).alias(f"gc_{when}"))
    return counted.join(sums, "unit_id", "left")


def trim_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """unit_id and reads, bases, q20, q30 and gc (bases that are G or C) before and after, for each unit of before."""
    both = _totals(before, by_cycle(before), "before").join(_totals(after, by_cycle(after), "after"), "unit_id", "left")
    return both.select("unit_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in both.columns if c != "unit_id"])


def as_json(report: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """unit_id, value: trim_report() and by_cycle() of both sides as a JSON text per unit, whose cycles are as many as
    the longest read has bases."""
    mean = lambda c, d: F.try_divide(F.col(c).cast("double"), F.col(d))
    out = report
    for when, cycles in (("before", before), ("after", after)):
        row = F.struct("cycle", mean("quality", "n").alias("quality"), *[mean(b.lower(), "n").alias(b) for b in _BASES])
        curves = cycles.groupBy("unit_id").agg(F.array_sort(F.collect_list(row)).alias("curve"))
        pick = lambda c: F.transform("curve", lambda x: x[c]).alias(c)  # noqa: E731, B023
        curves = curves.select("unit_id", F.struct(F.struct(pick("quality")).alias("quality_curves"), F.struct(*[pick(b) for b in _BASES]).alias("content_curves")).alias(f"reads_{when}_filtering"))
        out = out.join(curves, "unit_id", "left")
    side = lambda when: F.struct(
        F.col(f"reads_{when}").alias("total_reads"), F.col(f"bases_{when}").alias("total_bases"), F.col(f"q20_{when}").alias("q20_bases"), F.col(f"q30_{when}").alias("q30_bases"),
        mean(f"gc_{when}", f"bases_{when}").alias("gc_content"),
    ).alias(f"{when}_filtering")
    whole = F.struct(F.struct(side("before"), side("after")).alias("summary"), F.struct(F.col("reads_after").alias("passed_filter_reads")).alias("filtering_result"), "reads_before_filtering", "reads_after_filtering")
    return out.select("unit_id", F.to_json(whole).alias("value"))
