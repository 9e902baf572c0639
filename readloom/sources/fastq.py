"""FASTQ reads. Order in a file has a meaning, so every read carries its place."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.sources.lines import place


_RECORD = "path string, ordinal long, header string, seq string, qual string, whole boolean"


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reads from the lines (path, line, value) of a partition, in their order. What a split's border cuts off comes as
    rows that have a line each."""
    names = [x.split()[0] for x in _RECORD.split(", ")]
    none = lambda n: pa.nulls(n, pa.string())

    def rows(path: pa.Array, line: np.ndarray, value: pa.Array, last: bool) -> tuple[list[pa.RecordBatch], int]:
        code = path.dictionary_encode().indices.to_numpy(zero_copy_only=False)
        n = len(line)
        begins = np.flatnonzero(line % 4 == 0)
        full = begins[begins + 3 < n]
        full = full[(line[full + 3] == line[full] + 3) & (code[full + 3] == code[full])]
        out = [pa.RecordBatch.from_arrays([path.take(pa.array(full)), pa.array(line[full] // 4), *[value.take(pa.array(full + i)) for i in (0, 1, 3)], pa.array(np.ones(len(full), bool))], names=names)]
        open_ = n
        if not last and len(begins) and n - begins[-1] < 4 and line[-1] == line[begins[-1]] + n - 1 - begins[-1] and code[-1] == code[begins[-1]]:
            open_ = int(begins[-1])  # it goes on in the next batch
        cut = np.ones(n, bool)
        cut[open_:] = False
        for i in range(4):
            cut[full + i] = False
        for i in (0, 1, 3):
            some = np.flatnonzero(cut & (line % 4 == i))
            if len(some):
                own = value.take(pa.array(some))
                out.append(pa.RecordBatch.from_arrays([path.take(pa.array(some)), pa.array(line[some] // 4), *[own if i == j else none(len(some)) for j in (0, 1, 3)], pa.array(np.zeros(len(some), bool))], names=names))
        return out, open_

    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        path, line, value = batch.column(0), batch.column(1).to_numpy(), batch.column(2)
        if held:
            path, line, value = pa.concat_arrays([held[0], path]), np.concatenate([held[1], line]), pa.concat_arrays([held[2], value])
        out, open_ = rows(path, line, value, False)
        held = (path.slice(open_), line[open_:], value.slice(open_)) if open_ < len(line) else None
        yield from out
    if held:
        yield from rows(*held, True)[0]


def read_fastq(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path, ordinal, header, seq, qual. Files may be plain or gzip, of several members too, in splits of any size.

    Lines are numbered by place(), and reads are put together where their lines lie; only reads that the border of a
    split cuts through meet by a shuffle. A number of lines that isn't a multiple of four fails.
    """
    lines = place(spark.read.text(paths))
    whole = F.when(F.col("lines") % 4 != 0, F.raise_error(F.concat(F.lit("not a multiple of four lines: "), F.col("path"))).cast("boolean")).otherwise(True)
    found = lines.where(whole).select("path", "line", "value").mapInArrow(_records, _RECORD)
    reads = found.where("whole").drop("whole")
    if all(p.endswith(".gz") for p in paths):  # such files have one split
        return reads
    cut = found.where("not whole").groupBy("path", "ordinal").agg(*[F.max(c).alias(c) for c in ("header", "seq", "qual")])
    return reads.unionByName(cut)


def file_headers(reads: DataFrame, sample: int = 3) -> DataFrame:
    """path, header, header_sample of each file's first reads, by place."""
    few = reads.where(F.col("ordinal") < sample).groupBy("path").agg(F.array_sort(F.collect_list(F.struct("ordinal", "header"))).alias("h"))
    return few.select("path", F.col("h")[0]["header"].alias("header"), F.transform("h", lambda x: x["header"]).alias("header_sample"))


def write_pairs(pairs: DataFrame, path: str, by: tuple[str, ...] = ("qname",)) -> None:
    """Writes pairs (`by`, nth, seq1, qual1, seq2, qual2) as gzip FASTQ under path.R1 and path.R2, and rows with one end
    under path.SE. The n-th read of R1's files and the n-th of R2's are of one pair, file by file.

    Rows are put in the order of `by` by one range shuffle, and a task writes its pairs' both ends, so it can't come
    out otherwise. A stream without reads is an empty file.
    """
    spark, rows = pairs.sparkSession, pairs.repartitionByRange(*by, "nth")
    both = F.col("seq1").isNotNull() & F.col("seq2").isNotNull()
    record = lambda i: F.concat_ws("\n", F.concat(F.lit("@"), F.col("qname")), f"seq{i}", F.lit("+"), f"qual{i}")
    out = lambda stream, text: F.struct(F.lit(stream).alias("stream"), text.alias("value"))
    ends = F.when(both, F.array(out("R1", record(1)), out("R2", record(2)))).otherwise(F.array(out("SE", F.when(F.col("seq1").isNotNull(), record(1)).otherwise(record(2)))))
    lines = rows.select(*by, "nth", F.explode(ends).alias("e")).sortWithinPartitions("e.stream", *by, "nth").select("e.stream", "e.value")
    lines.write.mode("overwrite").partitionBy("stream").option("compression", "gzip").text(path)
    hadoop = spark._jvm.org.apache.hadoop.fs
    files = hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for stream in ("R1", "R2", "SE"):
        made, final = hadoop.Path(f"{path}/stream={stream}"), hadoop.Path(f"{path}.{stream}")
        files.delete(final, True)
        if not files.exists(made):
            spark.createDataFrame([], "value string").coalesce(1).write.option("compression", "gzip").text(f"{path}.{stream}")
        elif not files.rename(made, final):
            raise OSError(f"{made} can't be renamed")
    files.delete(hadoop.Path(path), True)
