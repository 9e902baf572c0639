"""Rows in a global order over stored range partitions, and what runs of equal keys carry from one to the next.

A run of any length may span partitions, so no key needs a task of its own. Rows are worked on within their partition
first; then one row per partition says what the run at its beginning has to add from the partitions before.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stage_table


def in_order(df: DataFrame, *keys: Column | str) -> DataFrame:
    """df in the order of keys: partition after partition, and sorted within."""
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def run_starts(*keys: np.ndarray) -> np.ndarray:
    """For each row of a sorted batch, the place where its run of equal keys begins."""
    n = len(keys[0])
    fresh = np.ones(n, bool)
    if n:
        fresh[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.maximum.accumulate(np.where(fresh, np.arange(n), 0)) if n else np.zeros(0, np.int64)


def per_batch(df: DataFrame, work: Callable[[], Callable[[dict[str, np.ndarray]], dict[str, np.ndarray]]], schema: str) -> DataFrame:
    """A row for each row of df, whose columns are whole numbers without nulls: work() gives, for a partition, a
    function from each batch's columns to those of schema. The column part, the partition's number, is added."""
    names = [f.name for f in T.StructType.fromDDL(schema).fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step, part = work(), TaskContext.get().partitionId()
        for batch in batches:
            if batch.num_rows:
                out = step({n: batch.column(i).to_numpy() for i, n in enumerate(batch.schema.names)})
                yield pa.RecordBatch.from_arrays([*[pa.array(out[n]) for n in names], pa.array(np.full(batch.num_rows, part, np.int32))], names=[*names, "part"])

    return df.mapInArrow(run, f"{schema}, part int")


def carries(stored: DataFrame, first: Column, last: Column, keys: int, join: Callable[[Sequence, Sequence], Sequence]) -> list[tuple]:
    """(part, key..., value...) for each part whose first run goes on from the part before, with what came before.

    first: the smallest key of a part, a struct of `keys` fields. last: the largest row, a struct of the key and then
    the values its last run has within the part. join(before, own) gives both parts' value. A row per part comes to
    the driver, whatever the parts hold.
    """
    out, at, value = [], None, None
    for r in stored.groupBy("part").agg(F.min(first).alias("first"), F.max(last).alias("last")).orderBy("part").collect():
        begins, ends, own = tuple(r["first"]), tuple(r["last"])[:keys], tuple(r["last"])[keys:]
        if begins == at:
            out.append((r["part"], *begins, *value))
            own = tuple(join(value, own)) if ends == begins else own
        at, value = ends, own
    return out


def with_carries(stored: DataFrame, rows: list[tuple], keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """stored with the columns values of carries(), null where nothing is carried. A broadcast of a row per part."""
    schema = T.StructType([stored.schema["part"], *[stored.schema[k] for k in keys], *[T.StructField(v, T.LongType()) for v in values]])
    return stored.join(F.broadcast(stored.sparkSession.createDataFrame(rows, schema)), ["part", *keys], "left")


def numbered(df: DataFrame, key: str, order: Sequence[Column | str], keep: Sequence[str], number: str, name: str) -> DataFrame:
    """key, number (from 1, in order, within the key) and the whole-number columns keep. The table is stored."""
    schema = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in (key, *keep))

    def work() -> Callable[[dict[str, np.ndarray]], dict[str, np.ndarray]]:
        state = {"key": None, "n": 0}

        def step(x: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
            k = x[key]
            start = run_starts(k)
            n = np.arange(1, len(k) + 1) - start
            if state["key"] == k[0]:
                n[start == 0] += state["n"]
            state.update(key=k[-1], n=int(n[-1]))
            return {**x, number: n}

        return step

    rows = per_batch(in_order(df, key, *order).select(key, *keep), work, f"{schema}, {number} long")
    stored = stage_table(rows, name)
    before = carries(stored, F.struct(key), F.struct(key, number), 1, lambda a, b: (a[0] + b[0],))
    return with_carries(stored, before, [key], ["before_"]).select(key, *keep, (F.col(number) + F.coalesce("before_", F.lit(0))).alias(number))
