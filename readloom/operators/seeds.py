"""Reads to seeds, and seeds to placements within a budget of mismatches."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, exp, log
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom.functions.packed import WORD, Packed, minimizers
from readloom.sources.index import WORDS, ReferenceIndex, may_be

#: Longest k-mer of a seed.
MOST_K = 24
#: What a key costs that the filter rules out, in lookups.
_MADE = 0.02
#: Seeds that are shuffled at once, at least.
WAVE = 1 << 24


class Plan(NamedTuple):
    """How reads of one length are looked up: `groups` stretches, of which one has `near` mismatches at most in any
    placement within the budget, each by its first k bases."""

    budget: int
    groups: int
    stretch: int
    near: int
    k: int
    #: Keys of a strand that the index's filter lets through, by chance or not.
    looked: float = 0.0


def index_lengths(bases: int) -> tuple[int, int]:
    """The two k that an index of so many bases has: hits by chance are few for one and none for the other."""
    k = min(16, max(6, ceil(log(max(bases, 1), 4)) + 1))
    return k, k + 2


def plan(length: int, budget: int, bases: int) -> Plan | None:
    """The cheapest way, by keys looked up and hits by chance, that finds all placements of reads of a length. With
    near = 0, a stretch is exact (budget + 1 of them); with near = 1, its k-mer's neighbours are looked up as well, for
    half as many and longer ones. None if reads are shorter than their stretches."""
    best, stretches = None, [(near, groups := -(-(budget + 1) // (near + 1)), length // groups) for near in (0, 1)]
    ways = [(k, *x) for x in stretches for k in index_lengths(bases) if k <= x[2]] or [(min(x[2], MOST_K), *x) for x in stretches if x[2]]
    for k, near, groups, stretch in ways:
        there = min(1.0, bases / 4.0**k)
        looked = groups * (1 + 3 * k * near * min(1.0, there + (1 - exp(-bases / 32 / WORDS)) ** 2))
        cost = looked + groups * (1 + 3 * k * near) * (bases / 4.0**k + _MADE)
        if best is None or cost < best[0]:
            best = cost, Plan(budget, groups, stretch, near, k, looked)
    return best[1] if best else None


_SEED = "k int, key long, offset int, size int, left long, right long, wrong int, odd boolean, budget int"


def exact_seeds(reads: DataFrame, plans: dict[int, Plan], known: dict[int, Broadcast] | None = None) -> DataFrame:
    """read_id, strand and the seeds of reads (read_id, seq) of both strands: k, key, offset on the strand, size of the
    read, the 32 bases before and after the k-mer, mismatches within it (of neighbours 1), whether other letters than
    A, C, G, T are around, and the budget. Such letters match nothing: a stretch with one is looked up with any base there if it may have a mismatch, others by nothing. known: the
    index's filters by k, whose keys alone are given."""
    names = [x.split()[0] for x in _SEED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p, n = Packed.of_strings(batch.column(1), both=True), batch.num_rows
            row = np.concatenate([np.arange(n), np.arange(n)[::-1]])
            strand = np.repeat([0, 16], n).astype(np.int32)
            for size in np.unique(p.size).tolist():
                if (use := plans.get(size)) is None:
                    continue
                own = np.flatnonzero(p.size == size)
                offset = np.tile(np.arange(use.groups) * use.stretch, len(own))
                of = np.repeat(own, use.groups)
                at = p.begin[of] + offset
                near, near_keys = p.one_odd(at, use.k) if use.near else (at[:0], at[:0])
                good = np.flatnonzero(p.plain(at, use.k))
                turns = np.array([0, *[c << 2 * i for i in range(use.k * use.near) for c in (1, 2, 3)]], np.int64)
                key = np.concatenate([(p.keys(at[good], use.k)[:, None] ^ turns[None, :]).ravel(), near_keys])
                kept = np.flatnonzero(may_be(known[use.k].value, key)) if known else np.arange(len(key))
                many = len(good) * len(turns)
                wrong = ((kept % len(turns) > 0) | (kept >= many)).astype(np.int32)
                stood = np.concatenate([good[kept[kept < many] // len(turns)], near[kept[kept >= many] - many]])
                key, of, at, offset = key[kept], of[stood], at[stood], offset[stood]
                odd = ~p.plain(p.begin[of], size)
                columns = [np.full(len(of), use.k, np.int32), key, offset.astype(np.int32), np.full(len(of), size, np.int32), p.word[at - WORD].view(np.int64), p.word[at + use.k].view(np.int64), wrong, odd, np.full(len(of), use.budget, np.int32)]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row[of])), pa.array(strand[of]), *[pa.array(c) for c in columns]], names=["read_id", "strand", *names])

    kind = reads.schema["read_id"].dataType.simpleString()
    return reads.select("read_id", "seq").mapInArrow(run, f"read_id {kind}, strand int, {_SEED}")


def minimizer_seeds(reads: DataFrame, k: int, w: int, known: Broadcast | None = None) -> DataFrame:
    """read_id, strand, key, offset, size of reads' minimizers on both strands, of which the index may have the key if
    its filter is known."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p, n = Packed.of_strings(batch.column(1), both=True), batch.num_rows
            row = np.concatenate([np.arange(n), np.arange(n)[::-1]])
            at, of = minimizers(p, k, w)
            if known:
                there = may_be(known.value, p.keys(at, k))
                at, of = at[there], of[there]
            columns = [np.repeat([0, 16], n)[of].astype(np.int32), p.keys(at, k), (at - p.begin[of]).astype(np.int32), p.size[of].astype(np.int32)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row[of])), *[pa.array(c) for c in columns]], names=["read_id", "strand", "key", "offset", "size"])

    kind = reads.schema["read_id"].dataType.simpleString()
    return reads.select("read_id", "seq").mapInArrow(run, f"read_id {kind}, strand int, key long, offset int, size int")


def _differing(a: str, b: str, mask: Column) -> Column:
    """Bases of two words that differ, of those in the mask."""
    x = F.col(a).bitwiseXOR(F.col(b)).bitwiseAND(mask)
    return F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x5555555555555555)))


def placed(hits: DataFrame) -> DataFrame:
    """read_id, strand, rname, pos, mm, whole of hits that keep to their budget as far as 32 bases to either side tell:
    mm counts mismatches; whole if no base is further off and all are A, C, G, T."""
    after = F.col("size") - F.col("offset") - F.col("k")
    near = lambda n: F.least(n, F.lit(WORD))
    low = F.when(F.col("offset") == 0, F.lit(0).cast("long")).otherwise(F.expr(f"shiftrightunsigned(-1L, 64 - 2 * least(offset, {WORD}))"))
    high = F.when(after == 0, F.lit(0).cast("long")).otherwise(F.expr(f"shiftleft(-1L, 64 - 2 * least(size - offset - k, {WORD}))"))
    inside = (near(F.col("offset")) <= F.col("lead")) & (near(after) <= F.col("tail"))
    mm = F.col("wrong") + _differing("left", "before", low) + _differing("right", "after", high)
    odd = F.col("odd_read") | F.col("odd")
    whole = (F.col("offset") <= WORD) & (after <= WORD) & ~odd
    rows = hits.where(inside & (odd | (mm <= F.col("budget"))))
    return rows.select("read_id", "strand", "rname", (F.col("pos") - F.col("offset")).alias("pos"), F.when(whole, mm).cast("int").alias("mm"), "budget").where("pos >= 1")


def plans_of(budgets: dict[int, int], index: ReferenceIndex) -> dict[int, Plan]:
    return {n: p for n, b in budgets.items() if n and (p := plan(n, b, index.bases))}


def placements(reads: DataFrame, index: ReferenceIndex, budgets: dict[int, int]) -> DataFrame:
    """read_id, strand, rname, pos, budget, mm of candidate placements of reads, once each; mm is null where it isn't
    known yet. budgets: mismatches by length of read."""
    plans = plans_of(budgets, index)
    found = None
    for k in sorted({p.k for p in plans.values()}):
        seeds = exact_seeds(reads, {n: p for n, p in plans.items() if p.k == k}, {k: index.filter(k)}).withColumnRenamed("odd", "odd_read")
        some = placed(index.hits(seeds, k))
        found = some if found is None else found.unionByName(some)
    if found is None:
        return placed(index.hits(exact_seeds(reads, {}).withColumnRenamed("odd", "odd_read"), index_lengths(index.bases)[0])).where("false").drop("mm").withColumn("mm", F.lit(None).cast("int"))
    near = found.repartition("read_id")  # what follows groups by read and more
    return near.groupBy("read_id", "strand", "rname", "pos", "budget").agg(F.max("mm").alias("mm"))
