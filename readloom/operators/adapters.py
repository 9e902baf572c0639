"""Adapters that nobody named: frequent k-mers of read tails, lengthened base by base, and what reads show beyond the
fragment where their mates overlap."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from readloom.functions.packed import Packed
from readloom.operators.stored import stored
from readloom.operators.trim import _COMPLEMENT, _matrix, overlaps, trim_poly_g

#: Bases of a k-mer, and of a tail.
K, TAIL = 12, 60
#: Counters of a sketch: a k-mer in more than one of so many tails' k-mers is never lost.
COUNTERS = 4096
#: Longest adapter that is told.
MOST = 40


def _keep(keys: np.ndarray, counts: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """A summary of `most` counters: what stands on the next place is taken off all, so any sum of summaries lacks at
    most a `most`-th of all that was counted."""
    if len(keys) <= most:
        return keys, counts
    off = np.partition(counts, len(counts) - most - 1)[len(counts) - most - 1]
    left = counts > off
    return keys[left], counts[left] - off


def frequent_kmers(reads: DataFrame, share: float = 0.005, least: int = 20) -> DataFrame:
    """unit_id, key, n, reads: k-mers that at least about `share` of a unit's reads (unit_id, seq), and `least` of them, have
    in their tails, with a count that lacks at most a COUNTERS-th of the unit's k-mers. A read counts a k-mer once. K-mers with
    over 8 of one letter are left out."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        reads_of: dict[str, int] = {}
        for batch in batches:
            p, units = Packed.of_strings(batch.column(1)), batch.column(0).dictionary_encode()
            unit = units.indices.to_numpy(zero_copy_only=False)
            many = np.clip(p.size - K + 1, 0, TAIL - K + 1)
            of = np.repeat(np.arange(len(many)), many)
            at = np.repeat(p.begin + p.size - K + 1 - many, many) + np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
            good = p.plain(at, K)
            key, of = p.keys(at[good], K), of[good]
            once = np.unique(of << 2 * K | key)  # a read's k-mers
            told, times = np.unique(unit[once >> 2 * K].astype(np.int64) << 2 * K | once & (1 << 2 * K) - 1, return_counts=True)
            begins = np.searchsorted(told, np.arange(len(units.dictionary) + 1) << 2 * K)
            many_of = np.bincount(unit, minlength=len(units.dictionary))
            for i, name in enumerate(units.dictionary.to_pylist()):
                own, counts = told[begins[i] : begins[i + 1]] & (1 << 2 * K) - 1, times[begins[i] : begins[i + 1]]
                before = held.get(name, (np.zeros(0, np.int64), np.zeros(0, np.int64)))
                both, where = np.unique(np.concatenate([before[0], own]), return_inverse=True)
                held[name] = _keep(both, np.bincount(where, weights=np.concatenate([before[1], counts]), minlength=len(both)).astype(np.int64), COUNTERS)
                reads_of[name] = reads_of.get(name, 0) + int(many_of[i])
        for name, (keys, counts) in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * (len(keys) + 1), pa.string()), pa.array([*keys.tolist(), None], pa.int64()), pa.array([*counts.tolist(), reads_of[name]], pa.int64())], names=["unit_id", "key", "n"]
            )

    parts = reads.select("unit_id", "seq").mapInArrow(sketch, "unit_id string, key long, n long").groupBy("unit_id", "key").agg(F.sum("n").alias("n"))
    whole = parts.where("key is null").select("unit_id", F.col("n").alias("reads"))
    digits = [F.shiftright("key", 2 * i).bitwiseAND(F.lit(3)) for i in range(K)]
    most = F.greatest(*[F.size(F.filter(F.array(*digits), _is(b))) for b in range(4)])  # of one letter
    return parts.where("key is not null").join(whole, "unit_id").where((F.col("n") >= F.col("reads") * share) & (F.col("n") >= least) & (most <= 8))


def _is(code: int) -> Callable[[Column], Column]:
    return lambda d: d == code


def _letter(key: str, i: int) -> str:
    return f"substr('ACGT', cast((shiftright({key}, {2 * (K - 1 - i)}) & 3) + 1 as int), 1)"


def _around(tails: DataFrame, seeds: list[tuple[str, int]]) -> DataFrame:
    """unit_id, key, side, place, base, n: how many of a unit's tails (unit_id, tail) have a base so many places before or
    after the first of a seed (unit and k-mer), MOST places at most. A task counts and hands on its counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = {u: i for i, u in enumerate(sorted({u for u, _ in seeds}))}
        wanted = np.sort(np.array([names[u] << 2 * K | key for u, key in seeds], np.int64))
        held, times = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            column, units = batch.column(1).cast(pa.large_string()), batch.column(0).dictionary_encode()
            p = Packed.of_strings(column)
            letters = np.zeros(len(p.codes), np.uint8)
            ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
            letters[np.repeat(p.begin - (ends[:-1] - ends[0]), p.size) + np.arange(ends[-1] - ends[0])] = np.frombuffer(column.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
            unit = np.array([names.get(u, -1) for u in units.dictionary.to_pylist()], np.int64)[units.indices.to_numpy(zero_copy_only=False)]
            many = np.where(unit >= 0, np.maximum(p.size - K + 1, 0), 0)
            of = np.repeat(np.arange(len(many)), many)
            at = np.repeat(p.begin - (np.cumsum(many) - many), many) + np.arange(len(of))
            code = unit[of] << 2 * K | p.keys(at, K)
            seed = np.minimum(np.searchsorted(wanted, code), len(wanted) - 1)
            hit = np.flatnonzero((wanted[seed] == code) & p.plain(at, K))
            _, first = np.unique(of[hit] * len(wanted) + seed[hit], return_index=True)  # hits stand in order of place
            seed, at, of = seed[hit][first], at[hit][first], of[hit][first]
            present, nth = np.unique(seed, return_inverse=True)
            alphabet = np.flatnonzero(np.bincount(letters, minlength=256))
            spelt = np.zeros(256, np.int64)
            spelt[alphabet] = np.arange(len(alphabet))
            for side, begin, step, room in ((0, at - 1, -1, at - p.begin[of]), (1, at + K, 1, p.begin[of] + p.size[of] - at - K)):
                n = np.clip(room, 0, MOST)
                place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                base = letters[np.repeat(begin, n) + step * place]
                counts = np.bincount((np.repeat(nth, n) * MOST + place) * len(alphabet) + spelt[base])
                new = np.flatnonzero(counts)
                counts, spot = counts[new], new // len(alphabet)
                new = ((present[spot // MOST] * 2 + side) * MOST + spot % MOST) << 8 | alphabet[new % len(alphabet)]
                held, where = np.unique(np.concatenate([held, new]), return_inverse=True)
                times = np.bincount(where, weights=np.concatenate([times, counts]), minlength=len(held)).astype(np.int64)
        spot = held >> 8
        own = wanted[spot // (2 * MOST)] if len(held) else held
        yield pa.RecordBatch.from_arrays(
            [pa.array(sorted(names), pa.string()).take(pa.array(own >> 2 * K)), pa.array(own & (1 << 2 * K) - 1), pa.array(["before", "after"]).take(pa.array(spot // MOST % 2)), pa.array((spot % MOST).astype(np.int32)),
             pa.array([chr(c) for c in (held & 255).tolist()], pa.string()), pa.array(times)], names=["unit_id", "key", "side", "place", "base", "n"],
        )

    parts = (tails if seeds else tails.where("false")).mapInArrow(run, "unit_id string, key long, side string, place int, base string, n long")
    return parts.groupBy("unit_id", "key", "side", "place", "base").agg(F.sum("n").alias("n"))


def _consensus(counts: DataFrame, by: list[str], agree: float, least: int) -> DataFrame:
    """by, adapter, differ: the bases of places (counts: by, place, base, n) from 0 on as long as one base has `agree` of
    at least `least` reads, and half of the reads that have the place before, less three standard deviations of such a
    draw: where most end, an adapter does, but reads cut off evenly leave just half of themselves for its last base.
    differ tells whether it ends because that many reads disagree. A row per place is sorted, MOST at most."""
    of = counts.groupBy(*by, "place").agg(F.max(F.struct("n", "base")).alias("top"), F.sum("n").alias("all"))
    earlier = F.coalesce(F.lag("all").over(Window.partitionBy(*by).orderBy("place")), F.lit(0))
    one, many = F.col("top.n") >= F.col("all") * agree, (F.col("all") >= least) & (2 * F.col("all") >= earlier - 3 * F.sqrt(earlier))
    told = of.withColumn("sure", one & many).withColumn("differ", ~one & many)
    parts = told.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("place", F.col("top.base").alias("base"), "sure", "differ"))).alias("parts"))
    stop = F.array_position(F.transform("parts", lambda p: p["sure"]), F.lit(False)).cast("int")
    kept = F.when(F.col("stop") > 0, F.slice("parts", F.lit(1), F.col("stop") - 1)).otherwise(F.col("parts"))
    differ = F.when(F.col("stop") > 0, F.element_at("parts", F.col("stop"))["differ"]).otherwise(False)
    return parts.withColumn("stop", stop).select(*by, F.array_join(F.transform(kept, lambda p: p["base"]), "").alias("adapter"), differ.alias("differ"))


def detect_adapters(reads: DataFrame, share: float = 0.005, agree: float = 0.8, least: int = 20, longest_rank: int = 8) -> DataFrame:
    """unit_id, adapter of units whose reads (unit_id, seq) end in one.

    A unit's `longest_rank` most frequent k-mers of tails (without poly-G) are looked up in all its reads, and the bases
    before and after them counted; the k-mer is lengthened to either side as long as `agree` of the reads agree. Before
    an adapter's first base fragments differ, so where it begins is found too, and copies of one fragment, which agree
    to their first base, are told from it. The most frequent k-mer that leads to an adapter counts. What reads are held
    against is these few k-mers of each unit, units x longest_rank rows; tails are stored, as they are gone through twice.
    """
    tail = F.coalesce(F.right(trim_poly_g(F.col("seq")), F.lit(TAIL + MOST)), F.lit("")).alias("tail")
    tails = stored(reads.where("unit_id is not null").select("unit_id", tail), "tails")
    order = Window.partitionBy("unit_id").orderBy(F.desc("n"), "key")
    kmer = F.concat(*[F.expr(_letter("key", i)) for i in range(K)]).alias("kmer")
    frequent = frequent_kmers(tails.withColumnRenamed("tail", "seq"), share, least)
    seeds = stored(frequent.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= longest_rank).select("unit_id", "rank", "key", kmer), "adapter-seeds")
    listed = [(r["unit_id"], r["key"]) for r in seeds.select("unit_id", "key").collect()]
    around = _around(tails, listed).join(F.broadcast(seeds.select("unit_id", "key", "kmer")), ["unit_id", "key"])
    grown = _consensus(around, ["unit_id", "kmer", "side"], agree, least)
    both = grown.groupBy("unit_id", "kmer").agg(
        F.max(F.when(F.col("side") == "before", F.col("adapter"))).alias("before"), F.max(F.when(F.col("side") == "after", F.col("adapter"))).alias("after"),
        F.bool_or((F.col("side") == "before") & F.col("differ")).alias("begins"),
    )
    whole = F.left(F.concat(F.reverse(F.coalesce("before", F.lit(""))), "kmer", F.coalesce("after", F.lit(""))), F.lit(MOST))
    named = seeds.join(both.where("begins"), ["unit_id", "kmer"]).select("unit_id", "rank", whole.alias("adapter"))
    return named.groupBy("unit_id").agg(F.min_by("adapter", "rank").alias("adapter"))


def detect_pair_adapters(pairs: DataFrame, agree: float = 0.8, least: int = 20) -> DataFrame:
    """unit_id, mate, adapter from pairs (unit_id, seq1, seq2) whose mates overlap and reach beyond the fragment: what
    stands there is the adapter from its first base on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            two_back = pa.array([s.encode().translate(_COMPLEMENT.tobytes())[::-1].decode() for s in batch.column(2).to_pylist()], pa.string())
            (one, n1), (two, n2) = _matrix(batch.column(1)), _matrix(two_back, pad=1)
            offset = overlaps(one, n1, two, n2)
            short = np.flatnonzero(offset < 0)
            fragment = np.minimum(n2[short] + offset[short], n1[short])
            units, firsts, seconds = (batch.column(i).take(pa.array(short)) for i in range(3))
            rows = [(u, mate, s[n : n + MOST]) for mate, column in ((1, firsts), (2, seconds)) for u, s, n in zip(units.to_pylist(), column.to_pylist(), fragment.tolist(), strict=True)]
            columns = list(zip(*rows, strict=True)) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.string())], names=["unit_id", "mate", "rest"])

    rest = pairs.select("unit_id", "seq1", "seq2").mapInArrow(run, "unit_id string, mate int, rest string")
    each = rest.select("unit_id", "mate", F.posexplode(F.split("rest", "")).alias("place", "base")).where("base <> ''")
    return _consensus(each.groupBy("unit_id", "mate", "place", "base").agg(F.count("*").alias("n")), ["unit_id", "mate"], agree, least).where("adapter <> ''").drop("differ")
