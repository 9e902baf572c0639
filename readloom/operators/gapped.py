"""Local alignment with affine gaps within a band, for a whole batch of candidates at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from readloom.functions.alignment import reverse_complement
from readloom.functions.packed import Packed
from readloom.operators.seeds import minimizer_seeds
from readloom.operators.stored import stored_in_waves, waves
from readloom.sources.index import ReferenceIndex
from readloom.sources.reference import windows

#: Seeds that are shuffled at once, with the bases and the reference of what they lead to.
WAVE = 1 << 24
#: Seeds: the least of W neighbouring K-mers, so that W + K - 1 = 23 exact bases have one.
K, W = 15, 9
#: Diagonals that seeds are brought together by, and the largest gap looked for beyond them.
BIN, GAP = 32, 16
MATCH, MISMATCH, OPEN, EXTEND = 1, -4, 6, 1
_LOW = -(1 << 20)
_STOP, _MATCH, _INSERT, _DELETE, _MORE_INSERT, _MORE_DELETE = 0, 1, 2, 3, 4, 8
_OPS = pa.array(["M", "I", "D", "S"])


def banded(reads: np.ndarray, sizes: np.ndarray, refs: np.ndarray, cells: int = 1 << 25) -> dict[str, np.ndarray | pa.Array]:
    """score, begin and end (on the read, end exclusive), ref (where the alignment begins on the reference's row), nm
    and cigar of each read's best local alignment.

    reads: codes by row, 4 beyond sizes. refs: codes by row, 5 where there is no base; base i of a read may meet
    places i to i + band - 1 of its row, where band is what refs has more than reads, plus 1. A gap of n bases costs
    OPEN + n EXTEND. Of equal alignments: the one that ends first, on the read and then on the reference, with gaps as
    far to the left as they go. cells bounds the memory of the ways back, a byte each.
    """
    n, length = reads.shape
    band = refs.shape[1] - length + 1
    lot = max(1, cells // max(1, length * band))
    whole = _whole(reads, sizes, refs, band)
    if (same := whole >= 0).any():  # no programme is needed for these
        rest = np.flatnonzero(~same)
        found = banded(reads[rest], sizes[rest], refs[rest], cells) if len(rest) else None
        sure = {"score": sizes, "begin": np.zeros(n, np.int64), "end": sizes, "ref": whole, "nm": np.zeros(n, np.int64)}
        out = {k: v.astype(found[k].dtype if found else np.int64) for k, v in sure.items()}
        for k in sure if found else ():
            out[k][rest] = found[k]
        texts = pc.binary_join_element_wise(pa.array(sizes.astype(np.int64)).cast(pa.string()), "M", "")
        return out | {"cigar": pc.replace_with_mask(texts, pa.array(~same), found["cigar"]) if found else texts}
    parts = [_lot(reads[i : i + lot], sizes[i : i + lot], refs[i : i + lot], band) for i in range(0, n, lot)]
    return {k: pa.concat_arrays([p[k] for p in parts]) if k == "cigar" else np.concatenate([p[k] for p in parts]) for k in parts[0]}


def _whole(reads: np.ndarray, sizes: np.ndarray, refs: np.ndarray, band: int) -> np.ndarray:
    """The first diagonal on which a read agrees with the reference in every base, -1 if there is none: nothing scores
    more, and of equal alignments it is the one that ends first."""
    beyond = np.arange(reads.shape[1]) >= sizes[:, None]
    out, left = np.full(len(reads), -1, np.int64), np.flatnonzero((sizes > 0) & ((reads < 4) | beyond).all(axis=1))
    for b in range(band):
        good = ((reads[left] == refs[left, b : b + reads.shape[1]]) | beyond[left]).all(axis=1)
        out[left[good]] = b
        left = left[~good]
    return out


def _lot(reads: np.ndarray, sizes: np.ndarray, refs: np.ndarray, band: int) -> dict[str, np.ndarray | pa.Array]:
    n, length = reads.shape
    way = np.zeros((length, n, band), np.uint8)
    best, end_i, end_b = np.zeros(n, np.int32), np.zeros(n, np.int64), np.zeros(n, np.int64)
    h, ins = np.zeros((n, band + 1), np.int32), np.full((n, band + 1), _LOW, np.int32)
    slope = EXTEND * np.arange(band, dtype=np.int32)
    for i in range(length):
        base = reads[:, i : i + 1]
        m = h[:, :band] + np.where((base == refs[:, i : i + band]) & (base < 4), MATCH, MISMATCH).astype(np.int32)
        m[(refs[:, i : i + band] > 4)] = _LOW
        opened = h[:, 1:] - (OPEN + EXTEND)
        more = ins[:, 1:] - EXTEND
        new = np.maximum(opened, more)
        step = np.where(more > opened, _MORE_INSERT, 0).astype(np.uint8)
        top = np.maximum(np.maximum(m, new), 0)
        # a deletion begins best at a cell that isn't one; `reach` is the best such cell to the left, at this cell's cost
        reach = np.maximum.accumulate(top + slope, axis=1)
        gap = np.full_like(top, _LOW)
        gap[:, 1:] = reach[:, :-1] - OPEN - slope[1:]
        step[:, 1:] |= np.where(gap[:, 1:] > top[:, :-1] - OPEN - EXTEND, _MORE_DELETE, 0).astype(np.uint8)
        now = np.maximum(top, gap)
        step |= np.where(now == 0, _STOP, np.where(now == m, _MATCH, np.where(now == new, _INSERT, _DELETE))).astype(np.uint8)
        now[i >= sizes] = 0
        way[i] = step
        h[:, :band], ins[:, :band] = now, new
        peak = now.max(axis=1)
        better = peak > best
        best[better], end_i[better], end_b[better] = peak[better], i, now[better].argmax(axis=1)
    found = _back(way, reads, refs, best, end_i, end_b)
    return {"score": best, "begin": found["begin"], "end": found["end"], "ref": found["ref"], "nm": found["nm"], "cigar": _cigars(found, sizes)}


def _back(way: np.ndarray, reads: np.ndarray, refs: np.ndarray, best: np.ndarray, end_i: np.ndarray, end_b: np.ndarray) -> dict[str, np.ndarray | pa.Array]:
    """From each end back to where the score was 0."""
    n, length = reads.shape
    i, b, state = end_i.copy(), end_b.copy(), np.zeros(n, np.int8)  # state: 0 any, 1 in an insertion, 2 in a deletion
    nm, rows, steps = np.zeros(n, np.int64), [], []
    going = np.flatnonzero(best > 0)
    while len(going):
        gi, gb = i[going], b[going]
        cell = way[gi, going, gb]
        kind = np.where(state[going] == 1, _INSERT, np.where(state[going] == 2, _DELETE, cell & 3))
        stop = (kind == _STOP) & (state[going] == 0)
        going, gi, gb, cell, kind = (x[~stop] for x in (going, gi, gb, cell, kind))
        rows.append(going)
        steps.append((kind - 1).astype(np.int8))
        match, insert, delete = kind == _MATCH, kind == _INSERT, kind == _DELETE
        nm[going] += np.where(match, (reads[going, gi] != refs[going, gi + gb]) | (reads[going, gi] > 3), 1)
        state[going] = np.where(insert & (cell & _MORE_INSERT > 0), 1, np.where(delete & (cell & _MORE_DELETE > 0), 2, 0))
        i[going] -= match | insert
        b[going] += np.where(insert, 1, np.where(delete, -1, 0))
        going = going[i[going] >= 0]
    begin = i + 1
    row = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    op = np.concatenate(steps) if steps else np.zeros(0, np.int8)
    nth = np.concatenate([np.full(len(r), -t) for t, r in enumerate(rows)]) if rows else np.zeros(0, np.int64)
    return {"begin": begin, "end": np.where(best > 0, end_i + 1, begin), "ref": begin + b, "nm": nm, "row": row, "op": op, "nth": nth}


def _cigars(found: dict[str, np.ndarray], sizes: np.ndarray) -> pa.Array:
    """CIGAR strings, from the steps of all rows."""
    n = len(sizes)
    order = np.lexsort((found["nth"], found["row"]))
    row, op = found["row"][order], found["op"][order].astype(np.int64)
    front, back = found["begin"], sizes - found["end"]
    clipped = [(np.flatnonzero(front > 0), front), (np.flatnonzero(back > 0), back)]
    fresh = np.ones(len(row), bool)
    fresh[1:] = (row[1:] != row[:-1]) | (op[1:] != op[:-1])
    at = np.flatnonzero(fresh)
    runs = np.diff(np.append(at, len(row)))
    rows = np.concatenate([clipped[0][0], row[at], clipped[1][0]])
    counts = np.concatenate([front[clipped[0][0]], runs, back[clipped[1][0]]])
    ops = np.concatenate([np.full(len(clipped[0][0]), 3), op[at], np.full(len(clipped[1][0]), 3)])
    place = np.concatenate([np.full(len(clipped[0][0]), -1), np.arange(len(at)), np.full(len(clipped[1][0]), len(at))])
    order = np.lexsort((place, rows))
    texts = pc.binary_join_element_wise(pa.array(counts[order].astype(np.int64)).cast(pa.string()), _OPS.take(pa.array(ops[order])), "")
    offsets = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=n))])
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), texts), "")


def _candidates(reads: DataFrame, index: ReferenceIndex) -> DataFrame:
    """read_id, strand, rname, low, high: the least and greatest diagonal (place on the contig of the read's first base)
    of the seeds in each bin of diagonals."""
    seeds = minimizer_seeds(reads, K, W, index.filter(K, W))
    hits = index.hits(seeds, K, W).select("read_id", "strand", "rname", (F.col("pos") - F.col("offset")).alias("at")).repartition("read_id")
    return hits.groupBy("read_id", "strand", "rname", F.floor(F.col("at") / BIN).alias("bin")).agg(F.min("at").alias("low"), F.max("at").alias("high")).drop("bin")


def _with_reference(candidates: DataFrame, reads: DataFrame, contigs: DataFrame, longest: int, widest: int) -> DataFrame:
    """candidates (diagonals low to high, `widest` at most) with bases of the read's strand, and reference: the contig's
    bases from GAP before the first diagonal (or the contig's first base, `lead` places later) to GAP beyond the last."""
    size = 1024
    while size < longest + widest:
        size *= 2
    pieces = windows(contigs, size, longest + widest + 2 * GAP).select("rname", "window", F.col("start").alias("piece_start"), F.col("bases").alias("piece"))
    bases = F.when(F.col("strand") == 16, reverse_complement(F.col("seq"))).otherwise(F.col("seq"))
    first, span = F.col("low") - GAP, (F.col("high") - F.col("low")).cast("int").alias("span")
    at = candidates.join(reads.select("read_id", "seq"), "read_id").select("read_id", "strand", "rname", "high", span, bases.alias("bases"), first.alias("first"), F.greatest(first, F.lit(1)).alias("begin"))
    joined = at.withColumn("window", F.expr(f"cast((begin - 1) div {size} as int)")).join(pieces, ["rname", "window"])
    reference = F.expr(f"substring(piece, cast(begin - piece_start + 1 as int), cast(greatest(high + length(bases) + {GAP} - begin, 0) as int))")
    return joined.select("read_id", "strand", "rname", "first", (F.col("begin") - F.col("first")).cast("int").alias("lead"), "span", "bases", reference.alias("reference"))


def aligned(candidates: DataFrame, reads: DataFrame, contigs: DataFrame, longest: int, widest: int, least_score: int) -> DataFrame:
    """read_id, strand, rname, pos, cost (the score below 0), cigar, mm (differing bases, gaps too), size of the best
    local alignment of each candidate (read_id, strand, rname, low, high: its diagonals), once each."""
    pairs = _with_reference(candidates, reads, contigs, longest, widest)
    names = ["read_id", "strand", "rname", "cost", "pos", "cigar", "mm", "size"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, other = Packed.of_strings(batch.column(6)), Packed.of_strings(batch.column(7))
            first, lead, span = (batch.column(i).to_numpy() for i in (3, 4, 5))
            order = np.lexsort((span, own.size // 64))
            group = own.size[order] // 64 * 4096 + span[order] // 64
            for lot in np.split(order, np.flatnonzero(np.diff(group)) + 1):  # reads and bands of like sizes together
                if not len(lot):
                    continue
                size = own.size[lot]
                width = int(size.max()) + int(span[lot].max()) + 2 * GAP
                a, b = np.full((len(lot), int(size.max())), 4, np.uint8), np.full((len(lot), width), 5, np.uint8)
                for to, p, shift in ((a, own, np.zeros(len(lot), np.int64)), (b, other, lead[lot])):
                    n = np.clip(to.shape[1] - shift, 0, p.size[lot])
                    r = np.repeat(np.arange(len(lot)), n)
                    c = np.arange(len(r)) - np.repeat(np.cumsum(n) - n, n)
                    to[r, c + shift[r]] = p.codes[p.begin[lot][r] + c]
                found = banded(a, size, b)
                good = np.flatnonzero(found["score"] >= least_score)
                pick = pa.array(lot[good])
                numbers = [-found["score"][good].astype(np.int64), first[lot[good]] + found["ref"][good]]
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(i).take(pick) for i in range(3)], *[pa.array(x) for x in numbers], found["cigar"].take(pa.array(good)), pa.array(found["nm"][good]), pa.array(size[good].astype(np.int32))], names=names,
                )

    schema = pairs.select("read_id", "strand", "rname").schema.add("cost", "long").add("pos", "long").add("cigar", "string").add("mm", "long").add("size", "integer")
    return pairs.mapInArrow(run, schema).repartition("read_id").dropDuplicates(["read_id", "strand", "rname", "pos", "cigar"])


def gapped_hits(reads: DataFrame, contigs: DataFrame, index: ReferenceIndex, sizes: dict[int, int], least_score: int = 30) -> DataFrame:
    """aligned() of all that reads' (read_id, seq) seeds lead to, stored in waves of about WAVE seeds. sizes: how many
    reads have each length."""
    made, longest = sum(n * max(0, size - K + 1) * 2 / (W + 1) for size, n in sizes.items()), max(sizes, default=1)
    return stored_in_waves((aligned(_candidates(part, index), part, contigs, longest, BIN, least_score) for part in waves(reads, made, WAVE)), "gapped-hits")


def best_of(hits: DataFrame) -> DataFrame:
    """Per read the hit of least cost (then by contig, place, strand and CIGAR), n, how many places have that cost, and
    next, the next place's cost. Hits on the best one's strand and contig within the read's length of it are the same
    place told again."""
    own = F.struct("cost", "rname", "pos", "strand", "cigar", "mm")
    read = Window.partitionBy("read_id")
    ranked = hits.withColumn("hit", own).withColumn("best", F.min("hit").over(read))
    same: Column = (F.col("rname") == F.col("best.rname")) & (F.col("strand") == F.col("best.strand")) & (F.abs(F.col("pos") - F.col("best.pos")) < F.col("size"))
    told = ranked.groupBy("read_id").agg(
        F.any_value("best").alias("best"), (F.count_if(~same & (F.col("cost") == F.col("best.cost"))) + 1).alias("n"),
        F.min(F.when(~same & (F.col("cost") > F.col("best.cost")), F.col("cost"))).alias("next"),
    )
    return told.select("read_id", "n", "next", "best.*")
