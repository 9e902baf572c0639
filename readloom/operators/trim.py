"""Trimming, filtering and merging of reads.

Tails, quality and length are DataFrame expressions; only adapters and overlaps, which compare bases at every offset,
are Arrow kernels, over whole batches at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from readloom.functions.alignment import qualities

_COMPLEMENT = np.frombuffer(bytes.maketrans(b"ACGTNacgtn", b"TGCANtgcan"), np.uint8)


def trim_poly_g(seq: Column, least: int = 10) -> Column:
    """seq without a tail of `least` or more G."""
    return F.regexp_replace(seq, rf"G{{{least},}}\z", "")


def poly_g_trimmed(reads: DataFrame, least: int = 10) -> DataFrame:
    """reads with seq, and qual if there, cut."""
    out = reads.withColumn("cut_", trim_poly_g(F.col("seq"), least))
    if "qual" in reads.columns:
        out = out.withColumn("qual", F.expr("left(qual, length(cut_))"))
    return out.withColumn("seq", F.col("cut_")).drop("cut_")


def good_quality(seq: Column, qual: Column, qualified: int = 15, bad_percent: int = 40, most_n: int = 5) -> Column:
    """At most bad_percent of the bases under `qualified`, and at most most_n N."""
    low = F.size(F.filter(qualities(qual), lambda q: q < qualified))
    return (low * 100 <= F.length(qual) * bad_percent) & (F.length(seq) - F.length(F.replace(seq, F.lit("N"), F.lit(""))) <= most_n)


def long_enough(seq: Column, least: int = 30) -> Column:
    return F.length(seq) >= least


def _matrix(column: pa.Array, pad: int = 0) -> tuple[np.ndarray, np.ndarray]:
    texts = [x.encode() for x in column.to_pylist()]
    sizes = np.array([len(t) for t in texts], np.int64)
    width = int(sizes.max(initial=0))
    return np.frombuffer(b"".join(t.ljust(width, bytes([pad])) for t in texts), np.uint8).reshape(len(texts), width), sizes


def _strings(rows: np.ndarray, sizes: np.ndarray, valid: np.ndarray | None) -> pa.Array:
    """The first bytes of each row, as many as sizes says, as strings; null where valid says so."""
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    data = rows[np.arange(rows.shape[1])[None, :] < sizes[:, None]].astype(np.uint8)
    mask = None if valid is None else pa.array(valid).buffers()[1]
    return pa.StringArray.from_buffers(len(sizes), pa.py_buffer(offsets), pa.py_buffer(data), mask)


def adapter_starts(reads: np.ndarray, sizes: np.ndarray, adapter: bytes, least: int = 4, per_mismatch: int = 8) -> np.ndarray:
    """Where in each read the adapter, or as much of it as the read's end holds, first begins with at most one mismatch
    per per_mismatch bases; the read's length if nowhere."""
    out, letters = sizes.copy(), np.frombuffer(adapter, np.uint8)
    open_ = np.ones(len(sizes), bool)
    for at in range(reads.shape[1] - least + 1):
        k = np.minimum(sizes - at, len(letters))
        rows = np.flatnonzero(open_ & (k >= least))
        if not len(rows):
            continue
        span = min(len(letters), reads.shape[1] - at)
        inside = np.arange(span)[None, :] < k[rows, None]
        wrong = ((reads[rows, at : at + span] != letters[None, :span]) & inside).sum(axis=1)
        hit = rows[wrong <= k[rows] // per_mismatch]
        out[hit], open_[hit] = at, False
    return out


def adapter_trimmed(reads: DataFrame, adapter: str) -> DataFrame:
    """reads (seq, qual and others) cut where the adapter begins; an empty adapter cuts nothing."""
    if not adapter:
        return reads
    rest = [c for c in reads.columns if c not in ("seq", "qual")]
    schema = T.StructType([reads.schema[c] for c in (*rest, "seq", "qual")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seq, qual = batch.column(len(rest)).to_pylist(), batch.column(len(rest) + 1).to_pylist()
            ends = adapter_starts(*_matrix(batch.column(len(rest))), adapter.encode()).tolist()
            cut = lambda column: pa.array([x[:e] for x, e in zip(column, ends, strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(rest)], cut(seq), cut(qual)], names=schema.names)

    return reads.select(*rest, "seq", "qual").mapInArrow(run, schema)


def own_adapter_trimmed(reads: DataFrame) -> DataFrame:
    """reads (seq, qual, adapter and others) cut where the row's adapter begins; null or empty cuts nothing. Without the
    column adapter."""
    rest = [c for c in reads.columns if c not in ("seq", "qual", "adapter")]
    schema = T.StructType([reads.schema[c] for c in (*rest, "seq", "qual")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seq, qual, adapter = (batch.column(len(rest) + i).to_pylist() for i in range(3))
            ends = [len(s) for s in seq]
            for name in {a for a in adapter if a}:
                rows = [i for i, a in enumerate(adapter) if a == name]
                starts = adapter_starts(*_matrix(batch.column(len(rest)).take(pa.array(rows))), name.encode())
                for i, e in zip(rows, starts.tolist(), strict=True):
                    ends[i] = e
            cut = lambda column: pa.array([x[:e] for x, e in zip(column, ends, strict=True)], pa.string())  # noqa: E731, B023
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(rest)], cut(seq), cut(qual)], names=schema.names)

    return reads.select(*rest, "seq", "qual", "adapter").mapInArrow(run, schema)


def overlaps(one: np.ndarray, n1: np.ndarray, two: np.ndarray, n2: np.ndarray, least: int = 30, most: int = 5, percent: int = 20) -> np.ndarray:
    """Where the second read, already reverse-complemented, begins on the first: the first offset of 0, 1, ... and
    then -1, -2, ... at which they overlap by `least` bases with few mismatches. A large number if at none."""
    none = np.iinfo(np.int64).max
    out = np.full(len(n1), none)
    for offset in [*range(one.shape[1] - least + 1), *range(-1, -(two.shape[1] - least) - 1, -1)]:
        a, b = max(offset, 0), max(-offset, 0)
        k = np.minimum(n1 - a, n2 - b)
        rows = np.flatnonzero((out == none) & (k >= least))
        if not len(rows):
            continue
        span = min(one.shape[1] - a, two.shape[1] - b)
        inside = np.arange(span)[None, :] < k[rows, None]
        wrong = ((one[rows, a : a + span] != two[rows, b : b + span]) & inside).sum(axis=1)
        out[rows[(wrong <= most) & (wrong * 100 <= k[rows] * percent)]] = offset
    return out


def merged_pairs(pairs: DataFrame) -> DataFrame:
    """pairs (seq1, qual1, seq2, qual2 and others) with merged_seq and merged_qual, null where the mates don't
    overlap, and with what reaches beyond the fragment cut off both mates where they do.

    Where the mates differ, the base of higher quality counts, the first mate's on a tie.
    """
    own = ("seq1", "qual1", "seq2", "qual2")
    rest = [c for c in pairs.columns if c not in own]
    schema = T.StructType([pairs.schema[c] for c in (*rest, *own)] + T.StructType.fromDDL("merged_seq string, merged_qual string").fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (one, n1), (q1, _), (two, n2), (q2, _) = (_matrix(batch.column(len(rest) + i)) for i in range(4))
            # the second mate turned: its last base first, where it stands at the matrix's left
            turn = np.maximum(n2[:, None] - 1 - np.arange(two.shape[1])[None, :], 0)
            back = _COMPLEMENT[np.take_along_axis(two, turn, axis=1)]
            back_q = np.take_along_axis(q2, turn, axis=1)
            back[np.arange(two.shape[1])[None, :] >= n2[:, None]] = 1
            offset = overlaps(one, n1, back, n2)
            found = offset < np.iinfo(np.int64).max
            offset = np.where(found, offset, 0)
            skip = np.maximum(-offset, 0)  # the fragment is shorter than the reads: what reaches beyond it goes
            cut2 = n2 - skip
            cut1 = np.where(skip > 0, np.minimum(n1, cut2), n1)
            offset = np.maximum(offset, 0)
            size = np.where(found, np.maximum(cut1, offset + cut2), 0)
            at = np.arange(int(size.max(initial=0)))[None, :]
            on2 = at - offset[:, None] + skip[:, None]
            has1, has2 = at < cut1[:, None], (at >= offset[:, None]) & (at < (offset + cut2)[:, None])
            pick = lambda m, i: np.take_along_axis(m, np.clip(i, 0, max(0, m.shape[1] - 1)), axis=1) if m.shape[1] else np.zeros(i.shape, np.uint8)
            first = np.broadcast_to(at, has1.shape)
            own = has1 & (~has2 | (pick(q1, first) >= pick(back_q, on2)))
            merged = [_strings(np.where(own, pick(m, first), pick(w, on2)), size, found) for m, w in ((one, back), (q1, back_q))]
            ends = [_strings(m, n, None) for m, n in ((one, cut1), (q1, cut1), (two, cut2), (q2, cut2))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(rest)], *ends, *merged], names=schema.names)

    return pairs.select(*rest, *own).mapInArrow(run, schema)


def _passes(seq: str, qual: str, min_length: int) -> Column:
    return good_quality(F.col(seq), F.col(qual)) & long_enough(F.col(seq), min_length)


def trim_pairs(pairs: DataFrame, min_length: int = 30, adapter1: str = "", adapter2: str = "") -> DataFrame:
    """unit_id, ordinal, read_class, mate, qname, seq, qual of pairs (mates() of limits): merged where the mates
    overlap, unmerged where both pass the filters, unpaired1 or unpaired2 where one does."""
    cut = pairs.select("unit_id", "ordinal", "qname1", "qname2", *[F.expr(f"regexp_replace(seq{i}, 'G{{10,}}\\\\z', '')").alias(f"seq{i}") for i in (1, 2)], "qual1", "qual2")
    cut = cut.withColumns({f"qual{i}": F.expr(f"left(qual{i}, length(seq{i}))") for i in (1, 2)})
    for i, adapter in ((1, adapter1), (2, adapter2)):
        if adapter:
            cut = adapter_trimmed(cut.withColumnsRenamed({f"seq{i}": "seq", f"qual{i}": "qual"}), adapter).withColumnsRenamed({"seq": f"seq{i}", "qual": f"qual{i}"})
    found = merged_pairs(cut)
    whole, first, second = _passes("merged_seq", "merged_qual", min_length), _passes("seq1", "qual1", min_length), _passes("seq2", "qual2", min_length)
    kind = F.when(F.col("merged_seq").isNotNull(), F.when(whole, "merged")).when(first & second, "unmerged").when(first, "unpaired1").when(second, "unpaired2")
    out = lambda mate, seq, qual: F.struct(F.lit(mate).alias("mate"), F.col(f"qname{mate}").alias("qname"), F.col(seq).alias("seq"), F.col(qual).alias("qual"))
    one, two = out(1, "seq1", "qual1"), out(2, "seq2", "qual2")
    reads = F.when(F.col("read_class") == "merged", F.array(out(1, "merged_seq", "merged_qual"))).when(F.col("read_class") == "unmerged", F.array(one, two)).when(F.col("read_class") == "unpaired1", F.array(one)).otherwise(F.array(two))
    return found.withColumn("read_class", kind).where("read_class is not null").select("unit_id", "ordinal", "read_class", F.explode(reads).alias("r")).select("unit_id", "ordinal", "read_class", "r.*")


def trim_singles(reads: DataFrame, min_length: int = 30, adapter: str = "", adapters: DataFrame | None = None) -> DataFrame:
    """The same of single reads (unit_id, ordinal, qname, seq, qual), all of class se. adapters (unit_id, adapter, a row
    per unit that has one) is for those units; adapter is for all."""
    cut = adapter_trimmed(poly_g_trimmed(reads.select("unit_id", "ordinal", "qname", "seq", "qual")), adapter)
    if adapters is not None:
        cut = own_adapter_trimmed(cut.join(adapters, "unit_id", "left"))
    return cut.where(_passes("seq", "qual", min_length)).select("unit_id", "ordinal", F.lit("se").alias("read_class"), F.lit(1).alias("mate"), "qname", "seq", "qual")
