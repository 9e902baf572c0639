"""Lines that stand in many documents, found by two Bloom filters before anything is shuffled.

Every task notes its lines' hashes in a filter of those seen once and, where one was there already, in a filter of those
seen twice. Merged, the second filter has every line of two documents or more; only lines it suspects are shuffled, by
their 128-bit keys, and counted exactly. Of the texts, only those that lose lines are shuffled. A filter is sized by the number of lines within a stated memory; more lines are
taken in slices of the hash, each with filters of its own.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import in_bitmap, key_bitmap, short_batches, stage_table
from .ordered import in_order, run_starts

SPACE = b" \t\n\x0b\x0c\r"
#: Bits of a filter at most: 32 MB each for once and twice in a task.
MOST_BITS = 1 << 28
_SEGMENT = 1 << 20
_HASHES = 3


def line_keys(text: bytes | None, least: int) -> tuple[list[bytes], list[bytes | None]]:
    """The lines of a text and, for each, its key: stripped of ASCII white space, A-Z in lower case; None where that
    has fewer than `least` code points. Null is one empty line."""
    lines = (text or b"").split(b"\n")
    keys = [x.strip(SPACE) for x in (text or b"").lower().split(b"\n")]
    return lines, [k if len(k) >= least and (len(k) >= 4 * least or len(k.decode()) >= least) else None for k in keys]


def _places(keys: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """keys: one uint64 a line. The bits of each line, one after the other."""
    for i in range(_HASHES):
        x = keys ^ np.uint64(0x9E3779B97F4A7C15 * (i + 1) & (1 << 64) - 1)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        yield (x ^ (x >> np.uint64(29))) & np.uint64(bits - 1)


class Seen:
    """Two Bloom filters: of what was added, and of what was added again."""

    def __init__(self, bits: int):
        self.bits, self.once, self.twice = bits, np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)

    def add(self, keys: np.ndarray) -> None:
        """keys may hold a key more than once: each time counts."""
        keys = np.sort(keys)
        again = has(self.once, keys)
        again[1:] |= keys[1:] == keys[:-1]
        for at in _places(keys[again], self.bits):
            np.bitwise_or.at(self.twice, (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
        for at in _places(keys[~again], self.bits):
            np.bitwise_or.at(self.once, (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))


def has(filter_: np.ndarray, keys: np.ndarray) -> np.ndarray:
    out = np.ones(len(keys), bool)
    for at in _places(keys, len(filter_) * 8):
        out &= filter_[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1 == 1
    return out


def _digests(column: pa.Array) -> np.ndarray:
    """The keys of a batch's documents, a row of two uint64 each."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, 2)


def twice_seen(keys: DataFrame, bits: int, slices: int = 1, number: int = 0) -> np.ndarray:
    """The merged filter of keys (of one slice) that two documents or more may have. Never without one that has.

    A task makes one pair of filters, so their number is that of the scan's tasks. They are cut into segments of 1 MB
    and merged by segment: what is in a task's once and in that of a task before has been seen twice. The driver gets
    the bits / 8 bytes of the result.
    """

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, held, size = Seen(bits), [], 0
        for batch in batches:
            k = _digests(batch.column(0))[:, 0]
            held.append(k[k % np.uint64(slices) == number])
            size += len(held[-1])
            if size > 1 << 20:
                seen.add(np.concatenate(held))
                held, size = [], 0
        if size:
            seen.add(np.concatenate(held))
        for at in range(0, bits // 8, _SEGMENT):
            once, twice = (f[at : at + _SEGMENT] for f in (seen.once, seen.twice))
            if once.any() or twice.any():
                yield pa.RecordBatch.from_arrays([pa.array([at // _SEGMENT], pa.int32()), pa.array([once.tobytes()], pa.binary()), pa.array([twice.tobytes()], pa.binary())], names=["segment", "once", "twice"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merged: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # the segments that are dealt to this task
        for batch in batches:
            for segment, once, twice in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                once, twice = np.frombuffer(once, np.uint8), np.frombuffer(twice, np.uint8)
                if segment in merged:
                    before, both = merged[segment]
                    both |= twice | (before & once)
                    before |= once
                else:
                    merged[segment] = once.copy(), twice.copy()
        for segment, (_, twice) in merged.items():
            yield pa.RecordBatch.from_arrays([pa.array([segment], pa.int32()), pa.array([twice.tobytes()], pa.binary())], names=["segment", "twice"])

    with short_batches(keys.sparkSession, 16):
        parts = keys.select("keys").mapInArrow(fill, "segment int, once binary, twice binary").repartition("segment").mapInArrow(merge, "segment int, twice binary").toArrow()
    out = np.zeros(bits // 8, np.uint8)
    for segment, twice in zip(parts["segment"].to_pylist(), parts["twice"].to_pylist(), strict=True):
        out[segment * _SEGMENT : segment * _SEGMENT + len(twice)] = np.frombuffer(twice, np.uint8)
    return out


def _suspects(keys: DataFrame, filter_: np.ndarray, slices: int, number: int) -> DataFrame:
    """doc, row, k1, k2: each document's keys that the filter has."""
    sent = keys.sparkSession.sparkContext.broadcast(filter_)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = _digests(batch.column(2))
            many = [len(x) // 16 for x in batch.column(2).to_pylist()]
            hit = np.flatnonzero(k[:, 0] % np.uint64(slices) == number)
            hit = hit[has(sent.value, k[hit, 0])]
            of = np.repeat(np.arange(len(many)), many)[hit]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(of)), batch.column(1).take(pa.array(of)), pa.array(k[hit, 0].view(np.int64)), pa.array(k[hit, 1].view(np.int64))], names=["doc", "row", "k1", "k2"])

    return keys.select("doc", "row", "keys").mapInArrow(run, "doc long, row long, k1 long, k2 long")


def _judged(least: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds to suspects in the order of key and falling doc: n, the place in the key's run, top, the run's first doc, and
    many, whether the run has `least` rows or more in this partition. Fewer than `least` rows of a run wait for it."""
    names = ("k1", "k2", "doc", "row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, key, count, top = TaskContext.get().partitionId(), None, None, 0, 0

        def rows(x: list[np.ndarray], last: bool) -> tuple[pa.RecordBatch | None, list[np.ndarray] | None]:
            nonlocal key, count, top
            k1, k2, doc, _ = x
            start = run_starts(k1, k2)
            n = np.arange(1, len(k1) + 1) - start
            size, tops = np.bincount(start, minlength=len(k1))[start], doc[start]
            if key == (k1[0], k2[0]):
                first = start == 0
                n[first] += count
                size[first] += count
                tops[first] = top
            ends = len(k1)
            if not last and size[-1] < least:
                ends = int(start[-1])
            if ends:
                key, count, top = (k1[ends - 1], k2[ends - 1]), int(n[ends - 1]), tops[ends - 1]
            cut = [a[:ends] for a in (*x, n, tops, size >= least, np.full(len(k1), part, np.int32))]
            batch = pa.RecordBatch.from_arrays([pa.array(a) for a in cut], names=[*names, "n", "top", "many", "part"]) if ends else None
            return batch, [a[ends:] for a in x] if ends < len(k1) else None

        for batch in batches:
            if batch.num_rows:
                x = [batch.column(i).to_numpy() for i in range(4)]
                out, held = rows([np.concatenate(c) for c in zip(held, x, strict=True)] if held else x, False)
                if out:
                    yield out
        if held:
            yield rows(held, True)[0]

    return run


def confirm(suspects: DataFrame, least: int) -> DataFrame:
    """row, k1, k2 of suspects (doc, row, k1, k2) whose key has `least` rows or more, but for those of its largest doc.

    One range shuffle by key, falling doc and row: a key that a third of all documents hold spans partitions. What its
    parts have to know of each other is a row per partition, which the driver adds up.
    """
    sort = (F.col("k1"), F.col("k2"), F.col("doc").desc(), F.col("row"))
    rows = in_order(suspects.select("k1", "k2", "doc", "row"), *sort)
    stored = stage_table(rows.mapInArrow(_judged(least), "k1 long, k2 long, doc long, row long, n long, top long, many boolean, part int"), "line-suspects")
    bounds = stored.groupBy("part").agg(F.min(F.struct("k1", "k2")).alias("first"), F.max(F.struct("k1", "k2", "n", "top")).alias("last")).orderBy("part").collect()
    begins = stored.sparkSession.createDataFrame([(r["part"], *r["first"]) for r in bounds], "part int, k1 long, k2 long")
    counts = dict(stored.join(F.broadcast(begins), ["part", "k1", "k2"]).groupBy("part").count().collect())
    spans: list[list] = []  # key, rows, top, parts
    for r in bounds:
        first, last = tuple(r["first"]), tuple(r["last"])[:2]
        if spans and spans[-1][0] == first:
            spans[-1][1] += counts[r["part"]]
            spans[-1][3].append(r["part"])
        if last != first or not spans or spans[-1][0] != first:
            spans.append([last, r["last"]["n"], r["last"]["top"], [r["part"]]])
    across = [(part, *key, top, n >= least) for key, n, top, parts in spans if len(parts) > 1 for part in parts]
    whole = stored.join(F.broadcast(stored.sparkSession.createDataFrame(across, "part int, k1 long, k2 long, all_top long, all_many boolean")), ["part", "k1", "k2"], "left")
    return whole.where(F.coalesce("all_many", "many") & (F.col("doc") < F.coalesce("all_top", "top"))).select("row", "k1", "k2")


def _rewrite(schema: T.StructType, least: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines_, dropped, kept = [], [], []
            for text, gone in zip(batch.column(1), batch.column(2), strict=True):
                raw, gone = text.as_py() or b"", gone.as_py()
                if not gone:
                    lines_.append(raw.count(b"\n") + 1)
                    dropped.append(0)
                    kept.append(raw)
                    continue
                lines, keys = line_keys(raw, least)
                drop = {np.array([g["k1"], g["k2"]], np.int64).tobytes() for g in gone}
                stay = [x for x, k in zip(lines, keys, strict=True) if k is None or _digest(k) not in drop]
                lines_.append(len(lines))
                dropped.append(len(lines) - len(stay))
                kept.append(b"\n".join(stay))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lines_, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.binary())], names=schema.names)

    return run


def _digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def _keys(least: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [b"".join({_digest(k) for k in line_keys(text.as_py(), least)[1] if k is not None}) for text in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.binary())], names=["doc", "row", "keys"])

    return run


def filter_size(lines: int, most_bits: int = MOST_BITS) -> tuple[int, int]:
    """Bits of a filter, a power of two, and slices: 16 bits a line, and over most_bits at least 8 in each slice."""
    slices = max(1, math.ceil(8 * lines / most_bits))
    return min(most_bits, 1 << max(16, math.ceil(16 * lines / slices) - 1).bit_length()), slices


def drop_repeated_lines(
    docs: DataFrame, least_chars: int = 40, least_docs: int = 5, id_col: str = "doc_id", text_col: str = "text", most_bits: int = MOST_BITS
) -> DataFrame:
    """docs with n_lines, n_dropped and kept (binary UTF-8, the text without the lines it loses); without text_col.

    A line's key is the line stripped of ASCII white space, A-Z in lower case. Keys of at least least_chars code points
    that at least least_docs rows hold lose all their lines except in the rows of the largest id. A null text is one
    empty line; a null id counts as the smallest number; every row is a document, repeated rows too; an empty table
    gives an empty table. Ids are whole numbers. Other columns pass through; those of the three names are replaced.
    """
    rest = [c for c in docs.columns if c not in (text_col, "n_lines", "n_dropped", "kept")]
    lowest = F.lit(-(1 << 63)).cast("long")
    staged = stage_table(
        docs.select(F.struct(*rest).alias("rest"), F.coalesce(F.col(id_col).cast("long"), lowest).alias("doc"), F.monotonically_increasing_id().alias("row"), F.col(text_col).cast("binary").alias("text")),
        "line-documents",
    )
    with short_batches(docs.sparkSession):
        keys = stage_table(staged.select("doc", "row", "text").mapInArrow(_keys(least_chars), "doc long, row long, keys binary").where(F.octet_length("keys") > 0), "line-keys")
    bits, slices = filter_size((keys.agg(F.sum(F.octet_length("keys").cast("long"))).first()[0] or 0) // 16, most_bits)
    suspects = None
    for number in range(slices):
        some = _suspects(keys, twice_seen(keys, bits, slices, number), slices, number)
        suspects = some if suspects is None else suspects.unionByName(some)
    gone = stage_table(confirm(suspects, least_docs).groupBy("row").agg(F.collect_list(F.struct("k1", "k2")).alias("gone")), "line-gone")
    loses = _among(gone.select(F.xxhash64("row").alias("key")), most_bits)
    schema = T.StructType([staged.schema["rest"], *T.StructType.fromDDL("n_lines long, n_dropped long, kept binary").fields])
    lines = (F.length("text") - F.length(F.replace(F.col("text"), F.lit("\n"), F.lit(""))) + 1).cast("long")
    whole = staged.withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    same = whole.where(~loses(F.xxhash64("row"))).select("rest", lines.alias("n_lines"), F.lit(0).cast("long").alias("n_dropped"), F.col("text").cast("binary").alias("kept"))
    with short_batches(docs.sparkSession):
        losing = staged.where(loses(F.xxhash64("row"))).hint("merge").join(gone, "row", "left").select("rest", "text", "gone")
        cut = stage_table(losing.mapInArrow(_rewrite(schema, least_chars), schema), "line-cut")
    return same.unionByName(cut).select("rest.*", "n_lines", "n_dropped", "kept")


def _among(keys: DataFrame, most_bits: int) -> Callable[[Column], Column]:
    """Whether a hash may be one of keys (key): a bitmap of 32 bits a key and of most_bits bits at most."""
    bits = min(most_bits, 1 << max(16, 32 * keys.count() - 1).bit_length())
    sent = keys.sparkSession.sparkContext.broadcast(key_bitmap(keys, "key", bits))

    @F.pandas_udf("boolean")
    def told(key: pd.Series) -> pd.Series:
        return pd.Series(in_bitmap(np.frombuffer(sent.value, np.int64), key.to_numpy()))

    return told
