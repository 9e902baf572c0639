"""SimHash near-duplicates by pigeonring filtering.

The 64 bits stand in a ring of segments. If two fingerprints differ in at most `most` bits, then from some segment
on, every chain of l consecutive segments differs in at most floor(l * most / segments) bits. While that budget is 0
the segments are equal, and they are the key that brings candidates together; longer chains then prune them before
the full Hamming check.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stage_table

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
BITS = 64


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """A bit is 1 if set in over half the XXH64 of the text's word shingles, repeats included; 0 without words."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate([len(w) + 1 for w in words]))
    starts = [0, *ends]
    hashes = [xxh64_intdigest(joined[a : b - 1], seed) for a, b in zip(starts, ends[min(shingle, len(words)) - 1 :], strict=False)]
    ones = np.zeros(BITS, np.int64)
    values = np.array(hashes, np.uint64)
    for at in range(0, len(values), 1 << 15):
        ones += np.unpackbits(values[at : at + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(values), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, seed: int = 42) -> DataFrame:
    """doc_id, fp long: the fingerprint of each row's whole text. Null text has no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(t.as_py(), shingle, seed) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64))], names=["doc_id", "fp"])

    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("fp", T.LongType())])
    return docs.select(id_col, text_col).mapInArrow(run, schema)


def ring(most: int) -> tuple[list[int], int]:
    """Segment widths and how many consecutive ones make a key, for a Hamming bound from 1: 2 * most + 1 segments, and
    the longest chain of budget 0."""
    n = 2 * most + 1
    return [BITS // n + (i < BITS % n) for i in range(n)], max(l for l in range(1, n + 1) if l * most // n == 0)


def _masks(widths: list[int]) -> list[np.uint64]:
    at, out = 0, []
    for w in widths:
        out.append(np.uint64(((1 << w) - 1) << at))
        at += w
    return out


def _within(values: np.ndarray, start: int, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of places in values whose chains from segment `start` on keep their budgets, block by block."""
    widths, _ = ring(most)
    masks, n = _masks(widths), len(widths)
    chains, mask = [], np.uint64(0)
    for l in range(1, n + 1):
        mask |= masks[(start + l - 1) % n]
        chains.append((mask, l * most // n))
    for at in range(0, len(values), 512):
        differ = values[at : at + 512, None] ^ values[None, at:]
        i, j = np.nonzero(np.ones(differ.shape, bool) if len(values) < 2 else np.triu(np.ones(differ.shape, bool), 1))
        differ = differ[i, j]
        for mask, budget in chains:
            keep = np.bitwise_count(differ & mask) <= budget
            i, j, differ = i[keep], j[keep], differ[keep]
        if len(i):
            yield i + at, j + at


def _forest(values: np.ndarray, start: int, most: int) -> list[tuple[int, int]]:
    """(member, root) for the members of each connected group of values but its root."""
    root = list(range(len(values)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i, j in _within(values, start, most):
        for a, b in zip(i.tolist(), j.tolist(), strict=True):
            if (a := find(a)) != (b := find(b)):
                root[max(a, b)] = min(a, b)
    return [(x, r) for x in range(len(values)) if (r := find(x)) != x]


def links(nodes: DataFrame, most: int = 2, bucket: int = 1024) -> DataFrame:
    """a, b: links between different fingerprints of nodes (fp, distinct) at most `most` bits apart, enough of them
    that whatever is connected by all links is connected by these.

    Each fingerprint goes to one bucket per segment, keyed by the chain of segments that must be equal. Buckets of
    over `bucket` fingerprints are dealt again by the next chain, of budget 1: its segments with one bit left out,
    once for each bit. Two values that differ in that bit at most meet there, and a bucket's size is bounded by the
    bits that remain.
    """
    widths, length = ring(most)
    n, starts, at = len(widths), [], 0
    for w in widths:
        starts.append(at)
        at += w
    part = lambda i: F.shiftrightunsigned("fp", starts[i % n]).bitwiseAND(F.lit((1 << widths[i % n]) - 1))

    def chain(first: int, many: int):
        out = part(first)
        for i in range(first + 1, first + many):
            out = F.shiftleft(out, widths[i % n]).bitwiseOR(part(i))
        return out

    keyed = nodes.select("fp", F.explode(F.array(*[F.struct(F.lit(i).alias("start"), chain(i, length).alias("key")) for i in range(n)])).alias("s")).select("fp", "s.*")
    hot = stage_table(keyed.groupBy("start", "key").count().where(F.col("count") > bucket).select("start", "key"), "simhash-hot")
    usual = keyed.join(hot, ["start", "key"], "left_anti").withColumn("left_out", F.lit(-1)).withColumn("rest", F.lit(0).cast("long"))
    wider = max(l for l in range(1, n + 1) if l * most // n <= 1)
    if wider > length:
        rest = F.element_at(F.array(*[chain(i + length, wider - length) for i in range(n)]), F.col("start") + 1)
        bits = F.element_at(F.array(*[F.lit(sum(widths[(i + k) % n] for k in range(length, wider))) for i in range(n)]), F.col("start") + 1)
        again = keyed.join(hot, ["start", "key"]).withColumn("left_out", F.explode(F.sequence(F.lit(0), bits - 1))).withColumn("rest", rest)
        again = again.withColumn("rest", F.col("rest").bitwiseAND(F.bitwise_not(F.expr("shiftleft(1L, left_out)"))))
    else:
        again = keyed.join(hot, ["start", "key"]).withColumn("left_out", F.lit(-1)).withColumn("rest", F.lit(0).cast("long"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for start, members in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                values = np.sort(members.values.to_numpy()).view(np.uint64)
                for x, r in _forest(values, start, most):
                    a.append(int(values.view(np.int64)[x])), b.append(int(values.view(np.int64)[r]))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    buckets = usual.select("start", "key", "left_out", "rest", "fp").unionByName(again.select("start", "key", "left_out", "rest", "fp"))
    met = buckets.groupBy("start", "key", "left_out", "rest").agg(F.collect_list("fp").alias("members")).where(F.size("members") > 1)
    return met.select("start", "members").mapInArrow(run, "a long, b long").distinct()


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """node, root of the nodes of edges (a, b long): root is the smallest node of the component.

    Large-star and small-star in turn: every node's neighbours, then its smaller ones, are tied to the smallest of
    them, until nothing changes. The minimum of a node's neighbours is aggregated before the shuffle; each round is
    stored. Links of a node with itself don't count.
    """
    now = stage_table(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "components")
    state = lambda e: e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    before = state(now)
    for _ in range(rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stage_table(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "components-large")
        large = stage_table(both.join(least, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "components-mid")
        small = stage_table(large.groupBy("u").agg(F.min("v").alias("m")), "components-small")
        tied = large.join(small, "u")
        now = stage_table(
            tied.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(tied.select("u", F.col("m").alias("v"))).distinct(),
            "components",
        )
        after = state(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components took more than {rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def near_duplicates(docs: DataFrame, most: int = 2, shingle: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp, component_id: the smallest doc_id that links of at most `most` bits reach, the row's own included.

    Every row is returned. Rows of equal texts or fingerprints are one node, whose smallest id is taken before any
    shuffle of candidates; null ids are never the smallest, so a component of null ids alone has null; null, empty
    and blank texts have fingerprint 0, linked like any other; an empty table gives no rows.
    """
    prints = stage_table(fingerprints(docs, id_col, text_col, shingle, seed), "simhash-prints")
    nodes = stage_table(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-nodes")
    member = components(links(nodes.select("fp"), most)).withColumnRenamed("node", "fp")
    joined = stage_table(member.join(nodes, "fp"), "simhash-members")
    smallest = stage_table(joined.groupBy("root").agg(F.min("first").alias("component")), "simhash-components")
    of_node = joined.select("fp", "root").join(smallest, "root").select("fp", "component")
    of_all = stage_table(nodes.join(of_node, "fp", "left").select("fp", F.coalesce("component", "first").alias("component_id")), "simhash-labels")
    return prints.join(of_all, "fp").select("doc_id", "fp", "component_id")
