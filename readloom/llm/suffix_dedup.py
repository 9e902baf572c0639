"""Removal of repeated byte strings through a sparse suffix array sorted deep-shallow.

A string of `length` bytes that occurs twice holds the same anchors both times: the leftmost smallest hash of its
`anchor`-byte substrings. Anchors (a few in a hundred positions) are counted over the corpus, and those that occur
once fall away. Occurrences with equal surroundings, everything that a string through the anchor can cover, are one
class, counted before the shuffle by a digest of 128 bits; classes of several are settled by that. For the rest, the
suffixes from the anchor and the reversed prefixes before it are sorted among the classes of the anchor: by words to
a shallow depth with multikey quicksort, and what still ties by blind tries. Common prefixes of neighbours then say
for each of the strings through the anchor whether another occurrence has the same.

An anchor with more classes than are sorted together is split by the bytes around it: strings that begin `lo` to `hi`
bytes before the anchor all hold the `lo` bytes before it and `length - hi` from it, so classes that differ there
never meet. Halving the range makes what they share longer, until every group is small or a single string.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import in_bitmap, key_bitmap, short_batches, stage_table

_BASE = 0x9E3779B97F4A7C15 | 1
_CHUNK = 1 << 18


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2 ** 64."""
    ones = lambda x: np.concatenate([[np.uint64(1)], np.full(n - 1, x, np.uint64)])
    inverse = pow(_BASE, -1, 1 << 64)
    return np.cumprod(ones(_BASE), dtype=np.uint64), np.cumprod(ones(inverse), dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _segments(sizes: np.ndarray, length: int, reach: int) -> Iterator[list[tuple[int, int, int, int, int]]]:
    """Lots of about _CHUNK bytes of (row, from, to, first start, end of starts); long documents come in parts that
    overlap by what strings and surroundings need."""
    lot, total = [], 0
    for row, n in enumerate(sizes.tolist()):
        for s in range(0, max(0, n - length + 1), 4 * _CHUNK):
            e = min(s + 4 * _CHUNK, n - length + 1)
            lo, hi = max(0, s - reach), min(n, e + reach + length)
            if lot and total + hi - lo > _CHUNK:
                yield lot
                lot, total = [], 0
            lot.append((row, lo, hi, s, e))
            total += hi - lo
    if lot:
        yield lot


def anchors(values: np.ndarray, offsets: np.ndarray, length: int, anchor: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Arrays row, position, anchor hash for the texts values[offsets[i]:offsets[i + 1]]."""
    reach = length - anchor
    sizes, last = np.diff(offsets), {}
    for lot in _segments(sizes, length, reach):
        data = np.concatenate([values[offsets[r] + lo : offsets[r] + hi] for r, lo, hi, _, _ in lot])
        m = len(data)
        power, inverse = _powers(max(2 * _CHUNK, 1 << int(m + 1).bit_length()))
        prefix = np.zeros(m + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:m], out=prefix[1:])
        grams = _mix((prefix[anchor:] - prefix[:-anchor]) * inverse[: m - anchor + 1])
        packed = (grams & ~np.uint64(0xFFFFFF)) | np.arange(len(grams), dtype=np.uint64)
        wide = reach + 1
        blocks = np.full(-(-len(packed) // wide) * wide, np.iinfo(np.uint64).max, np.uint64)
        blocks[: len(packed)] = packed
        blocks = blocks.reshape(-1, wide)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        starts = m - length + 1
        at = np.minimum(behind[:starts], ahead[reach : reach + starts]) & np.uint64(0xFFFFFF)
        begins = np.cumsum([0] + [hi - lo for _, lo, hi, _, _ in lot])
        valid = np.zeros(starts, bool)
        for (_, lo, _, s, e), b in zip(lot, begins[:-1], strict=True):
            valid[b + s - lo : b + e - lo] = True
        at = at[valid].astype(np.int64)
        at = at[np.concatenate([[True], at[1:] != at[:-1]])]
        of = np.searchsorted(begins, at, side="right") - 1
        row = np.array([x[0] for x in lot])[of]
        pos = at - begins[of] + np.array([x[1] for x in lot])[of]
        r0, r1 = lot[0][0], lot[-1][0]
        if r0 in last:  # the part before may have found the same
            new = (row != r0) | (pos > last[r0])
            at, row, pos = at[new], row[new], pos[new]
        last = {r1: pos[-1]} if len(pos) and row[-1] == r1 else {k: v for k, v in last.items() if k == r1}
        yield row, pos, grams[at].view(np.int64)


def _texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column without nulls, and where each text begins and the last ends."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8), offsets


def _lots(batch: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    return (batch.slice(at, rows) for at in range(0, batch.num_rows, rows))


# --- deep-shallow sorting ---------------------------------------------------------------------------------------


def blind_trie_order(keys: list[bytes]) -> list[int]:
    """The order of keys of one length, equal ones in the order given, from a trie that keeps branching places only.

    A key goes down by the bytes at branching places alone to some leaf; one comparison with that leaf tells where the
    key leaves the trie.
    """
    same: dict[bytes, list[int]] = {}
    for i, k in enumerate(keys):
        same.setdefault(k, []).append(i)
    distinct = list(same)
    root: list | bytes = distinct[0]  # a node is [depth, children by byte], a leaf the key
    for key in distinct[1:]:
        node = root
        while isinstance(node, list):
            node = node[1].get(key[node[0]]) or next(iter(node[1].values()))
        lo, hi = 0, len(key)
        while lo < hi:  # the first place where key and leaf differ
            mid = (lo + hi) // 2
            if key[lo : mid + 1] == node[lo : mid + 1]:
                lo = mid + 1
            else:
                hi = mid
        above, node_at = None, root
        while isinstance(node_at, list) and node_at[0] < lo:
            above, node_at = node_at, node_at[1][key[node_at[0]]]
        if isinstance(node_at, list) and node_at[0] == lo:
            node_at[1][key[lo]] = key
            continue
        inner = [lo, {node[lo]: node_at, key[lo]: key}]
        if above is None:
            root = inner
        else:
            above[1][key[above[0]]] = inner
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        if isinstance(node, list):
            todo += [node[1][b] for b in sorted(node[1], reverse=True)]
        else:
            out += same[node]
    return out


def multikey_quicksort(words: np.ndarray, order: np.ndarray, group: np.ndarray, depth: int) -> np.ndarray:
    """Sorts order (rows of words, those of one group next to each other) within groups by the first `depth` words, in
    place and stably, and returns the part that each place is in: rows of one part tie on all those words.

    Parts are split three ways by a pivot, the median of three words; the equal part goes on with its next word, the
    others with the same. All parts are split in step, so a round is a few array operations.
    """
    m = len(order)
    part = np.concatenate([[0], np.cumsum(group[1:] != group[:-1])]) if m else np.zeros(0, np.int64)
    part = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1])[part] if m else part  # named by their first place
    at_word = np.zeros(m, np.int64)
    while True:
        size = np.bincount(part, minlength=m)[part] if m else part
        at = np.flatnonzero((size > 1) & (at_word < depth))
        if not len(at):
            return part
        own, w = part[at], words[order[at], at_word[at]]
        first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        many = np.diff(np.append(first, len(at)))
        a, b, c = w[first], w[first + many // 2], w[first + many - 1]
        pivot = np.repeat(np.maximum(np.minimum(a, b), np.minimum(np.maximum(a, b), c)), many)
        kind = (w > pivot).astype(np.int64) - (w < pivot)
        start = np.repeat(first, many)
        to, base = np.empty(len(at), np.int64), start.copy()
        new_part = own.copy()
        for k in (-1, 0, 1):
            here = kind == k
            before = np.concatenate([[0], np.cumsum(here)])
            to[here] = base[here] + before[:-1][here] - before[start[here]]
            new_part[here] = own[here] + (base - start)[here]
            base += np.repeat(np.add.reduceat(here.astype(np.int64), first), many)
        rows, deeper = order[at], at_word[at] + (kind == 0)
        order[at[to]], part[at[to]], at_word[at[to]] = rows, new_part, deeper


def deep_shallow(strings: np.ndarray, sizes: np.ndarray, group: np.ndarray, shallow: int = 32) -> tuple[np.ndarray, np.ndarray]:
    """order, common: the rows of strings (bytes, padded with zeros to a multiple of 8) sorted within group
    (ascending), and the common prefix of each with the one before, -1 where a group begins.

    Multikey quicksort orders by words of 8 bytes to `shallow` bytes; blind tries order the groups that tie beyond.
    """
    m, width = strings.shape
    words = np.ascontiguousarray(strings).view(">u8").astype(np.uint64)
    order = np.lexsort((sizes, group))  # brings groups together; of padded strings that are equal the shortest is first
    part = multikey_quicksort(words, order, group[order], min(shallow, width) // 8)
    at = np.flatnonzero(np.bincount(part, minlength=m)[part] > 1) if m else part
    if len(at):
        cuts = np.flatnonzero(np.diff(part[at])) + 1
        for places in np.split(at, cuts):
            rows = order[places]
            order[places] = rows[blind_trie_order([strings[r].tobytes() for r in rows])]
    common = np.full(m, -1, np.int64)
    if m > 1:
        a, b = order[1:], order[:-1]
        differ = words[a] != words[b]
        word = np.where(differ.any(axis=1), differ.argmax(axis=1), width // 8 - 1)
        pick = np.arange(m - 1)
        inside = strings[a].reshape(m - 1, -1, 8)[pick, word] != strings[b].reshape(m - 1, -1, 8)[pick, word]
        first = np.where(inside.any(axis=1), word * 8 + inside.argmax(axis=1), width)
        common[1:] = np.where(group[a] == group[b], np.minimum(first, np.minimum(sizes[a], sizes[b])), -1)
    return order, common


def repeated_starts(group: np.ndarray, left: list[bytes], right: list[bytes], lo: np.ndarray, hi: np.ndarray, length: int, anchor: int) -> np.ndarray:
    """For each occurrence (row) and d from 0 to length - anchor: whether the string that begins d bytes before the
    anchor is that of another occurrence of the group, asked for d from the row's lo to its hi. left: reversed bytes
    before the anchor; right: those from it.
    """
    reach, m = length - anchor, len(group)

    def matrix(parts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
        width = -(-width // 8) * 8
        padded = b"".join([p.ljust(width, b"\0") for p in parts])
        return np.frombuffer(padded, np.uint8).reshape(m, width), np.array([len(p) for p in parts])

    rights, right_size = matrix(right, length)
    lefts, left_size = matrix(left, reach)
    right_order, right_common = deep_shallow(rights, right_size, group)
    left_order, left_common = deep_shallow(lefts, left_size, group)
    out = np.zeros((m, reach + 1), bool)
    classes = np.empty(m, np.int64)
    for d in range(reach + 1):
        some = np.flatnonzero((right_size >= length - d) & (left_size >= d) & (lo <= d) & (d <= hi))
        if len(some) < 2:
            continue
        classes[right_order] = np.cumsum(right_common < length - d) * (m + 1)
        key = classes[some]
        classes[left_order] = np.cumsum(left_common < d)
        key = key + classes[some]
        by = np.argsort(key, kind="stable")
        equal = key[by[1:]] == key[by[:-1]]
        out[some[by[1:][equal]], d] = True
        out[some[by[:-1][equal]], d] = True
    return out


# --- on Spark ---------------------------------------------------------------------------------------------------

#: Tells texts apart: hashes of 64 bits of the row's id and of its text, and the number of bytes. Rows that they don't
#: tell apart hold the same text, which any of them can stand for.
_TEXT = ("dk", "th", "size")
_GROUP = ("g1", "g2", "lo", "hi")


def _keyed(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = [F.xxhash64(F.col(id_col)).alias("dk"), F.xxhash64(text).alias("th"), F.octet_length(text).alias("size")]
    return docs.select(*more, *own, text.cast("binary").alias("data"))


def _left_out_by(df: DataFrame, key: Column, bitmap: bytes) -> DataFrame:
    """The rows of df whose 64-bit key falls on no set bit of the bitmap."""
    sent = df.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(sent.value, np.int64)
        for batch in batches:
            miss = ~in_bitmap(bits, batch.column(batch.num_columns - 1).to_numpy())
            rest = pa.RecordBatch.from_arrays(batch.columns[:-1], schema=pa.schema(list(batch.schema)[:-1]))
            yield rest.filter(pa.array(miss))

    return df.withColumn("bitmap_key", key).mapInArrow(run, df.schema)


def _occurrences(large: DataFrame, length: int, anchor: int, bits: int) -> DataFrame:
    """dk, th, size, pos, gram, c1, c2: where each anchor that the corpus has twice stands, and a digest of 128
    bits of its surroundings' bytes. Anchors are told apart by a hash, which may let some pass that occur once."""
    reach = length - anchor

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, gram in anchors(*_texts(batch.column(0)), length, anchor):
                yield pa.RecordBatch.from_arrays([pa.array(gram)], names=["gram"])

    twice = large.select("data").mapInArrow(count, "gram long").groupBy("gram").count().where("count > 1").select("gram")
    sent = large.sparkSession.sparkContext.broadcast(key_bitmap(twice, "gram", bits))

    def occur(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        bitmap = np.frombuffer(sent.value, np.int64)
        for batch in batches:
            values, offsets = _texts(batch.column(3))
            view, sizes = memoryview(values), np.diff(offsets)
            for row, pos, gram in anchors(values, offsets, length, anchor):
                hit = in_bitmap(bitmap, gram)
                row, pos, gram = row[hit], pos[hit], gram[hit]
                left, right = np.minimum(reach, pos), np.minimum(length, sizes[row] - pos)
                at = offsets[row] + pos
                digests = [
                    xxh3_128_digest(view[a:b], seed)
                    for a, b, seed in zip((at - left).tolist(), (at + right).tolist(), (left * 65536 + right).tolist(), strict=True)
                ]
                c = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                rows = pa.array(row)
                texts = [batch.column(i).take(rows) for i in range(3)]
                rest = [pos.astype(np.int32), gram, np.ascontiguousarray(c[:, 0]), np.ascontiguousarray(c[:, 1])]
                yield pa.RecordBatch.from_arrays([*texts, *map(pa.array, rest)], names=[*_TEXT, "pos", "gram", "c1", "c2"])

    schema = T.StructType([large.schema[c] for c in _TEXT] + T.StructType.fromDDL("pos int, gram long, c1 long, c2 long").fields)
    return large.select(*_TEXT, "data").mapInArrow(occur, schema)


def _cut_out(texts: DataFrame, length: int, anchor: int) -> DataFrame:
    """A row for each of texts' wanted places (pos, gram, n, hot) with the bytes before it, reversed, and from it."""
    reach = length - anchor
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.binary()]
    added = T.StructType.fromDDL("pos int, gram long, n long, hot boolean, left binary, right binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for lot in _lots(batch, 64):
                rows, out = [], []
                for row, (packed, places) in enumerate(zip(lot.column(3).to_pylist(), lot.column(4).to_pylist(), strict=True)):
                    data = unpack(packed)
                    for x in places:
                        p = x["pos"]
                        rows.append(row)
                        out.append((p, x["gram"], x["n"], x["hot"], data[max(0, p - reach) : p][::-1], data[p : p + length]))
                if rows:
                    take = pa.array(rows)
                    own = [lot.column(i).take(take) for i in range(3)]
                    made = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays([*own, *made], names=[*_TEXT, *added.names])

    schema = T.StructType([texts.schema[c] for c in _TEXT] + added.fields)
    return texts.select(*_TEXT, "packed", "wanted").mapInArrow(run, schema)


def _digest(*parts: Column) -> list[Column]:
    return [F.xxhash64(F.lit(seed), *parts) for seed in (1, 2)]


def _split(rows: DataFrame, length: int) -> DataFrame:
    """Each of rows once for either half of its range lo to hi, in the group of what all strings of the half share
    (g1, g2) and the class of what any of them covers (c1, c2); rows that no such string fits into fall away."""
    mid = F.expr("cast((lo + hi) div 2 as int)")
    halves = F.array(F.struct(F.col("lo").alias("a"), mid.alias("b")), F.struct((mid + 1).alias("a"), F.col("hi").alias("b")))
    both = rows.withColumn("h", F.explode(halves)).withColumn("lo", F.col("h.a")).withColumn("hi", F.col("h.b"))
    fits = (F.octet_length("left") >= F.col("lo")) & (F.octet_length("right") >= F.lit(length) - F.col("hi")) & (F.col("lo") <= F.col("hi"))
    part = lambda c, n: F.substring(c, F.lit(1), n)
    shared = _digest("gram", "lo", "hi", part("left", F.col("lo")), part("right", F.lit(length) - F.col("hi")))
    covered = _digest("gram", "lo", "hi", part("left", F.col("hi")), part("right", F.lit(length) - F.col("lo")))
    names = dict(zip(("g1", "g2", "c1", "c2"), [*shared, *covered], strict=True))
    return both.where(fits).withColumns(names).drop("h")


def _split_hot(hot: DataFrame, length: int, together: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Groups of at most `together` classes from those of more, and spans of classes that turned out to be of several
    on the way. Every round halves the range; a range of one is a single string, which has one class."""
    small, spans = [], []
    while True:
        rows = stage_table(_split(hot, length), "suffix-split")
        first = F.min(F.struct(*_TEXT, "pos", "left", "right")).alias("o")
        classes = stage_table(rows.groupBy(*_GROUP, "gram", "c1", "c2").agg(F.sum("n").alias("n"), F.count("*").alias("rows"), first), "suffix-classes")
        several = classes.where("rows > 1").select("c1", "c2")
        starts = ((F.col("pos") - F.col("hi")).alias("lo"), (F.col("pos") - F.col("lo")).alias("hi"))
        spans.append(rows.where("n = 1").join(several, ["c1", "c2"]).select(*_TEXT, *starts))
        open_groups = classes.groupBy(*_GROUP).agg(F.count("*").alias("many"), F.min("n").alias("least"))
        open_groups = open_groups.where("many > 1 and least = 1").select(*_GROUP, (F.col("many") > together).alias("hot"))
        going = stage_table(classes.join(open_groups, [*_GROUP]).select(*_GROUP, "gram", "n", "hot", "o.*"), "suffix-going")
        small.append(going.where("not hot").drop("hot"))
        if going.where("hot").isEmpty():
            return small, spans
        hot = going.where("hot").drop("hot", "g1", "g2")


def find_repeats(
    docs: DataFrame, length: int = 200, anchor: int = 40, together: int = 2048, bits: int = 1 << 26, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """dk, th, size, spans: per text the ranges lo to hi of starts of repeated strings, not yet clipped to the
    text.

    At most `together` classes of an anchor, of 2 * length - anchor bytes each, are sorted in one task; an anchor of
    more is split by the bytes around it. Equal rows are cut out once, and their spans are told once.
    """
    reach = length - anchor
    large = _keyed(docs, id_col, text_col).where(F.col("size") >= length)
    occurrences = stage_table(_occurrences(large, length, anchor, bits), "suffix-occurrences")
    classes = occurrences.groupBy("gram", "c1", "c2").agg(F.count("*").alias("n"), F.min(F.struct(*_TEXT, "pos")).alias("o"))
    classes = stage_table(classes.select("gram", "c1", "c2", "n", "o.*"), "suffix-surroundings")
    grams = classes.groupBy("gram").agg(F.count("*").alias("many"), F.min("n").alias("least"))
    open_grams = stage_table(grams.where("many > 1 and least = 1").select("gram", (F.col("many") > together).alias("hot")), "suffix-open")
    places = F.collect_list(F.struct("pos", "gram", "n", "hot")).alias("wanted")
    wanted = stage_table(classes.join(open_grams, "gram").groupBy(*_TEXT).agg(places), "suffix-wanted")
    texts = _packed(large, F.col("dk"), key_bitmap(wanted.select("dk"), "dk", bits >> 3)).groupBy(*_TEXT).agg(F.first("packed").alias("packed"))
    surroundings = _cut_out(texts.join(wanted, list(_TEXT)), length, anchor)
    whole_range = {"g1": F.col("gram"), "g2": F.lit(0).cast("long"), "lo": F.lit(0), "hi": F.lit(reach)}
    spans: list[DataFrame] = []
    if open_grams.where("hot").isEmpty():
        groups = [surroundings.withColumns(whole_range)]
    else:
        surroundings = stage_table(surroundings, "suffix-cut").withColumns(whole_range)
        more, spans = _split_hot(surroundings.where("hot").drop("hot", "g1", "g2"), length, together)
        groups = [surroundings.where("not hot"), *more]
    own = [*_GROUP, *_TEXT, "pos", "n", "left", "right"]
    together_now = groups[0].select(*own)
    for more_groups in groups[1:]:
        together_now = together_now.unionByName(more_groups.select(*own))
    span_schema = T.StructType([large.schema[c] for c in _TEXT] + T.StructType.fromDDL("lo int, hi int").fields)

    def done(part: pa.Table) -> pa.RecordBatch:
        keys = np.stack([part.column(c).to_numpy().astype(np.int64) for c in _GROUP])
        group = np.concatenate([[0], np.cumsum((keys[:, 1:] != keys[:, :-1]).any(axis=0))])
        hit = repeated_starts(group, part.column("left").to_pylist(), part.column("right").to_pylist(), keys[2], keys[3], length, anchor)
        hit[part.column("n").to_numpy() > 1] = False  # those are settled
        edge = np.diff(np.pad(hit.astype(np.int8), ((0, 0), (1, 1))), axis=1)
        row, first = np.nonzero(edge == 1)
        _, after = np.nonzero(edge == -1)
        pos, texts = part.column("pos").to_numpy()[row], part.select(list(_TEXT)).take(pa.array(row)).combine_chunks()
        one = lambda c: c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c
        ends = [pa.array((pos - after + 1).astype(np.int32)), pa.array((pos - first).astype(np.int32))]
        return pa.RecordBatch.from_arrays([*[one(c) for c in texts.columns], *ends], names=span_schema.names)

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= 16_384:
                whole = pa.Table.from_batches(held)
                keys = np.stack([whole.column(c).to_numpy().astype(np.int64) for c in _GROUP])
                cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0))
                if len(cuts):
                    yield done(whole.slice(0, int(cuts[-1]) + 1))
                    held = whole.slice(int(cuts[-1]) + 1).to_batches()
                    rows = sum(b.num_rows for b in held)
        if rows:
            yield done(pa.Table.from_batches(held))

    found = together_now.repartition("g1", "g2").sortWithinPartitions(*_GROUP).mapInArrow(settle, span_schema)
    settled = classes.where("n > 1").select("gram", "c1", "c2")
    starts = ((F.col("pos") - reach).cast("int").alias("lo"), F.col("pos").alias("hi"))
    every = occurrences.join(settled, ["gram", "c1", "c2"]).select(*_TEXT, *starts).distinct().unionByName(found)
    for more_spans in spans:
        every = every.unionByName(more_spans)
    return stage_table(every.groupBy(*_TEXT).agg(F.collect_list(F.struct("lo", "hi")).alias("spans")), "suffix-spans")


def _packed(keyed: DataFrame, key: Column, bitmap: bytes) -> DataFrame:
    """The rows of keyed (data and further columns) whose key falls on a set bit, with data compressed as packed for
    the shuffle."""
    schema = T.StructType([T.StructField("packed", T.BinaryType()) if f.name == "data" else f for f in keyed.schema.fields])
    place = keyed.columns.index("data")
    sent = keyed.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pack, bits = zstandard.ZstdCompressor(level=1).compress, np.frombuffer(sent.value, np.int64)
        for batch in batches:
            for lot in _lots(batch):
                hit = np.flatnonzero(in_bitmap(bits, lot.column(lot.num_columns - 1).to_numpy()))
                columns = [c if i == place else c.take(pa.array(hit)) for i, c in enumerate(lot.columns[:-1])]
                columns[place] = pa.array([pack(columns[place][i].as_buffer()) for i in hit.tolist()], pa.binary())
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return keyed.withColumn("bitmap_key", key).mapInArrow(run, schema)


def removed_runs(spans: list[dict] | None, size: int, length: int) -> list[tuple[int, int]]:
    """Maximal removed byte runs of a text of `size` bytes from ranges of starts."""
    runs: list[list[int]] = []
    for lo, hi in sorted((max(0, s["lo"]), min(size - length, s["hi"])) for s in spans or []):
        if lo > hi:
            continue
        if runs and lo <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], hi + length)
        else:
            runs.append([lo, hi + length])
    return [(a, b) for a, b in runs]


def remove_repeats(
    docs: DataFrame, length: int = 200, anchor: int = 40, together: int = 2048, bits: int = 1 << 26,
    id_col: str = "doc_id", text_col: str = "text", kept: str = "kept",
) -> DataFrame:
    """docs without text_col, and n_bytes, n_removed, n_spans (long) and kept: the bytes left of each text, or with
    kept="text" them as text, without what is left of a character cut in two, or with kept="sha256" their SHA-256 in
    the column kept_sha256.

    A byte goes if a string of `length` bytes over it also starts anywhere else in the corpus, in the same text or
    another's; strings are judged on the input and never reach across texts. Null text counts as empty. Rows of one
    id are told apart by their text; repeated rows hold each other's strings, so they lose what is long enough, at a
    cost in proportion to their number. Null ids are ids like any other; texts under `length` bytes stay as they are;
    an empty table gives an empty table. Other columns pass through; columns of the names above are replaced.

    The result is a stored table: whole texts go to Python in short batches, by a setting of the session that is as
    it was when this returns.
    """
    with short_batches(docs.sparkSession):
        return stage_table(_removed(docs, length, anchor, together, bits, id_col, text_col, kept), "suffix-kept")


def _removed(docs: DataFrame, length: int, anchor: int, together: int, bits: int, id_col: str, text_col: str, kept: str) -> DataFrame:
    spans = find_repeats(docs.select(id_col, text_col), length, anchor, together, bits, id_col, text_col)
    made = ["n_bytes", "n_removed", "n_spans", "kept", "kept_sha256", text_col]
    rest = F.struct(*[F.col(c) for c in docs.columns if c not in made]).alias("rest")  # so that no name clashes
    plain = _keyed(docs, id_col, text_col, rest)
    bitmap = key_bitmap(spans.select("dk"), "dk", bits >> 3)
    digest = kept == "sha256"
    last = F.sha2("data", 256).alias("kept_sha256") if digest else F.col("data").cast("string" if kept == "text" else "binary").alias("kept")
    none = F.lit(0).cast("long")
    counted = plain.select("rest", "dk", F.col("size").cast("long").alias("n_bytes"), none.alias("n_removed"), none.alias("n_spans"), last)
    untouched = _left_out_by(counted, F.col("dk"), bitmap).drop("dk")
    touched = _packed(plain, F.col("dk"), bitmap)
    joined = touched.join(spans.hint("shuffle_hash"), list(_TEXT), "left").select("rest", "packed", "spans")
    out_names = untouched.columns
    kind = pa.binary() if kept == "kept" else pa.string()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for lot in _lots(batch, 256):
                total, gone, many, left = [], [], [], []
                for packed, ranges in zip(lot.column(1), lot.column(2).to_pylist(), strict=True):
                    data = unpack(packed.as_py())
                    runs = removed_runs(ranges, len(data), length)
                    ends = [0, *[x for r in runs for x in r], len(data)]
                    remains = b"".join([data[a:b] for a, b in zip(ends[::2], ends[1::2], strict=True)])
                    total.append(len(data)), gone.append(len(data) - len(remains)), many.append(len(runs))
                    if digest:
                        left.append(hashlib.sha256(remains).hexdigest())
                    else:
                        left.append(remains.decode(errors="ignore") if kept == "text" else remains)
                numbers = [pa.array(x, pa.int64()) for x in (total, gone, many)]
                yield pa.RecordBatch.from_arrays([lot.column(0), *numbers, pa.array(left, kind)], names=out_names)

    return untouched.unionByName(joined.mapInArrow(run, untouched.schema)).select("rest.*", *out_names[1:])
