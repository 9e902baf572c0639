"""The prefix trie of conversations, in balanced parentheses per shard.

Every distinct sequence of first turns is a node. A node goes by its smallest member and its depth, so each conversation
owns the end of its path, from the depth where no smaller conversation shares it. The paths on the way from the root,
deepest branch first, put all nodes in preorder; a shard is a block of that order. It holds its nodes as parentheses
over blocks of least excess: findclose delimits subtrees, ranks of "()" count leaves and cumulative arrays give savings.
Nodes still open where a shard ends (its spine) get the rest from the shards after it.

Turns, nodes and members are put in order by range partitions (see ordered), so no conversation, first turn or group of
copies needs a task of its own, however large.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage_table
from .ordered import carries, in_order, numbered, per_batch, run_starts, with_carries

# The largest primes under 2^31, and a base for each. Together they tell 124 bits.
PRIMES = np.array([2147483647, 2147483629, 2147483587, 2147483579], np.int64)
BASES = np.array([1290130207, 1734062881, 1903410397, 1101538529], np.int64)
#: Nodes of a shard.
SHARD = 1 << 20
#: A path is joined with its nodes in pieces of so many depths.
_PIECE = 1 << 16
_KEYS = ("k0", "k1", "k2", "k3")


# --- conversations ------------------------------------------------------------------------------------------------


def ordered_turns(turns: DataFrame) -> DataFrame:
    """conv_id, t1, t2 (128 bits of role and text), chars (code points of the text), pos (from 1, by turn, null first).

    Null role or text is empty; rows of one turn follow each other by role, then text. Rows without conv_id belong to
    no conversation and are left out. Other columns are not read.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    plain = turns.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", text("role").alias("role"), text("text").alias("text"))
    hashed = plain.select("*", *[F.xxhash64(F.lit(i), "role", "text").alias(f"t{i}") for i in (1, 2)], F.length("text").cast("long").alias("chars"))
    return numbered(hashed, "conv_id", [F.col("turn").asc_nulls_first(), "role", "text"], ["t1", "t2", "chars"], "pos", "trie-turns")


def with_heads(turns: DataFrame, every: int = 100, most: int = 6) -> DataFrame:
    """conv_id, place, pos, t1, t2, chars: every conversation rebuilt from ordered_turns().

    Its first h turns are replaced by those of conversation c - c % every (all if it has fewer, none if there is no
    such conversation), h = crc32(decimal c) % most. place orders the rows: -1 is a row for each conversation, even
    one without turns, 0 the head's turns, 1 its own.
    """
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    ids = turns.select("conv_id").distinct()
    mark = ids.select("conv_id", F.lit(-1).alias("place"), *[F.lit(0).cast("long").alias(c) for c in ("pos", "t1", "t2", "chars")])
    heads = turns.where((F.col("conv_id") % every == 0) & (F.col("pos") < most)).withColumnRenamed("conv_id", "head_id")
    head = (
        ids.select("conv_id", (F.col("conv_id") - F.col("conv_id") % every).alias("head_id"), h.alias("h"))
        .join(heads, "head_id").where("pos <= h").select("conv_id", F.lit(0).alias("place"), "pos", "t1", "t2", "chars")
    )
    own = turns.where(F.col("pos") > h).select("conv_id", F.lit(1).alias("place"), "pos", "t1", "t2", "chars")
    return mark.unionByName(head).unionByName(own)


def marked(turns: DataFrame) -> DataFrame:
    """ordered_turns() as they are, in the columns of with_heads()."""
    return with_heads(turns, 1, 1)


def _power(exponents: np.ndarray, base: int, prime: int) -> np.ndarray:
    out, square = np.ones(len(exponents), np.int64), int(base)
    for bit in range(int(exponents.max(initial=0)).bit_length()):
        out = np.where(exponents >> bit & 1, out * square % prime, out)
        square = square * square % prime
    return out


def _path_keys() -> object:
    """Depth and path key of each row of sorted batches: sums of turn x base^depth modulo each prime, by conversation."""
    state: dict = {"conv": None, "d": -1, "k": [0] * 4}

    def step(x: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        conv, n = x["conv_id"], len(x["conv_id"])
        start = run_starts(conv)
        goes_on = state["conv"] == conv[0]
        first = start == 0
        depth = np.arange(n) - start
        if goes_on:
            depth[first] += state["d"] + 1
        halves = [x["t1"] & 0xFFFFFFFF, x["t1"] >> 32 & 0xFFFFFFFF, x["t2"] & 0xFFFFFFFF, x["t2"] >> 32 & 0xFFFFFFFF]
        out = {"conv_id": conv, "depth": depth, "chars": x["chars"]}
        for i, (half, prime, base) in enumerate(zip(halves, PRIMES.tolist(), BASES.tolist(), strict=True)):
            term = np.where(x["place"] < 0, 0, (half % (prime - 1) + 1) * _power(depth, base, prime) % prime)
            total = np.cumsum(term)
            k = total - (total - term)[start]
            if goes_on:
                k[first] += state["k"][i]
            out[f"k{i}"] = k % prime
        state.update(conv=conv[-1], d=int(depth[-1]), k=[int(out[k][-1]) for k in _KEYS])
        return out

    return step


def path_rows(rebuilt: DataFrame) -> DataFrame:
    """conv_id, depth, chars, k0 to k3 (the path's key) of every turn of with_heads(), and of depth 0. Stored."""
    rows = in_order(rebuilt, "conv_id", "place", "pos").select("conv_id", "place", "t1", "t2", "chars")
    stored = stage_table(per_batch(rows, _path_keys, "conv_id long, depth long, chars long, k0 long, k1 long, k2 long, k3 long"), "trie-paths")

    def join(before: tuple, own: tuple) -> list[int]:
        d = before[0] + 1
        return [own[0] + d, *[(b + pow(w, d, p) * o) % p for b, o, w, p in zip(before[1:], own[1:], BASES.tolist(), PRIMES.tolist(), strict=True)]]

    found = carries(stored, F.struct("conv_id"), F.struct("conv_id", "depth", *_KEYS), 1, join)
    rows_ = [(*r[:2], r[2] + 1, *r[3:], *[pow(w, r[2] + 1, p) for w, p in zip(BASES.tolist(), PRIMES.tolist(), strict=True)]) for r in found]
    with_ = with_carries(stored, rows_, ["conv_id"], ["b", *[f"b{i}" for i in range(4)], *[f"w{i}" for i in range(4)]])
    key = lambda i: F.when(F.col("b").isNull(), F.col(f"k{i}")).otherwise((F.col(f"b{i}") + F.col(f"w{i}") * F.col(f"k{i}")) % int(PRIMES[i])).alias(f"k{i}")
    return with_.select("conv_id", (F.col("depth") + F.coalesce("b", F.lit(0))).alias("depth"), "chars", *[key(i) for i in range(4)])


def _smallest() -> object:
    state: dict = {"key": None, "m": None}

    def step(x: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        keys = [x["a"], x["b"], x["depth"]]
        start = run_starts(*keys)
        m = x["conv_id"][start]
        if state["key"] == tuple(k[0] for k in keys):
            m[start == 0] = state["m"]
        state.update(key=tuple(k[-1] for k in keys), m=m[-1])
        return {**x, "m": m}

    return step


def memberships(paths: DataFrame) -> DataFrame:
    """conv_id, depth, chars, m of path_rows(): m is the smallest conversation that shares the path up to depth. Stored."""
    rows = paths.select((F.shiftleft("k0", 31).bitwiseOR(F.col("k1"))).alias("a"), (F.shiftleft("k2", 31).bitwiseOR(F.col("k3"))).alias("b"), "depth", "conv_id", "chars")
    stored = stage_table(per_batch(in_order(rows, "a", "b", "depth", "conv_id"), _smallest, "a long, b long, depth long, conv_id long, chars long, m long"), "trie-members")
    found = carries(stored, F.struct("a", "b", "depth"), F.struct("a", "b", "depth", "conv_id", "m"), 3, lambda before, own: before)
    with_ = with_carries(stored, [(*r[:4], r[5]) for r in found], ["a", "b", "depth"], ["before_"])
    return with_.select("conv_id", "depth", "chars", F.coalesce("before_", "m").alias("m"))


# --- parentheses --------------------------------------------------------------------------------------------------


class Parentheses:
    """A shard's nodes, given by their depths in preorder, as balanced parentheses.

    Ancestors from earlier shards that the shard closes stand before as opens of no node. `least` holds the least
    excess of blocks of `block` parentheses, in levels of a binary tree up to one.
    """

    def __init__(self, depths: np.ndarray, block: int = 64):
        n, self.block = len(depths), block
        self.spine = int(depths[0] - depths.min())
        closes = np.concatenate([depths[:-1] - depths[1:] + 1, [depths[-1] - depths.min() + 1]])
        self.open = self.spine + np.arange(n) + np.concatenate([[0], np.cumsum(closes[:-1])])
        size = 2 * (n + self.spine)
        self.bits = np.zeros(size, bool)
        self.bits[: self.spine] = True
        self.bits[self.open] = True
        self.opened = np.cumsum(self.bits)
        self.excess = 2 * self.opened - np.arange(1, size + 1)
        width = 1 << max(0, (-(-size // block) - 1).bit_length())
        padded = np.full(width * block, -1, np.int64)  # a block after the end closes all
        padded[:size] = self.excess
        self.padded, self.least = padded, [padded.reshape(width, block).min(axis=1)]
        while len(self.least[-1]) > 1:
            self.least.append(self.least[-1].reshape(-1, 2).min(axis=1))
        pairs = np.zeros(size, np.int64)
        pairs[:-1] = self.bits[:-1] & ~self.bits[1:]
        self.pairs = np.cumsum(pairs)

    def _in_block(self, places: np.ndarray, below: np.ndarray) -> np.ndarray:
        """The first place from places on, within its block, whose excess is below; -1 without any."""
        out, left = np.full(len(places), -1), np.arange(len(places))
        for _ in range(self.block):
            at = places[left]
            hit = self.padded[at] < below[left]
            out[left[hit]] = at[hit]
            left = left[~hit & ((at + 1) % self.block != 0)]
            if not len(left):
                break
            places[left] += 1
        return out

    def findclose(self, opens: np.ndarray) -> np.ndarray:
        """The close of each open: the first later place whose excess is under the open's."""
        below = self.excess[opens]
        inner = (opens + 1) % self.block != 0
        out = np.full(len(opens), -1)
        out[inner] = self._in_block(opens[inner] + 1, below[inner])
        left = np.flatnonzero(out < 0)
        node, level = opens[left] // self.block, np.zeros(len(left), np.int64)
        todo, found = np.arange(len(left)), np.zeros(len(left), np.int64)
        for up in range(len(self.least)):  # climb until the right neighbour holds the close
            here = node[todo]
            right = here + 1
            holds = (here % 2 == 0) & (right < len(self.least[up]))
            holds[holds] = self.least[up][right[holds]] < below[left[todo[holds]]]
            found[todo[holds]], level[todo[holds]] = right[holds], up
            todo = todo[~holds]
            node[todo] //= 2
            if not len(todo):
                break
        for down in range(len(self.least) - 1, 0, -1):  # and down to its first block that does
            at = np.flatnonzero(level == down)
            child = found[at] * 2
            found[at] = child + (self.least[down - 1][child] >= below[left[at]])
            level[at] = down - 1
        out[left] = self._in_block(found * self.block, below[left])
        return out


def shard_nodes(depth: np.ndarray, saving: np.ndarray) -> tuple[dict[str, np.ndarray], dict[str, np.ndarray]]:
    """What a shard knows of its nodes (leaves, saved and children of each subtree within the shard, and whether it is
    still open at the end), and its record depths: the nodes that are less deep than all before, with the leaves and
    savings that come before and the nodes of that depth until the next record. The last record row is the totals."""
    p, n = Parentheses(depth), len(depth)
    close = p.findclose(p.open)
    end = p.opened[close] - p.spine  # nodes opened up to the close
    total = np.concatenate([[0], np.cumsum(saving)])
    order = np.lexsort((np.arange(n), depth))
    keys = depth[order] * n + order
    at = np.searchsorted(keys, (depth - 1) * n + np.arange(n)) - 1
    has = (at >= 0) & (depth[order[at]] == depth - 1)
    nodes = {
        "leaves": p.pairs[close] - np.where(p.open > 0, p.pairs[p.open - 1], 0),
        "saved": total[end] - total[:n],
        "children": np.bincount(order[at[has]], minlength=n),
        "open": (end == n).astype(np.int64),
    }
    low = np.minimum.accumulate(depth)
    fresh = np.concatenate([[True], low[1:] < low[:-1]])
    at, leaf = np.flatnonzero(fresh), np.concatenate([[0], np.cumsum(np.concatenate([depth[1:] <= depth[:-1], [True]]))])
    records = {
        "depth": np.append(depth[at], depth[-1]),
        "leaves": np.append(leaf[at], leaf[-1]),
        "saved": np.append(total[at], total[-1]),
        "children": np.append(np.bincount((np.cumsum(fresh) - 1)[depth == low], minlength=len(at)), 0),
    }
    return nodes, records


def merge_spines(shards: list[tuple[tuple, list[tuple[int, int, int, int]]]]) -> list[tuple]:
    """(part, block, from depth, to depth, leaves, saved, children) to add to nodes that are open at their shard's end.

    shards: in order, each with its key and its records, (depth, leaves, saved, children), the last one the totals. What
    is kept of the shards after one is a falling list of depths at which open nodes end.
    """
    out, later, first = [], [], None
    leaves = saved = 0
    for key, records in reversed(shards):
        *own, (last, own_leaves, own_saved, _) = records
        inner = -1 if first == last + 1 else 0  # its last node has a child in the next shard
        ends = [*later, (0, leaves, saved, 0)] if later else []
        for (depth, _, _, children), (least, more_leaves, more_saved, _) in zip(ends, ends[1:], strict=False):
            # nodes less deep than one record end at the next; the record and its like are children of the deepest
            out.append((*key, depth - 1, depth - 1, more_leaves + inner, more_saved, children))
            if least < depth - 1:
                out.append((*key, least, depth - 2, more_leaves + inner, more_saved, 0))
        own_leaves += inner
        least = own[-1][0]
        same = sum(r[3] for r in later if r[0] == least)
        own[-1] = (*own[-1][:3], own[-1][3] + same)
        later = own + [(r[0], r[1] + own_leaves, r[2] + own_saved, r[3]) for r in later if r[0] < least]
        first, leaves, saved = own[0][0], leaves + own_leaves, saved + own_saved
    return out


def _shards(size: int) -> object:
    names = ("conv_id", "depth", "parent", "n", "saving")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, held, count = TaskContext.get().partitionId(), 0, [], 0

        def shard(cols: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            x = dict(zip(names, cols, strict=True))
            nodes, records = shard_nodes(x["depth"], x["saving"])
            for kind, a in ((0, {**x, **nodes}), (1, records)):
                n, zero = len(a["depth"]), np.zeros(len(a["depth"]), np.int64)
                cols_ = [np.full(n, kind), np.full(n, part), np.full(n, block), np.arange(n), *[a.get(c, zero) for c in (*names[:4], "leaves", "saved", "children", "open")]]
                for at in range(0, n, 1 << 16):
                    yield pa.RecordBatch.from_arrays([pa.array(c[at : at + (1 << 16)].astype(np.int64)) for c in cols_], names=_SHARD_COLUMNS)

        for batch in batches:
            cols = [batch.column(i).to_numpy() for i in range(len(names))]
            at = 0
            while at < batch.num_rows:
                take = min(size - count, batch.num_rows - at)
                held.append([c[at : at + take] for c in cols])
                count, at = count + take, at + take
                if count == size:
                    yield from shard([np.concatenate(c) for c in zip(*held, strict=True)])
                    held, count, block = [], 0, block + 1
        if count:
            yield from shard([np.concatenate(c) for c in zip(*held, strict=True)])

    return run


_SHARD_COLUMNS = ["kind", "part", "block", "at", "conv_id", "depth", "parent", "n", "leaves", "saved", "children", "open"]


# --- the trie -----------------------------------------------------------------------------------------------------


def _digests(ends: DataFrame) -> DataFrame:
    """conv_id, depth, ends_sha256 of ends (m, depth, conv_id): the digest of the ids, ascending, joined by commas.

    Ids are joined to pieces of 32 kB within range partitions first; the digest itself has to see a node's pieces in
    order, and streams them.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m, depth, conv = (batch.column(i).to_numpy() for i in range(3))
            if not len(m):
                continue
            start = run_starts(m, depth, np.arange(len(m)) // 4096)
            at = np.unique(start)
            text = [",".join(map(str, x.tolist())) for x in np.split(conv, at[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(m[at]), pa.array(depth[at]), pa.array(conv[at]), pa.array(text)], names=["m", "depth", "first", "ids"])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest, done = None, None, []
        for batch in batches:
            for m, depth, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if key == (m, depth):
                    digest.update(b"," + ids.encode())
                    continue
                if key:
                    done.append((*key, digest.hexdigest()))
                key, digest = (m, depth), hashlib.sha256(ids.encode())
            if len(done) > 4096:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names=["conv_id", "depth", "ends_sha256"])
                done = []
        if key:
            done.append((*key, digest.hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names=["conv_id", "depth", "ends_sha256"])

    blocks = in_order(ends.select("m", "depth", "conv_id"), "m", "depth", "conv_id").mapInArrow(pieces, "m long, depth long, first long, ids string")
    return blocks.repartition("m", "depth").sortWithinPartitions("m", "depth", "first").select("m", "depth", "ids").mapInArrow(digests, "conv_id long, depth long, ends_sha256 string")


def prefix_trie(rebuilt: DataFrame, shard: int = SHARD) -> DataFrame:
    """A row per node of the trie of with_heads() or marked(): conv_id (smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256; the root has depth 0.

    saved_tokens sums, over the subtree, (n_convs - 1) x code points of the node's last text. Equal conversations are
    members of the same nodes. No conversations: no nodes. The driver gets, per shard, a row for each depth at which
    ancestors of its first node end, and per range partition one row.
    """
    members = memberships(path_rows(rebuilt))
    nodes = members.groupBy("m", "depth").agg(F.count("*").alias("n"), F.max("chars").alias("chars"))
    spans = members.groupBy("conv_id", "m").agg(F.min("depth").alias("low"), F.max("depth").alias("high"))
    convs = stage_table(
        spans.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("low", "m"))).alias("chain"), F.max(F.struct("high", "m")).alias("end")), "trie-conversations"
    )
    last, before = F.element_at("chain", -1), F.try_element_at("chain", F.lit(-2))
    pieces = convs.where(last["m"] == F.col("conv_id")).select(
        F.col("conv_id").alias("m"), "chain", last["low"].alias("low"), before["m"].alias("above"),
        F.explode(F.sequence(F.floor(last["low"] / _PIECE), F.floor(F.col("end.high") / _PIECE))).alias("piece"),
    )
    placed = nodes.withColumn("piece", F.floor(F.col("depth") / _PIECE)).join(pieces, ["m", "piece"])
    path = F.transform("chain", lambda x: F.struct((-x["low"]).alias("up"), x["m"].alias("m")))
    parent = F.when(F.col("depth") > F.col("low"), F.col("m")).otherwise(F.col("above"))
    preorder = in_order(
        placed.select(path.alias("path"), "depth", "m", F.coalesce(parent, F.lit(-1)).alias("parent"), "n", ((F.col("n") - 1) * F.col("chars")).alias("saving")), "path", "depth"
    ).select("m", "depth", "parent", "n", "saving")
    shards = stage_table(preorder.mapInArrow(_shards(shard), ", ".join(f"{c} long" for c in _SHARD_COLUMNS)), "trie-shards")
    records: dict[tuple, list] = {}
    for r in shards.where("kind = 1").select("part", "block", "at", "depth", "leaves", "saved", "children").orderBy("part", "block", "at").collect():
        records.setdefault((r["part"], r["block"]), []).append((r["depth"], r["leaves"], r["saved"], r["children"]))
    more = shards.sparkSession.createDataFrame(
        merge_spines(sorted(records.items())), "part long, block long, low long, high long, more_leaves long, more_saved long, more_children long"
    )
    open_ = (F.col("open") == 1) & F.col("depth").between(F.col("low"), F.col("high"))
    own = shards.where("kind = 0")
    merged = own.join(F.broadcast(more), (own["part"] == more["part"]) & (own["block"] == more["block"]) & open_, "left")
    add = lambda c: (F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).alias(c)
    whole = merged.select("conv_id", "depth", "parent", "n", add("leaves"), add("saved"), add("children"))
    ends = _digests(convs.select(F.col("end.m").alias("m"), F.col("end.high").alias("depth"), "conv_id"))
    return whole.join(ends, ["conv_id", "depth"], "left").select(
        "conv_id", "depth", F.when(F.col("depth") > 0, F.col("parent")).alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
