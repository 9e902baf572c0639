"""Approximate nearest neighbours by inner product with a hierarchical k-means tree.

Vectors get one more component that gives all the same length, so that the largest inner product is the smallest
distance. The tree is fitted on a bounded sample, every vector goes to a leaf, and queries visit leaves best bin
first. How many is calibrated: visits widen until a sample of queries, compared with brute force, reaches the recall
asked for.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage_table


def _kmeans(x: np.ndarray, k: int, rounds: int, random: np.random.Generator) -> np.ndarray:
    """Centres of at most k clusters that hold a point each."""
    centres = x[random.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        near = _nearest(x, centres)
        many = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        centres = sums[many > 0] / many[many > 0, None]
    return centres


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (0.5 * (centres * centres).sum(axis=1) - x @ centres.T).argmin(axis=1)


@dataclass
class Tree:
    """Node 0 is the root; children are nodes by parent, and a node without children is a leaf."""

    longest: float  # squared length that all vectors are filled up to
    centres: np.ndarray = field(default_factory=lambda: np.zeros((1, 1)))
    children: list[list[int]] = field(default_factory=lambda: [[]])

    def lift(self, vectors: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.longest - (vectors * vectors).sum(axis=1), 0))
        return np.concatenate([vectors, rest[:, None]], axis=1)

    def leaf_of(self, vectors: np.ndarray) -> np.ndarray:
        x, node = self.lift(vectors), np.zeros(len(vectors), np.int64)
        todo = [0]
        while todo:
            at = todo.pop()
            if self.children[at] and len(rows := np.flatnonzero(node == at)):
                kids = np.array(self.children[at])
                node[rows] = kids[_nearest(x[rows], self.centres[kids])]
                todo += self.children[at]
        return node

    def visits(self, queries: np.ndarray, leaves: int, rows: dict[int, int], least_rows: int) -> list[list[int]]:
        """For each query the leaves it visits, best bin first: at least `leaves` with rows, and on until they hold
        least_rows rows."""
        x = np.concatenate([queries, np.zeros((len(queries), 1))], axis=1)
        away = (self.centres * self.centres).sum(axis=1) - 2 * x @ self.centres.T
        out = []
        for distance in away:
            heap, seen, held = [(0.0, 0)], [], 0
            while heap and (len(seen) < leaves or held < least_rows):
                _, node = heapq.heappop(heap)
                if self.children[node]:
                    for kid in self.children[node]:
                        heapq.heappush(heap, (float(distance[kid]), kid))
                elif many := rows.get(node, 0):
                    seen.append(node)
                    held += many
            out.append(seen)
        return out


def fit_tree(sample: np.ndarray, longest: float, leaves: int, branch: int = 8, rounds: int = 8, seed: int = 9) -> Tree:
    tree, random = Tree(longest), np.random.default_rng(seed)
    points = np.unique(tree.lift(sample), axis=0)
    centres, todo, least = [points.mean(axis=0)], [(0, points)], max(2.0, len(points) / max(1, leaves))
    while todo:
        node, own = todo.pop()
        k = min(branch, int(np.ceil(len(own) / least)))
        if k < 2:
            continue
        found = _kmeans(own, k, rounds, random)
        if len(found) < 2:
            continue
        near = _nearest(own, found)
        for i, centre in enumerate(found):
            tree.children[node].append(len(centres))
            tree.children.append([])
            todo.append((len(centres), own[near == i]))
            centres.append(centre)
    tree.centres = np.array(centres)
    return tree


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of 32-bit floats, stored as bytes, in double precision."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.array([np.frombuffer(x.as_buffer(), np.float64) for x in column]) if len(column) else np.zeros((0, 1))


def _score(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products along the last axis, added up component by component: equal vectors get equal scores."""
    total = np.zeros(np.broadcast_shapes(queries.shape[:-1], vectors.shape[:-1]))
    for d in range(queries.shape[-1]):
        total += queries[..., d] * vectors[..., d]
    return total


def _best(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Each query's k best of vectors other than its own: ids and scores, best first, ties to smaller ids."""
    spare = k + 8
    for at in range(0, len(queries), 256):
        own, q = query_ids[at : at + 256], queries[at : at + 256]
        rough = q @ vectors.T
        rough[own[:, None] == ids[None, :]] = -np.inf
        some = np.argpartition(-rough, min(spare, len(ids) - 1), axis=1)[:, :spare]
        exact = _score(q[:, None, :], vectors[some])
        taken = np.take_along_axis(rough, some, axis=1)
        exact[np.isneginf(taken)] = -np.inf
        slack = 1e-9 * (1 + np.abs(taken[np.isfinite(taken)]).max(initial=0))
        for row in range(len(q)):
            pick, score = some[row], exact[row]
            ordered = np.sort(taken[row])[::-1]
            if len(ids) > spare and ordered[k - 1] - ordered[-1] <= slack:  # more may tie than were taken
                pick = np.flatnonzero(rough[row] >= ordered[k - 1] - slack)
                score = _score(q[row][None, :], vectors[pick])
                score[np.isneginf(rough[row][pick])] = -np.inf
            order = np.lexsort((ids[pick], -score))[:k]
            order = order[np.isfinite(score[order])]
            yield int(own[row]), ids[pick][order], score[order]


_PAIRS = "query_id long, ids binary, scores binary"


def _pack(found: Iterator[tuple[int, np.ndarray, np.ndarray]]) -> pa.Table:
    rows = [(q, i.astype(np.int64).tobytes(), s.tobytes()) for q, i, s in found if len(i)]
    columns = list(zip(*rows, strict=True)) or [(), (), ()]
    return pa.table({"query_id": pa.array(columns[0], pa.int64()), "ids": pa.array(columns[1], pa.binary()), "scores": pa.array(columns[2], pa.binary())})


def _merged(parts: DataFrame, k: int, wanted: str) -> DataFrame:
    """One row a query: the k best of its parts, which stream through in order of queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, scores = None, np.zeros(0, np.int64), np.zeros(0)
        out: list[tuple[int, np.ndarray, np.ndarray]] = []
        for batch in batches:
            for query, i, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if query != now:
                    if now is not None:
                        out.append((now, ids, scores))
                    now, ids, scores = query, np.zeros(0, np.int64), np.zeros(0)
                ids, scores = np.concatenate([ids, np.frombuffer(i, np.int64)]), np.concatenate([scores, np.frombuffer(s)])
                if len(ids) > k:
                    order = np.lexsort((ids, -scores))[:k]
                    ids, scores = ids[order], scores[order]
            yield from _pack(iter(out)).to_batches()
            out = []
        if now is not None:
            order = np.lexsort((ids, -scores))[:k]
            yield from _pack(iter([(now, ids[order], scores[order])])).to_batches()

    return parts.repartition(wanted).sortWithinPartitions(wanted).mapInArrow(run, _PAIRS)


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """id, v (doubles as bytes), length (squared): rows with an id and a vector of finite components, not all zero,
    of the most frequent dimension (of several, the largest)."""
    v = F.col(vector_col)
    squared = F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v"), F.size(v).alias("d"), squared.alias("length"))
    rows = rows.where("id is not null and d > 0 and length > 0 and length < double('inf') and not isnan(length)")
    common = rows.groupBy("d").count().orderBy(F.col("count").desc(), F.col("d").desc()).first()
    if common is None:
        rows = rows.where("false")
    else:
        rows = rows.where(F.col("d") == common["d"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            flat = lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1) if batch.num_rows else np.zeros((0, 1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.tobytes() for x in flat], pa.binary()), batch.column(2)], names=["id", "v", "length"])

    return rows.select("id", "v", "length").mapInArrow(run, "id long, v binary, length double")


@dataclass
class Index:
    tree: Tree
    rows: dict[int, int]  # of each leaf
    vectors: DataFrame  # leaf, id, v
    visits: int = 1
    recall: float = 1.0  # of the calibration


def build(vectors: DataFrame, k: int = 20, recall: float = 0.95, fit_rows: int = 32_768, most_leaves: int = 8192, calibrate: int = 100, seed: int = 9) -> Index | None:
    """An index over usable()'s rows, all of them; None without rows.

    The tree is fitted on at most fit_rows rows, drawn by a hash, with about half the square root of the number of
    rows as leaves, most_leaves at most. `calibrate` rows serve as queries to choose the number of leaves visited.
    """
    stored = stage_table(vectors, "ann-vectors")
    total = stored.agg(F.count("*"), F.max("length")).first()
    if not total[0]:
        return None
    draw = F.xxhash64("id", F.lit(seed))
    sample = _matrix(stored.orderBy(draw, "id").select("v").limit(fit_rows).toArrow().column(0))
    tree = fit_tree(sample, float(total[1]), min(most_leaves, max(1, round(total[0] ** 0.5 / 2))))
    sent = stored.sparkSession.sparkContext.broadcast(tree)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = sent.value.leaf_of(_matrix(batch.column(1))) if batch.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(leaf), batch.column(0), batch.column(1)], names=["leaf", "id", "v"])

    leaved = stage_table(stored.select("id", "v").mapInArrow(assign, "leaf long, id long, v binary"), "ann-leaves")
    rows = {r["leaf"]: r["count"] for r in leaved.groupBy("leaf").count().collect()}
    index = Index(tree, rows, leaved)
    tried = leaved.orderBy(F.xxhash64("id", F.lit(seed + 1)), "id").select("id", "v").limit(calibrate).toArrow()
    ids, queries = tried.column(0).to_numpy(), _matrix(tried.column(1))
    probe = stored.sparkSession.sparkContext.broadcast((ids, queries))

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from _pack(_best(*probe.value, batch.column(0).to_numpy(), _matrix(batch.column(1)), k)).to_batches()

    true = _merged(leaved.select("id", "v").mapInArrow(exact, _PAIRS), k, "query_id").toArrow()
    nearest = {q: np.frombuffer(i, np.int64) for q, i in zip(true.column(0).to_pylist(), true.column(1).to_pylist(), strict=True)}
    found = leaved.where(F.col("id").isin([int(i) for n in nearest.values() for i in n])).select("id", "leaf").toArrow()
    leaf_of = dict(zip(found.column(0).to_pylist(), found.column(1).to_pylist(), strict=True))
    places = []
    for q, order in zip(ids.tolist(), tree.visits(queries, len(rows), rows, 0), strict=True):
        place = {leaf: n for n, leaf in enumerate(order)}
        places += [place[leaf_of[i]] for i in nearest.get(q, ())]
    places = np.sort(np.array(places or [0]))
    while (places < index.visits).mean() < recall:
        index.visits += 1
    index.recall = float((places < index.visits).mean())
    return index


def search(index: Index, queries: DataFrame, k: int = 20, block: int = 2048) -> DataFrame:
    """query_id, rank, vec_id, score of the k best rows found for each row (id, v) of queries other than its own.

    A leaf's rows are dealt into blocks and its queries into chunks, so a leaf of any size is searched by many tasks.
    """
    spark = queries.sparkSession
    tree, rows, visits = index.tree, index.rows, index.visits
    sent = spark.sparkContext.broadcast((tree, rows))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, rows = sent.value
        for batch in batches:
            if batch.num_rows:
                order = tree.visits(_matrix(batch.column(1)), visits, rows, k + 1)
                at = pa.array(np.repeat(np.arange(len(order)), [len(x) for x in order]))
                yield pa.RecordBatch.from_arrays([pa.array([leaf for x in order for leaf in x], pa.int64()), batch.column(0).take(at), batch.column(1).take(at)], names=["leaf", "query_id", "q"])

    routed = stage_table(queries.mapInArrow(route, "leaf long, query_id long, q binary"), "ann-routed")
    shape = stage_table(
        index.vectors.groupBy("leaf").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
        .join(routed.groupBy("leaf").agg(F.ceil(F.count("*") / block).cast("int").alias("chunks")), "leaf"),
        "ann-shape",
    )
    left = index.vectors.join(shape, "leaf").select("leaf", F.pmod(F.hash("id"), F.col("blocks")).alias("block"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), "id", "v")
    right = routed.join(shape, "leaf").select("leaf", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.pmod(F.hash("query_id"), F.col("chunks")).alias("chunk"), "query_id", "q")

    def scan(rows: pa.Table, asked: pa.Table) -> pa.Table:
        if not rows.num_rows or not asked.num_rows:
            return _pack(iter(()))
        return _pack(_best(asked.column("query_id").to_numpy(), _matrix(asked.column("q")), rows.column("id").to_numpy(), _matrix(rows.column("v")), k))

    keys = ["leaf", "block", "chunk"]
    parts = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(scan, _PAIRS)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [np.frombuffer(x, np.int64) for x in batch.column(1).to_pylist()]
            many = np.array([len(x) for x in ids], np.int64)
            if many.sum():
                scores = np.concatenate([np.frombuffer(x) for x in batch.column(2).to_pylist()])
                rank = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + 1
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(batch.column(0).to_numpy(), many)), pa.array(rank.astype(np.int32)), pa.array(np.concatenate(ids)), pa.array(scores)], names=["query_id", "rank", "vec_id", "score"])

    return _merged(parts, k, "query_id").mapInArrow(spread, "query_id long, rank int, vec_id long, score double")


def nearest(vectors: DataFrame, every: int = 20, k: int = 20, recall: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found by inner product of the rows whose id is divisible by
    `every`, of all rows but those of the query's own id; all there are, if fewer.

    Null ids, and vectors that are null, zero, hold null or non-finite components or have another dimension than most,
    take no part. Repeated rows are candidates each; a repeated query id is answered once, for its smallest vector.
    Equal scores go to the smaller id. An empty table gives no rows. Other columns are not read.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col)
    index = build(rows, k, recall)
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    asked = index.vectors.where(F.col("id") % every == 0).groupBy("id").agg(F.min("v").alias("v"))
    return search(index, asked, k)
