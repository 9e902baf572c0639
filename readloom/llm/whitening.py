"""Whitening of whole-number vectors by singular values of the centred rows.

Blocks of centred rows are reduced by QR within tasks, and their triangles by QR up a tree; Householder reflections make
the last triangle bidiagonal, dqds finds its singular values with shifts that keep every quotient positive, and twisted
factorisations give the right singular vectors. No covariance matrix is formed, so small values keep their digits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stage_table

#: Scaled entries are held to this, so that sums of halves of them stay exact.
LIMIT = 1 << 53
_EPS = np.finfo(np.float64).eps


class Whitening(NamedTuple):
    """n vectors with sums S; directions has a column per component, by falling variance; each variance is over n."""

    n: int
    sums: list[int]
    directions: np.ndarray
    variances: np.ndarray
    trace: float
    identity_error: float | None

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n: the whole part of S / n is taken off exactly."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([s % self.n for s in self.sums], np.float64) / self.n
        return (x - whole).astype(np.float64) - rest

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.directions / np.sqrt(self.variances))

    def deviation(self, x: np.ndarray) -> pa.Array:
        """The sum over dimensions of (n x - S)^2, exact; null where that is no 64-bit number."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([s % self.n for s in self.sums], np.int64)
        off = x - whole
        most = (int(np.abs(off).max(initial=0)) + 1) * self.n
        if x.shape[1] * most**2 < 1 << 63:
            return pa.array(((self.n * off - rest) ** 2).sum(axis=1))
        sums = [sum((self.n * a - r) ** 2 for a, r in zip(row, rest.tolist(), strict=True)) for row in off.tolist()]
        return pa.array([s if s < 1 << 63 else None for s in sums], pa.int64())


# --- bidiagonal form, dqds, twisted factorisations ----------------------------------------------------------------


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and V with r = U B V': Householder reflections from both sides in turn."""
    d = r.shape[1]
    a = np.zeros((d, d))
    a[: len(r)] = r
    v = np.eye(d)
    for k in range(d):
        for side in (0, 1):  # clear the column under the diagonal, then the row right of the superdiagonal
            at = k + side
            x = a[at:, k].copy() if side == 0 else a[k, at:].copy()
            norm = np.linalg.norm(x)
            if len(x) < 2 or norm == 0:
                continue
            x[0] += math.copysign(norm, x[0])
            x /= np.linalg.norm(x)
            if side == 0:
                a[at:, k:] -= 2 * np.outer(x, x @ a[at:, k:])
            else:
                a[k:, at:] -= 2 * np.outer(a[k:, at:] @ x, x)
                v[:, at:] -= 2 * np.outer(v[:, at:] @ x, x)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def _transform(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float] | None:
    """One dqds step; None if the shift is above the least value."""
    new_q, new_e, d = [], [], q[0] - shift
    least = d
    for i in range(len(e)):
        if d < 0:
            return None
        s = d + e[i]
        new_q.append(s)
        if s == 0:  # both parts vanish: what follows starts anew
            new_e.append(0.0)
            d = q[i + 1] - shift
        else:
            t = q[i + 1] / s
            new_e.append(e[i] * t)
            d = d * t - shift
        least = min(least, d)
    if d < 0:
        return None
    return [*new_q, d], new_e, least


def squared_singular_values(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Of the upper bidiagonal matrix, rising: dqds. Shifts are lower bounds by the last two quotients; one that proves
    too large is taken back."""
    out: list[float] = []
    todo = [([float(x) ** 2 for x in diagonal], [float(x) ** 2 for x in above], 0.0)]
    while todo:
        q, e, sigma = todo.pop()
        rounds, most = 0, 60 * (len(q) + 10)
        while len(q) > 1:
            cut = [i for i in range(len(e)) if e[i] <= (_EPS**2) * (sigma + q[i]) or e[i] == 0]
            if cut and cut[-1] == len(e) - 1:
                out.append(sigma + q.pop())
                e.pop()
                continue
            if cut:
                i = cut[-1]
                todo.append((q[: i + 1], e[:i], sigma))
                q, e = q[i + 1 :], e[i + 1 :]
                continue
            if q[0] < q[-1] and rounds == 0:  # graded the other way: turn round
                q, e = _turned(q, e)
            a, b, c = q[-2], q[-1], e[-1]
            half = (a + b + c) / 2  # the lesser value of the last two rows is near the least of all
            low = max(0.0, a * b / (half + math.sqrt(max(0.0, half * half - a * b)))) if half > 0 else 0.0
            for shift in (low * (1 - 1e-3), low * 0.75, low * 0.25, low * 0.01, 0.0):
                step = _transform(q, e, shift)
                if step:
                    break
            q, e, _ = step
            sigma += shift
            rounds += 1
            if rounds > most:
                raise ArithmeticError("dqds doesn't converge")
        out.append(sigma + q[0])
    return np.sort(np.array(out))


def _turned(q: list[float], e: list[float]) -> tuple[list[float], list[float]]:
    """The quotients of the matrix with its rows and columns in reverse order."""
    t = [math.sqrt(x) for x in q], [math.sqrt(x) for x in e]
    r = np.diag(t[0]) + np.diag(t[1], 1)
    low = r[::-1, ::-1]  # lower bidiagonal: its transpose has the same singular values
    return [float(x) ** 2 for x in np.diag(low)], [float(x) ** 2 for x in np.diag(low, -1)]


def _twisted(d: np.ndarray, low: np.ndarray, value: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Factors of L D L' - value from both ends, and the gammas of all twists."""
    n, tiny = len(d), max(value * _EPS**2, np.finfo(np.float64).tiny / _EPS)
    plus, minus, s, p = np.zeros(max(0, n - 1)), np.zeros(max(0, n - 1)), np.zeros(n), np.zeros(n)
    safe = lambda x: x if abs(x) > tiny else tiny
    s[0] = -value
    for i in range(n - 1):
        plus[i] = d[i] * low[i] / safe(s[i] + d[i])
        s[i + 1] = plus[i] * low[i] * s[i] - value
    p[-1] = safe(d[-1] - value)
    for i in range(n - 2, -1, -1):
        t = d[i] / safe(d[i] * low[i] ** 2 + p[i + 1])
        minus[i] = low[i] * t
        p[i] = safe(p[i + 1] * t - value)
    return plus, minus, s + p + value


def _vector(plus: np.ndarray, minus: np.ndarray, k: int) -> np.ndarray:
    z = np.zeros(len(plus) + 1)
    z[k] = 1
    for i in range(k - 1, -1, -1):
        z[i] = -plus[i] * z[i + 1]
    for i in range(k, len(minus)):
        z[i + 1] = -minus[i] * z[i]
        if not np.isfinite(z[i + 1]):
            z[i + 1] = 0
    return np.nan_to_num(z) / np.linalg.norm(np.nan_to_num(z))


def right_vectors(diagonal: np.ndarray, above: np.ndarray, squares: np.ndarray, close: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """The eigenvectors of B'B for the wanted squares (falling), and their eigenvalues.

    Each comes from the twist of least gamma. Values closer than `close` of each other share what their vectors span:
    those are taken at several twists, made orthogonal, and turned to B'B's own axes within the span.
    """
    size = max(float(np.abs(diagonal).max(initial=0)), float(np.abs(above).max(initial=0)), np.finfo(np.float64).tiny)
    a = np.where(np.abs(diagonal) < size * _EPS**2, size * _EPS**2, diagonal)
    d, low = a**2, above / a[:-1]
    times = lambda z: _product(diagonal, above, z)
    vectors, values, i = [], [], 0
    while i < len(squares):
        j = i + 1
        while j < len(squares) and squares[j - 1] - squares[j] <= close * squares[j - 1]:
            j += 1
        group: list[np.ndarray] = []
        for value in squares[i:j]:
            plus, minus, gamma = _twisted(d, low, float(value))
            for k in np.argsort(np.abs(gamma), kind="stable"):
                z = _vector(plus, minus, int(k))
                for _ in range(2):
                    for other in group:
                        z = z - (z @ other) * other
                if np.linalg.norm(z) > 0.1 or not group:
                    group.append(z / np.linalg.norm(z))
                    break
            else:
                raise ArithmeticError("a group of equal values without as many vectors")
        if len(group) > 1:
            span = _settled(np.array(group).T, d, low, float(np.mean(squares[i:j])))
            image = times(span)
            own, turn = np.linalg.eigh(image.T @ image)
            group = list((span @ turn[:, ::-1]).T)
            values += own[::-1].tolist()
        else:
            values.append(float(squares[i]))
        vectors += group
        i = j
    return np.array(vectors).T.reshape(len(diagonal), len(squares)), np.array(values)


def _settled(span: np.ndarray, d: np.ndarray, low: np.ndarray, value: float) -> np.ndarray:
    """Two steps of inverse iteration on a group's span, so that it is that of its values alone."""
    t = np.diag(d) + np.diag(np.append(0, low**2 * d[:-1])) + np.diag(low * d[:-1], 1) + np.diag(low * d[:-1], -1)
    shifted = t - value * (1 + 4 * _EPS) * np.eye(len(d))
    for _ in range(2):
        try:
            span = np.linalg.qr(np.linalg.solve(shifted, span))[0]
        except np.linalg.LinAlgError:  # exactly singular: the span has settled
            break
    return span


def _product(diagonal: np.ndarray, above: np.ndarray, z: np.ndarray) -> np.ndarray:
    out = diagonal[:, None] * z
    out[:-1] += above[:, None] * z[1:]
    return out


def principal(r: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Directions and squared singular values of r, falling, `most` at most, and the sum of all squares. Values of
    rounding size only (rank missing) are left out."""
    diagonal, above, v = bidiagonalise(r)
    squares = squared_singular_values(diagonal, above)[::-1]
    total = float(np.sum(r * r))
    wanted = squares[: min(most, int((squares > max(r.shape) ** 2 * _EPS**2 * max(squares[0], 0) * 16).sum()))] if total > 0 else squares[:0]
    if not len(wanted):
        return np.zeros((r.shape[1], 0)), wanted, total
    k = len(wanted)
    while k < len(squares) and squares[k] > 0 and squares[k - 1] - squares[k] <= 1e-6 * squares[k - 1]:
        k += 1  # the last group whole, or its span isn't that of its values
    z, values = right_vectors(diagonal, above, squares[:k])
    return v @ z[:, : len(wanted)], values[: len(wanted)], total


# --- on Spark -----------------------------------------------------------------------------------------------------


def whole_vectors(vector: Column, scale: float = 64, offset: int = 1_000_000) -> Column:
    """floor(scale * entry) + offset as whole numbers, scale * entry held to +-2^53; null for a null vector or one with a null or
    non-finite entry."""
    good = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    number = lambda c: F.floor(F.greatest(F.lit(-float(LIMIT)), F.least(F.lit(float(LIMIT)), c.cast("double") * F.lit(float(scale))))).cast("long") + F.lit(offset)
    return F.when(good, F.transform(vector, number))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def _moments(vectors: DataFrame, width: int) -> tuple[int, list[int]]:
    """Number and exact sums by dimension. Tasks add up halves of 27 bits; a row per task comes to the driver's sum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(width, np.int64), np.zeros(width, np.int64)
        for batch in batches:
            x = _matrix(batch.column(0), width)
            n, high, low = n + len(x), high + (x >> 27).sum(axis=0), low + (x & ((1 << 27) - 1)).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([n] * width), pa.array(range(width), pa.int32()), pa.array(high), pa.array(low)], names=["n", "i", "high", "low"])

    wide = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    rows = vectors.mapInArrow(run, "n long, i int, high long, low long").groupBy("i").agg(wide("n"), wide("high"), wide("low")).orderBy("i").collect()
    return (int(rows[0]["n"]) if rows else 0), [(int(r["high"]) << 27) + int(r["low"]) for r in rows]


def _triangle(vectors: DataFrame, model: Whitening, width: int, rows: int = 2048, memory: int = 64 << 20) -> np.ndarray:
    """R of the centred rows: a QR per block of rows, then up a tree whose nodes hold at most `memory` bytes."""

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, width))
        for batch in batches:
            x = _matrix(batch.column(0), width)
            for at in range(0, len(x), rows):
                r = np.linalg.qr(np.concatenate([r, model.centred(x[at : at + rows])]), mode="r")
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([r.tobytes()], pa.binary())], names=["node", "r"])

    def join(key: tuple, table: pa.Table) -> pa.Table:
        parts = sorted(zip(table["node"].to_pylist(), table["r"].to_pylist(), strict=True))
        stacked = np.concatenate([np.frombuffer(b).reshape(-1, width) for _, b in parts])
        return pa.table({"node": pa.array([key[0].as_py()], pa.int64()), "r": pa.array([np.linalg.qr(stacked, mode="r").tobytes()], pa.binary())})

    fan = int(max(2, min(64, memory // (width * width * 8))))
    level = stage_table(vectors.mapInArrow(leaves, "node long, r binary"), "whitening-triangles")
    while level.count() > 1:
        level = stage_table(level.groupBy(F.floor(F.col("node") / fan).alias("up")).applyInArrow(join, "node long, r binary"), "whitening-triangles")
    return np.frombuffer(level.first()["r"]).reshape(-1, width)


def _identity_error(vectors: DataFrame, model: Whitening, width: int) -> float:
    """The largest entry by which the covariance of whitened vectors differs from the identity. Tasks centre by the
    mean, which is taken first; a row per entry and task is summed."""
    k = len(model.variances)

    def totals(of: object, size: int) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size)
            for batch in batches:
                total += of(model.whiten(_matrix(batch.column(0), width)))
            yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array(total)], names=["i", "v"])

        return np.array([r["v"] for r in vectors.mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).orderBy("i").collect()])

    mean = totals(lambda w: w.sum(axis=0), k) / model.n
    covariance = totals(lambda w: ((w - mean).T @ (w - mean)).ravel(), k * k).reshape(k, k) / model.n
    return float(np.abs(covariance - np.eye(k)).max())


def fit(vectors: DataFrame, components: int = 16, column: str = "x") -> Whitening | None:
    """From each distinct vector (array<long>) once; None without any of at least one dimension.

    Null vectors are left out, and so are those of another dimension than most rows have (of equally common ones, the
    larger). Components without variance aren't returned. The driver holds matrices of dimension x dimension.
    """
    known = vectors.where(F.col(column).isNotNull() & (F.size(column) > 0)).select(F.col(column).alias("x"))
    common = known.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if common is None:
        return None
    width = common["d"]
    distinct = stage_table(known.where(F.size("x") == width).distinct(), "whitening-vectors")
    n, sums = _moments(distinct, width)
    empty = Whitening(n, sums, np.zeros((width, 0)), np.zeros(0), 0.0, None)
    directions, squares, total = principal(_triangle(distinct, empty, width), components)
    if not len(squares):
        return empty
    model = Whitening(n, sums, directions, squares / n, total / n, None)
    return model._replace(identity_error=_identity_error(distinct, model, width))


def whiten(df: DataFrame, model: Whitening | None, column: str = "x") -> DataFrame:
    """df with deviation (long) and whitened (array<double>, a place per component); without `column`.

    Rows whose vector is null or of another dimension than the model's are left out; without a model all are. Other
    columns pass through; those of the two names are replaced.
    """
    rest = [c for c in df.columns if c not in (column, "deviation", "whitened")]
    schema = T.StructType([df.schema[c] for c in rest] + T.StructType.fromDDL("deviation long, whitened array<double>").fields)
    if model is None:
        return df.where("false").select(*rest, F.lit(None).cast("long").alias("deviation"), F.lit(None).cast("array<double>").alias("whitened"))
    width, sent = len(model.sums), df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            x = _matrix(batch.column(len(rest)), width)
            w = model.whiten(x)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32()), pa.array(w.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(rest)], model.deviation(x), lists], names=schema.names)

    return df.where(F.col(column).isNotNull() & (F.size(column) == width)).select(*rest, column).mapInArrow(run, schema)
