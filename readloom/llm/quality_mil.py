"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages. Every passage is encoded, gated attention weighs the encodings, and their weighted
sum is scored; encoder, attention and scorer are learned together from labels of documents.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import short_batches, stage_table
from .langid import held_out

#: Features, passages by bag, labels, times.
Batch = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]
PASSAGE = 1024
_KINDS = 16
FEATURES = _KINDS * _KINDS + 2


def _kinds() -> np.ndarray:
    """A kind for every byte: letters by case, digits, white space, marks by use, and UTF-8 lead and later bytes."""
    out = np.full(256, 15, np.int64)
    out[128:192], out[192:] = 14, 13
    out[33:127] = 11
    for kind, some in enumerate(("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ", "\n\t\r\x0b\x0c", ",", ".", "!?", "|", "*#", "$%&<>")):
        out[list(some.encode())] = kind
    out[list(b"'\"-")] = 12
    return out


_KIND = _kinds()


#: Bytes that are looked at together.
_BLOCK = 1 << 19


class Passages:
    """The passages of some texts (of `passage` bytes, a text's last one shorter; an empty text has an empty one).

    `many` is the number of each text's passages. features() goes through them in blocks, so that besides the texts only
    a hash for each word is held.
    """

    def __init__(self, data: np.ndarray, sizes: np.ndarray, passage: int = PASSAGE):
        self.data, self.passage = data, passage
        self.many = np.maximum(1, -(-sizes // passage))
        ends = np.cumsum(sizes)
        self.text = np.repeat(np.arange(len(sizes)), self.many)
        nth = np.arange(len(self.text)) - np.repeat(np.cumsum(self.many) - self.many, self.many)
        self.at = (ends - sizes)[self.text] + nth * passage
        self.size = np.minimum(passage, ends[self.text] - self.at)
        self.first, self.end = nth == 0, ends[self.text]
        self.last = self.at + self.size == self.end
        self.words = [self._words(lo, hi) for lo, hi in self._blocks()]
        ordered = np.concatenate([np.zeros(0, np.uint64), *[k for _, k in self.words]])
        ordered.sort()
        again = ordered[1:][ordered[1:] == ordered[:-1]]
        self.again = again[np.concatenate([[True], again[1:] != again[:-1]])] if len(again) else again

    def _blocks(self) -> Iterator[tuple[int, int]]:
        """Ranges of passages of about _BLOCK bytes."""
        lot = (np.cumsum(self.size) - self.size) // _BLOCK
        cuts = np.concatenate([[0], np.flatnonzero(lot[1:] != lot[:-1]) + 1, [len(lot)]]) if len(lot) else [0]
        return zip(cuts[:-1], cuts[1:], strict=True)

    def _words(self, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """The number of word starts with 16 bytes after them of passages lo to hi, and a hash of these bytes each."""
        size, begin = self.size[lo:hi], int(self.at[lo])
        kind = _KIND[self.data[begin : begin + int(size.sum())]]
        blank = (kind == 3) | (kind == 4)
        before = np.concatenate([[False], blank[:-1]])
        own = np.cumsum(size) - size
        if begin and len(kind) and not self.first[lo]:
            before[0] = _KIND[self.data[begin - 1]] in (3, 4)
        before[own[self.first[lo:hi] & (size > 0)]] = True
        of = np.repeat(np.arange(hi - lo), size)
        starts = np.flatnonzero(~blank & before)
        starts = starts[begin + starts + 16 <= self.end[lo:hi][of[starts]]]
        of = of[starts]
        if not len(starts):
            return np.zeros(hi - lo, np.int64), np.zeros(0, np.uint64)
        words = np.lib.stride_tricks.sliding_window_view(self.data, 16)[begin + starts].copy().view(np.uint64)
        salt = self.text[lo:hi][of].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        return np.bincount(of, minlength=hi - lo), (words[:, 0] * np.uint64(0x9E3779B97F4A7C15)) ^ (words[:, 1] * np.uint64(0xC2B2AE3D27D4EB4F)) ^ salt

    def features(self) -> Iterator[np.ndarray]:
        """Of each passage, block by block: shares of pairs of kinds of bytes, the share of word starts whose 16 bytes
        the text has elsewhere too, and how full the passage is."""
        for (lo, hi), (starts, words) in zip(self._blocks(), self.words, strict=True):
            size, n, begin = self.size[lo:hi], hi - lo, int(self.at[lo])
            x = np.zeros((n, FEATURES), np.float32)
            kind = _KIND[self.data[begin : begin + int(size.sum()) + 1]]
            length = int(size.sum())
            pair = kind[:length] * _KINDS
            pair[: len(kind) - 1] += kind[1:][:length]
            own = np.cumsum(size)
            ends = own[self.last[lo:hi] & (size > 0)] - 1
            pair[ends] = kind[ends] * _KINDS + 4  # a text ends as a line does
            shares = np.bincount(np.repeat(np.arange(n), size) * _KINDS**2 + pair, minlength=n * _KINDS**2).reshape(n, -1)
            x[:, : _KINDS**2] = np.sqrt(shares / np.maximum(size, 1)[:, None])
            if len(self.again) and len(words):
                at = np.minimum(np.searchsorted(self.again, words), len(self.again) - 1)
                x[:, -2] = np.bincount(np.repeat(np.arange(n), starts), weights=self.again[at] == words, minlength=n) / np.maximum(starts, 1)
            x[:, -1] = np.log1p(size) / np.log1p(self.passage)
            yield x


def encode_passages(texts: list[bytes], passage: int = PASSAGE) -> tuple[np.ndarray, np.ndarray]:
    """All features of the texts' passages, and the number of passages of each text."""
    p = Passages(np.frombuffer(b"".join(texts), np.uint8), np.array([len(t) for t in texts], np.int64), passage)
    return np.concatenate([np.zeros((0, FEATURES), np.float32), *p.features()]), p.many


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


class Model:
    """Encoder, gated attention and scorer. score() gives each bag's probability of label 1."""

    def __init__(self, features: int = FEATURES, hidden: int = 24, gates: int = 12, seed: int = 5):
        r = np.random.default_rng(seed)
        init = lambda *s: (r.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        zeros = lambda n: np.zeros(n, np.float32)
        self.p = {"W": init(features, hidden), "bW": zeros(hidden), "V": init(hidden, gates), "bV": zeros(gates), "U": init(hidden, gates), "bU": zeros(gates), "w": init(gates), "c": init(hidden), "b": zeros(1)}
        self.mean, self.scale = zeros(features), np.ones(features, np.float32)

    def _hidden(self, x: np.ndarray) -> np.ndarray:
        """The encodings of passages; features are brought to mean 0 and scale 1 within the weights."""
        w = self.p["W"] / self.scale[:, None]
        return np.maximum(x @ w + (self.p["bW"] - self.mean @ w), 0)

    def _forward(self, h: np.ndarray, many: np.ndarray) -> dict[str, np.ndarray]:
        p, first = self.p, np.cumsum(many) - many
        t, g = np.tanh(h @ p["V"] + p["bV"]), _sigmoid(h @ p["U"] + p["bU"])
        e = (t * g) @ p["w"]
        a = np.exp(e - np.repeat(np.maximum.reduceat(e, first), many))
        a /= np.repeat(np.add.reduceat(a, first), many)
        z = np.add.reduceat(a[:, None] * h, first, axis=0)
        return {"h": h, "t": t, "g": g, "a": a, "z": z, "y": _sigmoid(z @ p["c"] + p["b"])}

    def score(self, x: np.ndarray, many: np.ndarray) -> np.ndarray:
        return self._forward(self._hidden(x), many)["y"] if len(many) else np.zeros(0)

    def score_passages(self, p: Passages) -> np.ndarray:
        """score() of texts whose features are made block by block."""
        return self._forward(np.concatenate([self._hidden(x) for x in p.features()]), p.many)["y"] if len(p.many) else np.zeros(0)

    def gradient(self, x: np.ndarray, many: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Of the weighted sum of the bags' log losses, by each parameter."""
        p, f, first = self.p, self._forward(self._hidden(x), many), np.cumsum(many) - many
        h, t, g, a = f["h"], f["t"], f["g"], f["a"]
        ds = (weight * (f["y"] - labels)).astype(np.float32)
        dz = np.repeat(ds, many)[:, None] * p["c"]
        da = (h * dz).sum(axis=1)
        de = a * (da - np.repeat(np.add.reduceat(a * da, first), many))
        dt, dg = de[:, None] * p["w"] * g * (1 - t * t), de[:, None] * p["w"] * t * g * (1 - g)
        dh = (a[:, None] * dz + dt @ p["V"].T + dg @ p["U"].T) * (h > 0)
        return {
            "W": (x.T @ dh - np.outer(self.mean, dh.sum(0))) / self.scale[:, None], "bW": dh.sum(0), "V": h.T @ dt, "bV": dt.sum(0), "U": h.T @ dg, "bU": dg.sum(0),
            "w": (t * g).T @ de, "c": f["z"].T @ ds, "b": ds.sum(keepdims=True),
        }

    def fit(
        self, x: np.ndarray, many: np.ndarray, labels: np.ndarray, times: np.ndarray | None = None, epochs: int = 200, rate: float = 0.01, decay: float = 1e-4
    ) -> None:
        """Adam over all bags at once, each counted so many times; both labels weigh alike."""
        self.fit_batches([lambda: (x, many, labels, np.ones(len(many)) if times is None else times)], epochs, rate, decay)

    def fit_batches(self, batches: Sequence[Callable[[], Batch]], steps: int = 200, rate: float = 0.01, decay: float = 1e-4, rounds: int = 8) -> None:
        """Adam with a batch a step, in turn: `steps` steps, or so many that each batch comes up `rounds` times. A batch
        is (features, passages by bag, labels, times each bag counts); one is held at a time."""
        rows, total, square, each = 0, 0.0, 0.0, {0: 0.0, 1: 0.0}
        for make in batches:
            x, _, labels, times = make()
            rows, total = rows + len(x), total + x.sum(axis=0, dtype=np.float64)
            each = {k: n + times[labels == k].sum() for k, n in each.items()}
        self.mean = (total / rows).astype(np.float32)
        for make in batches:
            x = make()[0]
            square = square + sum(((x[i : i + 4096] - self.mean) ** 2).sum(axis=0, dtype=np.float64) for i in range(0, len(x), 4096))
        self.scale = (np.sqrt(square / rows) + 0.02).astype(np.float32)
        m, v = ({k: np.zeros_like(a) for k, a in self.p.items()} for _ in range(2))
        for step in range(1, max(steps, rounds * len(batches)) + 1):
            x, many, labels, times = batches[(step - 1) % len(batches)]()
            weight = len(batches) * times * np.where(labels == 1, 0.5 / max(1, each[1]), 0.5 / max(1, each[0]))
            p, grad = self.p, self.gradient(x, many, labels, weight)
            for k in p:
                d = grad[k] + decay * p[k]
                m[k], v[k] = 0.9 * m[k] + 0.1 * d, 0.999 * v[k] + 0.001 * d * d
                p[k] = (p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)


def _lots(column: pa.Array, most: int = 1 << 21) -> Iterator[tuple[int, int, Passages]]:
    """Rows i to j of a batch's texts, of about `most` bytes or one longer text, as passages; nothing is copied."""
    column = column.cast(pa.large_binary())
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(at, at[i] + most, side="right")) - 1)
        yield i, j, Passages(data[at[i] : at[j]], np.diff(at[i : j + 1]))
        i = j


def train(
    docs: DataFrame, labels: DataFrame, sample_rows: int = 3000, batch_bytes: int = 32 << 20, seed: int = 3,
    id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
) -> Model | None:
    """A model from a bounded sample of labelled texts; None without any.

    The sample is drawn by a hash of the id: at most sample_rows labels of documents that are there, with their
    different texts, whatever their lengths. Features are stored, about a byte a byte of text, and learned from in
    batches of about batch_bytes, in the order of the draw; the driver holds a few of them, and the longest text's at
    least. Null labels are left out. Ids labelled more than once count once for each label, and repeated rows once
    each.
    """
    spark = docs.sparkSession
    draw = F.xxhash64(F.col(id_col), F.lit(seed))
    known = labels.where(F.col(label_col).isin(0, 1)).select(id_col, F.col(label_col).cast("int").alias("label"), draw.alias("draw"))
    some = known.join(docs.select(id_col), id_col, "left_semi").orderBy("draw", id_col, "label").limit(sample_rows)
    some = stage_table(some, "mil-labels")  # sample_rows rows at most
    text = F.coalesce(F.col(text_col), F.lit(""))
    asked = docs.select(id_col, text.alias("text_")).join(F.broadcast(some), id_col).select("draw", F.xxhash64("text_").alias("th"), "label", "text_")
    sized = asked.groupBy("draw", "th", "label").agg(F.max(F.octet_length("text_")).alias("size"), F.count("*").alias("times"))
    drawn, filled = [], 0
    for r in sized.orderBy("draw", "th", "label").limit(sample_rows).collect():
        drawn.append((r["draw"], r["th"], r["label"], r["times"], filled // batch_bytes))
        filled += r["size"]
    if not drawn:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, passages in _lots(batch.column(5), 1):
                nth = 0
                for x in passages.features():
                    own = [batch.column(c).slice(i, j - i) for c in range(5)]
                    yield pa.RecordBatch.from_arrays([*own, pa.array([nth], pa.int32()), pa.array([x.tobytes()], pa.binary())], names=["draw", "th", "label", "times", "batch", "nth", "x"])
                    nth += 1

    keys = F.broadcast(spark.createDataFrame(drawn, "draw long, th long, label int, times long, batch long"))
    chosen = asked.join(keys, ["draw", "th", "label"]).dropDuplicates(["draw", "th", "label"])
    with short_batches(spark, 64):
        encoded = chosen.select("draw", "th", "label", "times", "batch", F.col("text_").cast("binary").alias("data"))
        stored = stage_table(encoded.mapInArrow(run, "draw long, th long, label int, times long, batch long, nth int, x binary"), "mil-features")

    @lru_cache(maxsize=3)
    def read(number: int) -> Batch:
        found = stored.where(F.col("batch") == number).toPandas().sort_values(["draw", "th", "label", "nth"], ignore_index=True)  # the same for any order of rows
        x = np.frombuffer(b"".join(found["x"]), np.float32).reshape(-1, FEATURES)
        many = found.assign(n=found["x"].map(len) // (4 * FEATURES)).groupby(["draw", "th", "label"]).agg(n=("n", "sum"), times=("times", "first")).reset_index()
        return x, many["n"].to_numpy(), many["label"].to_numpy(), many["times"].to_numpy()

    model = Model()
    model.fit_batches([partial(read, n) for n in sorted({d[4] for d in drawn})])
    return model


def predict(docs: DataFrame, model: Model | None, threshold: float = 0.3, text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """docs with score (0 to 1, higher: label 1 likelier) and predicted (1 from threshold on); without text_col unless
    keep_text.

    Null and empty texts are bags of one empty passage. Without a model every score is 0.5. Repeated rows score alike;
    other columns pass through, and those of the two names are replaced; an empty table gives an empty table.
    """
    rest = [c for c in docs.columns if c not in ("score", "predicted", text_col)]
    passed = [*rest, text_col] if keep_text else rest
    schema = T.StructType([docs.schema[c] for c in passed] + T.StructType.fromDDL("score double, predicted int").fields)
    names = schema.names
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            data = batch.column(len(rest))
            scores = [model.score_passages(p) for _, _, p in _lots(data)] if model else [np.full(len(data), 0.5)]
            score = np.concatenate(scores).astype(np.float64) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(passed)], pa.array(score), pa.array((score >= threshold).astype(np.int32))], names=names)

    return docs.select(*rest, text_col).mapInArrow(run, schema)


def learn_from(labels: DataFrame, folds: int = 5, fold: int = 0, id_col: str = "doc_id") -> DataFrame:
    """The rows of labels that aren't held out."""
    return labels.where(~held_out(id_col, folds, fold))
