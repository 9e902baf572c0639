"""Language identification by character language models with interpolated Kneser-Ney smoothing.

There is a model per language over the letters of words, each word between two edges, from counts over all texts to
learn from: words and n-grams are counted on Spark, and every n-gram counts. All models share sorted arrays of n-gram
hashes, one per order, beside which stand the smoothed probabilities of every language: a seen n-gram takes one search,
an unseen one a search of its context's back-off weights and the next shorter n-gram. These arrays are bounded: they
have the most frequent contexts with all their n-grams. What follows other contexts stays in a table on Spark; a bitmap
tells the symbols that may need it, and these are joined with it, so that their probabilities are those of one whole model.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import in_bitmap, key_bitmap, stage_path, stage_table

_EDGE = 2  # code point of word edges


def letters(token: str) -> str:
    return token if token.isalpha() else "".join(filter(str.isalpha, token))


def _edged(words: list[str]) -> str:
    return "".join([f"{chr(_EDGE)}{w}{chr(_EDGE)}" for w in words])


def _grams(words: list[str], order: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """For every symbol that a model predicts in words (letters and the end): the word it is of, its place from 1,
    and per k up to order the hash of the k symbols that end there, where the word has as many."""
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    word = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(word)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return word, place, _hashes(_edged(words), order)


def _hashes(symbols: str, order: int) -> list[np.ndarray]:
    text = np.frombuffer(symbols.encode("utf-32-le"), np.uint32).astype(np.uint64)
    hashes, h = [], np.zeros(len(text), np.uint64)
    for k in range(order):
        shifted = np.zeros(len(text), np.uint64)
        shifted[k:] = text[: max(0, len(text) - k)]
        h = (h ^ (shifted + np.uint64(k * 0x1F1F1F1F1F))) * np.uint64(0x9E3779B97F4A7C15)
        h = h ^ (h >> np.uint64(29))
        hashes.append(h)
    return hashes


def _contexts(hashes: list[np.ndarray]) -> list[np.ndarray]:
    """Per k the hash of the k - 1 symbols before each."""
    return [np.zeros(len(hashes[0]), np.uint64)] + [np.concatenate([[np.uint64(0)], h[:-1]]) for h in hashes[:-1]]


def _find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(table, keys), max(0, len(table) - 1))
    return at, (table[at] == keys if len(table) else np.zeros(len(keys), bool))


@dataclass
class Model:
    languages: list[str]
    order: int
    grams: list[np.ndarray]  # per order: sorted hashes
    logs: list[np.ndarray]  # and the languages' log2 probabilities
    contexts: list[np.ndarray]  # per order: sorted hashes of contexts
    backs: list[np.ndarray]  # and the languages' log2 back-off weights
    uniform: float
    temperature: float = 1.0
    limits: np.ndarray | None = None  # per language the cross-entropy that its texts stay under
    rest: str | None = None  # folder of what follows other contexts (see fit)
    rest_bits: np.ndarray | None = None  # and a bitmap of these

    def __post_init__(self) -> None:
        if self.limits is None:
            self.limits = np.full(len(self.languages), np.inf)

    def logs_of(self, hashes: list[np.ndarray], place: np.ndarray, todo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The languages' log2 probabilities of the symbols todo, and whether what follows other contexts may change them."""
        before = _contexts(hashes)
        total, open_ = np.zeros((len(place), len(self.languages)), np.float32), np.zeros(len(place), bool)
        for k in range(self.order, 0, -1):
            long = place[todo] + 1 >= k
            some = todo[long]
            at, seen = _find(self.grams[k - 1], hashes[k - 1][some])
            total[some[seen]] += self.logs[k - 1][at[seen]]
            rest = some[~seen]
            at, seen = _find(self.contexts[k - 1], before[k - 1][rest])
            total[rest[seen]] += self.backs[k - 1][at[seen]]
            if self.rest_bits is not None:
                other = rest[~seen]
                open_[other] |= in_bitmap(self.rest_bits, before[k - 1][other].view(np.int64))
            todo = np.concatenate([todo[~long], rest])
        total[todo] += self.uniform  # symbols no language has
        return total, open_

    def symbols(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word, place and the languages' log2 probabilities of each symbol of words; place 0 is the opening edge."""
        word, place, hashes = _grams(words, self.order)
        return word, place, self.logs_of(hashes, place, np.flatnonzero(place > 0))[0]

    def score(self, words: list[str]) -> tuple[np.ndarray, list[tuple[int, str]]]:
        """For each word, made of letters: the sum of log2 probabilities by language, and how many symbols. Symbols that
        the rest on Spark may change are counted, but not summed: they are told, with the word each is of, by the window
        of symbols that bears on them."""
        out = np.zeros((len(words), len(self.languages) + 1))
        if not words:
            return out, []
        word, place, hashes = _grams(words, self.order)
        total, open_ = self.logs_of(hashes, place, np.flatnonzero(place > 0))
        total[open_] = 0
        first = np.flatnonzero(place == 0)
        out[:, :-1] = np.add.reduceat(total, first, axis=0, dtype=np.float64)
        out[:, -1] = np.diff(np.append(first, len(place))) - 1
        windows = []
        if open_.any():
            text = _edged(words)
            windows = [(int(word[i]), text[i + 1 - min(self.order, int(place[i]) + 1) : i + 1]) for i in np.flatnonzero(open_).tolist()]
        return out, windows


def count_words(texts: DataFrame, most: int = 200_000) -> DataFrame:
    """lang, word, n: how often each word, of letters, stands in texts (lang, text). Counted per task before the
    shuffle; a task hands on what it has whenever it holds `most` words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, Counter] = {}

        def flat() -> pa.RecordBatch:
            rows = [(lang, w, n) for lang, c in found.items() for w, n in c.items()]
            columns = list(zip(*rows, strict=True)) or [(), (), ()]
            kinds = (pa.string(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["lang", "word", "n"])

        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1), strict=True):
                tokens = Counter((text.as_py() or "").lower().split())
                own = found.setdefault(lang.as_py(), Counter())
                for token, n in tokens.items():
                    if w := letters(token):
                        own[w] += n
                if sum(map(len, found.values())) > most:
                    yield flat()
                    found.clear()
        yield flat()

    return texts.select("lang", "text").mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def count_grams(words: DataFrame, order: int) -> DataFrame:
    """lang, k, gram, context, shorter, n, raw of the n-grams of words (lang, word, n), by hashes.

    n: how often; raw: the count that Kneser-Ney smoothing goes by. N-grams of the highest order and those at a word's
    start count as often as they occur, others by how many symbols come before them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang = batch.column(0).to_numpy(zero_copy_only=False)
            for name in sorted(set(lang.tolist())):
                own = batch.filter(pa.array(lang == name))
                times = own.column(2).to_numpy()
                word, place, hashes = _grams(own.column(1).to_pylist(), order)
                before = _contexts(hashes)
                for k in range(1, order + 1):
                    at = np.flatnonzero((place > 0) & (place + 1 >= k))
                    gram, first, back = np.unique(hashes[k - 1][at], return_index=True, return_inverse=True)
                    first = at[first]
                    shorter = hashes[k - 2][first] if k > 1 else np.zeros(len(gram), np.uint64)
                    n = np.bincount(back, weights=times[word[at]], minlength=len(gram)).astype(np.int64)
                    longs = [x.view(np.int64) for x in (gram, before[k - 1][first], shorter)]
                    columns = [pa.array([name] * len(gram), pa.string()), pa.array(np.full(len(gram), k, np.int32))]
                    columns += [*map(pa.array, longs), pa.array(place[first] + 1 == k), pa.array(n)]
                    yield pa.RecordBatch.from_arrays(columns, names=["lang", "k", "gram", "context", "shorter", "opens", "n"])

    schema = "lang string, k int, gram long, context long, shorter long, opens boolean, n long"
    each = words.select("lang", "word", "n").mapInArrow(run, schema)
    same = [F.any_value(c).alias(c) for c in ("context", "shorter", "opens")]
    grams = stage_table(each.groupBy("lang", "k", "gram").agg(*same, F.sum("n").alias("n")), "langid-grams")
    more = grams.where("k > 1").groupBy("lang", (F.col("k") - 1).alias("k"), F.col("shorter").alias("gram")).agg(F.count("*").alias("kinds"))
    raw = F.when(F.col("opens") | (F.col("k") == order), F.col("n")).otherwise(F.col("kinds"))
    return grams.join(more, ["lang", "k", "gram"], "left").select("lang", "k", "gram", "context", "shorter", "n", raw.alias("raw"))


def fit(words: DataFrame, order: int = 5, most_grams: int = 100_000) -> Model | None:
    """A model from all words (lang, word, n); None without any.

    Counts, discounts (one per language and order, from its counts of one and two) and sums of contexts are over all
    n-grams. The arrays of an order hold the most frequent contexts with all their n-grams, about most_grams a language,
    by a least number of occurrences that never falls with the order, so that what an n-gram falls back on is there too.
    All others are in the table `rest`: what (2 k for n-grams, 2 k + 1 for contexts), key, at (the language's place) and
    value, an n-gram's own share of its context or a context's back-off weight.
    """
    spark = words.sparkSession
    grams = stage_table(count_grams(words, order), "langid-counts")
    shape = grams.groupBy("lang", "k").agg(F.count_if(F.col("raw") == 1).alias("ones"), F.count_if(F.col("raw") == 2).alias("twos")).collect()  # a row per language and order
    if not shape:
        return None
    symbols = grams.where("k = 1").select("gram").distinct().count()
    languages = sorted({r["lang"] for r in shape})
    discount = lambda ones, twos: min(0.95, max(0.05, ones / (ones + 2 * twos))) if ones + twos else 0.5
    per = F.broadcast(spark.createDataFrame([(r["lang"], r["k"], discount(r["ones"], r["twos"]), languages.index(r["lang"])) for r in shape], "lang string, k int, discount double, at int"))
    totals = grams.groupBy("lang", "k", "context").agg(F.sum("raw").alias("total"))
    own = grams.join(per, ["lang", "k"]).join(totals, ["lang", "k", "context"])
    own = own.select("k", "at", "gram", "context", "shorter", (F.greatest(F.col("raw") - F.col("discount"), F.lit(0.0)) / F.col("total")).alias("p"))
    heat = grams.groupBy("k", "context").agg(F.sum("n").alias("n"), F.count("*").alias("rows")).select("k", "context", F.floor(F.log2("n") * 8).cast("int").alias("bucket"), "rows")
    least, floors = 0, []
    by_bucket = heat.groupBy("k", "bucket").agg(F.sum("rows").alias("rows")).collect()  # some hundred rows
    for k in range(2, order + 1):  # there is one context of no symbols
        many = 0
        for r in sorted((r for r in by_bucket if r["k"] == k), key=lambda r: -r["bucket"]):
            many += r["rows"]
            if many > most_grams * len(languages):
                least = max(least, r["bucket"] + 1)
                break
        floors.append((k, least))
    if not least:
        return _assembled(own.toArrow(), languages, order, symbols)
    cold = heat.join(F.broadcast(spark.createDataFrame([(1, 0), *floors], "k int, least int")), "k").select("k", "context", (F.col("bucket") < F.col("least")).alias("cold"))
    own = stage_table(own.join(cold, ["k", "context"]), "langid-shares")
    model = _assembled(own.where("not cold").drop("cold").toArrow(), languages, order, symbols)
    others = own.where("cold")
    weights = others.groupBy((2 * F.col("k") + 1).alias("what"), F.col("context").alias("key"), "at").agg(F.greatest(1 - F.sum("p"), F.lit(1e-9)).alias("value"))
    model.rest = stage_path(spark, "langid-rest")
    others.select((2 * F.col("k")).alias("what"), F.col("gram").alias("key"), "at", F.col("p").alias("value")).unionByName(weights).write.parquet(model.rest)
    model.rest_bits = np.frombuffer(key_bitmap(others, "context"), np.int64)
    return model


def _windows_scored(windows: DataFrame, model: Model, sent: Broadcast) -> DataFrame:
    """window, logs of distinct windows: the languages' log2 probabilities of a window's last symbol by the whole model."""

    def ends(texts: list[str]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        last = np.cumsum(size) - 1
        place = np.zeros(int(size.sum()), np.int64)
        place[last] = size - 1
        return _hashes("".join(texts), sent.value.order), place, last

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in batches:
            hashes, place, last = ends(batch.column(0).to_pylist())
            before = _contexts(hashes)
            for k in range(2, m.order + 1):
                own = np.flatnonzero(place[last] + 1 >= k)
                own = own[in_bitmap(m.rest_bits, before[k - 1][last[own]].view(np.int64))]
                for what, hashed in ((2 * k, hashes[k - 1]), (2 * k + 1, before[k - 1])):
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(own)), pa.array(np.full(len(own), what, np.int32)), pa.array(hashed[last[own]].view(np.int64))], names=["window", "what", "key"])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in batches:
            hashes, place, last = ends(batch.column(0).to_pylist())
            p = np.exp2(m.logs_of(hashes, place, last)[0][last].astype(np.float64))
            found = batch.column(1)
            row = np.repeat(np.arange(len(p)), np.diff(found.offsets.to_numpy()))
            what, at, value = (found.flatten().field(i).to_numpy() for i in range(3))
            for k in range(2, m.order + 1):
                share, weight = np.zeros_like(p), np.ones_like(p)
                for kind, into in ((2 * k, share), (2 * k + 1, weight)):
                    into[row[what == kind], at[what == kind]] = value[what == kind]
                p = share + weight * p
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.log2(p).tolist(), pa.list_(pa.float64()))], names=["window", "logs"])

    rest = windows.sparkSession.read.schema("what int, key long, at int, value double").parquet(model.rest)
    asked = windows.mapInArrow(keys, "window string, what int, key long").join(rest, ["what", "key"], "left")
    found = asked.groupBy("window").agg(F.collect_list(F.when(F.col("at").isNotNull(), F.struct("what", "at", "value"))).alias("found"))  # orders x languages at most
    return found.mapInArrow(whole, "window string, logs array<double>")


def _assembled(kept: pa.Table, languages: list[str], order: int, symbols: int) -> Model:
    """The sorted arrays of a model from k, at (the language's place), gram, context, shorter and p, the n-gram's own
    share of its context."""
    column = {c: kept.column(c).to_numpy() for c in kept.column_names}
    column |= {c: column[c].view(np.uint64) for c in ("gram", "context", "shorter")}
    grams, logs, contexts, backs = [], [], [], []
    for k in range(1, order + 1):
        own = {c: x[column["k"] == k] for c, x in column.items()}
        gram, first, row = np.unique(own["gram"], return_index=True, return_inverse=True)
        context, of = np.unique(own["context"], return_inverse=True)
        weight, p = np.ones((len(context), len(languages))), np.zeros((len(gram), len(languages)))
        np.subtract.at(weight, (of, own["at"]), own["p"])
        weight = np.maximum(weight, 1e-9)
        p[row, own["at"]] = own["p"]
        if k == 1:
            lower = np.full((len(gram), len(languages)), 1 / symbols)
        else:
            lower = np.exp2(logs[-1][np.searchsorted(grams[-1], own["shorter"][first])].astype(np.float64))
        p += weight[of[first]] * lower
        grams.append(gram), logs.append(np.log2(p).astype(np.float32))
        contexts.append(context), backs.append(np.log2(weight).astype(np.float32))
    return Model(languages, order, grams, logs, contexts, backs, float(-np.log2(symbols)))


class Scorer:
    """Sums of texts, with the sums of tokens seen before remembered."""

    def __init__(self, model: Model, most: int = 1_000_000):
        self.model, self.most = model, most
        self.known: dict[str, int] = {}
        self.sums = np.zeros((1024, len(model.languages) + 1), np.float32)
        self.windows: dict[int, list[str]] = {}

    def _learn(self, missing: set[str]) -> None:
        new = list(missing)
        bare = [letters(t) for t in new]
        place = {w: i for i, w in enumerate(dict.fromkeys(filter(None, bare)))}
        base = len(self.known)
        if base + len(new) > len(self.sums):
            grown = np.zeros((2 * (base + len(new)), self.sums.shape[1]), np.float32)
            grown[:base] = self.sums[:base]
            self.sums = grown
        sums, windows = self.model.score(list(place))
        sums = np.concatenate([sums, np.zeros((1, sums.shape[1]))])
        self.sums[base : base + len(new)] = sums[[place.get(w, -1) for w in bare]]
        if windows:
            of: dict[int, list[str]] = {}
            for i, window in windows:
                of.setdefault(i, []).append(window)
            self.windows.update((base + i, of[place[w]]) for i, w in enumerate(bare) if w and place[w] in of)
        self.known.update(zip(new, range(base, base + len(new)), strict=True))

    def many(self, texts: list[str | None]) -> tuple[np.ndarray, list[list[str]]]:
        """For each text: the sum of log2 probabilities by language, and how many symbols: letters and word ends. And
        the windows of symbols that are counted, but not summed (see Model.score)."""
        tokens = [(t or "").lower().split() for t in texts]
        found = set().union(*tokens)
        missing = found.difference(self.known)
        if len(self.known) + len(missing) > self.most:
            self.known.clear(), self.windows.clear()
            missing = found
        if missing:
            self._learn(missing)
        get, out, windows = self.known.__getitem__, np.zeros((len(texts), self.sums.shape[1])), []
        for i, own in enumerate(tokens):
            at = np.fromiter(map(get, own), np.int64, len(own))
            out[i] = self.sums[at].sum(axis=0, dtype=np.float64)
            windows.append(list(chain.from_iterable([self.windows.get(k, ()) for k in at.tolist()])) if self.windows else [])
        return out, windows


def _posterior(bits: np.ndarray, temperature: float) -> np.ndarray:
    weight = np.exp2(-(bits - bits.min(axis=-1, keepdims=True)) * temperature)
    return weight / weight.sum(axis=-1, keepdims=True)


_scorers: dict[int, Scorer] = {}


def _texts_scored(docs: DataFrame, model: Model, text_col: str, finish: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType) -> DataFrame:
    """docs without text_col after finish, which gets batches of its other columns and `sums`: a list of the sums of a
    text's log2 probabilities by language and its number of symbols."""
    spark, rest = docs.sparkSession, [c for c in docs.columns if c != text_col]
    sent = spark.sparkContext.broadcast(model)
    key = id(sent)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _scorers:
            _scorers.clear()
        scorer = _scorers.setdefault(key, Scorer(sent.value))
        for whole in batches:
            for start in range(0, whole.num_rows, 100):
                batch = whole.slice(start, 100)
                found, windows = scorer.many(batch.column(len(rest)).to_pylist())
                columns = [*batch.columns[: len(rest)], pa.array(found.tolist(), pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(windows, pa.list_(pa.string()))], names=[*rest, "sums", "windows"])

    docs = docs.select(*rest, text_col)
    if model.rest is None:
        return docs.mapInArrow(lambda batches: finish(b.select([*range(len(rest) + 1)]) for b in sums(batches)), schema)
    kept = T.StructType([docs.schema[c] for c in rest] + T.StructType.fromDDL("sums array<double>, windows array<string>").fields)
    renamed = T.StructType([T.StructField(f"c{i}", f.dataType, f.nullable) for i, f in enumerate(kept)])  # whatever names docs has
    staged = stage_table(docs.mapInArrow(lambda batches: (b.rename_columns(renamed.names) for b in sums(batches)), renamed).withColumn("row", F.monotonically_increasing_id()), "langid-texts")
    total, windows = renamed.names[-2:]
    each = staged.select("row", F.explode(windows).alias("window"))
    logs = _windows_scored(each.select("window").distinct(), model, sent)
    more = each.join(logs, "window").groupBy("row").agg(F.array(*[F.sum(F.get("logs", F.lit(i))) for i in range(len(model.languages))]).alias("more"))
    added = F.when(F.col("more").isNull(), F.col(total)).otherwise(F.transform(total, lambda x, i: x + F.coalesce(F.get("more", i), F.lit(0.0))))
    whole = staged.join(more, "row", "left").select(*renamed.names[:-2], added.alias(total))
    return whole.mapInArrow(lambda batches: finish(b.rename_columns([*rest, "sums"]) for b in batches), schema)


def _bits(sums: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bits per symbol by language, and how many symbols. Without symbols there are none."""
    found = sums.flatten().to_numpy().reshape(len(sums), -1)
    n = np.rint(found[:, -1])
    return -found[:, :-1] / np.maximum(n, 1)[:, None], n


def train(
    docs: DataFrame, learn: Column, calibrate: int = 400, order: int = 5, most_grams: int = 100_000, accepted: float = 0.99, margin: float = 1.1,
    seed: int = 11, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
) -> Model | None:
    """A model from all rows of docs where learn holds and lang isn't null, whole texts; None if there is none.

    Of each language about `calibrate` rows, a fifth at most and never all, are drawn by a hash of the id and left out
    to calibrate: the temperature that turns cross-entropies into scores, and for each language the cross-entropy
    beyond which it is rejected, `margin` times what a share of `accepted` of its own texts stays under.
    """
    draw = F.xxhash64(F.col(id_col), F.lit(seed))
    known = docs.where(learn & F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), draw.alias("draw"))
    rows = known.groupBy("lang").agg(F.count("*").alias("n"), F.min("draw").alias("first")).collect()  # a row per language
    if not rows:
        return None
    per = docs.sparkSession.createDataFrame([(r["lang"], min(0.2, calibrate / r["n"]), r["first"]) for r in rows], "lang string, share double, first long")
    held = (F.col("draw").bitwiseAND(F.lit((1 << 31) - 1)) / float(1 << 31) < F.col("share")) & (F.col("draw") != F.col("first"))
    drawn = known.join(F.broadcast(per), "lang").select("lang", "text", held.alias("held"))
    model = fit(stage_table(count_words(drawn.where(~F.col("held"))), "langid-words"), order, most_grams)
    if model is None:
        return None

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, n = _bits(batch.column(1))
            some = pa.array(n > 0)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(some), pa.array(found.tolist(), pa.list_(pa.float64())).filter(some)], names=["lang", "bits"])

    schema = T.StructType.fromDDL("lang string, bits array<double>")
    found = _texts_scored(drawn.where("held").select("lang", "text"), model, "text", bits, schema).toPandas()  # `calibrate` rows a language
    found = found[found["lang"].isin(model.languages)]
    if len(found):
        matrix = np.stack(found["bits"].to_list())
        right = found["lang"].map(model.languages.index).to_numpy()
        loss = {t: -np.log(np.maximum(_posterior(matrix, t)[np.arange(len(right)), right], 1e-12)).mean() for t in (0.5, 1, 2, 4, 8, 16)}
        model.temperature = float(min(loss, key=loss.get))
        best = matrix.argmin(axis=1)
        for i in range(len(model.languages)):
            if len(own := matrix[(best == i) & (right == i), i]):
                model.limits[i] = float(np.quantile(own, accepted)) * margin
    return model


def predict(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """docs without text_col, and lang_pred, score (0 to 1), bits (of the language chosen), accepted.

    lang_pred is the language of lowest cross-entropy per symbol over the whole text, `und` with score 0 where the
    text is null or has no letter or where nothing was learned. accepted is false for those and where even the lowest
    cross-entropy is above its language's calibrated limit, as in languages that weren't learned. Ties go to the first language by name. Repeated rows get the same;
    other columns pass through, and those of the names above are replaced; an empty table gives an empty table.
    """
    made = ("lang_pred", "score", "bits", "accepted", text_col)
    rest = [c for c in docs.columns if c not in made]
    schema = T.StructType([docs.schema[c] for c in rest] + T.StructType.fromDDL("lang_pred string, score double, bits double, accepted boolean").fields)
    docs = docs.select(*rest, text_col)
    if model is None:
        return docs.select(*rest, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(None).cast("double").alias("bits"), F.lit(False).alias("accepted"))

    languages, temperature, limits = pa.array(model.languages, pa.string()), model.temperature, model.limits

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits, n = _bits(batch.column(len(rest)))
            rows, best, none = np.arange(len(n)), bits.argmin(axis=1), n == 0
            least, score = bits[rows, best], np.where(none, 0.0, _posterior(bits, temperature)[rows, best])
            names = pc.if_else(pa.array(none), "und", languages.take(pa.array(best)))
            made = [names, pa.array(score), pa.array(least, mask=none), pa.array(~none & (least <= limits[best]))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(rest)], *made], names=schema.names)

    return _texts_scored(docs, model, text_col, finish, schema)


def held_out(id_col: str, folds: int, fold: int) -> Column:
    """Whether the id's CRC-32 as text falls on the fold. Null ids are held out: nothing is learned from them."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == fold, F.lit(True))
