"""Neighbours, languages and quality against plain versions, by held-out accuracy and on odd tables."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from odd import documents, empty, rows, words
from pyspark.sql import functions as F

from readloom.llm import ann, langid, quality_mil


def plain_nearest(data, every, k):
    ids, x = np.array([i for i, _ in data]), np.array([v for _, v in data], np.float64)
    out = {}
    for q, v in data:
        if q % every == 0:
            score = x @ np.array(v, np.float64)
            score[ids == q] = -np.inf
            out[q] = ids[np.lexsort((ids, -np.round(score, 12)))[:k]].tolist()
    return out


def test_neighbours(spark):
    r = np.random.default_rng(3)
    centres = r.standard_normal((12, 16)) * 2
    x = (centres[r.integers(0, 12, 1500)] + 0.4 * r.standard_normal((1500, 16))).astype(np.float32)
    x[700:900] = x[700]  # ties
    data = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(2000, None), (2020, [0.0] * 16), (2040, [float("nan")] + [1.0] * 15), (2060, [float("inf")] * 16), (2080, [1.0, None] + [1.0] * 14), (2100, [1.0] * 3), (2120, []), (None, [1.0] * 16)]
    df = spark.createDataFrame(data + odd, "vec_id long, embedding array<float>").withColumn("leaf", F.lit("x")).repartition(4)
    mine = {}
    for row in ann.nearest(df, k=10).orderBy("query_id", "rank").collect():
        mine.setdefault(row["query_id"], []).append(row["vec_id"])
        assert row["rank"] == len(mine[row["query_id"]])
        assert row["score"] == pytest.approx(float(np.dot(x[row["query_id"]].astype(float), x[row["vec_id"]].astype(float))), abs=1e-9)
    asked = plain_nearest(data, 20, 10)
    assert set(mine) == set(asked) and all(len(v) == 10 for v in mine.values())
    assert sum(len(set(mine[q]) & set(asked[q])) for q in asked) >= 0.9 * 10 * len(asked)
    assert mine[720] == asked[720]  # the smallest of 200 equal ones


def test_few_neighbours(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5]), (3, [-1.0, 0.0])], "vec_id long, embedding array<float>")
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in ann.nearest(df).orderBy("rank").collect()] == [(0, 1, 1), (0, 2, 2), (0, 3, 3)]
    assert ann.nearest(df.where("false")).count() == 0 and ann.nearest(df.where("vec_id = 0")).count() == 0


def test_hot_leaves_are_searched_in_blocks(spark):
    x = np.random.default_rng(4).standard_normal((300, 8)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    index = ann.build(ann.usable(df), k=5, recall=1.0)
    found = ann.search(index, index.vectors.where("id % 3 = 0").select("id", "v"), 5, block=16).collect()
    asked = plain_nearest([(i, v.tolist()) for i, v in enumerate(x)], 3, 5)
    assert len(found) == 500 and sum(r["vec_id"] in asked[r["query_id"]] for r in found) >= 480


COUNTS = {"a": {"abba": 3, "abc": 2, "cab": 1, "a": 4, "bbbb": 1}, "b": {"bcd": 5, "dd": 1, "bd": 2, "abcd": 1}}


def fitted(spark, order, most=100_000):
    rows = [(lang, w, n) for lang, c in COUNTS.items() for w, n in c.items()]
    return langid.fit(spark.createDataFrame(rows, "lang string, word string, n long").repartition(3), order, most)


def test_kneser_ney_sums_to_one(spark):
    for most in (100_000, 4):
        model = fitted(spark, 4, most)
        for prefix in ("", "a", "ab", "abb", "bc", "dd", "cabab"):
            after = [prefix + c for c in "abcd"]
            word, place, logs = model.symbols([*after, prefix])
            last = [logs[(word == i) & (place == len(prefix) + 1)][0] for i in range(5)]
            assert np.exp2(np.array(last)).sum(axis=0) == pytest.approx([1, 1], abs=1e-4)


def plain_kneser_ney(counts, order):
    """A function of a context and a symbol, from dictionaries of n-grams; the edge is ^ before and $ after a word."""
    seen = {k: {} for k in range(1, order + 1)}
    for w, n in counts.items():
        text = "^" + w + "$"
        for end in range(2, len(text) + 1):
            for k in range(1, min(order, end) + 1):
                g = text[end - k : end]
                seen[k][g] = seen[k].get(g, 0) + n
    raw = {order: seen[order]}
    for k in range(1, order):
        kinds = {}
        for g in seen[k + 1]:
            kinds[g[1:]] = kinds.get(g[1:], 0) + 1
        raw[k] = {g: n if g[0] == "^" else kinds[g] for g, n in seen[k].items()}

    def p(context, symbol, k, symbols):
        if k == 0:
            return 1 / symbols
        if len(context) < k - 1:
            return p(context, symbol, k - 1, symbols)
        c = context[len(context) - k + 1 :]
        ones, twos = (sum(1 for n in raw[k].values() if n == x) for x in (1, 2))
        discount = min(0.95, max(0.05, ones / (ones + 2 * twos))) if ones + twos else 0.5
        own = {g: n for g, n in raw[k].items() if g[:-1] == c}
        total = sum(own.values())
        shorter = p(context, symbol, k - 1, symbols)
        return shorter if not total else max(own.get(c + symbol, 0) - discount, 0) / total + discount * len(own) / total * shorter

    return p


@pytest.mark.parametrize("order", [1, 2, 3, 5])
def test_kneser_ney_equals_the_plain_one(spark, order):
    model = fitted(spark, order)
    symbols = len(set("".join("".join(c) for c in COUNTS.values()))) + 1
    words_ = ["abba", "abc", "dcba", "zz", "a", "bcdd", "cabbage"]
    for i, lang in enumerate(model.languages):
        p = plain_kneser_ney(COUNTS[lang], order)
        word, place, logs = model.symbols(words_)
        for j, w in enumerate(words_):
            text = "^" + w + "$"
            asked = [np.log2(p(text[:end], text[end], order, symbols)) for end in range(1, len(text))]
            assert logs[(word == j) & (place > 0)][:, i] == pytest.approx(asked, abs=1e-4)


@pytest.mark.parametrize("most", [1, 4, 8])
def test_texts_are_scored_by_all_grams_whatever_the_arrays_hold(spark, most):
    order, r = 4, random.Random(5)
    texts = ["".join(r.choices("abcdz", k=r.randint(1, 9))) + " " + " ".join(r.choices([*COUNTS["a"], *COUNTS["b"]], k=3)) for _ in range(60)] + [None, "12 -", "Abba, ABBA!", "abba abba"]
    docs = spark.createDataFrame(list(enumerate(texts)), "sums long, text string").repartition(3)
    whole, small = fitted(spark, order), fitted(spark, order, most)
    assert whole.rest is None and small.rest and sum(map(len, small.grams)) < sum(map(len, whole.grams))
    asked, found = [{x["sums"]: x for x in langid.predict(docs, m).collect()} for m in (whole, small)]
    assert len(asked) == len(found) == len(texts)
    symbols, p = len(set("".join("".join(c) for c in COUNTS.values()))) + 1, [plain_kneser_ney(COUNTS[x], order) for x in whole.languages]
    for i, text in enumerate(texts):
        words_ = [w for w in (langid.letters(t) for t in (text or "").lower().split()) if w]
        assert found[i]["lang_pred"] == asked[i]["lang_pred"] and found[i]["accepted"] == asked[i]["accepted"] == bool(words_)
        if words_:
            logs = [[np.log2(q(f"^{w}$"[:end], f"^{w}$"[end], order, symbols)) for w in words_ for end in range(1, len(w) + 2)] for q in p]
            assert [found[i]["bits"], asked[i]["bits"]] == pytest.approx([min(-np.mean(x) for x in logs)] * 2, abs=1e-4)
            assert found[i]["score"] == pytest.approx(asked[i]["score"], abs=1e-4)


def test_words_of_many_texts_are_scored_at_once(spark):
    model = fitted(spark, 4)
    texts, calls, keep = ["abba, cab", None, "", "dd 12 Cab", "abba! zz"] * 20, [], model.score
    one = [langid.Scorer(model).many([t])[0][0] for t in texts]
    model.score = lambda words_: calls.append(words_) or keep(words_)
    for most in (1_000_000, 4):
        calls.clear()
        scorer = langid.Scorer(model, most)
        assert np.array([x for a in range(0, 100, 50) for x in scorer.many(texts[a : a + 50])[0]]) == pytest.approx(np.array(one), abs=1e-4)
        assert [sorted(c) for c in calls] == [["abba", "cab", "dd", "zz"]] * (1 if most > 4 else 2)


def test_all_words_of_all_rows_are_counted(spark):
    texts = [("a", "Ab ab, c1d"), ("a", "AB"), ("b", "ab 12 --"), ("b", None), ("a", "")]
    found = langid.count_words(spark.createDataFrame(texts, "lang string, text string").repartition(2), most=1).collect()
    assert {(r["lang"], r["word"]): r["n"] for r in found} == {("a", "ab"): 3, ("a", "cd"): 1, ("b", "ab"): 1}


def test_unlearned_languages_are_rejected(spark):
    r = random.Random(17)
    make = lambda letters, n: " ".join("".join(r.choices(letters, k=r.randint(2, 7))) for _ in range(n))
    learned = {"one": "aeioulmn", "two": "zxkwqtrsa"}
    docs = [(i, make(learned[lang], 80), lang) for i in range(400) for lang in [("one", "two")[i % 2]]]
    model = langid.train(spark.createDataFrame(docs, "doc_id long, text string, lang string"), F.lit(True), order=3)
    new = [(i, make(letters, 80)) for letters in (*learned.values(), "bdfghjpvy", "жзийклмн") for i in range(30)]
    found = langid.predict(spark.createDataFrame(new, "doc_id long, text string"), model).collect()
    accepted = [sum(x["accepted"] for x in found[k : k + 30]) for k in range(0, 120, 30)]
    assert min(accepted[:2]) >= 28 and accepted[2:] == [0, 0]
    one = spark.createDataFrame([(1, "only one row", "solo"), *[(i, make("abc", 30), "more") for i in range(2, 40)]], "doc_id long, text string, lang string")
    assert langid.train(one, F.lit(True)).languages == ["more", "solo"]


def test_languages(spark):
    r = random.Random(7)
    make = lambda letters, n: " ".join("".join(r.choices(letters, k=r.randint(2, 7))) for _ in range(n))
    docs = [(i, make(*(("aeioulmn", 60) if i % 2 else ("zxkwqtrs", 60))), "vow" if i % 2 else "con") for i in range(200)]
    other = documents(spark, extra=False).select((F.col("doc_id") + 1000).alias("doc_id"), "text", F.lit(None).cast("string").alias("lang"))
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string").unionByName(other).withColumns({c: F.lit("old") for c in ("score", "bits", "accepted", "lang_pred")})
    held = langid.held_out("doc_id", 4, 2)
    model = langid.train(df, ~held)
    found = langid.predict(df.withColumn("held", held), model).collect()
    assert len(found) == 200 + len(rows()) and all(0 <= x["score"] <= 1 for x in found)
    assert all(x["lang_pred"] == x["lang"] for x in found if x["doc_id"] is not None and x["doc_id"] < 200)
    has_letter = {i + 1000: any(c.isalpha() for c in t or "") for i, t, *_ in rows()[:15]}
    assert all((x["lang_pred"] == "und") != has_letter[x["doc_id"]] for x in found if x["doc_id"] in has_letter)
    assert all(x["held"] == (x["doc_id"] is None or zlib.crc32(str(x["doc_id"]).encode()) % 4 == 2) for x in found)
    assert langid.train(df, F.lit(False)) is None and langid.predict(df.limit(3), None).first()["lang_pred"] == "und"
    assert langid.predict(empty(spark), model).count() == 0


def test_quality(spark):
    r = random.Random(8)
    docs = [(i, words(120, i) if i % 2 else " ".join(w + r.choice(["***", "%%%"]) for w in words(120, i).split())) for i in range(160)]
    other = documents(spark, extra=False).select((F.col("doc_id") + 1000).alias("doc_id"), "text")
    df = spark.createDataFrame(docs, "doc_id long, text string").unionByName(other).withColumn("score", F.lit("old"))
    labels = spark.createDataFrame([(i, i % 2) for i in range(100)] + [(1000, None), (1001, 1), (1001, 1), (None, 0)], "doc_id long, quality int")
    model = quality_mil.train(df, quality_mil.learn_from(labels))
    found = quality_mil.predict(df, model, keep_text=True).collect()
    assert len(found) == 160 + len(rows()) and all(0 <= x["score"] <= 1 and x["predicted"] == (x["score"] >= 0.3) for x in found)
    assert all(x["predicted"] == x["doc_id"] % 2 and x["text"] == docs[x["doc_id"]][1] for x in found if x["doc_id"] is not None and x["doc_id"] < 160)
    assert quality_mil.train(df, labels.where("false")) is None
    assert {x["score"] for x in quality_mil.predict(df, None).collect()} == {0.5}
    assert quality_mil.predict(empty(spark), model).count() == 0


def test_attention_learns():
    r = np.random.default_rng(1)
    x, many, y = r.standard_normal((9, 5)).astype(np.float32), np.array([2, 3, 4]), np.array([1, 0, 1])
    model = quality_mil.Model(features=5, hidden=8, gates=3)
    before = np.abs(model.score(x, many) - y).mean()
    model.fit(x, many, y, epochs=200)
    assert np.abs(model.score(x, many) - y).mean() < 0.1 < before
    assert model.score(x[:2], many[:1]) == pytest.approx(model.score(x, many)[:1], abs=1e-5)


def test_attention_equals_plain_loops():
    r = np.random.default_rng(2)
    x, many, y, weight = r.standard_normal((9, 5)).astype(np.float32), np.array([2, 3, 4]), np.array([1, 0, 1]), np.array([0.5, 1.0, 2.0])
    model = quality_mil.Model(features=5, hidden=6, gates=3, seed=1)
    model.p = {k: v.astype(np.float64) + 0.1 * r.standard_normal(v.shape) for k, v in model.p.items()}

    def plain(p):
        out, at = [], 0
        for n in many:
            h = [np.maximum(np.array([sum(v[i] * p["W"][i, j] for i in range(5)) + p["bW"][j] for j in range(6)]), 0) for v in x[at : at + n]]
            e = [sum(p["w"][g] * np.tanh(u @ p["V"][:, g] + p["bV"][g]) / (1 + np.exp(-(u @ p["U"][:, g] + p["bU"][g]))) for g in range(3)) for u in h]
            a = np.exp(e) / np.exp(e).sum()
            out.append(1 / (1 + np.exp(-(sum(w * u for w, u in zip(a, h)) @ p["c"] + p["b"][0]))))
            at += n
        return np.array(out)

    assert model.score(x, many) == pytest.approx(plain(model.p), abs=1e-6)
    loss = lambda p: float(-(weight * (y * np.log(plain(p)) + (1 - y) * np.log(1 - plain(p)))).sum())
    grad = model.gradient(x, many, y, weight)
    for name, value in model.p.items():
        for at in [tuple(r.integers(0, n) for n in value.shape) for _ in range(4)]:
            step = np.zeros_like(value)
            step[at] = 1e-5
            slope = (loss(model.p | {name: value + step}) - loss(model.p | {name: value - step})) / 2e-5
            assert grad[name][at] == pytest.approx(slope, abs=1e-4), name


def test_labels_are_drawn_of_documents_that_are_there(spark, monkeypatch):
    docs = spark.createDataFrame([(i, words(5 + 40 * (i % 3), i)) for i in range(30)] + [(3, words(5, 3))] * 4, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20_000)], "doc_id long, quality int")
    held = []
    fit = quality_mil.Model.fit_batches
    monkeypatch.setattr(quality_mil.Model, "fit_batches", lambda self, batches: held.append([(len(m), int(t.sum())) for _, m, _, t in (b() for b in batches)]) or fit(self, batches, steps=1, rounds=1))
    quality_mil.train(docs, labels, sample_rows=100)
    quality_mil.train(docs, labels, sample_rows=7)
    quality_mil.train(docs, labels, batch_bytes=600)
    assert held[0] == [(30, 34)] and held[1][0][0] == 7
    assert len(held[2]) > 3 and tuple(map(sum, zip(*held[2], strict=True))) == (30, 34)


def test_batches_learn_like_one():
    r = np.random.default_rng(4)
    many = r.integers(1, 5, 60)
    y = r.integers(0, 2, 60)
    x = r.random((int(many.sum()), 6)).astype(np.float32)
    x[:, 2] += np.repeat(y, many)
    ends = np.cumsum(many)
    models = [quality_mil.Model(features=6, hidden=8, gates=3) for _ in range(2)]
    models[0].fit(x, many, y)
    part = lambda i: lambda: (x[(0, ends[29])[i] : (ends[29], None)[i]], many[i * 30 : i * 30 + 30], y[i * 30 : i * 30 + 30], np.ones(30))
    models[1].fit_batches([part(0), part(1)])
    assert np.allclose(models[0].mean, models[1].mean, atol=1e-6) and np.allclose(models[0].scale, models[1].scale, atol=1e-6)
    assert all(((m.score(x, many) >= 0.5) == y).mean() > 0.95 for m in models)


def test_passages_equal_plain_counts():
    texts = [b"", b"a", b" ", b"x" * 64, b"y" * 65, (b"the same words of a line, again and again\n" * 5), "\u00dc b".encode() * 40, bytes(range(32, 127)) * 3]
    x, many = quality_mil.encode_passages(texts, 64)
    assert many.tolist() == [max(1, -(-len(t) // 64)) for t in texts]
    row = 0
    for t in texts:
        kinds = quality_mil._KIND[list(t)].tolist() if t else []
        begins = [i for i in range(len(t) - 15) if kinds[i] not in (3, 4) and (i == 0 or kinds[i - 1] in (3, 4))]
        heads = [t[i : i + 16] for i in begins]
        for at in range(0, max(1, len(t)), 64):
            piece = range(at, min(at + 64, len(t)))
            pairs = np.zeros(quality_mil._KINDS**2)
            for i in piece:
                pairs[kinds[i] * quality_mil._KINDS + (kinds[i + 1] if i + 1 < len(t) else 4)] += 1
            own = [heads.count(h) > 1 for i, h in zip(begins, heads, strict=True) if i in piece]
            asked = [*np.sqrt(pairs / max(1, len(piece))), sum(own) / max(1, len(own)), np.log1p(len(piece)) / np.log1p(64)]
            assert x[row] == pytest.approx(asked, abs=1e-6)
            row += 1
    assert row == len(x)
