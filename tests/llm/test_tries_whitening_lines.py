"""Conversation tries, whitening and repeated lines against plain versions and on odd tables."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import DATA
from odd import documents, empty, rows, words
from pyspark.sql import functions as F

from readloom.llm import conversations, line_dedup, queries, whitening

# --- conversations


def plain_trie(turns, rebuild=True):
    own = defaultdict(list)
    for c, turn, role, text in turns:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    whole = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6 if rebuild else 0
        whole[c] = own.get(c - c % 100 if c >= 0 else c + -c % 100, [])[:h] + ts[h:]
    members, kids = defaultdict(list), defaultdict(set)
    for c in sorted(whole):
        for d in range(len(whole[c]) + 1):
            members[tuple(whole[c][:d])].append(c)
            if d:
                kids[tuple(whole[c][: d - 1])].add(tuple(whole[c][:d]))
    leaves, saved = {}, {}
    for k in sorted(members, key=len, reverse=True):
        own_saving = (len(members[k]) - 1) * len(k[-1][1]) if k else 0
        leaves[k] = sum(leaves[x] for x in kids[k]) or 1
        saved[k] = own_saving + sum(saved[x] for x in kids[k])
    ends = lambda k: ",".join(str(c) for c in members[k] if len(whole[c]) == len(k))
    return Counter((members[k][0], len(k), members[k[:-1]][0] if k else None, len(members[k]), len(kids[k]), leaves[k], saved[k], hashlib.sha256(ends(k).encode()).hexdigest()) for k in members)


TURNS = "conv_id long, turn long, role string, text string"
NODE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def trie_rows(df):
    return Counter(tuple(r) for r in df.select(*NODE).collect())


def odd_turns():
    r, out = random.Random(4), []
    for c in [*range(0, 230), -7, -100, -101, 100_000, 100_001]:
        for t in range(r.choice((0, 1, 2, 3, 7, 9))):
            out.append((c, r.choice((t, t, None)), r.choice(("user", "assistant", None, "")), r.choice((None, "", "a", "ab", "Ü𝄞", words(3, t)))))
    copy = [(t, "user", words(4, t)) for t in range(40)]
    out += [(c, *x) for c in range(1000, 1060) for x in copy]  # copies of one conversation
    out += [(c, *x) for c in range(1100, 1130) for x in copy[: c - 1100]]  # its beginnings
    out += [(5000, t, "user", str(t % 3)) for t in range(3000)]  # one conversation with most turns
    return out + out[:9] + [(None, 1, "user", "no conversation")]


@pytest.mark.parametrize("shard", [7, 1 << 20])
def test_trie(spark, shard):
    df = spark.createDataFrame(odd_turns(), TURNS).withColumn("depth", F.lit("clash")).withColumn("k0", F.lit(0)).repartition(5)
    rebuilt = conversations.with_heads(conversations.ordered_turns(df))
    assert trie_rows(conversations.prefix_trie(rebuilt, shard)) == plain_trie(odd_turns())


def test_trie_of_conversations_as_they_are(spark):
    df = spark.createDataFrame(odd_turns(), TURNS)
    assert trie_rows(conversations.prefix_trie(conversations.marked(conversations.ordered_turns(df)), 64)) == plain_trie(odd_turns(), rebuild=False)
    assert conversations.prefix_trie(conversations.with_heads(conversations.ordered_turns(df.where("false")))).count() == 0
    assert conversations.prefix_trie(conversations.with_heads(conversations.ordered_turns(df.where("conv_id is null")))).count() == 0


def test_findclose():
    r = np.random.default_rng(1)
    for n in (1, 2, 63, 64, 65, 3000):
        depth = np.zeros(n, np.int64)
        depth[0] = r.integers(0, 9)
        for i in range(1, n):
            depth[i] = r.integers(max(0, depth[i - 1] - 3), depth[i - 1] + 2)
        p = conversations.Parentheses(depth)
        stack, close = [], {}
        for i, b in enumerate(p.bits):
            if b:
                stack.append(i)
            else:
                close[stack.pop()] = i
        assert not stack and p.findclose(p.open).tolist() == [close[i] for i in p.open.tolist()]


# --- whitening


@pytest.mark.parametrize("name", ["random", "graded", "equal", "rank", "few", "blocks"])
def test_principal(name):
    r = np.random.default_rng(3)
    q = np.linalg.qr(r.standard_normal((24, 24)))[0]
    x = {
        "random": r.standard_normal((90, 24)), "graded": r.standard_normal((90, 24)) * np.logspace(0, -5, 24), "equal": np.diag([5.0] * 9 + [3.0] * 9 + [1.0] * 6) @ q,
        "rank": np.diag([5.0] * 4 + [0.0] * 20) @ q, "few": r.standard_normal((5, 24)), "blocks": np.kron(np.eye(8), r.standard_normal((4, 3))),
    }[name]
    a = np.linalg.qr(x, mode="r")
    v, squares, total = whitening.principal(a, 16)
    true = np.linalg.svd(a, compute_uv=False) ** 2
    assert len(squares) == min(16, int((true > 1e-20).sum())) and np.allclose(squares, true[: len(squares)], rtol=1e-9)
    assert np.allclose(v.T @ v, np.eye(len(squares)), atol=1e-11) and np.allclose(x.T @ (x @ v), v * squares, atol=1e-9 * true[0]) and np.isclose(total, true.sum())


def test_whitening_of_a_table(spark):
    data = spark.read.parquet(f"{DATA}/embeddings.parquet").toPandas()
    good = data[data.embedding.map(lambda v: v is not None and bool(np.isfinite(np.array(v, float)).all()))]
    x = np.floor(np.stack(good.embedding).astype(np.float64) * 64).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    c = fit - sums / n
    e, v = np.linalg.eigh(c.T @ c / n)
    e, v = e[::-1], v[:, ::-1][:, :16]
    found = queries.op12_embedding_whitening(spark, DATA).toPandas()
    assert len(found) == 16 * len(good) and (found.n == n).all()
    assert (found.deviation == found.vec_id.map(dict(zip(good.vec_id, ((n * x - sums) ** 2).sum(axis=1), strict=True)))).all()
    assert found.identity_error.nunique() == 1 and found.identity_error[0] < 1e-9
    explained = found.drop_duplicates("component").sort_values("component").explained
    assert np.allclose(explained, e[:16] / e.sum(), rtol=1e-9)
    got = found.pivot(index="vec_id", columns="component", values="whitened").loc[good.vec_id].to_numpy()
    asked = (x - sums / n) @ v / np.sqrt(e[:16])
    assert np.allclose(got * np.sign((got * asked).sum(axis=0)), asked, atol=1e-7)


def test_whitening_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    odd = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [3.0, -4.0]), (3, [1e300, 0.0]), (4, None), (5, [1.0, None]), (6, [nan, 1.0]), (7, [-inf, 1.0]), (8, []), (9, [1.0, 2.0, 3.0]), (None, [0.5, 0.25])]
    df = spark.createDataFrame(odd, "vec_id long, embedding array<double>").withColumn("whitened", F.lit("old")).withColumn("other", F.lit("kept"))
    vectors = df.withColumn("x", whitening.whole_vectors(F.col("embedding")))
    model = whitening.fit(vectors)
    out = whitening.whiten(vectors, model).collect()
    assert sorted((r["vec_id"] or -1) for r in out) == [-1, 1, 1, 2, 3] and model.n == 4 and {r["other"] for r in out} == {"kept"}
    assert [r["deviation"] for r in out if r["vec_id"] == 3] == [None]  # it fits no 64-bit number
    whole = [r["deviation"] for r in whitening.whiten(vectors.where("vec_id in (1, 2)"), whitening.fit(vectors.where("vec_id in (1, 2)"))).collect()]
    assert len(whole) == 3 and set(whole) == {128**2 + 384**2}
    same = vectors.where("vec_id = 1")
    model = whitening.fit(same)
    assert model.n == 1 and [(r["whitened"], r["deviation"]) for r in whitening.whiten(same, model).collect()] == [([], 0)] * 2
    assert whitening.fit(vectors.where("false")) is None and whitening.whiten(vectors, None).count() == 0
    assert queries.op12_embedding_whitening(spark, DATA).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


# --- lines


def plain_lines(table, least_chars=40, least_docs=5):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(lower)
    holders = defaultdict(list)
    for i, (_, text) in enumerate(table):
        for k in {key(x) for x in (text or "").split("\n")}:
            holders[k].append(i)
    low = lambda i: -(1 << 63) if table[i][0] is None else table[i][0]
    many = {k: max(map(low, h)) for k, h in holders.items() if len(k) >= least_chars and len(h) >= least_docs}
    out = []
    for i, (doc, text) in enumerate(table):
        lines = (text or "").split("\n")
        stay = [x for x in lines if not (key(x) in many and low(i) < many[key(x)])]
        out.append((doc, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return Counter(out)


def line_rows(df):
    return Counter((r["doc_id"], r["n_lines"], r["n_dropped"], bytes(r["kept"]).decode()) for r in df.collect())


def odd_lines():
    r = random.Random(8)
    common = [words(12, i)[:60].ljust(40, "x") for i in range(8)] + ["Ü" * 40, "Ü" * 39, "a" * 39, "a" * 40, "𝄞" * 10]
    out = [(x[0], x[1]) for x in rows()]
    for i in range(300):
        lines = [r.choice(("", " ", "\t", "\x0b")) + (x.upper() if r.random() < 0.3 else x) + r.choice(("", "\r", " ")) for x in r.sample(common, r.randint(0, 4))]
        lines += [words(9, 1000 + r.randint(0, 120)) for _ in range(r.randint(0, 4))]
        r.shuffle(lines)
        out.append((r.choice((i, i, i, 7, None)), "\n".join(lines)))
    every = common[0]
    return out + [(1000 + i, every + "\n" + every.upper() + "\n") for i in range(200)] + out[-3:]


@pytest.mark.parametrize("most_bits", [1 << 28, 1 << 8])
def test_lines(spark, most_bits):
    table = odd_lines()
    df = spark.createDataFrame(table, "doc_id long, text string").withColumns({c: F.lit(f"old {c}") for c in ("kept", "row", "doc", "k1", "gone", "keys", "n_lines")}).repartition(6)
    found = line_dedup.drop_repeated_lines(df, most_bits=most_bits)
    assert line_rows(found) == plain_lines(table) and {r["gone"] for r in found.select("gone").distinct().collect()} == {"old gone"}


@pytest.mark.parametrize("least", [1, 2, 9])
def test_lines_of_other_bounds(spark, least):
    table = odd_lines()
    df = spark.createDataFrame(table, "doc_id long, text string").repartition(3)
    assert line_rows(line_dedup.drop_repeated_lines(df, 8, least)) == plain_lines(table, 8, least)


def test_lines_of_odd_documents(spark):
    found = line_dedup.drop_repeated_lines(documents(spark), 2, 2)
    assert line_rows(found) == plain_lines([(r[0], r[1]) for r in rows()], 2, 2)
    assert line_dedup.drop_repeated_lines(empty(spark)).count() == 0


def test_twice_seen_lacks_no_line_of_two_documents():
    r = np.random.default_rng(2)
    keys = r.integers(0, 1 << 63, 5000).astype(np.uint64)
    seen = line_dedup.Seen(1 << 16)
    for part in np.array_split(np.concatenate([keys, keys[:900]]), 7):
        seen.add(part)
    assert line_dedup.has(seen.twice, keys[:900]).all() and line_dedup.has(seen.twice, keys[900:]).mean() < 0.2
