"""Suffix-array dedup and SimHash against brute force and on odd tables."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from odd import documents, empty, rows, words
from pyspark.sql import functions as F

from readloom.llm import simhash, suffix_dedup
from readloom.llm.common import in_bitmap, key_bitmap


def plain_repeats(texts, length):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((len(t), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def repeated_texts(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choices("abé", k=r.randint(1, 6)))
    passages = [" ".join(word() for _ in range(r.randint(5, 40))) for _ in range(6)]
    texts = [" ".join(r.choice([word(), word(), r.choice(passages)]) for _ in range(r.randint(0, 40))) for _ in range(60)]
    return texts + [t[: len(t) // 2] + "x" + t[len(t) // 2 :] for t in texts[:20]] + texts[:5] + ["a" * 90, "a" * 50, "ab" * 70, "\0" * 45 + "q", "\0" * 60, ""]


@pytest.mark.parametrize(("seed", "limit"), [(1, 4096), (2, 4096), (3, 1), (4, 3)])
def test_suffix_dedup_equals_brute_force(spark, seed, limit):
    texts = repeated_texts(seed)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    found = suffix_dedup.remove_repeats(df, length=40, anchor=16, together=limit, bits=1 << 12, kept="sha256").collect()
    asked = plain_repeats([t.encode() for t in texts], 40)
    assert len(found) == len(texts)
    for r in found:
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == asked[r["doc_id"]], r["doc_id"]


def test_suffix_dedup_of_odd_documents(spark):
    found = suffix_dedup.remove_repeats(documents(spark), kept="text").collect()
    asked = Counter((r[0], *x) for r, x in zip(rows(), plain_repeats([(r[1] or "").encode() for r in rows()], 200)))
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"].encode()).hexdigest()) for r in found) == asked
    assert {r["place"] for r in found} == {"old place"} and suffix_dedup.remove_repeats(empty(spark)).count() == 0


def test_long_documents_come_in_parts(monkeypatch):
    r = random.Random(5)
    data = np.frombuffer("".join(r.choices("ab", k=5000)).encode() + b"a" * 300, np.uint8)
    whole = [np.concatenate(x) for x in zip(*suffix_dedup.anchors(data, np.array([0, len(data)]), 60, 20))]
    monkeypatch.setattr(suffix_dedup, "_CHUNK", 64)
    parts = [np.concatenate(x) for x in zip(*suffix_dedup.anchors(data, np.array([0, len(data)]), 60, 20))]
    assert all((a == b).all() for a, b in zip(whole, parts))


def test_repeated_rows_cost_in_proportion(spark):
    """2000 rows of one id and text, 2000 of one text under ids of their own, and null ids."""
    from time import time

    one, two, three = words(600, 21), words(600, 22), words(400, 23)
    data = [(1, one)] * 2000 + [(i, two) for i in range(2, 2002)] + [(None, three)] * 300 + [(1, words(100, 24)), (1, one[:400] + words(60, 25))]
    began = time()
    found = suffix_dedup.remove_repeats(spark.createDataFrame(data, "doc_id long, text string").repartition(4), kept="text")
    per = Counter((r["n_bytes"], r["n_removed"], r["n_spans"]) for r in found.select("n_bytes", "n_removed", "n_spans").collect())
    n = lambda t: len(t.encode())
    last = data[-1][1]
    assert per == {(n(one), n(one), 1): 2000, (n(two), n(two), 1): 2000, (n(three), n(three), 1): 300, (n(data[-2][1]), 0, 0): 1, (n(last), 400, 1): 1}
    assert time() - began < 60


def test_a_hot_anchor_is_split(spark):
    """One anchor in 400 different surroundings, of which some share up to 60 bytes on one side or both."""
    r = random.Random(8)
    letters = lambda n: "".join(r.choices("abcdefgh", k=n))
    core, left, right = letters(30), [letters(30) for _ in range(5)], [letters(30) for _ in range(5)]
    texts = [letters(r.randint(0, 9)) + r.choice(left)[r.randint(0, 29) :] + core + r.choice(right)[: r.randint(0, 30)] + letters(r.randint(0, 9)) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    asked = plain_repeats([t.encode() for t in texts], 40)
    for together in (2, 64):
        found = suffix_dedup.remove_repeats(df, length=40, anchor=16, together=together, bits=1 << 12, kept="sha256").collect()
        assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in found} == dict(enumerate(asked))


def test_the_session_is_left_as_it_was(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    suffix_dedup.remove_repeats(spark.createDataFrame([(1, "a")], "doc_id long, text string"))
    assert spark.conf.get(name) == before


def test_deep_shallow_order():
    r = random.Random(6)
    stem = bytes(r.choices(b"ab", k=90))
    strings = sorted({stem[: r.randint(0, 90)] + bytes(r.choices(b"ab\0", k=r.randint(0, 30))) for _ in range(300)}) * 2
    r.shuffle(strings)
    width = 128
    matrix = np.frombuffer(b"".join(s.ljust(width, b"\0") for s in strings), np.uint8).reshape(-1, width)
    sizes, group = np.array([len(s) for s in strings]), np.array([r.randint(0, 3) for _ in strings])
    order, common = suffix_dedup.deep_shallow(matrix, sizes, group)
    key = lambda i: (group[i], strings[i].ljust(width, b"\0"))
    assert [key(i) for i in order] == sorted(key(i) for i in range(len(strings)))
    for a, b, c in zip(order, order[1:], common[1:]):
        n = next((k for k, (x, y) in enumerate(zip(strings[a], strings[b])) if x != y), min(sizes[a], sizes[b]))
        assert c == (n if group[a] == group[b] else -1)
    keys = [bytes(r.choices(b"ab", k=12)) for _ in range(200)]
    assert [keys[i] for i in suffix_dedup.blind_trie_order(keys)] == sorted(keys)


def plain_components(pairs):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {x: find(x) for x in root}


def test_fingerprint():
    import xxhash

    for text in ["", None, " \n", "One", "a B c", "x y z x y z", words(50, 1), "É è A"]:
        w = re.sub("[A-Z]", lambda m: m[0].lower(), text or "").encode().split()
        grams = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
        h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        assert simhash.fingerprint(text) == sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize(("most", "bucket"), [(2, 1024), (2, 2), (1, 1024), (3, 4)])
def test_links_connect_what_is_near(spark, most, bucket):
    r = random.Random(most)
    base = [r.getrandbits(64) for _ in range(12)]
    prints = set(base)
    for b in base:
        for _ in range(25):
            for _ in range(r.randint(1, 3)):
                b ^= 1 << r.randrange(64)
            prints.add(b)
    prints |= {base[0] ^ (1 << i) for i in range(64)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    found = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long"), most, bucket).collect()
    near = [(a, b) for a in signed for b in signed if a < b and ((a ^ b) & ((1 << 64) - 1)).bit_count() <= most]
    joined = plain_components(near)
    assert all(joined.get(a) == joined.get(b) is not None for a, b in found)
    assert plain_components(map(tuple, found)) == joined


def test_components(spark):
    r = random.Random(9)
    edges = [(i, i + 1) for i in range(100, 160)] + [(r.randint(0, 60), r.randint(0, 60)) for _ in range(45)] + [(500, i) for i in range(600, 700)] + [(7, 7)]
    found = {x["node"]: x["root"] for x in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == plain_components([e for e in edges if e[0] != e[1]])
    assert simhash.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates_of_odd_documents(spark):
    found = simhash.near_duplicates(documents(spark)).collect()
    prints = [(r[0], simhash.fingerprint(r[1])) for r in rows()]
    distinct = sorted({p for _, p in prints})
    root = plain_components([(a, b) for a in distinct for b in distinct if (a ^ b).bit_count() <= 2])
    least = {}
    for i, p in prints:
        if i is not None:
            least[root[p]] = min(i, least.get(root[p], i))
    assert Counter((r["doc_id"], r["fp"] & ((1 << 64) - 1), r["component_id"]) for r in found) == Counter((i, p, least.get(root[p])) for i, p in prints)
    assert simhash.near_duplicates(empty(spark)).count() == 0


def test_pipeline_keeps_one_row_of_each_group(spark):
    found = corpus_pipeline.simhash_near_dedup(spark, documents(spark, extra=False), "").collect()
    clean = [(7, words(90, 11), "en", "s1", 1), (7, words(90, 12), "de", "s0", 2), (7, words(90, 12), "de", "s0", 1)]
    every = [*rows(), *clean]
    more = spark.createDataFrame(clean, documents(spark, extra=False).schema)
    for out, source in ((found, rows()), (corpus_pipeline.simhash_near_dedup(spark, documents(spark, extra=False).unionByName(more), "").collect(), every)):
        prints = sorted({simhash.fingerprint(r[1]) for r in source})
        root = {p: p for p in prints} | plain_components([(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 2])
        least = {}
        for r in source:
            k = root[simhash.fingerprint(r[1])]
            least[k] = min(least.get(k, (True, 0)), (r[0] is None, r[0] or 0))
        assert Counter((root[simhash.fingerprint(r["text"])], (r["doc_id"] is None, r["doc_id"] or 0)) for r in out) == Counter(least.items())
        assert not Counter(map(tuple, out)) - Counter(source)
    assert (7, words(90, 9)) in [(r["doc_id"], r["text"]) for r in found]
    assert {clean[0], clean[2]} <= set(map(tuple, out)) and clean[1] not in set(map(tuple, out))


def test_bitmap(spark):
    keys = spark.range(1000).select(F.xxhash64("id").alias("k"))
    bits = np.frombuffer(key_bitmap(keys, "k", 1 << 16), np.int64)
    assert in_bitmap(bits, np.array([r["k"] for r in keys.collect()])).all()
    others = np.array([r["k"] for r in spark.range(5000, 9000).select(F.xxhash64("id").alias("k")).collect()])
    assert in_bitmap(bits, others).mean() < 0.05
