"""Packing and archives against plain versions and on odd tables."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from odd import documents, empty, rows
from pyspark.sql import functions as F

from readloom.llm import packing, warc
from readloom.llm.common import stage_path


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_encoder_equals_the_tokenizer(tokenizer):
    import public_tokenizers

    encode = packing.CachedEncoder(public_tokenizers.path("byte_bpe_50k.json"), most=50)
    r = random.Random(1)
    some = ["a", " ", "  ", "\n", "\n\n", "b,", "don't", "'S", "\t", "　", "\x1c", "\x85", "é", "12", "!!", "<|endoftext|>", "日本", "x" * 60, "Ġ", " "]
    texts = ["", " ", "a b c", "end ", " begin", "a\nb c\n"] + ["".join(r.choices(some, k=r.randint(1, 12))) for _ in range(600)]
    texts += [" ".join(r.choices(["a", "b,", "don't", "é", "x" * 60, "foo\nbar", "12", "Ġ"], k=20)) for _ in range(50)]
    for t in texts:
        assert encode(t) == np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes(), repr(t)


def test_encoder_learns_words_once_for_many_texts(tokenizer):
    import public_tokenizers

    r = random.Random(2)
    some = ["word", "word.", "Word,", ".", "\n", "?!", "a.b", "é.", "don't.", "x" * 60 + ".", "12;", "foo\n\nbar", "\nWord", "end.\nWord.", "...", "S", "'s."]
    texts = ["", "\n", ".\nWord", "\n\nWord a", "word\n", "x.\n.\n!", "a\n\nb c"] + ["".join(x + r.choice([" ", " ", " ", "\n", ""]) for x in r.choices(some, k=r.randint(1, 12))) for _ in range(800)]
    asked = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    for most in (20, 100_000):
        encode = packing.CachedEncoder(public_tokenizers.path("byte_bpe_50k.json"), most)
        assert [x for a in range(0, len(texts), 60) for x in encode.many(texts[a : a + 60])] == asked
        assert max(map(len, encode.known)) <= encode.longest
    learned, keep = [], encode._encode
    encode._encode = lambda keys, begins: learned.extend(keys) or keep(keys, begins)
    encode.many(["a Newword b", "a Newword, b", "a Newword.\nOther b", "a\nNewword. b"])
    assert {k for k in learned if "w" in k} == {"Newword", "\nNewword"} and len(learned) == len(set(learned))


def bins_of(found, capacity):
    bins = {}
    for r in found:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in bins.values():
        own.sort()
        assert [o for o, _ in own] == [0, *np.cumsum([n for _, n in own])[:-1]] and sum(n for _, n in own) <= capacity
    return bins


def test_packing_of_odd_documents(spark, tokenizer):
    found = packing.pack_documents(documents(spark)).collect()
    asked = Counter()
    for d, t, *_ in rows():
        x = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        n = len(x)
        cuts = [0, n] if n <= 2048 else [0, *range(n % 2048 or 2048, n + 1, 2048)]
        asked.update((d, k, a, b - a, zlib.crc32(x[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:])))
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == asked
    assert len(bins_of(found, 2048)) <= -(-sum(r["length"] for r in found) // 2048) + 1
    assert packing.pack_documents(empty(spark)).count() == 0


def test_packing_in_rounds_is_tight(spark):
    r = random.Random(2)
    lengths = [r.choice([r.randint(1, 64), r.randint(1, 20)]) for _ in range(3000)]
    pieces = spark.createDataFrame([(i, 0, n) for i, n in enumerate(lengths)], "doc_id long, piece int, length long")
    found = packing.pack(pieces, capacity=64, per_shard=40, fan_in=3).collect()
    assert len(found) == 3000 and sum(r["length"] for r in found) == sum(lengths)
    assert len(bins_of(found, 64)) <= 1.03 * sum(lengths) / 64 + 1


def test_best_fit():
    bins, offsets, fill = packing.best_fit(np.array([5, 6, 4, 5]), 10)
    assert sorted(fill) == [10, 10] and bins[1] == bins[2] and offsets[2] == 6


def test_archives(spark):
    big, tricky = "<p>" + "x" * 200, "a\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n" + "é" * 100 + "WARC/1.1\r\n"
    pages = [(5, "http://a b/\n", big), (3, "u", big), (9, None, big), (1, "u", "small"), (2, "u", "small"), (4, "u", None), (6, "u", ""), (7, "u", tricky), (8, "u", tricky)]
    pages += [(12, "again", big), (None, "u", big), (None, "u", "y" * 100), (10, "u", "z" * 99), (11, "u", "z" * 99)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("block", F.lit(1)).withColumn("record_id", F.lit(2)).repartition(3)
    found = warc.archive_pages(df).collect()
    asked = Counter()
    for i, _, h in pages:
        p = (h or "").encode()
        first = min((j for j, _, x in pages if (x or "").encode() == p and j is not None), default=None)
        revisit = len(p) >= 100 and first is not None and i != first
        asked[i, len(p), hashlib.sha256(p).hexdigest(), "revisit" if revisit else "response", first if revisit else None] += 1
    assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in found) == asked
    assert all((r["refers_to_record"] is not None) == (r["record_type"] == "revisit") for r in found)
    assert warc.archive_pages(df.where("false")).count() == 0


def test_repeated_page_rows_have_one_response(spark):
    df = spark.createDataFrame([(1, "u", "x" * 150)] * 3, "page_id long, url string, html string")
    assert Counter(r["record_type"] for r in warc.archive_pages(df).collect()) == {"response": 1, "revisit": 2}


def test_payloads_come_back(spark):
    html = ["", "WARC/1.1\r\n" * 30, "\r\n\r\n", "ü" * 50, "plain\n"]
    path = stage_path(spark, "test-warc")
    warc.capture(spark.createDataFrame(list(enumerate(html)), "page_id long, html string").withColumn("url", F.lit("u")).coalesce(1), path)
    assert {r["page_id"]: r["payload"] for r in warc.read_archive(spark, path, with_payload=True).collect()} == dict(enumerate(html))


def test_pieces_without_ids_are_dealt_to_all_shards(spark, monkeypatch):
    seen = []
    stage = packing.stage_table
    monkeypatch.setattr(packing, "stage_table", lambda df, name: (lambda out: seen.append(out) or out)(stage(df, name)) if name == "pack-placed" else stage(df, name))
    pieces = spark.createDataFrame([(None, 0, 1 + i * 7 % 900) for i in range(4000)], "doc_id long, piece int, length long").repartition(5)
    out = packing.pack(packing.stage_table(pieces, "test"), per_shard=1000)
    assert out.count() == 4000 and out.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0
    assert max(r["count"] for r in seen[0].groupBy("shard").count().collect()) < 1300
