"""The registered queries against their SQL, and the pipeline against plain versions of its decisions."""

import hashlib
import importlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import DATA, same_rows
from odd import documents, rows, words
from pyspark.sql import functions as F
from test_duplicates import plain_components

from readloom.llm import mixing, quality_mil, simhash, suffix_dedup
from readloom.llm import queries as corpus


@pytest.mark.parametrize("name", sorted(corpus.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    found = corpus.queries()[name](spark, DATA).toPandas()
    asked = duck.execute(corpus.oracle_sql()[name]).df()
    assert len(found)
    same_rows(found, asked)


def test_all_operators_are_registered():
    entry = importlib.import_module("__spark_entry__")
    assert [sum(n.startswith(f"op{i}_") for n in entry.queries()) for i in range(1, 14)] == [1] * 13
    assert "pipeline" in entry.queries()


def test_held_out_accuracy(spark):
    truth = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang").join(spark.read.parquet(f"{DATA}/labels.parquet"), "doc_id", "left")
    for name, right, least in (("op7_language_id", F.col("lang_pred") == F.col("lang"), 0.95), ("op8_quality_mil", F.col("predicted") == F.col("quality"), 0.85)):
        rows = corpus.queries()[name](spark, DATA).join(truth, "doc_id").where("held_out").where(right.isNotNull())
        assert rows.select(F.avg(right.cast("double"))).first()[0] >= least


def test_pipeline_stages(spark):
    pipeline = importlib.import_module("corpus_pipeline")
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns = docs.columns
    for name, stage in pipeline.STAGES:
        out = pipeline.stage_table(stage(spark, docs, DATA), "test-pipeline")
        if name != "best-fit packing":
            assert out.columns == columns and out.count()
        if name == "quality classifier":
            labels = spark.read.parquet(f"{DATA}/labels.parquet").where("quality = 1").join(docs, "doc_id")
            assert labels.join(out, "doc_id", "left_anti").count() <= 0.03 * labels.count()
        if name == "SimHash near-dedup":
            found = simhash.near_duplicates(docs)
            assert out.count() == found.select("component_id").distinct().count() and out.join(found.where("doc_id = component_id"), "doc_id", "left_anti").count() == 0
        if name == "suffix-array dedup":
            cut = suffix_dedup.remove_repeats(docs.select("doc_id", "text"), kept="text").select("doc_id", "kept")
            assert out.join(cut, "doc_id").where("text <> kept or n_chars <> length(kept)").count() == 0 and out.count() == docs.count()
        if name.startswith("mixing"):
            assert out.count() == mixing.mix(docs).agg(F.sum("mix_copies")).first()[0]
        if name == "best-fit packing":
            per = out.groupBy("sequence_id").agg(F.sum("length").alias("n"))
            assert per.where("n > 2048").count() == 0 and out.where("piece = 0").count() == docs.count()
        docs = out
    assert len(pipeline.STAGES) == 5


def labelled():
    """Documents of two kinds and their labels: what is full of marks is bad."""
    r = random.Random(21)
    out = []
    for i in range(100, 260):
        text = words(r.randint(60, 120), i)
        out.append((i, text if i % 2 else " ".join(w + r.choice(("***", "%%%", "|")) for w in text.split()), "en", ("s1", "s2", "s0", None)[i % 4], len(text)))
    shared = words(60, 999)
    out += [(300 + i, words(40, 2000 + i) + " " + shared + " " + words(40, 3000 + i), "en", "s2", 1) for i in range(6)]  # passages of over 200 bytes
    return out, [(i, i % 2) for i in range(100, 220)]


def plain_pipeline(docs, model):
    """doc_id, piece, start, length, crc32 of what comes out, step by step, of rows (doc_id, text, lang, source, n_chars)."""
    import public_tokenizers
    from tokenizers import Tokenizer

    scored = [(d, float(model.score(*quality_mil.encode_passages([(d[1] or "").encode()]))[0]) if model else 0.5) for d in docs]
    docs = [d for d, s in scored if s >= 0.3]
    prints = [simhash.fingerprint(d[1]) for d in docs]
    root = {p: p for p in prints} | plain_components([(p, q) for p in set(prints) for q in set(prints) if p < q and (p ^ q).bit_count() <= 2])
    least = {}
    for d, p in zip(docs, prints, strict=True):
        key = (d[0] is None, d[0] or 0)
        if root[p] not in least or key < least[root[p]][0]:
            least[root[p]] = key, d
    docs = [d for _, d in least.values()]
    texts = [(d[1] or "").encode() for d in docs]
    seen = Counter(t[i : i + 200] for t in texts for i in range(len(t) - 199))
    left = []
    for t in texts:
        gone = {j for i in range(len(t) - 199) if seen[t[i : i + 200]] > 1 for j in range(i, i + 200)}
        left.append(bytes(b for j, b in enumerate(t) if j not in gone).decode())
    docs = [(d[0], t, d[3]) for d, t in zip(docs, left, strict=True)]
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    sizes = Counter()
    for _, t, source in docs:
        sizes[source] += count(t)
    order = sorted(sizes, key=lambda x: (x is None, x or ""))
    weight = {x: (3, 1, 2)[i % 3] for i, x in enumerate(order)}
    target, open_, rest = {}, set(order), 1.5 * sum(sizes.values())
    while open_:
        level = rest / sum(weight[x] for x in open_)
        over = {x for x in open_ if weight[x] * level >= 2 * sizes[x]}
        for x in over or open_:
            target[x] = 2.0 * sizes[x] if over else weight[x] * level
        rest -= sum(target[x] for x in over)
        open_ -= over or open_
    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    equal, encoder, out = Counter(), Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), Counter()
    for d in docs:
        rate = target[d[2]] / sizes[d[2]] if sizes[d[2]] else 0
        key = ":".join(("null" if d[0] is None else str(d[0]), "null" if d[2] is None else md5(d[2]), md5(d[1]), str(equal[d])))
        equal[d] += 1
        copies = int(rate) + (int(md5("42:" + key)[:13], 16) / (1 << 52) < rate - int(rate))
        x = np.array([*encoder.encode(d[1], add_special_tokens=False).ids, 0], "<u4")
        cuts = [0, len(x)] if len(x) <= 2048 else [0, *range(len(x) % 2048 or 2048, len(x) + 1, 2048)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            out[d[0], k, a, b - a, zlib.crc32(x[a:b].tobytes())] += copies
    return +out


def test_pipeline_equals_a_plain_one(spark, tmp_path):
    pipeline = importlib.import_module("corpus_pipeline")
    more, labels = labelled()
    whole = [*rows(), *more]
    table = spark.createDataFrame(whole, documents(spark, extra=False).schema).repartition(3)
    table.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([*labels, (6, 1), (7, 1), (8, 0), (None, None)], "doc_id long, quality int").withColumn("toxic", F.lit(0)).write.parquet(str(tmp_path / "labels.parquet"))
    model = quality_mil.train(table.select("doc_id", "text"), quality_mil.learn_from(spark.read.parquet(str(tmp_path / "labels.parquet")).select("doc_id", "quality")))
    found = pipeline.run(spark, str(tmp_path)).collect()
    asked = plain_pipeline(whole, model)
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == asked
    assert 60 < len({r["doc_id"] for r in found}) < len(whole) - 60  # the bad ones have gone
    bins = {}
    for r in found:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in map(sorted, bins.values()):
        assert [o for o, _ in own] == [sum(n for _, n in own[:i]) for i in range(len(own))] and sum(n for _, n in own) <= 2048
    assert len(bins) <= -(-sum(r["length"] for r in found) // 2048) + 1
    for part in ("documents", "labels"):
        spark.read.parquet(str(tmp_path / f"{part}.parquet")).where("false").write.parquet(str(tmp_path / "none" / f"{part}.parquet"))
    assert pipeline.run(spark, str(tmp_path / "none")).count() == 0
