"""Operators on cases made by hand."""

import random
from math import exp, factorial

import numpy as np
import pytest
from pyspark.sql import functions as F

from readloom.config import MappingConfig
from readloom.functions import alignment as A
from readloom.functions.cigars import Walk
from readloom.functions.headers import direction, qname
from readloom.operators import adapters, align, coverage, damage, limits, pairing, post, reports, stored, trim
from readloom.sources.index import ReferenceIndex
from readloom.sources.reports import first_int
from readloom.sources.reference import windows

HEADERS = [  # header, further second tokens, direction, key
    ("@M1:1:FC 1:N:0:AC", [], "R1", "M1:1:FC"),
    ("@M1:1:FC 2:N:0:AC", [], "R2", "M1:1:FC"),
    ("@a 1:x 2:y", [], "R1", "a"),
    ("@SRR1.1 foo/1", [], "R1", "SRR1.1"),
    ("@SRR1.1 foo/2 length=9", [], "R2", "SRR1.1"),
    ("@r7/1 foo/2", [], "R2", "r7"),
    ("@r7/1", [], "R1", "r7"),
    ("@r7/2 len=4", [], "R2", "r7"),
    ("@r7 1", ["1", "1"], "R1", "r7"),
    ("@SRR9.1 1 length=90", ["2", "3"], "UNKNOWN", "SRR9.1"),
    ("@SRR9.1 1 length=90", [], "R1", "SRR9.1"),
    ("@SRR9.1", [], "UNKNOWN", "SRR9.1"),
    ("@r7  1", [], "UNKNOWN", "r7"),
    ("@x/2/1", [], "R1", "x"),
    ("@x/1/2", [], "R2", "x/1"),
]


def test_headers(spark):
    rows = [(i, h, [h, *[f"@n {t}" for t in more]]) for i, (h, more, _, _) in enumerate(HEADERS)]
    df = spark.createDataFrame(rows, "i int, h string, s array<string>")
    found = {r["i"]: (r["d"], r["k"]) for r in df.select("i", direction(F.col("h"), F.col("s")).alias("d"), qname(F.col("h")).alias("k")).collect()}
    assert [found[i] for i in range(len(HEADERS))] == [(d, k) for _, _, d, k in HEADERS]


FILES = {  # directions under one key: kinds of units, problem
    "a": (["R1", "R2"], ["PE"], None),
    "b": (["R1"], ["SE"], None),
    "c": (["R2"], [], "R2 without R1"),
    "d": (["R1", "R1"], [], "two R1"),
    "e": (["R1", "R2", "R2"], [], "two R2"),
    "f": (["UNKNOWN"], ["SE"], None),
    "g": (["UNKNOWN", "UNKNOWN"], ["PE"], None),
    "h": (["UNKNOWN"] * 3, [], "over two unmarked"),
    "i": (["R1", "UNKNOWN"], ["SE", "SE"], None),
    "j": (["R1", "UNKNOWN", "UNKNOWN"], ["SE", "PE"], "unmarked pair of a marked key"),
}


def test_pairing(spark):
    rows = [(i, k, d) for i, (k, d) in enumerate((k, d) for k, (ds, _, _) in FILES.items() for d in ds)]
    files = spark.createDataFrame(rows, "idx long, key string, direction string")
    problems = {r["key"]: r["problem"] for r in pairing.conflicts(files).collect()}
    assert problems == {k: p for k, (_, _, p) in FILES.items() if p}
    good = files.where(~F.col("key").isin(list(problems)))
    units = pairing.units(good).collect()
    for key, (_, kinds, problem) in FILES.items():
        if not problem:
            assert sorted(u["kind"] for u in units if u["key"] == key) == sorted(kinds)
    assert sorted(u["unit_id"] for u in units) == ["PE0001", "PE0002", "SE0001", "SE0002", "SE0003", "SE0004"]
    g = next(u for u in units if u["key"] == "g")
    assert g["idx1"] < g["idx2"]
    assert pairing.sequencing_mode(pairing.units(good)).first()["seq_mode"] == "MIX"


def test_chunks_and_budgets(spark):
    reads = spark.range(25).select(F.lit("u").alias("unit_id"), F.col("id").alias("ordinal"))
    chunked = reads.withColumn("chunk_id", limits.chunk_id(F.col("ordinal"), 10))
    budget = {r["chunk_id"]: (r["take"], r["left_over"]) for r in limits.pilot_budget(limits.read_counts(chunked, "unit_id", "chunk_id"), 13).collect()}
    assert budget == {"0000": (10, 3), "0001": (3, 0), "0002": (0, 0)}
    assert limits.pilot(reads, 13).count() == 13 and limits.pilot(reads, 0).count() == 25
    assert reads.select(limits.chunk_id(F.lit(123_456), 1)).first()[0] == "123456"


def test_cigars(spark):
    row = spark.createDataFrame([("3H2S10M2I5D4M1S", 100)], "c string, p long")
    found = row.select(A.reference_length(F.col("c")), A.clipped(F.col("c"), False), A.clipped(F.col("c"), True), A.five_prime(F.col("p"), F.col("c"), F.lit(0)), A.five_prime(F.col("p"), F.col("c"), F.lit(16))).first()
    assert list(found) == [19, 5, 1, 95, 119]


def test_duplicates(spark):
    rows = [("a", 0, 10, "5M", 1), ("b", 0, 10, "5M", 9), ("c", 0, 12, "2S3M", 5), ("d", 16, 6, "5M", 5), ("e", 4, 10, "5M", 99), ("f", 256, 10, "5M", 99)]
    rows += [("p", 65, 30, "5M", 1), ("p", 145, 60, "5M", 1), ("q", 65, 30, "5M", 2), ("q", 145, 60, "5M", 2), ("s", 0, 30, "5M", 50)]
    df = spark.createDataFrame([(q, f, "c1", p, c, s) for q, f, p, c, s in rows], "qname string, flag int, rname string, pos long, cigar string, score long")
    found = post.mark_duplicates(df, F.col("score")).where("(flag & 1024) <> 0").select("qname").distinct()
    assert {r["qname"] for r in found.collect()} == {"a", "c", "p", "s"}
    assert post.mark_duplicates(df, F.col("score")).count() == len(rows)
    ends = spark.createDataFrame([("a", 0, "c", 1, "5M", 1), ("b", 0, "c", 1, "6M", 2)], df.schema)
    assert post.mark_duplicates(ends, F.col("score"), fragment_ends=True).where("flag > 0").count() == 0
    assert post.mark_duplicates(ends, F.col("score")).where("flag > 0").first()["qname"] == "a"


def test_reads_that_share_a_name_stand_by_themselves(spark):
    rows = [("q", 0, 10, "5M", 5, "u1"), ("q", 0, 500, "5M", 5, "u2"), ("z", 0, 10, "5M", 9, "u3"), (None, 0, 70, "5M", 1, "u1"), (None, 0, 70, "5M", 2, "u1")]
    rows += [("p", 65, 30, "5M", 1, u) for u in ("u1", "u2")] + [("p", 145, 60, "5M", 1, u) for u in ("u1", "u2")]
    df = spark.createDataFrame([(q, f, "c1", p, c, s, u) for q, f, p, c, s, u in rows], "qname string, flag int, rname string, pos long, cigar string, score long, unit_id string")
    marked = lambda by: {(r["qname"], r["pos"], r["score"], r["unit_id"]) for r in post.mark_duplicates(df, F.col("score"), by=by).where("(flag & 1024) <> 0").collect()}
    singles = {("q", 10, 5, "u1"), (None, 70, 1, "u1")}
    assert marked(("unit_id", "qname")) == singles | {("p", 30, 1, "u2"), ("p", 60, 1, "u2")}
    assert {x for x in marked(("qname",)) if x[0] != "p"} == singles
    again = post.mark_duplicates(df, F.col("score"), by=("unit_id", "qname"))
    assert post.mark_duplicates(again, F.col("score"), by=("unit_id", "qname")).exceptAll(again).count() == 0
    report = post.duplicate_report(again).first()
    assert (report["examined"], report["duplicate_paired"], report["duplicate_single"]) == (9, 2, 2) and report["duplicate_share"] == 4 / 9


def test_bases_around_adapter_kmers_are_counted_in_tasks(spark):
    """The counts of the plain way, a row per read, k-mer, side and base, from no more rows than there are counts a task."""
    r = random.Random(11)
    kmers = {"u1": ("ACGTACGTAACC", "GGATTACAGGCA"), "u2": ("ACGTACGTAACC", "TTTTGGGGCCCA")}
    rows = [(u, "".join(r.choices("ACGTN", k=r.randint(0, 50))) + (r.choice(kmers.get(u, ("",))) * r.randint(0, 2)) + "".join(r.choices("ACGT", k=r.randint(0, 50)))) for u in ("u1", "u2", "u3") for _ in range(300)]
    code = lambda s: sum("ACGT".index(c) << 2 * (11 - i) for i, c in enumerate(s))
    df = spark.createDataFrame(rows, "unit_id string, tail string").repartition(3)
    asked = {}
    for u, s in rows:
        for kmer in kmers.get(u, ()):
            if (at := s.find(kmer)) >= 0:
                for side, text in (("before", s[:at][::-1]), ("after", s[at + 12 :])):
                    for place, base in enumerate(text[: adapters.MOST]):
                        asked[u, code(kmer), side, place, base] = asked.get((u, code(kmer), side, place, base), 0) + 1
    around = adapters._around(df, [(u, code(kmer)) for u, own in kmers.items() for kmer in own])
    found = {tuple(x)[:-1]: x["n"] for x in around.collect()}
    assert found == asked and len(asked) > 1000 and adapters._around(df, []).count() == 0
    none = spark.createDataFrame([("u1", None), (None, "ACGT"), ("u1", "")], "unit_id string, seq string")
    assert adapters.detect_adapters(none).count() == 0


def test_duplicates_without_a_shuffle_of_reads(spark, monkeypatch):
    """Where reads begin at few places, none is shuffled; with many, the verdicts are the same."""
    r = random.Random(8)
    rows = []
    for i in range(3000):
        n = r.choice((1, 2, 2, 3))  # reads of a name: alone, a pair, or one too many
        for j in range(n):
            flag = (1 + (64 if j == 0 else 128) if n > 1 or r.random() < 0.3 else 0) + r.choice((0, 0, 16)) + (r.choice((4, 256, 1024)) if r.random() < 0.1 else 0)
            rows.append((f"q{i}" if i % 50 else None, flag, f"c{r.randint(0, 1)}", r.randint(1, 2000), r.choice(("20M", "3S17M", "17M3S")), r.randint(0, 5)))
    df = spark.createDataFrame(rows, "qname string, flag int, rname string, pos long, cigar string, score long").repartition(5)
    told = lambda **more: sorted(map(str, post.mark_duplicates(df, F.col("score"), **more).collect()))
    few = told(), told(fragment_ends=True)
    assert 300 < sum(int(x.split("flag=")[1].split(",")[0]) & 1024 > 0 for x in few[0]) < len(rows) and few[0] != few[1]
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    try:
        spark.conf.set(setting, "-1")
        plan = post.mark_duplicates(df, F.col("score"))._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning" not in plan and plan.count("BroadcastHashJoin") == 3
        monkeypatch.setattr(stored, "FEW", 0)
        assert (told(), told(fragment_ends=True)) == few
    finally:
        spark.conf.set(setting, before)


@pytest.mark.parametrize("size", [7, 64, 1 << 20])
def test_depth_equals_counting(spark, size):
    r = random.Random(1)
    spans = [(f"c{r.randint(0, 2)}", (s := r.randint(1, 300)), s + r.randint(0, 80)) for _ in range(200)] + [("c0", 5, 4)]
    depth = {}
    for c, s, e in spans:
        for i in range(s, e + 1):
            depth[c, i] = depth.get((c, i), 0) + 1
    runs = coverage.depth_runs(spark.createDataFrame(spans, "rname string, start long, end long"), size).collect()
    assert {(x["rname"], i): x["depth"] for x in runs for i in range(x["start"], x["end"] + 1)} == depth


def test_quality_and_tails(spark):
    df = spark.createDataFrame([("ACGT" + "G" * 10, "I" * 14), ("ACGT" + "G" * 9, "!" * 6 + "I" * 7), ("NNNNNNAC", "I" * 8), ("", "")], "seq string, qual string")
    assert [r["seq"] for r in trim.poly_g_trimmed(df).collect()] == ["ACGT", "ACGT" + "G" * 9, "NNNNNNAC", ""]
    assert [r[0] for r in df.select(trim.good_quality(F.col("seq"), F.col("qual"))).collect()] == [True, False, False, True]


def test_adapters_and_overlaps():
    matrix = lambda xs: trim._matrix(__import__("pyarrow").array(xs))
    assert trim.adapter_starts(*matrix(["ACGTACAGATCGGA", "ACGTACAGA", "TTTTTTTT", "", "ACGTAGATCGGAAGTGCC"]), b"AGATCGGAAGAGC").tolist() == [6, 9, 8, 0, 4]
    r = np.random.default_rng(0)
    for n in (36, 50, 70):
        whole = "".join(r.choice(list("ACGT"), n))
        one, two = matrix([whole[:40]]), matrix([whole[-40:]])
        assert trim.overlaps(*one, *two)[0] == (n - 40 if 40 - abs(n - 40) >= 30 and n >= 40 else 0 if n < 40 else np.iinfo(np.int64).max)


def test_merging_prefers_quality(spark):
    whole = "ACGTTGCAAGGCTTACCGATTGCATGCCAGTTACGGATCA"
    back = whole[::-1].translate(str.maketrans("ACGT", "TGCA"))
    wrong = "T" + whole[1:]
    df = spark.createDataFrame([(1, wrong, "!" + "I" * 39, back, "I" * 40), (2, wrong, "I" * 40, back, "I" * 40)], "id int, seq1 string, qual1 string, seq2 string, qual2 string")
    assert {r["id"]: r["merged_seq"] for r in trim.merged_pairs(df).collect()} == {1: whole, 2: wrong}


def test_budgets():
    for n in range(20, 200, 7):
        tail = lambda k: 1 - sum(exp(-n * 0.02) * (n * 0.02) ** i / factorial(i) for i in range(k + 1))  # noqa: E731, B023
        assert align.mismatch_budget(n, 0.01) == next(k for k in range(1, 50) if tail(k) < 0.01)
    assert [align.mismatch_budget(50, x) for x in (0, 1, 3)] == [0, 1, 3]


def test_substitutions_are_counted_from_both_ends(spark):
    r = random.Random(11)
    turn = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))
    rows, asked = [], {}
    for _ in range(200):
        ref = "".join(r.choices("ACGT", k=r.randint(1, 40)))
        seq, flag = "".join(x if r.random() < 0.8 else r.choice("ACGT") for x in ref), r.choice([0, 16])
        rows.append((flag, seq, ref))
        s, t = (turn(seq), turn(ref)) if flag else (seq, ref)
        for end, a, b in (("5p", s, t), ("3p", s[::-1], t[::-1])):
            for i in range(min(25, len(a))):
                asked[end, i + 1, b[i], a[i]] = asked.get((end, i + 1, b[i], a[i]), 0) + 1
    rows += [(0, None, "A"), (0, "A", None), (0, "", ""), (0, "AC", "A")]
    df = spark.createDataFrame(rows, "flag int, seq string, reference string").repartition(3)
    found = damage.substitutions(df).collect()
    assert {(x["end"], x["place"], x["ref"], x["alt"]): x["n"] for x in found} == asked and len(found) == len(asked)
    assert damage.substitutions(df.limit(0)).count() == 0


def test_kmers_cross_pieces(spark):
    seq = "".join(random.Random(2).choices("ACGT", k=2570))
    contigs = spark.createDataFrame([("c", seq), ("short", "ACGTA"), ("empty", "")], "rname string, seq string")
    number = lambda s: sum("ACGT".index(c) << 2 * (len(s) - 1 - i) for i, c in enumerate(s))
    for k in (3, 7):
        light, heavy = ReferenceIndex(contigs, heavy=20).table(k)
        found = light.where("rname is not null").unionByName(heavy.drop("part"), True).collect()
        whole = {"c": seq, "short": "ACGTA"}
        assert len(found) == 2570 - k + 1 + max(0, 5 - k + 1) and (heavy.count() > 0) == (k == 3)
        for r in found:
            s, p = whole[r["rname"]], r["pos"] - 1
            before, after = s[max(0, p - 32) : p], s[p + k : p + k + 32]
            assert (r["key"], r["lead"], r["tail"], r["odd"]) == (number(s[p : p + k]), len(before), len(after), False)
            assert r["before"] % (1 << 64) == number(before) and r["after"] % (1 << 64) == number(after.ljust(32, "A"))
    assert windows(contigs, 1000, 4).where("rname = 'c'").count() == 3


def test_alignment_finds_every_placement(spark):
    r = random.Random(3)
    genome = "".join(r.choices("ACGT", k=3000))
    contigs = spark.createDataFrame([("c1", genome[:1800]), ("c2", genome[1800:])], "rname string, seq string")
    turn = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))
    reads, truth = [], {}
    for i in range(60):
        n, c = r.randint(30, 70), r.choice(["c1", "c2"])
        own = genome[:1800] if c == "c1" else genome[1800:]
        p = r.randint(1, len(own) - n + 1)
        s = list(own[p - 1 : p - 1 + n])
        for j in r.sample(range(n), r.randint(0, align.mismatch_budget(n, 0.01))):
            s[j] = r.choice([x for x in "ACGT" if x != s[j]])
        strand = r.choice([0, 16])
        reads.append((f"r{i}", turn("".join(s)) if strand else "".join(s)))
        truth[f"r{i}"] = (strand, c, p)
    reads += [("junk", "AC" * 20), ("short", "A"), ("none", "")]
    found = {x["read_id"]: x for x in align.align_ancient(spark.createDataFrame(reads, "read_id string, seq string"), contigs).collect()}
    assert len(found) == 63 and all((found[k]["flag"], found[k]["rname"], found[k]["pos"]) == v for k, v in truth.items())
    assert all(found[k]["flag"] == 4 for k in ("junk", "short", "none"))


def test_long_reads_are_placed_wherever_they_begin(spark):
    r = random.Random(5)
    genome = "".join(r.choices("ACGT", k=9000))
    contigs = spark.createDataFrame([("c", genome)], "rname string, seq string")
    places = [(n, p) for n in (40, 600, 1700, 2600) for p in (1, 950, 1020, 1024, 1025, 2040, 3060, 6001)]
    reads = []
    for n, p in places:
        s = list(genome[p - 1 : p - 1 + n])
        for j in r.sample(range(n), min(n // 60, align.mismatch_budget(n, 0.01))):
            s[j] = r.choice([x for x in "ACGT" if x != s[j]])
        reads.append((f"{n}:{p}", "".join(s)))
    df = spark.createDataFrame(reads, "read_id string, seq string")
    found = {x["read_id"]: x for x in align.align_ancient(df, contigs).collect()}
    assert {k: (x["pos"], x["cigar"]) for k, x in found.items()} == {f"{n}:{p}": (p, f"{n}M") for n, p in places}
    assert align.mismatch_budget(2600, 0.01) > align.mismatch_budget(512, 0.01) and 1000 < align.mismatch_budget(50_000, 0.01) < 1200
    whole = spark.createDataFrame([(f"{n}:{p}", genome[p - 1 : p - 1 + n]) for n, p in places], "read_id string, seq string")
    found = {x["read_id"]: x for x in align.align_modern(whole, contigs).collect()}
    assert {k: (x["pos"], x["cigar"]) for k, x in found.items()} == {f"{n}:{p}": (p, f"{n}M") for n, p in places}


def test_local_alignment_clips(spark):
    genome = "".join(random.Random(4).choices("ACGT", k=500))
    contigs = spark.createDataFrame([("c", genome)], "rname string, seq string")
    reads = [("whole", genome[100:160]), ("tail", genome[100:150] + "T" * 12 if genome[150] != "T" else genome[100:150] + "A" * 12), ("edge", "GATTACAGAT" + genome[:45])]
    found = {x["read_id"]: x for x in align.align_modern(spark.createDataFrame(reads, "read_id string, seq string"), contigs).collect()}
    assert (found["whole"]["pos"], found["whole"]["cigar"], found["whole"]["mapq"]) == (101, "60M", 60)
    assert found["tail"]["pos"] == 101 and found["tail"]["cigar"].startswith("5") and found["tail"]["cigar"].endswith("S")
    assert found["edge"]["pos"] == 1 and found["edge"]["cigar"] == "10S45M"


def test_adapters_are_found(spark):
    r = random.Random(14)
    dna = lambda n: "".join(r.choices("ACGT", k=n))
    planted = {"a": dna(33), "b": dna(16), "c": "", "d": dna(60)}
    rows = [(u, (dna(r.randint(25, 50)) + x + ("" if r.random() < 0.8 else "G" * 15))[: r.randint(60, 90)] if r.random() < 0.4 else dna(80)) for u, x in planted.items() for _ in range(1500)]
    rows += [("poly", dna(30) + "A" * 30) for _ in range(500)] + [("few", dna(30) + planted["a"]) for _ in range(10)] + [("copies", dna(70))] * 400 + [("copies", dna(70)) for _ in range(600)] + [("a", ""), ("a", "ACN")]
    found = {x["unit_id"]: x["adapter"] for x in adapters.detect_adapters(spark.createDataFrame(rows, "unit_id string, seq string").repartition(4)).collect()}
    assert set(found) == {"a", "b", "d"} and found["a"] == planted["a"] and found["b"] == planted["b"] and planted["d"].startswith(found["d"]) and len(found["d"]) >= 25
    assert adapters.detect_adapters(spark.createDataFrame([], "unit_id string, seq string")).count() == 0


def test_adapters_of_reads_cut_off_evenly_keep_their_last_base(spark):
    r = random.Random(16)
    planted = "TGGAATTCTCGGGTGCCAAGG"
    rows = [(f"u{n}", "".join(r.choices("ACGT", k=r.randint(25, 50))) + planted[: 14 + i % 8]) for n in (320, 326, 327) for i in range(n)]  # of 327, 40 have the last base and 41 end before it
    rows += [("more", "".join(r.choices("ACGT", k=40)) + planted + "G" * (i % 4)) for i in range(0, 400)] + [("fewer", "".join(r.choices("ACGT", k=40)) + planted + "G" * 5 * (i % 4 == 0)) for i in range(400)]
    found = {x["unit_id"]: x["adapter"] for x in adapters.detect_adapters(spark.createDataFrame(rows, "unit_id string, seq string").repartition(4)).collect()}
    assert [found[u] for u in ("u320", "u326", "u327", "fewer")] == [planted] * 4 and found["more"].startswith(planted)


def test_sketches_lose_no_frequent_key():
    r = np.random.default_rng(3)
    keys, held = r.zipf(1.3, 200_000) % 50_000, (np.zeros(0, np.int64), np.zeros(0, np.int64))
    for part in np.array_split(keys, 40):
        own, counts = np.unique(part, return_counts=True)
        both, where = np.unique(np.concatenate([held[0], own]), return_inverse=True)
        held = adapters._keep(both, np.bincount(where, weights=np.concatenate([held[1], counts])).astype(np.int64), 200)
    true = dict(zip(*np.unique(keys, return_counts=True), strict=True))
    kept = dict(zip(held[0].tolist(), held[1].tolist(), strict=True))
    assert len(kept) <= 200 and all(true[k] - len(keys) / 200 <= n <= true[k] for k, n in kept.items()) and all(k in kept for k, n in true.items() if n > len(keys) / 200)


def test_pair_adapters_are_found(spark):
    r = random.Random(15)
    dna = lambda n: "".join(r.choices("ACGT", k=n))
    turn = str.maketrans("ACGT", "TGCA")
    first, second, rows = dna(25), dna(22), []
    for i in range(300):
        whole = dna(r.randint(35, 90))
        rows.append(("u", (whole + first + dna(50))[:70], (whole[::-1].translate(turn) + second + dna(50))[:70]))
    found = {(x["unit_id"], x["mate"]): x["adapter"] for x in adapters.detect_pair_adapters(spark.createDataFrame(rows, "unit_id string, seq1 string, seq2 string")).collect()}
    assert found == {("u", 1): first, ("u", 2): second}


def test_trim_reports(spark):
    before = spark.createDataFrame([("u", "ACGT", "I5!I"), ("u", "GG", "?+"), ("v", "", ""), ("u", "ANC", "III")], "unit_id string, seq string, qual string").repartition(3)
    after = before.where("length(seq) > 2")
    found = {x["unit_id"]: x for x in reports.trim_report(before, after).collect()}
    assert [found["u"][c] for c in ("reads_before", "bases_before", "q20_before", "q30_before", "gc_before", "reads_after", "bases_after")] == [3, 9, 7, 6, 5, 2, 7]
    assert [found["v"][c] for c in ("reads_before", "bases_before", "reads_after", "bases_after")] == [1, 0, 0, 0]
    text = reports.as_json(reports.trim_report(before, after), reports.by_cycle(before), reports.by_cycle(after))
    numbers = text.select("unit_id", first_int(F.col("value"), "summary.before_filtering.total_reads").alias("n"), first_int(F.col("value"), "summary.after_filtering.total_bases").alias("b")).collect()
    assert {tuple(x) for x in numbers} == {("u", 3, 7), ("v", 1, 0)}
    curve = text.where("unit_id = 'u'").select(F.from_json(F.get_json_object("value", "$.reads_before_filtering.quality_curves.quality"), "array<double>").alias("q")).first()["q"]
    assert curve == pytest.approx([(40 + 30 + 40) / 3, (20 + 10 + 40) / 3, 20.0, 40.0])


def walked(cigar):
    """Columns of a CIGAR: places on the read and on the reference."""
    read = ref = 0
    out, number = [], ""
    for c in cigar:
        if c.isdigit():
            number += c
            continue
        for _ in range(int(number)):
            if c in "MIDX=":
                out.append((read if c != "D" else -1, ref if c != "I" else -1))
            read, ref = read + (c in "MISX="), ref + (c in "MDNX=")
        number = ""
    return out, read, ref


CIGARS = ["10M", "3S10M", "2H4S5M2I3M1D6M3S", "12S", "*", None, "1M1D1M1I1M", "5=1X4=", "3M100N4M", "123M", "7M2S1H", "2I3M"]


def test_walk_equals_a_plain_walk():
    import pyarrow as pa

    walk = Walk(pa.array(["9M", *CIGARS])[1:])
    row, read, ref = walk.columns()
    for i, c in enumerate(CIGARS):
        asked = walked(c)[0] if c not in ("*", None) else []
        assert list(zip(read[row == i].tolist(), ref[row == i].tolist(), strict=True)) == asked


def test_coverage_under_cigars(spark):
    """Depth and base qualities against a count base by base: deletions and skips aren't covered, clips don't count."""
    r = random.Random(12)
    rows, depth, quality = [], {}, []
    for i in range(200):
        cigar = r.choice([c for c in CIGARS if c not in ("12S", "*", None)])
        columns, n, _ = walked(cigar)
        pos, qual = r.randint(1, 80), "".join(chr(33 + r.randint(0, 40)) for _ in range(n))
        rows.append((f"r{i}", 0, "c", pos, 30, cigar, qual))
        for a, b in columns:
            if a >= 0 and b >= 0:
                depth[pos + b] = depth.get(pos + b, 0) + 1
                quality.append(ord(qual[a]) - 33)
    rows.append(("odd", 0, "c", 1, 30, "5M", "II"))
    for p in range(1, 6):
        depth[p] = depth.get(p, 0) + 1
    df = spark.createDataFrame(rows, "qname string, flag int, rname string, pos long, mapq int, cigar string, qual string").repartition(3)
    contigs = spark.createDataFrame([("c", 500), ("d", 10)], "rname string, length long")
    found = {x["rname"]: x for x in coverage.coverage_by_contig(df, contigs).collect()}
    assert (found["c"]["covbases"], found["c"]["meandepth"]) == (len(depth), sum(depth.values()) / 500)
    assert found["c"]["meanbaseq"] == pytest.approx(sum(quality) / len(quality)) and found["d"]["meanbaseq"] == 0
    assert {x["depth"]: x["bases"] for x in coverage.depth_histogram(df).collect()} == {d: list(depth.values()).count(d) for d in set(depth.values())}


def test_damage_under_cigars(spark):
    r = random.Random(13)
    turn = str.maketrans("ACGT", "TGCA")
    genome = "".join(r.choices("ACGT", k=3000))
    rows, asked, around = [], {}, {}
    for i in range(300):
        cigar = r.choice([c for c in CIGARS if c not in ("12S", "*", None)])
        columns, n, m = walked(cigar)
        flag, pos, seq = r.choice((0, 16)), r.choice((1, 5, r.randint(1, 2800), 3000 - m + 1)), "".join(r.choices("ACGT", k=n))
        rows.append((flag, "c", pos, cigar, seq))
        pairs = [(genome[pos - 1 + b] if b >= 0 else "-", seq[a] if a >= 0 else "-") for a, b in columns]
        left, right = genome[max(0, pos - 11) : pos - 1][::-1], genome[pos - 1 + m : pos + 9 + m]
        if flag:
            pairs = [(a.translate(turn), b.translate(turn)) for a, b in pairs[::-1]]
            left, right = right.translate(turn), left.translate(turn)
        for end, own, out in (("5p", pairs, left), ("3p", pairs[::-1], right)):
            for j, (a, b) in enumerate(own[:25]):
                asked[end, j + 1, a, b] = asked.get((end, j + 1, a, b), 0) + 1
            for j, a in enumerate(out):
                around[end, j + 1, a] = around.get((end, j + 1, a), 0) + 1
    df = spark.createDataFrame([*rows, (4, "*", 0, "*", "ACGT")], "flag int, rname string, pos long, cigar string, seq string").repartition(3)
    over = align.with_reference(df, spark.createDataFrame([("c", genome)], "rname string, seq string"))
    found = damage.substitutions_under_cigars(over).collect()
    assert {(x["end"], x["place"], x["ref"], x["alt"]): x["n"] for x in found} == asked and len(found) == len(asked)
    assert {(x["end"], x["place"], x["base"]): x["n"] for x in damage.base_composition(over).collect()} == around


def test_config():
    assert MappingConfig("s").key() != MappingConfig("s", min_mapq=30).key()
    assert MappingConfig("s").key("manifest") == MappingConfig("s", min_mapq=30).key("manifest")
    for bad in ({"sample": ""}, {"library_type": "old"}, {"min_mapq": -1}, {"chunk_reads": 1.5}, {"mismatch": -1}):
        with pytest.raises(ValueError):
            MappingConfig(**({"sample": "s"} | bad))
