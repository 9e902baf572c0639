"""The stored index, seeds without loss, and gapped alignment against plain programmes."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from readloom.functions import packed
from readloom.operators import align, gapped, seeds, stored
from readloom.sources.index import ReferenceIndex

TURN = str.maketrans("ACGT", "TGCA")


def turned(s):
    return s[::-1].translate(TURN)


def test_words_and_keys():
    r = random.Random(1)
    texts = ["".join(r.choices("ACGT", k=n)) for n in (0, 1, 5, 31, 32, 33, 100)] + ["ACGNT" * 9, "acgt" * 10]
    p = packed.Packed.of_strings(pa.array(texts), both=True)
    whole = texts + [turned(t.upper()) for t in texts][::-1]
    number = lambda s: sum("ACGT".index(c) << 2 * (len(s) - 1 - i) for i, c in enumerate(s.upper().replace("N", "A")))
    for i, t in enumerate(whole):
        for at in range(0, max(0, len(t) - 6)):
            if "N" not in t:
                assert p.keys(p.begin[i : i + 1] + at, 7)[0] == number(t[at : at + 7])
            assert p.plain(p.begin[i : i + 1] + at, 7)[0] == ("N" not in t[at : at + 7])
        assert t == "" or "N" in t or int(p.word[p.begin[i]]) == number(t[:32].ljust(32, "A"))


def test_minimizers_of_shared_bases_are_shared():
    r = random.Random(2)
    k, w = 7, 5
    for _ in range(200):
        common = "".join(r.choices("ACGT", k=w + k - 1))
        a, b = ("".join(r.choices("ACGT", k=r.randint(0, 20))) + common + "".join(r.choices("ACGTN", k=r.randint(0, 20))) for _ in range(2))
        p = packed.Packed.of_strings(pa.array([a, "ACG", b]))
        at, of = packed.minimizers(p, k, w)
        keys = p.keys(at, k)
        assert set(keys[of == 0]) & set(keys[of == 2]) and not (of == 1).any()


def plain_local(read, ref):
    """The best local score by a quadratic programme."""
    n, m = len(read), len(ref)
    h, e, f = (np.full((n + 1, m + 1), -9999) for _ in range(3))
    h[0], h[:, 0] = 0, 0
    for i in range(1, n + 1):
        for j in range(1, m + 1):
            e[i, j] = max(h[i - 1, j] - 7, e[i - 1, j] - 1)
            f[i, j] = max(h[i, j - 1] - 7, f[i, j - 1] - 1)
            same = read[i - 1] == ref[j - 1] and read[i - 1] in "ACGT"
            h[i, j] = max(0, h[i - 1, j - 1] + (1 if same else -4), e[i, j], f[i, j])
    return h.max()


def cost_of(read, ref, cigar, pos):
    """The score and differing bases that a CIGAR stands for, pos from 0 on ref."""
    score, nm, i, number = 0, 0, 0, ""
    for c in cigar:
        if c.isdigit():
            number += c
            continue
        n, number = int(number), ""
        if c == "M":
            wrong = sum(not (a == b and a in "ACGT") for a, b in zip(read[i : i + n], ref[pos : pos + n], strict=True))
            score, nm, i, pos = score + n - 5 * wrong, nm + wrong, i + n, pos + n
        elif c == "S":
            i += n
        else:
            score, nm = score - 6 - n, nm + n
            i, pos = (i + n, pos) if c == "I" else (i, pos + n)
    assert i == len(read)
    return score, nm


def mutated(r, s):
    out = list(s)
    for _ in range(r.randint(0, 3)):
        at = r.randrange(len(out))
        out[at] = r.choice(("", r.choice("ACGTN"), out[at] + "".join(r.choices("ACGT", k=r.randint(1, 5)))))
    cut = r.randrange(len(out))
    if r.random() < 0.4:
        del out[cut : cut + r.randint(1, 9)]
    return "".join(out)


def test_banded_equals_a_plain_programme():
    r = random.Random(3)
    code = lambda s, n, fill: [("ACGT".find(c) if c in "ACGT" else 4) for c in s] + [fill] * (n - len(s))
    pairs = []
    for _ in range(150):
        ref = "".join(r.choices("ACGT" if r.random() < 0.7 else "AC", k=90))
        pairs.append((mutated(r, ref[10 : 10 + r.randint(20, 60)]) or "A", ref))
    longest = max(len(a) for a, _ in pairs)
    width = 2 * longest + 90  # so wide a band leaves nothing out
    reads = np.array([code(a, longest, 4) for a, _ in pairs], np.uint8)
    refs = np.array([[5] * longest + code(b, width - longest, 5) for _, b in pairs], np.uint8)
    sizes = np.array([len(a) for a, _ in pairs])
    for cells in (1 << 25, 1 << 14):
        found = gapped.banded(reads, sizes, refs, cells)
        for i, (a, b) in enumerate(pairs):
            score = plain_local(a, b)
            assert found["score"][i] == score
            if score:
                assert cost_of(a, b, found["cigar"][i].as_py(), int(found["ref"][i]) - longest) == (score, found["nm"][i]), pairs[i]


def test_gaps_stand_as_far_left_as_they_go(spark):
    r = random.Random(4)
    left, right = ("".join(r.choices("ACGT", k=40)) for _ in range(2))
    contigs = spark.createDataFrame([("c", "".join(r.choices("ACGT", k=300)) + left + "GAAAAAT" + right + "".join(r.choices("ACGT", k=300)))], "rname string, seq string")
    at = 300 + 40
    reads = [("deleted", left + "GAAAT" + right), ("inserted", left + "GAAAAAAAT" + right), ("same", left + "GAAAAAT" + right)]
    reads += [(k + "-", turned(s)) for k, s in reads]
    found = {x["read_id"]: (x["flag"], x["pos"], x["cigar"], x["mm"]) for x in align.align_modern(spark.createDataFrame(reads, "read_id string, seq string"), contigs).collect()}
    for back in ("", "-"):
        flag = 16 if back else 0
        assert found["deleted" + back] == (flag, at - 39, "41M2D44M", 2) and found["inserted" + back] == (flag, at - 39, "41M2I46M", 2) and found["same" + back] == (flag, at - 39, "87M", 0)


@pytest.mark.parametrize("length, budget, bases", [(30, 3, 3 * 10**9), (30, 3, 4000), (72, 5, 10**6), (20, 9, 10**6), (500, 40, 10**9), (25, 0, 10**9)])
def test_plans_miss_nothing(length, budget, bases):
    p = seeds.plan(length, budget, bases)
    assert p.groups * (p.near + 1) > budget and p.groups * p.stretch <= length and p.k <= p.stretch  # so one stretch has `near` mismatches at most
    assert seeds.plan(3, 9, bases) is None


def every_placement(reads, contigs, budgets):
    out = set()
    for name, s in reads:
        for strand, own in ((0, s), (16, turned(s))):
            for rname, c in contigs:
                for p in range(len(c) - len(own) + 1):
                    mm = sum(a != b or a not in "ACGT" for a, b in zip(own, c[p : p + len(own)], strict=True))
                    if own and mm <= budgets[len(own)]:
                        out.add((name, strand, rname, p + 1, mm))
    return out


def repeated(r):
    unit = "".join(r.choices("ACGT", k=23))
    return [("c1", "".join(r.choices("ACGT", k=900)) + unit * 60 + "".join(r.choices("ACGT", k=400))), ("c2", "A" * 300 + "".join(r.choices("ACGTN", k=500))), ("c3", "ACG"), ("c4", "")]


def test_no_placement_is_missed(spark):
    """Against a comparison at every place, with tandem repeats, other letters, contig ends, and keys split into parts."""
    r = random.Random(5)
    contigs = repeated(r)
    reads = []
    for i in range(120):
        c = contigs[i % 2][1]
        n = r.choice((24, 30, 45, 70, 110))
        p = r.choice((0, len(c) - n, r.randint(0, len(c) - n)))
        s = list(c[p : p + n])
        for j in r.sample(range(n), r.randint(0, 4)):
            s[j] = r.choice("ACGTN")
        reads.append((f"r{i}", turned("".join(s)) if i % 3 else "".join(s)))
    table = spark.createDataFrame(contigs, "rname string, seq string")
    index = ReferenceIndex(table, heavy=16)
    budgets = {n: align.mismatch_budget(n, 0.01) for n in {len(s) for _, s in reads}}
    found = align.place_ancient(spark.createDataFrame(reads, "read_id string, seq string").repartition(3), table, index=index).collect()
    asked = every_placement(reads, contigs, budgets)
    assert len(found) == len(asked) > 200 and {tuple(x) for x in found} == asked
    assert index.table(6)[1].count() > 0  # some keys are heavy
    near = {n: seeds.Plan(b, (b + 2) // 2, n // ((b + 2) // 2), 1, 8) for n, b in budgets.items()}
    once = seeds.placed(index.hits(seeds.exact_seeds(spark.createDataFrame(reads, "read_id string, seq string"), near).withColumnRenamed("odd", "odd_read"), 8))
    some = {tuple(x) for x in once.where("mm is not null").select("read_id", "strand", "rname", "pos", "mm").collect()}
    sure = {x for x in asked if len(dict(reads)[x[0]]) <= 30 and "N" not in dict(reads)[x[0]] and x[2] == "c1"}
    assert some <= asked and sure <= some


def test_the_index_is_made_once_and_not_shuffled(spark, tmp_path):
    contigs = spark.createDataFrame([("c", "".join(random.Random(6).choices("ACGT", k=5000)))], "rname string, seq string")
    folder = (tmp_path / "index").as_uri()
    first = ReferenceIndex(contigs, folder)
    first.table(8)
    spark.sql(f"drop table {first.name(8)}")  # another session knows no table
    again = ReferenceIndex(contigs.repartition(3), folder)
    assert again.table(8)[0].count() == 5000 - 7 and first.made == ["k8w1"] and again.made == []
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    try:
        spark.conf.set(setting, "-1")
        table = again.table(8)[0]
        plan = spark.createDataFrame([(1, 5, 7)], "read_id long, key long, offset int").join(table, "key")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(setting, before)
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan and plan.count("Exchange") == 1  # the seeds' own
    other = ReferenceIndex(contigs.withColumn("seq", F.concat("seq", F.lit("A"))), folder)
    assert other._told[0] != first._told[0]


def test_tandem_repeat_keeps_tasks_even(spark):
    """A 50 kb tandem repeat: no index row group has more than about `heavy` places, and no hit is lost."""
    r = random.Random(7)
    unit = "".join(r.choices("ACGT", k=31))
    genome = "".join(r.choices("ACGT", k=4000)) + unit * 1600 + "".join(r.choices("ACGT", k=4000))
    contigs = spark.createDataFrame([("c", genome)], "rname string, seq string")
    reads = spark.createDataFrame([(i, (unit * 3)[i % 31 : i % 31 + 40]) for i in range(30)] + [(100 + i, genome[i * 90 : i * 90 + 40]) for i in range(30)], "read_id long, seq string")
    index = ReferenceIndex(contigs)
    found = align.place_ancient(reads, contigs, 0, index).groupBy("read_id").count().collect()
    counts = {x["read_id"]: x["count"] for x in found}
    assert len(counts) == 60 and all(1590 <= counts[i] <= 1600 for i in range(30)) and all(counts[100 + i] == 1 for i in range(30))
    light, heavy = index.table(seeds.plan(40, 0, len(genome)).k)
    assert light.where("rname is not null").groupBy("key").count().agg(F.max("count")).first()[0] <= 256
    sizes = [x["count"] for x in heavy.groupBy("key", "part").count().collect()]
    assert max(sizes) < 2 * 256 and len(sizes) > 31 * 5


def test_waves_and_the_filter_lose_nothing(spark, monkeypatch):
    """The same placements and alignments from reads in many waves; most seeds are never shuffled; a k-mer with another
    letter is found by a stretch that may have a mismatch."""
    r = random.Random(10)
    genome = "".join(r.choices("ACGT", k=30_000))
    genome = genome[:500] + "N" + genome[501:]
    contigs = spark.createDataFrame([("c", genome)], "rname string, seq string")
    starts = [470, 480, 490] + [r.randint(0, 29_900) for _ in range(200)]
    reads = [(i, "".join("ACGTN"[r.randint(0, 4)] if r.random() < 0.02 else b for b in genome[p : p + 48])) for i, p in enumerate(starts)]
    df, index = spark.createDataFrame(reads, "read_id long, seq string"), ReferenceIndex(contigs)
    told = lambda f: sorted(map(str, f(df, contigs, index=index).collect()))
    once = told(align.place_ancient), told(align.align_modern)
    budget = align.mismatch_budget(48, 0.01)
    mm = lambda p, s: sum(a != b or a == "N" for a, b in zip(s, genome[p : p + 48], strict=True))
    own = {(i, p + 1) for (i, s), p in zip(reads, starts, strict=True) if mm(p, s) <= budget}
    assert len(own) > 190 and own <= {(x["read_id"], x["pos"]) for x in align.place_ancient(df, contigs, index=index).collect()}
    assert len(list(stored.waves(df, 6000, 600))) == 10 and sum(part.count() for part in stored.waves(df, 6000, 600)) == len(reads)
    for module in (align, gapped):
        monkeypatch.setattr(module, "waves", lambda df, rows, most: stored.waves(df, 7, 1))
    assert (told(align.place_ancient), told(align.align_modern)) == once
    plans = {48: seeds.Plan(budget, 3, 16, 1, 11)}
    every, some = (seeds.exact_seeds(df, plans, known).withColumnRenamed("odd", "odd_read") for known in (None, {11: index.filter(11)}))
    assert some.count() < every.count() / 4
    assert own <= {(x["read_id"], x["pos"]) for x in seeds.placed(index.hits(some, 11)).collect()}


def test_reads_that_agree_whole_need_no_programme(monkeypatch):
    """The programme's own result for reads that agree in every base, at a tandem repeat's first place too."""
    r = random.Random(12)
    code = lambda s, n, fill: [("ACGT".find(c) if c in "ACGT" else 4) for c in s] + [fill] * (n - len(s))
    texts = []
    for i in range(80):
        ref = "".join(r.choices("ACGT", k=60)) if i % 3 else "ACGAC"[: r.randint(1, 5)] * 60
        own = ref[:60][(p := r.randint(0, 30)) : p + r.randint(10, 30)]
        texts.append((own if i % 4 else own[:5] + "N" + own[6:], ref[:60]))
    reads = np.array([code(a, 30, 4) for a, _ in texts], np.uint8)
    refs, sizes = np.array([code(b, 60, 5) for _, b in texts], np.uint8), np.array([len(a) for a, _ in texts])
    found, asked = [], []
    for out in (found, asked):
        out += [gapped.banded(reads, sizes, refs), gapped.banded(reads[1:2], sizes[1:2], refs[1:2])]
        monkeypatch.setattr(gapped, "_whole", lambda reads, *_: np.full(len(reads), -1))
    for a, b in zip(found, asked, strict=True):
        assert all(list(map(str, a[k])) == list(map(str, b[k])) for k in b)
    monkeypatch.undo()
    monkeypatch.setattr(gapped, "_lot", None)
    assert gapped.banded(reads[1:2], sizes[1:2], refs[1:2])["cigar"][0].as_py() == f"{sizes[1]}M"
