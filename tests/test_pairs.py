"""Placement by pair: repeats, rescue, insert sizes."""

import random

from readloom.operators import align, pairs

TURN = str.maketrans("ACGT", "TGCA")


def turned(s):
    return s[::-1].translate(TURN)


def test_pairs_with_repeats_and_rescue(spark):
    r = random.Random(9)
    again = "".join(r.choices("ACGT", k=200))
    part = lambda: "".join(r.choices("ACGT", k=1500))
    contigs = [("c1", part() + again + part() + again + part()), ("c2", part() + again + part())]
    starts = {"c1": (1500, 3200), "c2": (1500,)}
    rows, truth = [], {}

    def add(name, rname, p, n, kind="plain"):
        whole = dict(contigs)[rname][p : p + n]
        ends = [whole[:60], turned(whole[-60:])]
        if kind == "broken":  # a wrong base in every eleven leaves no seed
            ends[1] = "".join(("ACGT"["ACGT".index(b) - 1] if i % 11 == 5 else b) for i, b in enumerate(ends[1]))
        if kind == "lost":
            ends[1] = "".join(r.choices("ACGT", k=60))
        turn = r.random() < 0.5
        for mate, i in ((1, int(turn)), (2, 1 - int(turn))):
            rows.append((name, mate, ends[i]))
            if not (kind == "lost" and i == 1):
                truth[name, mate] = (16 if i else 0, rname, p + 1 if i == 0 else p + n - 60 + 1, kind)
            else:
                truth[name, mate] = (4, "*", 0, kind)

    for i in range(200):
        rname = r.choice(("c1", "c2"))
        add(f"plain{i}", rname, r.randint(0, len(dict(contigs)[rname]) - 240), r.randint(180, 240))
    for rname, at in starts.items():
        for a in at:
            for j in range(12):  # one end within a repeat, the other outside
                add(f"left{rname}{a}{j}", rname, a - 130 + j, 210)
                add(f"right{rname}{a}{j}", rname, a + 120 + j, 210)
    for i in range(20):
        add(f"broken{i}", "c1", 100 + 60 * i, 200, "broken")
        add(f"lost{i}", "c2", 100 + 60 * i, 200, "lost")
    reads = spark.createDataFrame(rows, "pair_id string, mate int, seq string").repartition(3)
    table = spark.createDataFrame(contigs, "rname string, seq string")
    found = {(x["pair_id"], x["mate"]): x for x in pairs.align_pairs(reads, table).collect()}
    assert len(found) == len(rows)
    for key, (flag, rname, pos, kind) in truth.items():
        x = found[key]
        assert (x["flag"], x["rname"], x["pos"]) == (flag, rname, pos) or kind == "broken" and abs(x["pos"] - pos) < 12 and x["flag"] == flag, (key, x)
        assert x["proper"] == (kind != "lost")
    alone = {x["read_id"]: x for x in align.align_modern(reads.selectExpr("pair_id || '/' || mate as read_id", "seq"), table).collect()}
    wrong = [k for k, v in truth.items() if (alone[f"{k[0]}/{k[1]}"]["rname"], alone[f"{k[0]}/{k[1]}"]["pos"]) != v[1:3] and v[3] == "plain"]
    assert len(wrong) >= 10 and all(k[0].startswith(("left", "right", "plain")) for k in wrong)  # by themselves, ends within repeats go astray
    broken = [x for (name, _), x in found.items() if name.startswith("broken") and x["mm"]]
    assert len(broken) == 20 and all(alone[f"{x['pair_id']}/{x['mate']}"]["flag"] == 4 for x in broken)  # found around their mates alone


def test_insert_sizes(spark):
    r = random.Random(10)
    rows = []
    for i in range(500):
        n = int(r.gauss(300, 20)) if i % 50 else 900
        rows += [(f"p{i}", 1, 0, "c", 1000, 1050), (f"p{i}", 2, 16, "c", 1000 + n - 51, 1000 + n - 1)]
    rows += [("far", 1, 0, "c", 1, 50), ("far", 2, 16, "c", 90_000, 90_050), ("turned", 1, 16, "c", 1, 50), ("turned", 2, 0, "c", 200, 250)]
    found = pairs.insert_sizes(spark.createDataFrame(rows, "pair_id string, mate int, strand int, rname string, pos long, end long"))
    assert abs(found.mean - 300) < 4 and abs(found.deviation - 20) < 4 and found.low < 240 and 360 < found.high < 600
    few = pairs.insert_sizes(spark.createDataFrame(rows[:4], "pair_id string, mate int, strand int, rname string, pos long, end long"))
    assert (few.low, few.high) == (1, 1000)
