"""Files in, files out."""

import gzip
import random

import pytest

from readloom.config import MappingConfig
from readloom.jobs.__main__ import config, parser
from readloom.jobs.mapping import MappingJob
from readloom.jobs.store import StageStore, with_retries
from readloom.operators import post, regions
from readloom.sources import fastq, manifest, reference, sam

TURN = str.maketrans("ACGT", "TGCA")


@pytest.fixture(scope="module")
def inputs(tmp_path_factory):
    """A genome, a paired and a single file, and where each read is from. The paired file's fragments of 160 bases
    don't overlap, those of 70 do; every tenth single read is from elsewhere."""
    d, r = tmp_path_factory.mktemp("run"), random.Random(5)
    genome = {"c1": "".join(r.choices("ACGT", k=2500)), "c2": "".join(r.choices("ACGT", k=1500))}
    (d / "ref.fa").write_text("".join(f">{k} some\n" + "\n".join(v[i : i + 60] for i in range(0, len(v), 60)) + "\n" for k, v in genome.items()))
    files = {"a_x": [], "a_y": [], "b": []}
    for i in range(120):
        c, n = r.choice(["c1", "c2"]), 160 if i % 2 else 70
        p = r.randint(0, len(genome[c]) - n)
        whole = genome[c][p : p + n]
        files["a_x"].append((f"p{i} 1:N", whole[:50])), files["a_y"].append((f"p{i} 2:N", whole[::-1].translate(TURN)[:50]))
        files["b"].append((f"s{i}", "".join(r.choices("ACGT", k=60)) if i % 10 == 0 else whole[:60]))
    for name, reads in files.items():
        with gzip.open(d / f"{name}.fastq.gz", "wt") as f:
            f.writelines(f"@{h}\n{s}\n+\n{'I' * len(s)}\n" for h, s in reads)
    (d / "list.txt").write_text("# files\n\n  a_x.fastq.gz \na_y.fastq.gz\nb.fastq.gz")
    return d


def make(spark, inputs, out, **more):
    return MappingJob(spark, MappingConfig("s1", str(inputs / "list.txt"), str(inputs / "ref.fa"), str(out), **more))


def test_sources(spark, inputs, tmp_path):
    assert [p.rsplit("/", 1)[1] for p in MappingJob(spark, MappingConfig("s", str(inputs / "list.txt"))).paths()] == ["a_x.fastq.gz", "a_y.fastq.gz", "b.fastq.gz"]
    reads = fastq.read_fastq(spark, [str(inputs / "b.fastq.gz"), str(inputs / "a_x.fastq.gz")])
    assert reads.count() == 240 and reads.where("ordinal = 0").count() == 2 and reads.agg({"ordinal": "max"}).first()[0] == 119
    contigs = reference.lengths(reference.read_fasta(spark, str(inputs / "ref.fa"))).orderBy("tid").collect()
    assert [(c["tid"], c["rname"], c["length"]) for c in contigs] == [(0, "c1", 2500), (1, "c2", 1500)]
    (tmp_path / "cut.fastq").write_text("@a\nAC\n+\n")
    with pytest.raises(Exception, match="multiple of four"):
        fastq.read_fastq(spark, [str(tmp_path / "cut.fastq")]).count()
    (tmp_path / "broken.gz").write_bytes((inputs / "b.fastq.gz").read_bytes()[:-20])
    with pytest.raises(Exception):
        manifest.check_gzip(spark, [str(tmp_path / "broken.gz")])
    (tmp_path / "none.txt").write_text("# nothing\n")
    with pytest.raises(ValueError):
        manifest.read_manifest(spark, str(tmp_path / "none.txt"))


def test_readers_under_small_splits(spark, tmp_path):
    r = random.Random(9)
    reads = [(f"r{i} 1:N", "".join(r.choices("ACGT", k=(n := r.randint(1, 90)))), "".join(r.choices("@+>I", k=n))) for i in range(900)]
    for name, part in (("a", reads), ("b", reads[:7])):
        (tmp_path / f"{name}.fastq").write_text("".join(f"@{h}\n{s}\n+\n{q}\n" for h, s, q in part))
    contigs = {f"c{i}": "".join(r.choices("ACGTacgt", k=n)) for i, n in enumerate([5000, 1, 777, 0, 90_000])}
    (tmp_path / "ref.fa").write_text("".join(f">{k} x\n" + "\n".join([v] if len(v) > 50_000 else [v[i : i + 60] for i in range(0, len(v), 60)]) + "\n" for k, v in contigs.items()))
    setting = "spark.sql.files.maxPartitionBytes"
    before, batch = spark.conf.get(setting), spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set(setting, "2000b")
        lines = spark.read.text(str(tmp_path / "a.fastq"))
        assert lines.rdd.getNumPartitions() > 10
        found = fastq.read_fastq(spark, [str(tmp_path / f"{x}.fastq") for x in "ab"]).collect()
        assert {(x["path"][-7], x["ordinal"], x["header"], x["seq"], x["qual"]) for x in found} == {(n, i, f"@{h}", s, q) for n, own in (("a", reads), ("b", reads[:7])) for i, (h, s, q) in enumerate(own)}
        assert len(found) == 907
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
        few = fastq.read_fastq(spark, [str(tmp_path / f"{x}.fastq") for x in "ab"]).collect()
        assert sorted(few) == sorted(found)
        for _ in range(2):  # the second time in batches of seven lines
            lines = reference.read_fasta(spark, str(tmp_path / "ref.fa"))
            rows = sorted(lines.collect(), key=lambda x: (x["tid"], x["offset"], x["bases"]))
            whole = {}
            for x in rows:
                assert len(whole.setdefault((x["tid"], x["rname"]), "")) == x["offset"]
                whole[x["tid"], x["rname"]] += x["bases"]
            assert list(whole.items()) == [((i, k), v.upper()) for i, (k, v) in enumerate(contigs.items())]
            assert {tuple(x) for x in reference.lengths(lines).collect()} == {(i, k, len(v)) for i, (k, v) in enumerate(contigs.items())}
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
        pieces = {(x["rname"], x["window"]): (x["start"], x["bases"]) for x in reference.windows(lines, 100, 45).collect()}
        assert pieces == {(k, w): (100 * w + 1, v.upper()[100 * w : 100 * w + 145]) for k, v in contigs.items() for w in range(-(-len(v) // 100))}
    finally:
        spark.conf.set(setting, before)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)


def test_reads_are_put_together_where_they_lie(spark, inputs):
    plan = fastq.read_fastq(spark, [str(inputs / "b.fastq.gz")])._jdf.queryExecution().executedPlan().toString()
    after = plan[: plan.index("BroadcastExchange")]
    assert "MapInArrow" in after and "hashpartitioning" not in after  # only the table of splits is shuffled


@pytest.mark.parametrize("library", ["modern", "ancient-all", "ancient-fast"])
def test_run(spark, inputs, tmp_path, library):
    job = make(spark, inputs, tmp_path, library_type=library, emit_unmapped=True, damage=True)
    assert job.validate() == 3 * 480
    row = job.run().first()
    assert row["seq_mode"] == "MIX" and row["raw_fragments"] == 240 and row["raw_R2_reads"] == 120 and row["merged_reads"] == 60
    assert row["trimmed_fragments"] == 240 and row["unpaired_reads"] == 0
    assert row["mapped_fragments_all"] == (168 if library == "ancient-fast" else 228)
    assert row["mapped_reads_all"] >= row["mapped_reads_unique"] > 0 and row["mapped_fragments_all"] >= row["mapped_fragments_unique"]
    reads = sam.read_sam(spark, f"{tmp_path}/s1.final.RG.sam/*/*.txt")
    assert reads.count() == spark.read.parquet(f"{tmp_path}/s1.final.RG").count() == row["mapped_reads_unique"]
    assert reads.where("tags['RG'] = 'Z:s1'").count() == reads.count()
    with_lost = spark.read.text(f"{tmp_path}/s1.unmapped.SE").count()
    assert with_lost == 12 * 4
    again = make(spark, inputs, tmp_path, library_type=library)
    assert again.run().first() == row and {"reads", "trimmed", "aligned", "marked"} <= set(again.store.reused)
    stricter = make(spark, inputs, tmp_path, library_type=library, min_mapq=61)
    assert stricter.run().first()["mapped_reads_all"] == 0 and "marked" not in stricter.store.reused


def test_a_broken_run_maps_only_what_is_left(spark, inputs, tmp_path, monkeypatch):
    asked, align_ = [], MappingJob.align

    def broken(self, part, lines):
        asked.append({(x["unit_id"], x["chunk_id"]) for x in part.select("unit_id", "chunk_id").distinct().collect()})
        if len(asked) == 2:
            raise RuntimeError("the machine stops")
        return align_(self, part, lines)

    monkeypatch.setattr("readloom.jobs.mapping._WAVES", 2)
    monkeypatch.setattr(MappingJob, "align", broken)
    settings = {"library_type": "ancient-all", "chunk_reads": 60}
    with pytest.raises(RuntimeError):
        make(spark, inputs, tmp_path, **settings).run()
    first = asked[0]
    row = make(spark, inputs, tmp_path, **settings).run().first()
    every = {(unit, f"000{i}") for unit in ("PE0001", "SE0001") for i in range(2)}
    assert len(first) == 2 and set().union(*asked[2:]) == every - first
    assert row["mapped_fragments_all"] == 228  # as in one go
    assert len(spark.read.csv(f"{tmp_path}/s1.chunks", sep="\t", header=True).collect()) == 4


def test_sam_is_in_coordinate_order(spark, tmp_path):
    """Whatever the sizes of the range partitions and of the files."""
    r = random.Random(3)
    place = lambda i: (r.choice(("c1", "c0")), r.randint(1, 40) if i % 3 else r.randint(1, 100_000))
    rows = [(f"r{i}", 0, *place(i), 30, "4M", "*", 0, 0, "ACGT" * (1 + i % 50), "IIII" * (1 + i % 50), {"NM": "i:0"}) for i in range(20_000)]
    df = spark.createDataFrame(rows, "qname string, flag int, rname string, pos long, mapq int, cigar string, rnext string, pnext long, tlen long, seq string, qual string, tags map<string, string>")
    contigs = spark.createDataFrame([(0, "c1", 100_100), (1, "c0", 100_100)], "tid int, rname string, length long")
    sam.write_sam(post.coordinate_sorted(df, contigs, 6), contigs, str(tmp_path / "out.sam"), "s")
    lines = [line for f in sorted((tmp_path / "out.sam" / "reads").glob("part-*")) for line in f.read_text().splitlines()]
    places = [(("c1", "c0").index(line.split("\t")[2]), int(line.split("\t")[3])) for line in lines]
    assert len(lines) == 20_000 and places == sorted(places) and len(list((tmp_path / "out.sam" / "reads").glob("part-*"))) > 3


def test_regions_open_only_their_files(spark, tmp_path):
    r = random.Random(8)
    rows = [(f"r{i}", 4 if i % 40 == 0 else 0, *(("*", 0) if i % 40 == 0 else (r.choice(("c1", "c0")), r.randint(1, 200_000))), r.choice(("50M", "20M30000N30M", "10S40M"))) for i in range(8000)]
    df = spark.createDataFrame(rows, "qname string, flag int, rname string, pos long, cigar string")
    contigs = spark.createDataFrame([(0, "c1"), (1, "c0")], "tid int, rname string")
    path = str(tmp_path / "final")
    regions.write_regions(post.coordinate_sorted(df, contigs, 16), path)
    reach = {"50M": 50, "20M30000N30M": 30_050, "10S40M": 40}
    for rname, start, end in (("c0", 1, 10), ("c1", 90_000, 90_100), ("c0", 199_990, 300_000), ("c1", 400_000, 500_000), ("none", 1, 9)):
        found = regions.region(spark, path, rname, start, end)
        asked = {x[0] for x in rows if x[2] == rname and x[3] <= end and x[3] + reach[x[4]] - 1 >= start}
        assert {x["qname"] for x in found.collect()} == asked
        assert len(found.inputFiles()) <= (6 if asked else 1)
    assert len(list((tmp_path / "final").glob("part-*"))) > 12


def test_unmapped_mates_are_in_step(spark, tmp_path):
    """Over several files and units that share names, with names that repeat within a unit and reads alone."""
    r, rows = random.Random(6), []
    for i in range(3000):
        unit, name = f"u{i % 3}", f"p{i // 3 if i % 50 else 7}"
        for mate in (1, 2) if i % 10 else (1,):
            seq = "".join(r.choices("ACGT", k=r.randint(1, 200 if i < 500 else 20)))
            rows.append((unit, name, (77, 141)[mate - 1], f"{mate}{seq}", "I" * (len(seq) + 1)))
    df = spark.createDataFrame(rows, "unit_id string, qname string, flag int, seq string, qual string").repartition(5)
    by = ("unit_id", "qname")
    pairs = post.unmapped_pairs(post.route_unmapped(df, by=by), by)
    partitions = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        fastq.write_pairs(pairs, str(tmp_path / "x"), by)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", partitions)

    def records(stream):
        files = [gzip.open(f, "rt").read().splitlines() for f in sorted((tmp_path / f"x.{stream}").glob("part-*"))]
        return [[tuple(f[i : i + 4]) for i in range(0, len(f), 4)] for f in files]

    one, two, alone = (records(s) for s in ("R1", "R2", "SE"))
    assert len(one) == len(two) > 3 and [[x[0] for x in f] for f in one] == [[x[0] for x in f] for f in two]
    assert sorted(x[1] for part in (one, two, alone) for f in part for x in f) == sorted(row[3] for row in rows)
    assert all(x[1][0] == "1" for f in one for x in f) and all(x[1][0] == "2" for f in two for x in f) and sum(map(len, alone)) >= 200
    fastq.write_pairs(pairs.where("false"), str(tmp_path / "x"), by)
    assert [sum(map(len, records(s))) for s in ("R1", "R2", "SE")] == [0, 0, 0] and all(list((tmp_path / f"x.{s}").glob("part-*")) for s in ("R1", "R2", "SE"))


def test_trim_only_and_pilot(spark, inputs, tmp_path):
    job = make(spark, inputs, tmp_path, trim_only=True, pilot_fragments=7)
    row = job.run().first()
    assert row["raw_fragments"] == 14 and row["mapped_bp"] == 0 and len(row) == 22
    job.reset()
    assert not list(tmp_path.glob("*.stages"))


def test_files_of_one_name_and_changed_files(spark, inputs, tmp_path):
    for lane, names in (("lane 1", "ab"), ("lane2", "ab")):
        (tmp_path / lane).mkdir()
        for name in names:
            (tmp_path / lane / f"{name}.fastq").write_text("".join(f"@{lane[-1]}{i} {'12'['ab'.index(name)]}:N\n{'ACGTTGCA' * 6}\n+\n{'I' * 48}\n" for i in range(6)))
    (tmp_path / "list.txt").write_text("lane 1/a.fastq\nlane 1/b.fastq\nlane2/a.fastq\nlane2/b.fastq\n")
    job = lambda: MappingJob(spark, MappingConfig("s1", str(tmp_path / "list.txt"), outdir=str(tmp_path / "out"), trim_only=True))
    first = job()
    assert first.run().first()["raw_fragments"] == 12 and first.store.reused == []
    again = job()
    assert again.run().first()["raw_fragments"] == 12 and set(again.store.reused) == {"reads", "trimmed", "raw-counts"}
    for name in "ab":
        path = tmp_path / "lane2" / f"{name}.fastq"
        path.write_text("".join(path.read_text().splitlines(True)[:-4]))
    changed = job()
    assert changed.run().first()["raw_fragments"] == 11 and changed.store.reused == []
    (tmp_path / "list.txt").write_text("lane2/a.fastq\nlane2/b.fastq\nlane2/a.fastq\n")
    with pytest.raises(ValueError, match="twice"):
        job().run()


def test_store_ignores_what_is_not_whole(spark, tmp_path):
    store = StageStore(spark, str(tmp_path / "x"))
    store.run("a", "k", lambda: spark.range(3))
    assert store.run("a", "k", lambda: spark.range(5)).count() == 3
    (tmp_path / "x" / "a-k" / "_SUCCESS").unlink()
    assert store.run("a", "k", lambda: spark.range(5)).count() == 5
    assert with_retries(lambda: True) and not with_retries(lambda: False, 2, 0)


def test_command_line():
    c = config(parser().parse_args("--manifest m --prefix p --ref r --outdir o --library-type ancient-all --mapq 7 --no-resume --trim-only --no-mapdamage".split()))
    assert (c.sample, c.min_mapq, c.resume, c.trim_only, c.library_type) == ("p", 7, False, True, "ancient-all")
    with pytest.raises(SystemExit) as e:
        parser().parse_args(["--prefix", "p"])
    assert e.value.code == 2


def test_late_rows_are_left_out(spark, tmp_path):
    from readloom.streaming import arrivals

    rows = [("2024-01-01 00:00:10", 1.0), ("2024-01-01 00:07:00", 2.0), ("2024-01-01 01:00:00", 4.0)]
    for i, (ts, v) in enumerate([*rows, ("2024-01-01 00:00:20", 8.0), ("2024-01-01 03:00:00", 16.0)]):
        spark.createDataFrame([(ts, v)], "t string, value double").selectExpr("to_timestamp(t) as ts", "value").coalesce(1).write.mode("append").parquet(str(tmp_path / f"in{i}"))
    stream = arrivals.arriving(spark, str(tmp_path / "in*"), spark.read.parquet(str(tmp_path / "in0")).schema, 1)
    out = arrivals.counts_by_window(stream, "ts", "5 minutes", "10 minutes")
    query = out.writeStream.outputMode("append").format("memory").queryName("late").trigger(availableNow=True).start()
    query.awaitTermination()
    found = spark.table("late").collect()
    assert sum(r["n"] for r in found) >= 3 and all(r["total"] in (1.0, 2.0, 4.0, 9.0) for r in found)
