"""Every operator as a query over the given tables, each with SQL that says the same.

The tables hold no reads, so files, reads and alignments are projections of events, lineitem, orders and part. Their
SQL runs on both engines; operators are DataFrames on one side and SQL on the other.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.functions import alignment as A
from readloom.functions import headers as H
from readloom.operators import adapters, align, coverage, damage, limits, pairing, pairs, post, regions, stats, trim
from readloom.operators import reports as trim_reports
from readloom.operators.stored import shared_folder, stored
from readloom.sources import manifest, reports
from readloom.sources.reference import windows
from readloom.streaming import arrivals

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def _s(x: str) -> str:
    return f"cast({x} as varchar(40))"


def _dna(x: str) -> str:
    return f"translate(md5({x}), '0123456789abcdef', 'ACGTACGTACGTACGT')"


def _joined(*parts: str) -> str:
    return " || ':' || ".join(_s(p) for p in parts)


_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "cast(round(l_extendedprice * 100) as bigint)")
_LENGTH = "cast(20 + 6 * l_linenumber as int)"

VIEWS = {
    "listed": f"""select event_id as idx, case when event_type = 'error' then '# left out ' || {_s("event_id")} when event_id % 50 = 0 then ' '
      else '  run' || {_s("user_id")} || '/reads' || {_s("event_id")} || '.fastq.gz ' end as line from {{events}}""",
    # every event is a file; views and clicks, signups and purchases, and up to three errors of a user share names
    "headers": f"""select event_id as idx, case event_type when 'view' then '@A' || {_s("user_id")} || '.' || {_s("nth")} || ' 1:N:0' when 'click' then '@A' || {_s("user_id")} || '.' || {_s("nth")} || ' 2:N:0'
        when 'signup' then '@B' || {_s("user_id")} || '.' || {_s("nth")} || '/1' when 'purchase' then '@B' || {_s("user_id")} || '.' || {_s("nth")} || '/2 len=4'
        else '@SRR' || {_s("user_id")} || '.' || {_s("cast(ceil(nth / cast(1 + user_id % 3 as double)) as bigint)")} || ' 1 length=90' end as header,
      case event_type when 'error' then '@SRR' || {_s("user_id")} || '.2 2 length=90' else '@next 1' end as header2, cast(100 + event_id % 2 as bigint) as reads
      from (select *, row_number() over (partition by user_id, event_type order by event_id) as nth from {{events}}) e""",
    "reads": f"""select 'U' || {_s("l_suppkey % 20")} as unit_id, case when l_suppkey % 20 < 10 then 'PE' else 'SE' end as kind,
      cast(case when l_suppkey % 20 < 10 then 1 + l_linenumber % 2 else 1 end as int) as mate, l_returnflag, l_linestatus,
      cast(row_number() over (partition by l_suppkey % 20 order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 as bigint) as ordinal,
      {_joined("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")} as qname,
      substr({_dna("'a' || " + _s("l_partkey"))} || {_dna("'b' || " + _s("l_orderkey"))}, 1, {_LENGTH}) || case when l_linenumber = 1 then 'GGGGGGGGGGGGGG' else '' end as seq,
      substr(repeat(translate(md5('q' || {_joined("l_orderkey", "l_linenumber", "l_partkey")}), '0123456789abcdef',
        case when l_linenumber % 4 = 3 then '!!!!!!!!++5?IIII' else '!+5?IIIIIIIIIIII' end), 3), 1, {_LENGTH} + case when l_linenumber = 1 then 14 else 0 end) as qual
      from {{lineitem}}""",
    "trimmed": """select unit_id, ordinal, mate, qname, seq, qual, case when l_returnflag = 'A' then 'merged' when l_returnflag = 'N' then 'unmerged'
      when l_linestatus = 'F' then 'unpaired1' else 'unpaired2' end as read_class from {reads}""",
    "alignments": f"""select {_joined(*_KEY)} as qname,
      cast(case when l_linenumber % 3 = 0 then 4 else 0 end + case when l_returnflag = 'R' then 16 else 0 end
        + case when l_linestatus = 'F' then 1 + case when l_linenumber % 2 = 1 then 64 else 128 end else 0 end + case when l_suppkey % 50 = 0 then 256 else 0 end as int) as flag,
      'chr' || {_s("l_suppkey % 5")} as rname, cast(l_partkey % 1000 + 1 as bigint) as pos, cast(l_quantity as int) as mapq,
      {_s("cast(30 + 5 * l_linenumber as int)")} || 'M' as cigar, repeat('A', cast(30 + 5 * l_linenumber as int)) as seq,
      substr(repeat(translate(md5('q' || {_joined("l_orderkey", "l_linenumber")}), '0123456789abcdef', '!+5?IIIIIIIIIIII'), 3), 1, cast(30 + 5 * l_linenumber as int)) as qual, cast(30 + 5 * l_linenumber as bigint) as readlen,
      cast(round(l_extendedprice * 100) as bigint) as score, 'U' || {_s("l_suppkey % 20")} as unit_id from {{lineitem}}""",
    "pairs": f"""select 'o' || {_s("o_orderkey")} as qname, cast(case when m = 1 then 99 else 147 end as int) as flag, 'chr' || {_s("o_custkey % 5")} as rname,
      cast(case when m = 1 then o_custkey % 500 + 1 else o_custkey % 500 + 51 + (o_orderkey % 3) * 10 end as bigint) as pos,
      cast(case when m = 1 then o_orderkey % 60 else (o_orderkey * 7) % 60 end as int) as mapq, '40M' as cigar, cast(round(o_totalprice) as bigint) as score
      from {{orders}} cross join (select 1 as m union all select 2 as m) mates""",
    "lost": f"""select 'o' || {_s("o_orderkey")} as qname, cast(case o_custkey % 3 when 0 then case when m = 1 then 77 else 141 end when 1 then case when m = 1 then 73 else 149 end
        else case when m = 1 then 4 else 0 end end as int) as flag, substr({_dna(_s("o_orderkey"))}, m, 20) as seq, '!+5?IIIIIIIIIIIIIII!' as qual
      from {{orders}} cross join (select 1 as m union all select 2 as m) mates""",
    # an order is a pair: its mates stand at one place of a unit's two files and share a name, but for one in 97
    "mated": f"""select 'U' || {_s("o_orderkey % 20")} as unit_id, m as mate, cast(floor(o_orderkey / 20.0) as bigint) as ordinal,
      case when m = 2 and o_orderkey % 97 = 0 then 'x' else 'o' end || {_s("o_orderkey")} as qname,
      substr({_dna(_joined("o_orderkey", "m"))}, 1, cast(20 + o_custkey % 12 as int)) as seq, repeat('I', cast(20 + o_custkey % 12 as int)) as qual
      from {{orders}} cross join (select 1 as m union all select 2 as m) mates where o_orderkey % 89 <> 0 or m = 1""",
    # single reads of all units under fifty names
    "shared": f"select 'r' || {_s('score % 50')} as qname, cast(flag & 20 as int) as flag, rname, pos, cigar, readlen, score, unit_id from {{alignments}}",
    "contigs": f"select n_nationkey as tid, 'chr' || {_s('n_nationkey')} as rname, cast(1100 as bigint) as length from {{nation}} where n_nationkey < 7",
}
#: The genome and reads cut from it. Every part is 32 bases, in the order of its key, of which none is left out.
GENOME = {
    "spark": f"select 'chr' || {_s('p_partkey % 4')} as rname, p_partkey div 4 * 32 as offset, {_dna(_s('p_partkey'))} as bases from {{part}}",
    "duckdb": f"select rname, length(seq) as length, seq from (select 'chr' || {_s('p_partkey % 4')} as rname, string_agg({_dna(_s('p_partkey'))}, '' order by p_partkey) as seq from {{part}} group by 1)",
}
#: A genome in which two blocks after one another, 64 bases, come back every hundred; and both ends, of 40 bases, of
#: fragments of 150 to 190 from it.
_BLOCK = f"md5(case when cast(floor(p_partkey / 4.0) as bigint) % 100 in (3, 4) then 'again' || {_s('cast(floor(p_partkey / 4.0) as bigint) % 100')} else {_s('p_partkey')} end)"
REPEATS = {k: v.replace(_dna(_s("p_partkey")), f"translate({_BLOCK}, '0123456789abcdef', 'ACGTACGTACGTACGT')") for k, v in GENOME.items()}
FRAGMENTS = f"""select {_s("o_orderkey")} as pair_id, o_orderkey % 2 = 0 as ahead, g.rname, cast((o_custkey * 7919 + o_orderkey * 31) % (g.length - 200) + 1 as bigint) as pos,
  cast(150 + o_orderkey % 5 * 10 as int) as n from {{orders}} o join {{repeats}} g on g.rname = 'chr' || {_s("o_custkey % 4")}"""
CUT = f"""select {_joined(*_KEY)} as read_id, g.rname, l_linenumber, cast((l_partkey * 37 + l_orderkey * 11) % (g.length - 80) + 1 as bigint) as pos,
  cast(case when l_returnflag = 'R' then 16 else 0 end as int) as flag,
  substr(g.seq, cast((l_partkey * 37 + l_orderkey * 11) % (g.length - 80) + 1 as int), cast(30 + 6 * l_linenumber as int)) as reference
  from {{lineitem}} l join {{genome}} g on g.rname = 'chr' || {_s("l_partkey % 4")}"""
#: On Spark the reads are cut from short pieces of the contigs, as a place in a long string is walked to.
PLACES = CUT.replace("substr(g.seq, cast((l_partkey * 37 + l_orderkey * 11) % (g.length - 80) + 1 as int), cast(30 + 6 * l_linenumber as int)) as reference", "cast(30 + 6 * l_linenumber as int) as n")
_DAMAGED = "case when l_linenumber % 2 = 0 and substr(reference, 1, 1) = 'C' then 'T' || substr(reference, 2) else reference end"


def _lengths(lines: DataFrame) -> DataFrame:
    return lines.groupBy("rname").agg(F.max(F.col("offset") + F.length("bases")).cast("long").alias("length"))


class Views:
    """The views of one folder of tables, as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        if name == "cut":
            return self._cut()
        if name == "repeats":
            return self.spark.sql(REPEATS["spark"], part=self.part)
        sql = GENOME["spark"] if name == "genome" else VIEWS[name]
        used = {t: getattr(self, t) for t in (*TABLES, *VIEWS, "genome") if f"{{{t}}}" in sql}
        return self.spark.sql(sql, **used)

    def _cut(self) -> DataFrame:
        placed = self.spark.sql(PLACES, lineitem=self.lineitem, genome=_lengths(self.genome))
        pieces = windows(self.genome, align.STEP, 80).select("rname", "window", "start", "bases")
        at = placed.withColumn("window", F.expr(f"cast((pos - 1) div {align.STEP} as int)")).join(pieces, ["rname", "window"])
        reference = F.expr("substring(bases, cast(pos - start + 1 as int), n)").alias("reference")
        return at.select("read_id", "rname", "l_linenumber", "pos", "flag", reference)

    def ends(self) -> DataFrame:
        """pair_id, mate, seq of both ends of fragments of the genome with repeats."""
        fragments = self.spark.sql(FRAGMENTS, orders=self.orders, repeats=_lengths(self.repeats))
        pieces = windows(self.repeats, align.STEP, 200).select("rname", "window", "start", "bases")
        at = fragments.withColumn("window", F.expr(f"cast((pos - 1) div {align.STEP} as int)")).join(pieces, ["rname", "window"])
        whole = at.withColumn("bases", F.expr("substring(bases, cast(pos - start + 1 as int), n)"))
        left, right = F.left("bases", F.lit(40)), A.reverse_complement(F.right("bases", F.lit(40)))
        mate = F.explode(F.array(F.struct(F.lit(1).alias("mate"), F.when(F.col("ahead"), left).otherwise(right).alias("seq")), F.struct(F.lit(2).alias("mate"), F.when(F.col("ahead"), right).otherwise(left).alias("seq"))))
        return whole.select("pair_id", mate.alias("m")).select("pair_id", "m.*")

    def headers_described(self) -> DataFrame:
        h = self.headers
        return pairing.describe(h.select("idx", "header", F.array("header", "header2").alias("header_sample"), "reads"))


def _with(*names: str, body: str) -> str:
    """SQL of a query over views."""
    parts = []
    for n in names:
        sql = GENOME["duckdb"] if n == "genome" else CUT if n == "cut" else VIEWS[n]
        parts.append(f"{n} as ({sql.format(**{t: t for t in (*TABLES, *VIEWS, 'genome')})})")
    return f"with {', '.join(parts)} {body}" if parts else body


@dataclass
class Registry:
    made: dict[str, Callable[[SparkSession, str], DataFrame]] = field(default_factory=dict)
    sql: dict[str, str] = field(default_factory=dict)

    def add(self, name: str, make: Callable[[Views], DataFrame], sql: str | None = None) -> None:
        self.made[name] = lambda spark, sf_dir: make(Views(spark, sf_dir))
        if sql:
            self.sql[name] = sql


R = Registry()

# --- headers and files ------------------------------------------------------------------------------------------

R.add("manifest_scan", lambda v: manifest.entries(v.listed, "/data"),
      _with("listed", body="select idx, '/data/' || trim(line) as path from listed where trim(line) <> '' and trim(line) not like '#%'"))

_QNAME = r"regexp_replace(regexp_replace(regexp_replace(split_part(header, ' ', 1), '^@', ''), '/1$', ''), '/2$', '')"
_DIRECTION = """case when header like '% 1:%' then 'R1' when header like '% 2:%' then 'R2' when split_part(header, ' ', 2) like '%/1' then 'R1' when split_part(header, ' ', 2) like '%/2' then 'R2'
  when split_part(header, ' ', 1) like '%/1' then 'R1' when split_part(header, ' ', 1) like '%/2' then 'R2'
  when split_part(header, ' ', 2) in ('1', '2') and split_part(header2, ' ', 2) = split_part(header, ' ', 2) then 'R' || split_part(header, ' ', 2) else 'UNKNOWN' end"""
_FILES = f"files as (select idx, {_QNAME} as key, {_DIRECTION} as direction, reads from headers)"
_BY = """by_key as (select key, count(*) filter (direction = 'R1') as n1, count(*) filter (direction = 'R2') as n2, count(*) filter (direction = 'UNKNOWN') as n0,
  min(idx) filter (direction = 'R1') as i1, min(idx) filter (direction = 'R2') as i2, min(idx) filter (direction = 'UNKNOWN') as u1, max(idx) filter (direction = 'UNKNOWN') as u2 from files group by key)"""
_UNITS = """units as (select kind || case when nth < 1000 then lpad(cast(nth as varchar), 4, '0') else cast(nth as varchar) end as unit_id, kind, key, idx1, idx2 from (select *, row_number() over (partition by kind order by idx1) as nth from (
  select key, case when n2 = 1 then 'PE' else 'SE' end as kind, i1 as idx1, i2 as idx2 from by_key where n1 = 1
  union all select key, case when n0 = 2 then 'PE' else 'SE' end, u1, case when n0 = 2 then u2 end from by_key where n0 between 1 and 2) u) w)"""


def _files(body: str) -> str:
    return _with("headers", body=f", {_FILES}, {_BY}, {_UNITS} {body}")


R.add("header_classify", lambda v: v.headers_described().select("idx", "direction"), _files("select idx, direction from files"))
R.add("qname_normalize", lambda v: v.headers.select("idx", H.qname(F.col("header")).alias("key")), _files("select idx, key from files"))
R.add("header_sample_consistency", lambda v: v.headers.select("idx", F.forall(F.array("header", "header2"), lambda h: F.split_part(h, F.lit(" "), F.lit(2)) == F.split_part("header", F.lit(" "), F.lit(2))).alias("steady")),
      _with("headers", body="select idx, split_part(header, ' ', 2) = split_part(header2, ' ', 2) as steady from headers"))
R.add("unit_pairing", lambda v: pairing.units(v.headers_described()), _files("select unit_id, kind, key, idx1, idx2 from units"))
R.add("pair_conflicts", lambda v: pairing.conflicts(v.headers_described()), _files(
    """select * from (select key, case when n1 > 1 then 'two R1' when n2 > 1 then 'two R2' when n2 = 1 and n1 = 0 then 'R2 without R1' when n0 > 2 then 'over two unmarked'
       when n0 = 2 and n1 + n2 > 0 then 'unmarked pair of a marked key' end as problem from by_key) p where problem is not null"""))  # fmt: skip
R.add("unit_orphans", lambda v: pairing.orphans(v.headers_described()), _files(
    "select key, idx from files f where direction = 'R2' and not exists (select 1 from files g where g.key = f.key and g.direction = 'R1')"))
R.add("seq_mode", lambda v: pairing.sequencing_mode(pairing.units(v.headers_described())), _files(
    """select case when count(*) filter (kind = 'PE') > 0 and count(*) filter (kind = 'SE') > 0 then 'MIX' when count(*) filter (kind = 'PE') > 0 then 'PE' else 'SE' end as seq_mode,
       count(*) filter (kind = 'PE') as pe_units, count(*) filter (kind = 'SE') as se_units from units"""))  # fmt: skip
R.add("count_mismatch", lambda v: pairing.count_mismatches(pairing.units(v.headers_described()), v.headers.select("idx", "reads")), _files(
    "select unit_id, a.reads as reads1, b.reads as reads2 from units join files a on a.idx = idx1 join files b on b.idx = idx2 where a.reads <> b.reads"))
R.add("json_first_int", lambda v: v.events.select("event_id", reports.first_int(F.col("props"), "missing.part", "k", "other").alias("n")),
      """select event_id, coalesce(nullif(try_cast(json_extract_string(props, '$.missing.part') as bigint), 0), nullif(try_cast(json_extract_string(props, '$.k') as bigint), 0),
         nullif(try_cast(json_extract_string(props, '$.other') as bigint), 0), 0) as n from events""")  # fmt: skip

# --- chunks, pilots, mates --------------------------------------------------------------------------------------

_CHUNK = "case when ordinal // 500 < 10000 then lpad(cast(ordinal // 500 as varchar), 4, '0') else cast(ordinal // 500 as varchar) end"
_chunked = lambda v: v.reads.withColumn("chunk_id", limits.chunk_id(F.col("ordinal"), 500))
R.add("read_counts", lambda v: limits.read_counts(v.reads, "unit_id"), _with("reads", body="select unit_id, count(*) as reads from reads group by unit_id"))
R.add("chunk_assign", lambda v: _chunked(v).select("unit_id", "ordinal", "chunk_id"), _with("reads", body=f"select unit_id, ordinal, {_CHUNK} as chunk_id from reads"))
R.add("chunk_ids", lambda v: limits.chunk_ids(_chunked(v)), _with("reads", body=f"select distinct unit_id, {_CHUNK} as chunk_id from reads"))
R.add("pilot_limit", lambda v: limits.pilot(v.reads, 100).select("unit_id", "ordinal", "qname"), _with("reads", body="select unit_id, ordinal, qname from reads where ordinal < 100"))
R.add("pilot_budget_by_chunk", lambda v: limits.pilot_budget(limits.read_counts(_chunked(v), "unit_id", "chunk_id"), 1200), _with("reads", body=f"""
    , chunks as (select unit_id, {_CHUNK} as chunk_id, count(*) as reads from reads group by 1, 2),
    b as (select *, greatest(1200 - coalesce(sum(reads) over (partition by unit_id order by chunk_id rows between unbounded preceding and 1 preceding), 0), 0) as budget from chunks)
    select unit_id, chunk_id, reads, cast(least(reads, budget) as bigint) as take, cast(greatest(budget - reads, 0) as bigint) as left_over from b"""))  # fmt: skip


_mates = lambda v: limits.mates(v.mated.where("mate = 1"), v.mated.where("mate = 2"))
_MATES = """, m as (select unit_id, ordinal, max(case when mate = 1 then qname end) as qname1, max(case when mate = 1 then seq end) as seq1,
    max(case when mate = 2 then qname end) as qname2, max(case when mate = 2 then seq end) as seq2
  from mated group by unit_id, ordinal having count(*) = 2)"""
R.add("mate_join", lambda v: _mates(v).select("unit_id", "ordinal", "qname1", "seq1", "qname2", "seq2"), _with("mated", body=f"{_MATES} select * from m"))
R.add("mate_name_check", lambda v: limits.mate_name_mismatches(_mates(v)), _with("mated", body=f"{_MATES} select unit_id, ordinal, qname1, qname2 from m where qname1 <> qname2"))
R.add("resume_pending", lambda v: limits.pending(limits.chunk_ids(_chunked(v)), _chunked(v).where("unit_id in ('U3', 'U4') or ordinal < 500").select("unit_id", "chunk_id").distinct(), "unit_id", "chunk_id"),
      _with("reads", body=f", c as (select distinct unit_id, {_CHUNK} as chunk_id from reads) select * from c where unit_id not in ('U3', 'U4') and chunk_id <> '0000'"))

# --- trimming ---------------------------------------------------------------------------------------------------

_TAIL = "regexp_replace(seq, 'G{10,}$', '')"
_GOOD = "length(regexp_replace(qual, '[^!+]', '', 'g')) * 100 <= length(qual) * 40 and length(regexp_replace(seq, '[^N]', '', 'g')) <= 5"
R.add("length_filter", lambda v: v.reads.where(trim.long_enough(F.col("seq"), 30)).select("unit_id", "ordinal"), _with("reads", body="select unit_id, ordinal from reads where length(seq) >= 30"))
R.add("polyg_trim", lambda v: trim.poly_g_trimmed(v.reads).select("unit_id", "ordinal", "seq", "qual"), _with("reads", body=f"select unit_id, ordinal, {_TAIL} as seq, substr(qual, 1, length({_TAIL})) as qual from reads"))
R.add("quality_filter", lambda v: v.reads.where(trim.good_quality(F.col("seq"), F.col("qual"))).select("unit_id", "ordinal"), _with("reads", body=f"select unit_id, ordinal from reads where {_GOOD}"))
R.add("single_trim", lambda v: trim.trim_singles(v.reads.where("kind = 'SE'")).select("unit_id", "ordinal", "read_class", "seq", "qual"), _with("reads", body=f"""
    , t as (select unit_id, ordinal, {_TAIL} as seq, substr(qual, 1, length({_TAIL})) as qual from reads where kind = 'SE')
    select unit_id, ordinal, 'se' as read_class, seq, qual from t where length(seq) >= 30 and {_GOOD}"""))  # fmt: skip
_ADAPTER = "AGATCGGAAGAGC"
R.add("adapter_trim", lambda v: trim.adapter_trimmed(v.reads.select("unit_id", "ordinal", F.concat("seq", F.lit(_ADAPTER)).alias("seq"), F.concat("qual", F.lit("I" * len(_ADAPTER))).alias("qual")), _ADAPTER).select("unit_id", "ordinal", "seq"),
      _with("reads", body=f"""
    , w as (select unit_id, ordinal, seq || '{_ADAPTER}' as seq from reads),
    o as (select unit_id, ordinal, seq, unnest(generate_series(0, length(seq) - 4)) as spot from w),
    h as (select unit_id, ordinal, spot, substr(seq, spot + 1, {len(_ADAPTER)}) as tail from o),
    cut as (select unit_id, ordinal, min(spot) as spot from h where hamming(tail, substr('{_ADAPTER}', 1, length(tail))) <= length(tail) // 8 group by unit_id, ordinal)
    select unit_id, ordinal, substr(seq, 1, coalesce(spot, length(seq))) as seq from w left join cut using (unit_id, ordinal)"""))  # fmt: skip


# units of three kinds end in adapters of their own, cut off after 14 bases or more; others in none
_PLANTED = "case cast(substr(unit_id, 2) as int) % 4 when 1 then 'AGATCGGAAGAGCACACGTC' when 2 then 'CTGTCTCTTATACACATCTGA' when 3 then 'TGGAATTCTCGGGTGCCAAGG' else '' end"
R.add("adapter_detect", lambda v: adapters.detect_adapters(v.reads.selectExpr("unit_id", f"substr(seq, 1, cast(20 + ordinal % 15 as int)) || substr({_PLANTED}, 1, cast(14 + ordinal % 8 as int)) as seq")),
      _with("reads", body=f"select distinct unit_id, {_PLANTED} as adapter from reads where cast(substr(unit_id, 2) as int) % 4 <> 0"))
_SUMS = "count(*) as reads, sum(length(seq)) as bases, sum(length(regexp_replace(qual, '[^5?I]', '', 'g'))) as q20, sum(length(regexp_replace(qual, '[^?I]', '', 'g'))) as q30, sum(length(regexp_replace(seq, '[^GC]', '', 'g'))) as gc"
R.add("trim_report", lambda v: trim_reports.trim_report(v.reads, trim.trim_singles(v.reads)), _with("reads", body=f"""
    , t as (select unit_id, {_TAIL} as seq, substr(qual, 1, length({_TAIL})) as qual from reads),
    a as (select unit_id, {_SUMS} from t where length(seq) >= 30 and {_GOOD} group by unit_id), b as (select unit_id, {_SUMS} from reads group by unit_id)
    select b.unit_id, {', '.join(f'b.{c}::bigint as {c}_before, coalesce(a.{c}, 0)::bigint as {c}_after' for c in ('reads', 'bases', 'q20', 'q30', 'gc'))} from b left join a using (unit_id)"""))  # fmt: skip
R.add("cycle_report", lambda v: trim_reports.by_cycle(v.reads), _with("reads", body="""
    , each as (select unit_id, cycle, substr(seq, cycle, 1) as b, ascii(substr(qual, cycle, 1)) - 33 as q from (select unit_id, seq, qual, unnest(generate_series(1, length(seq))) as cycle from reads) c)
    select unit_id, cast(cycle as int) as cycle, count(*) as n, count(*) filter (b = 'A') as a, count(*) filter (b = 'C') as c, count(*) filter (b = 'G') as g, count(*) filter (b = 'T') as t,
      sum(q)::bigint as quality, count(*) filter (q >= 20) as q20, count(*) filter (q >= 30) as q30 from each group by unit_id, cycle"""))  # fmt: skip


def _fragments(v: Views) -> DataFrame:
    """Both ends, 40 bases long, of fragments of 36 to 72 bases: most overlap."""
    cut = v.cut.withColumn("n", F.length("reference"))
    q = F.repeat(F.lit("I"), F.least(F.lit(40), F.col("n")))
    return cut.select("read_id", F.col("reference").alias("fragment"), F.expr("left(reference, 40)").alias("seq1"), q.alias("qual1"), F.expr("left(reverse(translate(reference, 'ACGT', 'TGCA')), 40)").alias("seq2"), q.alias("qual2"))


R.add("overlap_merge", lambda v: trim.merged_pairs(_fragments(v)).select("read_id", "merged_seq"), _with("genome", "cut", body="select read_id, case when length(reference) <= 50 then reference end as merged_seq from cut"))
R.add("pool_union", lambda v: v.trimmed.select("unit_id", "ordinal", "qname", F.when(F.col("read_class") == "unmerged", "PE").otherwise("SE").alias("pool")), _with("reads", "trimmed", body="select unit_id, ordinal, qname, case when read_class = 'unmerged' then 'PE' else 'SE' end as pool from trimmed"))
_RAW = """select cast(count(*) filter (mate = 1) as bigint) as "raw_R1_reads", count(*) filter (mate = 1 and kind = 'PE') as "raw_R2_reads", count(*) filter (mate = 1) as raw_fragments,
  (select count(*) from trimmed where read_class <> 'unmerged' or mate = 1) as trimmed_fragments, (select count(*) from trimmed where read_class = 'merged') as merged_reads,
  (select count(*) from trimmed where read_class like 'unpaired%') as unpaired_reads from reads"""
R.add("raw_counts", lambda v: stats.raw_counts(v.reads, v.trimmed), _with("reads", "trimmed", body=_RAW))
_SETTINGS = {"sample": "s1", "library_type": "modern", "seq_mode": "MIX", "pilot_fragments": 0, "max_reads_per_chunk": 500, "mapq": 20}
_FIXED = "'s1' as sample, 'modern' as library_type, 'MIX' as seq_mode, 0 as pilot_fragments, 500 as max_reads_per_chunk, 20 as mapq"
R.add("trim_only_stats", lambda v: stats.trim_only_summary(_SETTINGS, stats.raw_counts(v.reads, v.trimmed)), _with("reads", "trimmed", body=f"select {_FIXED}, r.*, {', '.join(f'0 as {c}' for c in stats.SUMMARY[12:])} from ({_RAW}) r"))

# --- alignments -------------------------------------------------------------------------------------------------

_named = lambda f: lambda v: f(v.alignments).select("qname", "flag")
for _name, _f, _where in (
    ("mapped_filter", post.mapped, "flag & 4 = 0"), ("mapq_filter", post.confident, "mapq >= 20"), ("stats_flag_filter", post.for_statistics, "flag & 2820 = 0"),
    ("dedup_filter", post.deduplicated, "flag & 1028 = 0"), ("unmapped_filter", post.unmapped, "flag & 4 <> 0"),
):
    R.add(_name, _named(_f), _with("alignments", body=f"select qname, flag from alignments where ({_where.split(' ', 1)[0]} {_where.split(' ', 1)[1]})".replace("flag & 4 ", "(flag & 4) ").replace("flag & 2820 ", "(flag & 2820) ").replace("flag & 1028 ", "(flag & 1028) ")))
R.add("unmapped_route", lambda v: post.route_unmapped(v.lost), _with("lost", body="""
    , u as (select *, count(*) filter ((flag & 1) <> 0) over (partition by qname) as ends from lost where (flag & 4) <> 0)
    select qname, case when ends > 1 and (flag & 64) <> 0 then 'R1' when ends > 1 and (flag & 128) <> 0 then 'R2' else 'SE' end as stream,
    case when (flag & 16) <> 0 then reverse(translate(seq, 'ACGT', 'TGCA')) else seq end as seq, case when (flag & 16) <> 0 then reverse(qual) else qual end as qual from u"""))  # fmt: skip
R.add("unmapped_pairs_in_step", lambda v: post.unmapped_pairs(post.route_unmapped(v.lost)), _with("lost", body="""
    , u as (select *, count(*) filter ((flag & 1) <> 0) over (partition by qname) as ends, case when (flag & 16) <> 0 then reverse(translate(seq, 'ACGT', 'TGCA')) else seq end as s,
      case when (flag & 16) <> 0 then reverse(qual) else qual end as q from lost where (flag & 4) <> 0),
    f as (select qname, ends > 1 and (flag & 192) <> 0 as paired, (flag & 128) <> 0 as second, s, q from u),
    n as (select *, row_number() over (partition by qname, paired, paired and second order by s, q) as nth from f)
    select qname, cast(nth as int) as nth, max(case when not (paired and second) then s end) as seq1, max(case when not (paired and second) then q end) as qual1,
      max(case when paired and second then s end) as seq2, max(case when paired and second then q end) as qual2 from n group by qname, paired, nth"""))  # fmt: skip
R.add("fixmate", lambda v: post.fix_mates(post.confident(v.pairs)).select("qname", "flag", "pos", "rnext", "pnext", "tlen"), _with("pairs", body="""
    , g as (select * from pairs where mapq >= 20)
    select a.qname, cast(case when b.qname is null then (a.flag & ~40) | 8 else (a.flag & ~40) | case when (b.flag & 16) <> 0 then 32 else 0 end end as int) as flag, a.pos,
    case when b.qname is null then '*' else '=' end as rnext, coalesce(b.pos, 0) as pnext,
    cast(case when b.qname is null then 0 when (a.flag & 16) <> 0 then b.pos - a.pos - 39 - 1 else b.pos + 39 - a.pos + 1 end as bigint) as tlen
    from g a left join g b on a.qname = b.qname and (a.flag & 64) <> (b.flag & 64)"""))  # fmt: skip
_GROUPS = """, k as (select *, case when (flag & 16) <> 0 then pos + readlen - 1 else pos end as five, (flag & 2308) = 0 as counted from alignments),
  d as (select *, case when counted and row_number() over (partition by counted, rname, five, flag & 16 order by score desc, qname) > 1 then 1024 else 0 end as dup from k),
  marked as (select qname, cast(flag | dup as int) as flag, rname, pos, mapq, seq, qual, readlen, cigar from d)"""
_marked = lambda v: post.mark_duplicates(v.alignments, F.col("score"))
R.add("markdup_se", lambda v: _marked(v).select("qname", "flag"), _with("alignments", body=f"{_GROUPS} select qname, flag from marked"))
R.add("markdup_pe", lambda v: post.mark_duplicates(post.confident(v.pairs), F.col("score")).select("qname", "flag"), _with("pairs", body="""
    , e as (select *, rname || ':' || cast(case when (flag & 16) <> 0 then pos + 39 else pos end as varchar) || ':' || case when (flag & 16) <> 0 then '-' else '+' end as e from pairs where mapq >= 20),
    n as (select qname, sum(score) as score, min(e) as e1, max(e) as e2, count(*) = 2 as pair from e group by qname),
    r as (select *, row_number() over (partition by pair, e1, e2 order by score desc, qname) as nth from n),
    ends as (select e1 as x from n where pair union select e2 from n where pair),
    l as (select qname from r where nth > 1 or (not pair and e1 in (select x from ends)))
    select e.qname, cast(e.flag | case when l.qname is null then 0 else 1024 end as int) as flag from e left join l on e.qname = l.qname"""))  # fmt: skip
_REPORT = """select count(*) as reads, count(*) filter (not x) as excluded, count(*) filter (x) as examined, count(*) filter (x and p) as paired, count(*) filter (x and not p) as single,
  count(*) filter (x and p and d) as duplicate_paired, count(*) filter (x and not p and d) as duplicate_single, case when count(*) filter (x) > 0 then count(*) filter (x and d) / count(*) filter (x) else 0.0 end::double as duplicate_share
  from (select (flag & 2308) = 0 as x, (flag & 1) <> 0 as p, (flag & 1024) <> 0 as d from marked) f"""
R.add("duplicate_report", lambda v: post.duplicate_report(_marked(v)), _with("alignments", body=f"{_GROUPS} {_REPORT}"))
R.add("markdup_shared_names", lambda v: post.mark_duplicates(v.shared, F.col("score")).select("qname", "flag", "rname", A.five_prime(F.col("pos"), F.col("cigar"), F.col("flag")).alias("five"), "score"), _with("alignments", "shared", body="""
    , k as (select *, case when (flag & 16) <> 0 then pos + readlen - 1 else pos end as five from shared),
    d as (select *, row_number() over (partition by flag, rname, five order by score desc, qname) as nth from k)
    select qname, cast(flag | case when nth > 1 and (flag & 4) = 0 then 1024 else 0 end as int) as flag, rname, five, score from d"""))  # fmt: skip
R.add("read_group", lambda v: post.with_read_group(v.alignments.withColumn("tags", F.create_map(F.lit("RG"), F.col("unit_id"), F.lit("NM"), F.lit("i:0"))), "s1").select("qname", F.col("tags")["RG"].alias("rg"), F.size("tags").alias("n_tags")),
      _with("alignments", body="select qname, 'Z:s1' as rg, 2 as n_tags from alignments"))


def _rank(v: Views) -> DataFrame:
    """The place of each read among those of its position, from ranks in coordinate order: a prefix count of range
    partitions, and the place within each."""
    ranked = post.coordinate_ranks(post.coordinate_sorted(post.mapped(v.alignments), v.contigs).select("tid", "pos", "qname", "flag"))
    first = ranked.groupBy("tid", "pos").agg(F.min("rank").alias("first"))
    return ranked.join(first, ["tid", "pos"]).select("tid", "pos", (F.col("rank") - F.col("first")).cast("int").alias("nth"), "qname")


R.add("coord_sort_rank", _rank, _with("alignments", "contigs", body="select tid, pos, cast(row_number() over (partition by tid, pos order by qname, flag) - 1 as int) as nth, qname from alignments join contigs using (rname) where (flag & 4) = 0"))
def _region(v: Views) -> DataFrame:
    path = f"{shared_folder(v.spark)}/regions-{uuid.uuid4().hex}"
    regions.write_regions(post.coordinate_sorted(v.alignments, v.contigs, 12).select("qname", "flag", "rname", "pos", "cigar"), path)
    return regions.region(v.spark, path, "chr2", 240, 260)


R.add("region_scan", _region, _with("alignments", body="select qname, flag, rname, pos, cigar from alignments where (flag & 4) = 0 and rname = 'chr2' and pos <= 260 and pos + readlen - 1 >= 240"))
R.add("union_alignments", lambda v: v.alignments.select("qname", "flag", "rname", "pos").unionByName(v.pairs.select("qname", "flag", "rname", "pos")), _with("alignments", "pairs", body="select qname, flag, rname, pos from alignments union all select qname, flag, rname, pos from pairs"))

# --- coverage and summary ---------------------------------------------------------------------------------------

_USED = f"""{_GROUPS}, used as (select rname, pos, readlen, mapq, qual from marked where (flag & 1796) = 0 and mapq >= 20),
  bases as (select rname, at, count(*) as depth from (select rname, unnest(generate_series(pos, pos + readlen - 1)) as at from used) b group by 1, 2),
  coverage as (select c.rname, cast(1 as bigint) as startpos, c.length as endpos, coalesce(n, 0) as numreads, coalesce(covered, 0) as covbases, coalesce(covered, 0) * 100.0::double / c.length as coverage,
    coalesce(total, 0)::double / c.length as meandepth, coalesce(b, 0)::double as meanbaseq, coalesce(q, 0)::double as meanmapq from contigs c
    left join (select rname, count(*) as n, avg(mapq) as q, sum(list_sum(list_transform(string_split(qual, ''), lambda x: ascii(x) - 33))) / sum(length(qual)) as b from used group by 1) r on r.rname = c.rname
    left join (select rname, count(*) as covered, sum(depth)::bigint as total from bases group by 1) b on b.rname = c.rname)""".replace("as at,", "as p,").replace(" at,", " p,").replace(" as at ", " as p ")
_covered = lambda v: coverage.coverage_by_contig(_marked(v), v.contigs, 20)
R.add("coverage_by_contig", _covered, _with("alignments", "contigs", body=f"{_USED} select * from coverage"))
R.add("depth_histogram", lambda v: coverage.depth_histogram(_marked(v), 20), _with("alignments", "contigs", body=f"{_USED} select depth, count(*) as bases from bases group by depth"))
_WEIGHTED = "select sum(meandepth * (endpos - startpos + 1)) / sum(endpos - startpos + 1) as avg_depth, sum(coverage * (endpos - startpos + 1)) / sum(endpos - startpos + 1) as pct_covered from coverage"
_rounded = lambda df, *own: df.select(*[F.round(c, 9).alias(c) if c in own else F.col(c) for c in df.columns])
R.add("weighted_coverage", lambda v: _rounded(coverage.weighted_coverage(_covered(v)), "avg_depth", "pct_covered"), _with("alignments", "contigs", body=f"{_USED} select round(avg_depth, 9) as avg_depth, round(pct_covered, 9) as pct_covered from ({_WEIGHTED}) w"))
_FRAGMENTS = """fragments as (select count(*) as every, count(*) filter ((flag & 1024) <> 0) as dup from marked where (flag & 2820) = 0 and ((flag & 1) = 0 or (flag & 64) <> 0))"""
R.add("fragment_counts", lambda v: stats.fragment_counts(_marked(v)), _with("alignments", body=f"{_GROUPS}, {_FRAGMENTS} select every as mapped_fragments_all, dup as dup_fragments, greatest(every - dup, 0) as mapped_fragments_unique from fragments"))
R.add("duprate", lambda v: stats.duplicate_rate(stats.fragment_counts(_marked(v))), _with("alignments", body=f"{_GROUPS}, {_FRAGMENTS} select every as mapped_fragments_all, dup as dup_fragments, case when every > 0 then dup / every else 0 end as duprate from fragments"))
R.add("endog", lambda v: stats.endogenous(stats.fragment_counts(_marked(v)), 1000), _with("alignments", body=f"{_GROUPS}, {_FRAGMENTS} select greatest(every - dup, 0) as mapped_fragments_unique, greatest(every - dup, 0) / 1000.0::double as endog from fragments"))
R.add("readlen_bp", lambda v: stats.read_lengths(post.deduplicated(_marked(v))), _with("alignments", body=f"{_GROUPS} select avg(length(seq)) as avg_readlen, sum(length(seq))::bigint as mapped_bp from marked where (flag & 1028) = 0"))


def summary(v: Views) -> DataFrame:
    """The summary row of the alignments that pass: what the whole library leads up to."""
    marked = post.mark_duplicates(post.confident(post.mapped(v.alignments)), F.col("score"))
    depth = coverage.weighted_coverage(coverage.coverage_by_contig(marked, v.contigs, 20))
    row = stats.summary(_SETTINGS, stats.raw_counts(v.reads, v.trimmed), stats.mapping_statistics(marked), depth)
    return _rounded(row, "endog", "duprate", "avg_readlen", "avg_depth", "pct_covered")


_KEPT = _USED.replace("from alignments)", "from alignments where (flag & 4) = 0 and mapq >= 20)")
R.add("summary_stats", summary, _with("reads", "trimmed", "alignments", "contigs", body=f"""{_KEPT}, {_FRAGMENTS}, w as ({_WEIGHTED}), raw as ({_RAW}),
    m as (select count(*) filter ((flag & 2820) = 0) as mapped_reads_all, count(*) filter ((flag & 2820) = 0 and (flag & 1024) = 0) as mapped_reads_unique,
      avg(length(seq)) filter ((flag & 3844) = 0) as avg_readlen, (sum(length(seq)) filter ((flag & 3844) = 0))::bigint as mapped_bp from marked)
    select {_FIXED}, raw.*, mapped_reads_all, mapped_reads_unique, every as mapped_fragments_all, greatest(every - dup, 0) as mapped_fragments_unique,
      round(greatest(every - dup, 0) / raw_fragments, 9) as endog, round(dup / every, 9) as duprate, round(avg_readlen, 9) as avg_readlen, mapped_bp,
      round(avg_depth, 9) as avg_depth, round(pct_covered, 9) as pct_covered from raw, m, fragments, w"""))  # fmt: skip

# --- placing reads ----------------------------------------------------------------------------------------------


def _read(reference: str = "reference") -> str:
    return f"case when flag = 16 then reverse(translate({reference}, 'ACGT', 'TGCA')) else {reference} end"


def _cut_reads(v: Views, seq: str, where: str = "true") -> DataFrame:
    """read_id, seq cut from the genome, stored, as aligners go through their reads several times."""
    return stored(v.cut.where(where).selectExpr("read_id", f"{seq} as seq"), "cut")


R.add("align_exact_truth", lambda v: align.place_ancient(_cut_reads(v, _read()), v.genome, 0).select("read_id", "strand", "rname", "pos"),
      _with("genome", "cut", body="select read_id, flag as strand, rname, pos from cut"))
R.add("align_ancient", lambda v: align.align_ancient(_cut_reads(v, _read("(" + _DAMAGED + ")")), v.genome).select("read_id", "flag", "rname", "pos", "cigar"),
      _with("genome", "cut", body="select read_id, flag, rname, pos, cast(30 + 6 * l_linenumber as varchar) || 'M' as cigar from cut"))
R.add("align_modern", lambda v: align.align_modern(_cut_reads(v, _read()), v.genome).select("read_id", "flag", "rname", "pos", "cigar"),
      _with("genome", "cut", body="select read_id, flag, rname, pos, cast(30 + 6 * l_linenumber as varchar) || 'M' as cigar from cut"))
#: Reads of 48 bases or more with a gap of one to three bases in their middle: bases left out, or more of them put in.
_HALF, _GAP = "length(reference) // 2", "(1 + pos % 3)"
_INDEL = {
    "gone": f"substr(reference, 1, cast(floor(length(reference) / 2.0) as int)) || substr(reference, cast(floor(length(reference) / 2.0) + 2 + pos % 3 as int))",
    "more": f"substr(reference, 1, cast(floor(length(reference) / 2.0) as int)) || substr('TGACCA', cast(1 + pos % 4 as int), cast(1 + pos % 3 as int)) || substr(reference, cast(floor(length(reference) / 2.0) + 1 as int))",
}
_GAPPED = f"(case when pos % 2 = 0 then {_INDEL['gone']} else {_INDEL['more']} end)"
# a gap goes as far left as its bases allow: by the first place before it where the bases on its two sides differ
_SHIFT = f"""coalesce(list_position(list_transform(range(1, {_HALF} + 1), lambda i: case when pos % 2 = 0 then substr(reference, {_HALF} - i + 1, 1) = substr(reference, {_HALF} - i + 1 + {_GAP}, 1)
    else substr(reads, {_HALF} - i + 1, 1) = substr(reads, {_HALF} - i + 1 + {_GAP}, 1) end), false), {_HALF} + 1) - 1"""
R.add("align_gapped", lambda v: align.align_modern(_cut_reads(v, _read(_GAPPED), "length(reference) >= 48"), v.genome).select("read_id", "flag", "rname", "pos", "cigar"),
      _with("genome", "cut", body=f""", g as (select *, {_GAPPED} as reads from cut where length(reference) >= 48), s as (select *, {_HALF} - ({_SHIFT}) as head from g)
    select read_id, flag, rname, pos, head::varchar || 'M' || {_GAP}::varchar || case when pos % 2 = 0 then 'D' else 'I' end || (length(reference) - head - case when pos % 2 = 0 then {_GAP} else 0 end)::varchar || 'M' as cigar from s"""))  # fmt: skip
R.add("align_pairs", lambda v: pairs.align_pairs(stored(v.ends(), "ends"), v.repeats).select("pair_id", "mate", "flag", "rname", "pos", "cigar", "proper"), f"""
    with repeats as ({REPEATS['duckdb'].format(part='part')}), f as ({FRAGMENTS.format(orders='orders', repeats='repeats')})
    select pair_id, cast(m as int) as mate, cast(case when (m = 1) = ahead then 0 else 16 end as int) as flag, rname, case when (m = 1) = ahead then pos else pos + n - 40 end as pos, '40M' as cigar, true as proper
    from f cross join (select 1 as m union all select 2 as m) mates""")  # fmt: skip
_AT = """, d as (select *, length(reference) as n, {damaged} as seq from cut), t as (select n, {turn_s} as s, {turn_r} as r from d), i as (select unnest(generate_series(1, 25)) as place),
    p as (select '5p' as "end", place, substr(r, place, 1) as ref, substr(s, place, 1) as alt from t join i on place <= n union all select '3p', place, substr(r, n - place + 1, 1), substr(s, n - place + 1, 1) from t join i on place <= n),
    c as (select "end", cast(place as int) as place, ref, alt, count(*) as n from p group by all)""".format(damaged=_DAMAGED, turn_s=_read("seq"), turn_r=_read())
_subs = lambda v: damage.substitutions(v.cut.selectExpr("flag", "reference", f"{_DAMAGED} as seq"))
R.add("damage_by_position", _subs, _with("genome", "cut", body=f'{_AT} select * from c'))
R.add("damage_profile", lambda v: damage.damage_profile(_subs(v)), _with("genome", "cut", body=f"""{_AT} select "end", place,
    (sum(case when ("end" = '5p' and alt = 'T') or ("end" = '3p' and alt = 'A') then n else 0 end) / sum(n))::double as rate from c where ("end" = '5p' and ref = 'C') or ("end" = '3p' and ref = 'G') group by 1, 2"""))  # fmt: skip
R.add("damage_clipped", lambda v: damage.substitutions_under_cigars(v.cut.selectExpr("flag", "reference", f"'TTTTT' || {_DAMAGED} || 'CC' as seq", "'5S' || length(reference) || 'M2S' as cigar")),
      _with("genome", "cut", body=f'{_AT} select * from c'))
R.add("base_composition", lambda v: damage.base_composition(align.with_reference(v.cut.selectExpr("flag", "rname", "pos", "length(reference) || 'M' as cigar"), v.genome)), _with("genome", "cut", body="""
    , f as (select flag, substr(g.seq, greatest(c.pos - 10, 1)::int, least(c.pos - 1, 10)::int) as l, substr(g.seq, (c.pos + length(reference))::int, 10) as r from cut c join genome g using (rname)),
    t as (select case when flag = 16 then translate(r, 'ACGT', 'TGCA') else reverse(l) end as five, case when flag = 16 then translate(reverse(l), 'ACGT', 'TGCA') else r end as three from f),
    i as (select unnest(generate_series(1, 10)) as place)
    select "end", cast(place as int) as place, base, count(*) as n from (select '5p' as "end", place, substr(five, place, 1) as base from t join i on place <= length(five)
      union all select '3p', place, substr(three, place, 1) from t join i on place <= length(three)) b group by 1, 2, 3"""))  # fmt: skip
R.add("fragment_length_hist", lambda v: damage.fragment_lengths(v.cut.selectExpr("flag", "reference as seq")), _with("genome", "cut", body="select cast(length(reference) as int) as length, case when flag = 16 then '-' else '+' end as strand, count(*) as n from cut group by 1, 2"))


# --- arriving files ---------------------------------------------------------------------------------------------


def _arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream over the events folder, run until all that is there has been read.

    Each batch writes the windows it changed to the shared folder, under its own number, so a batch done twice is
    written once; the last that was said of a window counts. The table is history, read in any order, so that only
    what is ten years late would be left out.
    """
    folder = f"{shared_folder(spark)}/arrivals-{uuid.uuid4().hex}"
    stream = arrivals.arriving(spark, f"{sf_dir}/events*.parquet", spark.read.parquet(f"{sf_dir}/events.parquet").schema)
    utc = stream.withColumn("ts", F.expr("cast(convert_timezone('UTC', current_timezone(), ts) as timestamp)"))  # watermarks ask for instants
    counts = arrivals.counts_by_window(utc, "ts", "1 day", "3650 days", "event_type")

    def keep(batch: DataFrame, number: int) -> None:
        batch.withColumn("said", F.lit(number)).write.mode("overwrite").parquet(f"{folder}/windows/batch={number}")

    query = counts.writeStream.outputMode("update").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).foreachBatch(keep).start()
    query.awaitTermination()
    last = spark.read.parquet(f"{folder}/windows").groupBy("window_start", "event_type").agg(F.max_by(F.struct("n", "total"), "said").alias("l"))
    start = F.expr("convert_timezone(current_timezone(), 'UTC', cast(window_start as timestamp_ntz))").alias("window_start")
    return last.select(start, "event_type", "l.n", F.round("l.total", 3).alias("total"))


R.made["streaming_counts"] = _arrivals
R.sql["streaming_counts"] = "select date_trunc('day', ts)::timestamp as window_start, event_type, count(*) as n, round(sum(value), 3) as total from events group by 1, 2"


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary(Views(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(R.made)


def oracle_sql() -> dict[str, str]:
    return dict(R.sql)
