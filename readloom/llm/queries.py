"""The queries of the training-data operators, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, conversations, langid, quality_mil, whitening
from .common import stage_table, table, word_count
from .licenses import oracle as license_oracle
from .licenses import recognise
from .line_dedup import drop_repeated_lines
from .mixing import content, mix
from .packing import pack_documents
from .quality_rules import judge
from .simhash import near_duplicates
from .suffix_dedup import remove_repeats
from .warc import archive_pages


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op2_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = archive_pages(table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP2_SQL = """
with p as (select page_id, coalesce(html, '') as html from pages),
d as (select page_id, octet_length(encode(html))::bigint as payload_bytes, sha256(html) as payload_digest from p),
o as (select *, min(page_id) over (partition by payload_digest) as first from d)
select page_id, payload_bytes, payload_digest,
       case when payload_bytes >= 100 and page_id <> first then 'revisit' else 'response' end as record_type,
       case when payload_bytes >= 100 and page_id <> first then first end as refers_to
from o
"""


def op6_ann_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    held = langid.held_out("doc_id", 4, 2)
    model = langid.train(docs, ~held)
    found = langid.predict(docs.select("doc_id", held.alias("held_out"), "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score", "accepted")


def op8_quality_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    model = quality_mil.train(docs, quality_mil.learn_from(labels))
    return quality_mil.predict(docs.withColumn("held_out", langid.held_out("doc_id", 5, 0)), model)


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), kept="sha256")


OP9_SQL = """
with d as (select row_number() over () as r, doc_id, encode(coalesce(text, '')) as h from documents),
w as (select r, i, hash(h[i + 1 : i + 200]) as k from (select r, h, unnest(range(0, octet_length(h) - 199)) as i from d) t),
many as (select r, i from (select r, i, count(*) over (partition by k) as n from w) c where n > 1),
marked as (select r, i, sum(fresh) over (partition by r order by i) as run from (select r, i, case when i - lag(i) over (partition by r order by i) <= 200 then 0 else 1 end as fresh from many) f),
s as (select r, run, min(i) as a, max(i) + 200 as b from marked group by r, run),
left_over as (
  select r, coalesce(lag(b) over (partition by r order by a), 0) as x, a as y from s
  union all select d.r, max(b), any_value(octet_length(h)) from s join d on s.r = d.r group by d.r),
kept as (select l.r, string_agg(case when y > x then hex(h[x + 1 : y]) else '' end, '' order by x) as k from left_over l join d on l.r = d.r group by l.r),
total as (select r, sum(b - a) as removed, count(*) as runs from s group by r)
select doc_id, octet_length(h)::bigint as n_bytes, coalesce(removed, 0)::bigint as n_removed, coalesce(runs, 0)::bigint as n_spans,
       case when k is null then sha256(h) else sha256(unhex(k)) end as kept_sha256
from d left join total on d.r = total.r left join kept on d.r = kept.r
"""


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op3_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge(docs, measures=("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")).drop("rejected_by")


OP3_SQL = r"""
with d as (select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),
w as (
  select r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
  from d),
windows as (select r, i, words[i] || chr(10) || words[i + 1] || chr(10) || words[i + 2] as g
            from (select r, words, unnest(range(1, len(words) - 1)) as i from w)),
many as (select r, i from (select r, i, count(*) over (partition by r, g) as n from windows) where n > 1),
covered as (select r, count(distinct p) as n from (select r, i + unnest([0, 1, 2]) as p from many) group by r),
m as (
  select w.doc_id, len(words)::bigint as n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::bigint as word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
         (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, coalesce(c.n, 0)::bigint as n_repeat_words, len(lines) as n_lines,
         length(regexp_replace(text, '[^A-Z]', '', 'g')) as upper, length(regexp_replace(text, '[^A-Za-z]', '', 'g')) as letters,
         len(list_filter(words, lambda x: regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]'))) as letter_words
  from w left join covered c using (r)),
b as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and word_chars between 2 * n_words and 12 * n_words and 10 * n_symbols <= n_words
       and 2 * n_dup_lines <= n_lines and not (letters > 0 and upper / letters > 0.5)
       and letter_words / n_words >= 0.6 as kept
from b
"""


def op4_license_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recognise(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = table(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size"), content(F.col("text")).alias("content"))
    mixed = mix(stage_table(sized, "mix-sizes"), size=F.col("size"), told_by=F.col("content"))
    return mixed.select(
        "doc_id", "size", F.col("mix_source_size").alias("source_size"), F.col("mix_target").alias("target"),
        (F.col("size") * F.col("mix_copies")).alias("taken"),
    )


OP5_SQL = r"""
with sized as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
         concat_ws(':', coalesce(doc_id::varchar, 'null'), coalesce(md5(source), 'null'), coalesce(md5(text), 'null'), (row_number() over (partition by doc_id, source, text) - 1)::varchar) as key
  from documents),
per as (select source, sum(size)::bigint as source_size from sized group by source),
ranked as (
  select *, [3.0, 1.0, 2.0][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int]::double as weight,
         2.0::double * source_size as cap
  from per),
levels as (
  select *, row_number() over o as place,
         ((select sum(source_size) from per)::double * 1.5::double - coalesce(sum(cap) over (o rows between unbounded preceding and 1 preceding), 0))
         / ((select sum(weight) from ranked) - coalesce(sum(weight) over (o rows between unbounded preceding and 1 preceding), 0)) as level
  from ranked window o as (order by cap / weight, source nulls last)),
flagged as (select *, cap > weight * level as under from levels),
targets as (
  select source, source_size,
         case when under then weight * (select min_by(level, place) from flagged where under) else cap end as target
  from flagged),
rated as (
  select s.doc_id, s.size, t.source_size, t.target,
         case when t.source_size > 0 then t.target / t.source_size else 0 end as rate,
         ('0x' || substr(md5('42:' || key), 1, 13))::bigint::double / 4503599627370496::double as u
  from sized s join targets t on s.source is not distinct from t.source)
select doc_id, size, source_size, target,
       (size * (floor(rate) + case when u < rate - floor(rate) then 1 else 0 end))::bigint as taken
from rated
"""


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = conversations.ordered_turns(table(spark, sf_dir, "conversations"))
    return conversations.prefix_trie(conversations.with_heads(turns))


OP11_SQL = """
with recursive
bits(i, k, c) as (
  select i, 0, i from (select unnest(range(256)) as i) t
  union all select i, k + 1, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end from bits where k < 8),
tab as (select list(c order by i) as t from bits where k = 8),
turns as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
         row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as pos
  from conversations where conv_id is not null),
ids as (select distinct conv_id, conv_id::varchar as s from turns),
crc(conv_id, s, i, c) as (
  select conv_id, s, 0, 4294967295 from ids
  union all select conv_id, s, i + 1, xor(c >> 8, t[(xor(c, ascii(s[i + 1])) & 255) + 1]) from crc, tab where i < length(s)),
heads as (select conv_id, xor(c, 4294967295) % 6 as h, conv_id - conv_id % 100 as head_id from crc where i = length(s)),
rebuilt as (
  select h.conv_id, 0 as own, pos, role, text from heads h join turns t on t.conv_id = h.head_id where pos <= h
  union all select h.conv_id, 1, pos, role, text from heads h join turns t on t.conv_id = h.conv_id where pos > h),
path as (
  select conv_id, row_number() over w as depth, length(text) as chars,
         md5(string_agg(md5(length(role)::varchar || ':' || role || text), '') over w) as k
  from rebuilt window w as (partition by conv_id order by own, pos)),
rows_ as (select conv_id, depth, chars, k from path union all select conv_id, 0, 0, '' from ids),
named as (select *, min(conv_id) over (partition by depth, k) as m from rows_),
nodes as (select m, depth, count(*) as n, (count(*) - 1) * any_value(chars) as saving from named group by m, depth),
linked as (select n.*, p.m as parent from nodes n left join named p on p.conv_id = n.m and p.depth = n.depth - 1),
leafy as (select l.*, not exists (select 1 from linked c where c.parent = l.m and c.depth = l.depth + 1) as leaf from linked l),
below as (
  select a.m, a.depth, sum(v.leaf::int) as leaves, sum(v.saving) as saved, count(*) filter (v.depth = a.depth + 1) as children
  from leafy v join named a on a.conv_id = v.m and a.depth <= v.depth group by a.m, a.depth),
tops as (select conv_id, max(depth) as depth from rows_ group by conv_id),
ends as (select m, n.depth, string_agg(n.conv_id::varchar, ',' order by n.conv_id) as ids from named n join tops using (conv_id, depth) group by m, n.depth)
select l.m as conv_id, l.depth::bigint as depth, l.parent as parent_conv_id, l.n::bigint as n_convs, b.children::bigint as n_children,
       b.leaves::bigint as n_leaves, b.saved::bigint as saved_tokens, sha256(coalesce(e.ids, '')) as ends_sha256
from linked l join below b on b.m = l.m and b.depth = l.depth left join ends e on e.m = l.m and e.depth = l.depth
"""


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", whitening.whole_vectors(F.col("embedding")).alias("x"))
    model = whitening.fit(vectors)
    explained = [] if model is None else (model.variances / model.trace).tolist() if len(model.variances) else []
    rows = whitening.whiten(vectors, model).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return rows.select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(model.n if model else 0).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(F.array(*[F.lit(float(e)) for e in explained or [0.0]]), F.col("at") + 1).alias("explained"),
        F.lit(model.identity_error if model else None).cast("double").alias("identity_error"),
    )


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


OP13_SQL = """
with d as (select row_number() over () as r, doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents),
l as (select r, doc_id, unnest(lines) as line, unnest(range(len(lines))) as i from d),
k as (
  select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from l),
many as (select key, max(doc_id) as last from k where length(key) >= 40 group by key having count(distinct r) >= 5),
told as (select k.*, m.key is not null and (k.doc_id is null and m.last is not null or k.doc_id < m.last) as dropped from k left join many m using (key))
select doc_id, count(*)::bigint as n_lines, count(*) filter (dropped)::bigint as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by i) filter (not dropped), '')) as kept_sha256
from told group by r, doc_id
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_best_fit_packing, op2_warc_revisits, op3_quality_cascade, op4_license_sentences, op5_source_mixing, op6_ann_kmeans_tree, op7_language_id, op8_quality_mil, op9_suffix_array_dedup, op10_simhash_near_dedup, op11_conversation_trie, op12_embedding_whitening, op13_line_dedup)}


def oracle_sql() -> dict[str, str]:
    return {"op2_warc_revisits": OP2_SQL, "op3_quality_cascade": OP3_SQL, "op4_license_sentences": license_oracle(), "op5_source_mixing": OP5_SQL, "op9_suffix_array_dedup": OP9_SQL, "op11_conversation_trie": OP11_SQL, "op13_line_dedup": OP13_SQL}
