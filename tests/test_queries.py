"""Every reference query against its SQL, and every registered name."""

import importlib

import pytest
from conftest import DATA, same_rows

from readloom.jobs import queries as reads


@pytest.mark.parametrize("name", sorted(reads.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    found = reads.queries()[name](spark, DATA).toPandas()
    asked = duck.execute(reads.oracle_sql()[name]).df()
    if name not in ("count_mismatch", "pair_conflicts", "unit_orphans", "single_trim"):  # the smallest tables have none of these
        assert len(found)
    same_rows(found, asked)


def test_coordinate_ranks(spark, duck, monkeypatch):
    v = reads.Views(spark, DATA)
    asked = duck.execute(reads._with("alignments", "contigs", body="""select tid, pos, qname, row_number() over (order by tid, pos, qname, flag) - 1 as rank
      from alignments join contigs using (rname) where (flag & 4) = 0""")).df()
    for partitions in (1, 7):
        ordered = reads.post.coordinate_sorted(reads.post.mapped(v.alignments), v.contigs, partitions).select("tid", "pos", "qname", "flag")
        same_rows(reads.post.coordinate_ranks(ordered).drop("flag").toPandas(), asked)
    asked = duck.execute(reads.oracle_sql()["coord_sort_rank"]).df()
    monkeypatch.setattr(reads.post, "coordinate_sorted", lambda df, contigs: df.join(contigs.select("rname", "tid"), "rname", "left").repartition(5))
    with pytest.raises(AssertionError):  # the query stands on the order
        same_rows(reads.queries()["coord_sort_rank"](spark, DATA).toPandas(), asked)


def test_entry_has_the_summary(spark):
    entry = importlib.import_module("__spark_entry__")
    row = entry.entry(spark).first()
    assert row["mapped_fragments_all"] >= row["mapped_fragments_unique"] >= 0
    assert 0 <= row["pct_covered"] <= 100 and 0 <= row["duprate"] <= 1


def test_sql_is_of_queries():
    entry = importlib.import_module("__spark_entry__")
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(reads.queries()) <= set(entry.queries())


def test_adapter_trim_leaves_the_read(spark):
    from readloom.jobs.queries import Views

    v = Views(spark, DATA)
    whole = v.reads.selectExpr("unit_id", "ordinal", "seq as whole")
    found = reads.queries()["adapter_trim"](spark, DATA).join(whole, ["unit_id", "ordinal"])
    n, kept = found.count(), found.where("whole = seq").count()
    assert kept > 0.9 * n and found.where("not startswith(whole, seq)").count() == 0
