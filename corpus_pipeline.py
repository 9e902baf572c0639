"""The corpus pipeline: rate, drop near-duplicates, cut repeated strings, mix sources, pack.

STAGES are (name, function) pairs; each function takes (spark, docs, sf_dir), works on all its predecessor kept, and
returns a DataFrame that is stored before the next one reads it. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.llm import quality_mil
from readloom.llm.common import stage_table, table
from readloom.llm.mixing import emit, mix
from readloom.llm.packing import pack_documents
from readloom.llm.simhash import near_duplicates
from readloom.llm.suffix_dedup import remove_repeats


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps what the classifier predicts to be of quality 1, learned from the labels that aren't held out."""
    labels = quality_mil.learn_from(table(spark, sf_dir, "labels").select("doc_id", "quality"))
    model = quality_mil.train(docs.select("doc_id", "text"), labels)
    return quality_mil.predict(docs, model, keep_text=True).where("predicted = 1").select(*docs.columns)


def _row_key() -> Column:
    """Tells rows apart by doc_id and text, as sources may share ids; rows without an id come last."""
    return F.struct(F.col("doc_id").isNull().alias("missing"), F.coalesce(F.col("doc_id"), F.lit(0)).alias("id"), F.xxhash64("text").alias("content"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near-duplicates: of the smallest id, then of the smallest hash of the text.

    Rows are told apart by id and text, so an id that different texts share costs none of them. What goes is joined, as
    it is less than what stays; its table is stored first, so it is broadcast exactly when its size is under Spark's
    limit. Of rows of one id and text the first by all columns stays, by an aggregate over those rows alone.
    """
    found = stage_table(near_duplicates(docs.select(_row_key().alias("doc_id"), "text")), "pipeline-near")
    gone = stage_table(found.where("doc_id <> component_id").select(F.col("doc_id").alias("gone_key")).distinct(), "pipeline-gone")
    kept = docs.join(gone, _row_key() == F.col("gone_key"), "left_anti")
    same = stage_table(found.where("doc_id = component_id").groupBy(F.col("doc_id").alias("same_key")).count().where("count > 1").select("same_key"), "pipeline-same")
    if same.isEmpty():
        return kept
    several = kept.join(same, _row_key() == F.col("same_key"), "left_semi")
    first = several.groupBy(_row_key().alias("same_key")).agg(F.min(F.struct(*docs.columns)).alias("first_row")).select("first_row.*")
    return kept.join(same, _row_key() == F.col("same_key"), "left_anti").unionByName(first)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts strings of 200 bytes that also start elsewhere; n_chars follows the text."""
    cut = remove_repeats(docs, kept="text")
    return cut.withColumn("text", F.col("kept")).withColumn("n_chars", F.length("kept").cast("long")).select(*docs.columns)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Emits every document as often as its source's target asks for."""
    return emit(mix(docs)).select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the tokens of all documents, a row per piece."""
    return pack_documents(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", simhash_near_dedup),
    ("suffix-array dedup", suffix_array_dedup),
    ("mixing sources to target weights", source_mixing),
    ("best-fit packing", best_fit_packing),
]

#: The classifier has no SQL; tests hold the pipeline against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)
