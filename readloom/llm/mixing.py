"""Mixing sources to target weights, with DataFrame functions only.

Sizes are aggregated per source, targets come from a small table of sources, and every document is emitted
floor(rate) times plus once more with the probability of the rate's fraction, drawn from a seeded hash of its id.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage_table, word_count


def source_targets(
    sized: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, cap: float = 2.0
) -> DataFrame:
    """mix_source, source_size, target per source of (mix_source, mix_size).

    Sources in code-point order, null last, take the weights in turn and share `share` times all sizes. A target
    stops at `cap` times its source's size and the excess goes to the others by weight until none is above: with
    sources by cap / weight, those before the first that stays under the common level are at their cap. The windows
    run over one row per source, never over documents.
    """
    if not 0 < share <= cap:
        raise ValueError("share must be above 0 and not above cap, or the targets can't be met")
    per = sized.groupBy("mix_source").agg(F.sum("mix_size").alias("source_size"))
    in_turn = F.row_number().over(Window.orderBy(F.col("mix_source").asc_nulls_last()))
    ranked = per.withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((in_turn - 1) % len(weights) + 1).cast("int"))
    ).withColumn("limit", F.col("source_size") * F.lit(float(cap)))
    order = Window.orderBy((F.col("limit") / F.col("weight")).asc(), F.col("mix_source").asc_nulls_last())
    before, everyone = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    levels = (
        ranked.withColumn("place", F.row_number().over(order))
        .withColumn("left_size", F.sum("source_size").over(everyone) * F.lit(float(share)) - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
        .withColumn("left_weight", F.sum("weight").over(everyone) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("level", F.col("left_size") / F.col("left_weight"))
        .withColumn("under", F.col("limit") > F.col("weight") * F.col("level"))
    )
    common = F.min_by("level", F.when(F.col("under"), F.col("place"))).over(everyone)
    return levels.withColumn("common", common).select(
        "mix_source",
        "source_size",
        F.when(F.col("under"), F.col("weight") * F.col("common")).otherwise(F.col("limit")).alias("target"),
    )


def unit_draw(key: Column, seed: int) -> Column:
    """A double in [0, 1) from 52 bits of the seeded MD5 of the key, a text."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key)), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def content(text: Column) -> Column:
    """What tells texts apart in a draw: their MD5, or the text null."""
    return F.coalesce(F.md5(text), F.lit("null"))


def _numbered(keyed: DataFrame, key: str, salts: int = 32) -> DataFrame:
    """keyed with mix_number, 0 and up among rows of one key. Rows of one key are alike, so it doesn't matter which has
    which number. Only keys that repeat are numbered, within salts first, so that no group needs a task of its own."""
    many = stage_table(keyed.groupBy(F.col(key).alias("mix_many")).count().where("count > 1").select("mix_many"), "mix-repeated")
    single = keyed.withColumn("mix_number", F.lit(0).cast("long"))
    if many.isEmpty():
        return single
    several = stage_table(keyed.join(many, F.col(key) == F.col("mix_many"), "left_semi").withColumn("mix_salt", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(salts))), "mix-several")
    order = Window.partitionBy(key).orderBy("mix_salt").rowsBetween(Window.unboundedPreceding, -1)  # one row per key and salt
    before = several.groupBy(key, "mix_salt").count().select(key, "mix_salt", F.coalesce(F.sum("count").over(order), F.lit(0)).alias("mix_before"))
    within = F.row_number().over(Window.partitionBy(key, "mix_salt").orderBy(key)) - 1
    numbered = several.withColumn("mix_within", within).join(before, [key, "mix_salt"]).withColumn("mix_number", F.col("mix_before") + F.col("mix_within"))
    alone = single.join(many, F.col(key) == F.col("mix_many"), "left_anti")
    return alone.unionByName(numbered.select(*alone.columns))


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    cap: float = 2.0,
    seed: int = 42,
    id_col: str = "doc_id",
    source_col: str = "source",
    size: Column | None = None,
    told_by: Column | None = None,
) -> DataFrame:
    """docs with mix_size, mix_source_size, mix_target and mix_copies, the times each document is to be emitted.

    size defaults to the words of the column text, and told_by, which tells rows of one id apart, to content() of it.
    Null text has size 0; null source is a source of its own, last in order; every row draws for itself, by id, source,
    text and, where these repeat, its number among equals, so a source whose rows share an id meets its target too; a
    source without words gets target 0 and no copies; an empty table gives an empty table. Other columns pass through,
    whatever their names; columns of the four names above are replaced. The table of targets is written first, so the
    join is a broadcast exactly when its file is under spark.sql.autoBroadcastJoinThreshold, and otherwise a sort-merge
    join that AQE can split. docs is read several times: hand in a stored table.
    """
    if told_by is None:
        told_by = content(F.col("text")) if "text" in docs.columns else F.lit("")
    own = [c for c in docs.columns if not c.startswith("mix_")]
    hidden = {c: f"mix_other_{i}" for i, c in enumerate(c for c in docs.columns if c.startswith("mix_") and c not in ("mix_size", "mix_source_size", "mix_target", "mix_copies"))}
    mixed = docs.select(
        *own, *[F.col(c).alias(h) for c, h in hidden.items()],
        (word_count(F.col("text")) if size is None else F.coalesce(size.cast("long"), F.lit(0).cast("long"))).alias("mix_size"),
        F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.coalesce(F.md5(F.col(source_col).cast("string")), F.lit("null")), told_by).alias("mix_key"),
    )
    targets = stage_table(
        source_targets(mixed.select(F.col(source_col).alias("mix_source"), "mix_size"), weights, share, cap), "mix-targets"
    ).select("mix_source", F.col("source_size").alias("mix_source_size"), F.col("target").alias("mix_target"))
    rate = F.when(F.col("mix_source_size") > 0, F.col("mix_target") / F.col("mix_source_size")).otherwise(F.lit(0.0))
    draw = unit_draw(F.concat_ws(":", "mix_key", F.col("mix_number").cast("string")), seed)
    return (
        _numbered(mixed, "mix_key").join(targets, F.col(source_col).eqNullSafe(F.col("mix_source")), "left")
        .withColumn("mix_rate", rate)
        .withColumn("mix_copies", (F.floor("mix_rate") + (draw < F.col("mix_rate") - F.floor("mix_rate")).cast("long")).cast("long"))
        .select(*own, *[F.col(h).alias(c) for c, h in hidden.items()], "mix_size", "mix_source_size", "mix_target", "mix_copies")
    )


def emit(mixed: DataFrame) -> DataFrame:
    """The rows of mix(), each mix_copies times, without its columns."""
    return (
        mixed.where("mix_copies > 0")
        .withColumn("mix_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("mix_copies"))))
        .drop("mix_copy", "mix_size", "mix_source_size", "mix_target", "mix_copies")
    )
