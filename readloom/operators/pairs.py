"""Mates placed together: candidates of both ends weighed under the distribution of insert sizes, and a search around
one end for the other."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from readloom.functions.alignment import reference_length
from readloom.operators import gapped
from readloom.operators.align import read_lengths
from readloom.operators.stored import stored
from readloom.sources.index import ReferenceIndex

#: What a pair loses that isn't placed as one, in the score of alignments.
UNPAIRED = 17
#: Score for a standard deviation's square: a natural logarithm to base 4.
_BY_SQUARE = 0.36


class Inserts(NamedTuple):
    """Mean and deviation of insert sizes, and the sizes that make a proper pair."""

    mean: float
    deviation: float
    low: int
    high: int


def _sided(hits: DataFrame, *more: str) -> DataFrame:
    """hits of read_id = pair/mate, with pair_id, mate and end, the last base on the contig."""
    return hits.select(
        F.expr("left(read_id, length(read_id) - 2)").alias("pair_id"), F.right("read_id", F.lit(1)).cast("int").alias("mate"), "strand", "rname", "pos",
        (F.col("pos") + reference_length(F.col("cigar")) - 1).alias("end"), "cost", "cigar", "mm", *more,
    )


def insert_sizes(best: DataFrame, largest: int = 1000, least: int = 20) -> Inserts:
    """From pairs whose ends each have one best place (pair_id, mate, strand, rname, pos, end), facing each other within
    `largest` bases. Quartiles come from a mergeable sketch, and what is more than twice the middle half's width from it
    counts for neither mean nor deviation. With fewer than `least` such pairs, any size up to `largest` will do."""
    side = lambda s: best.where(F.col("strand") == s).select("pair_id", F.col("mate").alias(f"mate{s}"), F.col("rname").alias(f"rname{s}"), F.col("pos").alias(f"pos{s}"), F.col("end").alias(f"end{s}"))
    size = F.col("end16") - F.col("pos0") + 1
    sizes = side(0).join(side(16), "pair_id").where("mate0 <> mate16 and rname0 = rname16 and end16 >= pos0").select(size.alias("n")).where(F.col("n") <= largest)
    row = sizes.agg(F.count("*").alias("many"), F.percentile_approx("n", [0.25, 0.75], 10_000).alias("q")).first()
    if row["many"] < least:
        return Inserts(largest / 2, largest / 4, 1, largest)
    q1, q3 = row["q"]
    wide = max(1, q3 - q1)
    near = sizes.where(F.col("n").between(q1 - 2 * wide, q3 + 2 * wide)).agg(F.avg("n").alias("mean"), F.stddev_pop("n").alias("deviation")).first()
    deviation = max(1.0, near["deviation"])
    low, high = min(q1 - 3 * wide, near["mean"] - 4 * deviation), max(q3 + 3 * wide, near["mean"] + 4 * deviation)
    return Inserts(near["mean"], deviation, max(1, int(low)), int(high) + 1)


def _together(sided: DataFrame, inserts: Inserts) -> DataFrame:
    """pair_id, total, f and r: each two hits of a pair's ends that face each other at a proper distance. They meet by
    contig and stretches of the largest distance, so hits far from each other are never brought together."""
    hit = F.struct("mate", "rname", "pos", "strand", "cigar", "mm", "cost", "size", "end")
    stretch = lambda c: F.floor(F.col(c) / inserts.high)
    ahead = sided.where("strand = 0").select("pair_id", "rname", F.explode(F.array(stretch("pos"), stretch("pos") + 1)).alias("at"), hit.alias("f"))
    back = sided.where("strand = 16").select("pair_id", "rname", stretch("end").alias("at"), hit.alias("r"))
    size = F.col("r.end") - F.col("f.pos") + 1
    off = (size - F.lit(inserts.mean)) / F.lit(inserts.deviation)
    met = ahead.join(back, ["pair_id", "rname", "at"]).where((F.col("f.mate") != F.col("r.mate")) & size.between(inserts.low, inserts.high) & (F.col("r.end") >= F.col("f.end")))
    return met.select("pair_id", (-F.col("f.cost") - F.col("r.cost") - F.lit(_BY_SQUARE) * off * off).alias("total"), "f", "r")


def _around(best: DataFrame, reads: DataFrame, inserts: Inserts) -> DataFrame:
    """Candidates for the other ends of `best` hits: the diagonals at which they would be a proper pair."""
    other = F.concat_ws("/", "pair_id", (3 - F.col("mate")).cast("string")).alias("read_id")
    sized = best.select(other, "strand", "rname", "pos", "end").join(reads.select("read_id", F.length("seq").alias("n")), "read_id")
    forward = F.col("strand") == 0
    low = F.when(forward, F.col("pos") + inserts.low - F.col("n")).otherwise(F.col("end") - inserts.high + 1)
    high = F.when(forward, F.col("pos") + inserts.high - F.col("n")).otherwise(F.col("end") - inserts.low + 1)
    return sized.select("read_id", (16 - F.col("strand")).alias("strand"), "rname", low.alias("low"), F.greatest(low, high).alias("high"))


def _chosen(met: DataFrame) -> DataFrame:
    """Per pair and mate the hit of the best two, with the next total at which this end stands elsewhere."""
    read = Window.partitionBy("pair_id")
    best = F.max(F.struct("total", (-F.col("f.pos")).alias("p"), "f", "r")).over(read)
    ends = met.withColumn("best", best).select("pair_id", "total", "best", F.explode(F.array(F.struct(F.col("f").alias("hit"), F.col("best.f").alias("own")), F.struct(F.col("r").alias("hit"), F.col("best.r").alias("own")))).alias("e"))
    mates = met.withColumn("best", best).select("pair_id", "best.total", F.explode(F.array("best.f", "best.r")).alias("own")).distinct()
    other = ends.select("pair_id", "total", F.col("e.hit").alias("hit"))
    own, hit = F.col("own"), F.col("hit")
    same: Column = (hit["rname"] == own["rname"]) & (hit["strand"] == own["strand"]) & (F.abs(hit["pos"] - own["pos"]) < own["size"])
    seen = mates.join(other.withColumnRenamed("total", "else_total"), "pair_id").where(hit["mate"] == own["mate"])
    return seen.groupBy("pair_id", "total", "own").agg(F.max(F.when(~same, F.col("else_total"))).alias("next"))


def align_pairs(reads: DataFrame, contigs: DataFrame, index: ReferenceIndex | None = None, least_score: int = 30, least_rescued: int = 20, largest: int = 1000) -> DataFrame:
    """pair_id, mate, flag, rname, pos, mapq, cigar, mm, proper of both ends of reads (pair_id string, mate 1 or 2, seq).

    Both ends' local alignments are scored together: the sum of scores less what their distance loses under the insert
    sizes of pairs that are sure. Ends without a partner at a proper distance are looked for around the other's best
    places by the banded programme alone, without seeds, from least_rescued on. A pair is placed together unless its ends
    by themselves score UNPAIRED more; proper tells. mapq is twice the distance to the next total that has the end
    elsewhere, 60 at most. Unmapped ends have flag 4, `*` and 0.
    """
    index = index or ReferenceIndex(contigs)
    named = reads.withColumn("read_id", F.concat_ws("/", "pair_id", F.col("mate").cast("string")))
    sizes = read_lengths(reads)
    longest = max(sizes, default=1)
    found = gapped.gapped_hits(named, contigs, index, sizes, least_score)
    single = stored(_sided(gapped.best_of(found), "n", "next"), "pair-single")
    inserts = insert_sizes(single.where("n = 1"), largest)
    sided = _sided(found, "size")
    met = stored(_together(sided, inserts), "pair-met")
    missing = single.join(met.select("pair_id").distinct(), "pair_id", "left_anti").select("pair_id", "mate", F.col("cost").alias("best"))
    anchors = sided.join(missing, ["pair_id", "mate"]).where("cost = best").drop("best")
    rescued = gapped.aligned(_around(anchors, named, inserts), named, contigs, longest, inserts.high - inserts.low, least_rescued)
    more = _together(sided.join(missing.select("pair_id").distinct(), "pair_id", "left_semi").unionByName(_sided(rescued, "size")).distinct(), inserts)
    chosen = _chosen(met.unionByName(more))
    apart = single.groupBy("pair_id").agg((F.sum(-F.col("cost")) - UNPAIRED).cast("double").alias("apart"), F.count("*").alias("ends"))
    judged = chosen.join(apart, "pair_id", "left").where("apart is null or ends < 2 or total >= apart")
    mapq = F.least(F.lit(60.0), 2 * (F.col("total") - F.coalesce("next", F.lit(0.0)))).cast("int")
    paired = judged.select("pair_id", "own.mate", "own.strand", "own.rname", "own.pos", F.greatest(mapq, F.lit(0)).alias("mapq"), "own.cigar", "own.mm", F.lit(True).alias("proper"))
    lone_mapq = F.when(F.col("n") > 1, 0).otherwise(F.least(F.lit(60), (F.coalesce("next", F.lit(0)) - F.col("cost")) * 2)).cast("int")
    left = single.join(judged.select("pair_id").distinct(), "pair_id", "left_anti").select("pair_id", "mate", "strand", "rname", "pos", lone_mapq.alias("mapq"), "cigar", "mm", F.lit(False).alias("proper"))
    placed = reads.select("pair_id", F.col("mate").cast("int").alias("mate")).join(paired.unionByName(left), ["pair_id", "mate"], "left")
    zero = lambda c, t: F.coalesce(c, F.lit(0)).cast(t).alias(c)
    return placed.select(
        "pair_id", "mate", F.coalesce("strand", F.lit(4)).cast("int").alias("flag"), F.coalesce("rname", F.lit("*")).alias("rname"), zero("pos", "long"), zero("mapq", "int"),
        F.coalesce("cigar", F.lit("*")).alias("cigar"), "mm", F.coalesce("proper", F.lit(False)).alias("proper"),
    )
