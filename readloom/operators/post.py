"""From raw alignments to final ones."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from readloom.functions import alignment as A
from readloom.operators.stored import few, stored

_flag = F.col


def mapped(df: DataFrame) -> DataFrame:
    return df.where(A.without(_flag("flag"), A.UNMAPPED))


def unmapped(df: DataFrame) -> DataFrame:
    return df.where(A.has(_flag("flag"), A.UNMAPPED))


def confident(df: DataFrame, least: int = 20) -> DataFrame:
    return df.where(F.col("mapq") >= least)


def for_statistics(df: DataFrame) -> DataFrame:
    return df.where(A.without(_flag("flag"), A.STATS_MASK))


def deduplicated(df: DataFrame) -> DataFrame:
    return df.where(A.without(_flag("flag"), A.DEDUP_MASK))


def unmapped_stream(flag: Column, mate_missing: Column, legacy: bool = False) -> Column:
    """Where an unmapped read is exported: R1 or R2 with its mate, SE alone. Unpaired reads go to SE, or with legacy
    nowhere (null)."""
    paired = A.has(flag, A.PAIRED) & ~mate_missing
    return (
        F.when(paired & A.has(flag, A.READ1), "R1").when(paired & A.has(flag, A.READ2), "R2")
        .when(A.has(flag, A.READ1) | A.has(flag, A.READ2), "SE")
        .when(F.lit(not legacy), "SE")
    )


def route_unmapped(df: DataFrame, legacy: bool = False, by: tuple[str, ...] = ("qname",)) -> DataFrame:
    """qname, stream, seq, qual of unmapped reads; seq and qual as they were read. A read whose mate, of the same `by`,
    isn't unmapped stands alone."""
    lost = unmapped(df)
    pair = lost.where(A.has(_flag("flag"), A.PAIRED)).groupBy(*by).agg(F.count("*").alias("ends"))
    both = lost.join(pair.where("ends > 1").select(*by, F.lit(True).alias("both")), list(by), "left")
    back = A.has(_flag("flag"), A.REVERSE)
    stream = unmapped_stream(_flag("flag"), F.col("both").isNull(), legacy)
    seq = F.when(back, A.reverse_complement(F.col("seq"))).otherwise(F.col("seq"))
    qual = F.when(back, F.reverse("qual")).otherwise(F.col("qual"))
    names = [*[c for c in by if c != "qname"], "qname"]
    return both.select(*names, stream.alias("stream"), seq.alias("seq"), qual.alias("qual")).where("stream is not null")


def unmapped_pairs(routed: DataFrame, by: tuple[str, ...] = ("qname",)) -> DataFrame:
    """`by`, nth, seq1, qual1, seq2, qual2 of route_unmapped(): a row per pair, or with one end null per read alone.

    A name's first R1 goes with its first R2 and so on, in the order of bases and qualities, so names that repeat lose
    no read; a surplus end stands alone, as every SE read does.
    """
    nth = F.row_number().over(Window.partitionBy(*by, "stream").orderBy("seq", "qual"))
    ends = routed.withColumn("nth", nth).withColumn("alone", F.col("stream") == "SE")
    end = lambda c, streams: F.max(F.when(F.col("stream").isin(*streams), F.col(c)))
    return ends.groupBy(*by, "alone", "nth").agg(
        end("seq", ("R1", "SE")).alias("seq1"), end("qual", ("R1", "SE")).alias("qual1"), end("seq", ("R2",)).alias("seq2"), end("qual", ("R2",)).alias("qual2")
    ).drop("alone")


def fix_mates(df: DataFrame, by: tuple[str, ...] = ("qname",)) -> DataFrame:
    """df (primary alignments) with rnext, pnext, tlen and the mate bits of flag set from the mate: a self-join on
    `by`, which name a pair, without a name sort. Orphans get `*`, 0, 0 and the bit that the mate is unmapped."""
    mate = df.select(
        *by, A.has(_flag("flag"), A.READ1).alias("m_first"), F.col("rname").alias("m_rname"), F.col("pos").alias("m_pos"),
        A.has(_flag("flag"), A.REVERSE).alias("m_reverse"), (F.col("pos") + A.reference_length(F.col("cigar")) - 1).alias("m_end"),
    )
    own = df.withColumn("first", A.has(_flag("flag"), A.READ1)).alias("o")
    same_pair = reduce(and_, [F.col(f"o.{c}") == F.col(f"m.{c}") for c in by])
    both = own.join(mate.alias("m"), same_pair & (F.col("first") != F.col("m_first")) & A.has(F.col("flag"), A.PAIRED), "left")
    end, there = F.col("pos") + A.reference_length(F.col("cigar")) - 1, F.col("m_pos").isNotNull()
    same = there & (F.col("rname") == F.col("m_rname"))
    five, mate_five = F.when(A.has(_flag("flag"), A.REVERSE), end).otherwise(F.col("pos")), F.when(F.col("m_reverse"), F.col("m_end")).otherwise(F.col("m_pos"))
    span = mate_five - five
    tlen = F.when(same, F.when(span > 0, span + 1).when(span < 0, span - 1).when(F.col("first"), F.lit(1)).otherwise(F.lit(-1))).otherwise(F.lit(0))
    cleared = _flag("flag").bitwiseAND(F.lit(~(A.MATE_UNMAPPED | A.MATE_REVERSE)))
    flag = F.when(~A.has(_flag("flag"), A.PAIRED), _flag("flag")).when(there, cleared.bitwiseOR(F.when(F.col("m_reverse"), A.MATE_REVERSE).otherwise(0))).otherwise(cleared.bitwiseOR(F.lit(A.MATE_UNMAPPED)))
    kept = [F.col(f"o.{c}") for c in df.columns if c not in ("flag", "rnext", "pnext", "tlen")]
    return both.select(*kept, flag.cast("int").alias("flag"), F.when(same, "=").when(there, F.col("m_rname")).otherwise("*").alias("rnext"), F.coalesce("m_pos", F.lit(0)).cast("long").alias("pnext"), tlen.cast("long").alias("tlen"))


def mark_duplicates(df: DataFrame, score: Column, fragment_ends: bool = False, by: tuple[str, ...] = ("qname",)) -> DataFrame:
    """df with the duplicate bit of flag set on all but the best of reads that begin alike.

    Two paired reads, one of each end, that share the columns `by` are a pair; every other read stands by itself,
    whatever its name, as names repeat across units. Pairs are alike by both ends' contigs, unclipped 5' positions and
    strands, singles by their own; a single that begins where an end of a pair does is a duplicate of it. The best has
    the highest score (of both ends), then the smallest `by`. With fragment_ends, singles must also end alike.
    Unmapped, secondary and supplementary reads are left alone. Rows equal in `by`, flag, place, CIGAR and score are
    one read told twice and share its verdict.

    What is stored on the way is a row per pair and per place where reads begin, aggregated before the shuffle, so a
    group of any size is never sorted in one task. Only hashes of names, and the names that these say may be twice, are
    shuffled to find pairs. Reads get their verdict where they begin: by a broadcast of few places without a shuffle of
    whole reads, else by a join by place, and one by name if there are pairs.
    """
    counted = A.without(_flag("flag"), A.UNMAPPED | A.SECONDARY | A.SUPPLEMENTARY)
    paired, back = A.has(_flag("flag"), A.PAIRED), A.has(_flag("flag"), A.REVERSE)
    last = F.col("pos") + A.reference_length(F.col("cigar")) - 1
    end = F.concat_ws(":", "rname", A.five_prime(F.col("pos"), F.col("cigar"), _flag("flag")).cast("string"), F.when(back, "-").otherwise("+"))
    lone = F.concat_ws(":", end, F.when(back, F.col("pos")).otherwise(last).cast("string")) if fragment_ends else end
    read = F.xxhash64(*by, _flag("flag").bitwiseAND(F.lit(~A.DUPLICATE)), "rname", "pos", "cigar", score)
    rank = lambda cost, r: F.struct((-cost).alias("cost"), *by, r.alias("read"))

    named = df.where(counted & paired).where(" and ".join(f"{c} is not null" for c in by)).withColumn("_name", F.xxhash64(*by))
    twice, _ = few(named.groupBy("_name").agg(F.count("*").alias("n")).where("n > 1").select("_name"), "names-twice")
    both = named.join(twice, "_name", "left_semi").select(*by, end.alias("end"), read.alias("read"), score.alias("score"), A.has(_flag("flag"), A.READ1).alias("first"))
    both = both.groupBy(*by).agg(F.count("*").alias("ends"), F.count_if("first").alias("firsts"), F.sum("score").alias("score"), F.min("end").alias("e1"), F.max("end").alias("e2"), F.min("read").alias("read"))
    pairs, many = few(both.where("ends = 2 and firsts = 1").select(*by, "e1", "e2", rank(F.col("score"), F.col("read")).alias("rank")), "named-pairs")
    starts, _ = few(pairs.select(F.explode(F.array("e1", "e2")).alias("_end")).distinct().withColumn("_begun", F.lit(True)), "pair-starts")
    best, _ = few(pairs.groupBy("e1", "e2").agg(F.min("rank").alias("best")), "best-pairs")
    mated, _ = few(pairs.join(best, ["e1", "e2"]).select(*[F.col(c).alias(f"_{c}") for c in by], (F.col("rank") != F.col("best")).alias("_loses")), "pairs-judged")
    own = reduce(and_, [F.col(c) == F.col(f"_{c}") for c in by]) & counted & paired
    alone = df.where(counted)
    if many:
        alone = alone.join(mated, own, "left_anti")
    least, _ = few(alone.select(lone.alias("_lone"), rank(score, read).alias("rank")).groupBy("_lone").agg(F.min("rank").alias("_best")), "best-singles")

    told, worse = df.withColumn("_lone", lone).join(least, "_lone", "left"), rank(score, read) != F.col("_best")
    if many:
        told = told.withColumn("_end", end).join(starts, "_end", "left").join(mated, own, "left")
        worse = F.coalesce("_loses", worse | F.col("_begun").isNotNull())
    flag = F.when(counted & worse, _flag("flag").bitwiseOR(F.lit(A.DUPLICATE))).otherwise(_flag("flag").bitwiseAND(F.lit(~A.DUPLICATE)))
    return told.withColumn("flag", flag.cast("int")).select(*df.columns)


def duplicate_report(marked: DataFrame) -> DataFrame:
    """One row of counts: reads read, excluded (unmapped, secondary, supplementary), examined, paired and single among
    these, duplicates of each kind, and the share of duplicates among the examined (0 if there are none)."""
    examined = A.without(_flag("flag"), A.UNMAPPED | A.SECONDARY | A.SUPPLEMENTARY)
    paired, duplicate = A.has(_flag("flag"), A.PAIRED), A.has(_flag("flag"), A.DUPLICATE)
    counts = marked.agg(
        F.count("*").alias("reads"), F.count_if(~examined).alias("excluded"), F.count_if(examined).alias("examined"),
        F.count_if(examined & paired).alias("paired"), F.count_if(examined & ~paired).alias("single"),
        F.count_if(examined & paired & duplicate).alias("duplicate_paired"), F.count_if(examined & ~paired & duplicate).alias("duplicate_single"),
    )
    share = F.when(F.col("examined") > 0, (F.col("duplicate_paired") + F.col("duplicate_single")) / F.col("examined")).otherwise(F.lit(0.0))
    return counts.withColumn("duplicate_share", share)


def with_read_group(df: DataFrame, sample: str) -> DataFrame:
    """tags with the sample's read group in place of any other."""
    rest = F.map_filter("tags", lambda k, _: k != "RG")
    return df.withColumn("tags", F.map_concat(rest, F.create_map(F.lit("RG"), F.lit(f"Z:{sample}"))))


def coordinate_sorted(df: DataFrame, contigs: DataFrame, partitions: int | None = None) -> DataFrame:
    """One range shuffle by contig, in the order of the reference, and position. contigs: tid, rname."""
    placed = df.join(contigs.select("rname", "tid"), "rname", "left")
    keys = [F.col("tid").asc_nulls_last(), F.col("pos")]
    spread = placed.repartitionByRange(partitions, *keys) if partitions else placed.repartitionByRange(*keys)
    return spread.sortWithinPartitions(*keys, "qname", "flag")


def coordinate_ranks(ordered: DataFrame) -> DataFrame:
    """ordered, as coordinate_sorted() gives it, with rank: the row's place from 0 in the order of all, which is the
    rows of earlier range partitions and its place within its own.

    Rows are numbered once and stored in the shared folder, as a second range shuffle may draw other borders; the
    prefix sum takes one row per partition.
    """
    numbered = stored(ordered.withColumn("at", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("at", 33)
    per = numbered.groupBy(part.alias("part")).agg(F.count("*").alias("rows"))
    earlier = F.sum("rows").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    before = per.select("part", F.coalesce(earlier, F.lit(0)).alias("before"))
    place = F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    return numbered.join(F.broadcast(before), part == F.col("part")).select(*ordered.columns, (F.col("before") + place).alias("rank"))
