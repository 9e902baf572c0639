"""Reads to the reference: seeds from a stored index, candidate diagonals, and verification.

Ancient reads are matched end to end within a budget of mismatches; seeds are chosen so that no placement within it is
missed (see seeds). Modern reads are matched locally with gaps (see gapped), their ends clipped where that scores better.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import exp, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from readloom.functions.alignment import reference_length, reverse_complement
from readloom.functions.packed import code_of
from readloom.operators import gapped
from readloom.operators.seeds import WAVE, placements, plans_of
from readloom.operators.stored import stored_in_waves, waves
from readloom.sources.index import ReferenceIndex
from readloom.sources.reference import windows

#: Bases of a contig in one piece, besides the overlap of the longest read: every candidate is joined with one piece.
STEP = 1024
#: Pieces grow with reads longer than STEP, so that a contig's pieces together have twice its bases; up to this.
MOST_STEP = 1 << 18


def mismatch_budget(length: int, allowed: float, error: float = 0.02) -> int:
    """Mismatches that a read may have: `allowed` itself if 0 or from 1 on, else the least number that a read of this
    length exceeds with a probability under it, at `error` errors a base."""
    if allowed == 0 or allowed >= 1:
        return int(allowed)
    mean, term, below, k = length * error, -length * error, exp(-length * error), 0
    while k == 0 or 1 - below >= allowed:
        k += 1
        term += log(mean / k)  # as a logarithm, which long reads don't take to 0
        below += exp(term)
    return k


def read_lengths(reads: DataFrame) -> dict[int, int]:
    """How many reads (seq) have each length, in order, without 0: as many rows as the longest read has bases at most."""
    return dict(sorted(reads.groupBy(F.length("seq").alias("n")).agg(F.count("*")).where("n > 0").collect()))


def _against(candidates: DataFrame, contigs: DataFrame, longest: int) -> DataFrame:
    """candidates (rname, pos, bases) with reference: the bases of the contig under them, as many as it has. Contigs
    come in pieces, which are joined by place and overlap by the bases of the longest candidate."""
    size = min(max(STEP, longest), MOST_STEP)
    pieces = windows(contigs, size, longest).select("rname", "window", F.col("start").alias("piece_start"), F.col("bases").alias("piece"))
    at = candidates.withColumn("window", F.expr(f"cast((greatest(pos, 1) - 1) div {size} as int)"))
    joined = at.join(pieces, ["rname", "window"])
    return joined.withColumn("reference", F.expr("substring(piece, cast(greatest(pos, 1) - piece_start + 1 as int), cast(length(bases) - greatest(1 - pos, 0) as int))")).drop("piece", "piece_start", "window")


def with_reference(alignments: DataFrame, contigs: DataFrame, around: int = 10) -> DataFrame:
    """alignments (rname, pos, cigar) with reference, the contig's bases they span, and left and right, up to `around`
    bases before and after them. Unmapped ones are left out."""
    size = reference_length(F.col("cigar"))
    mapped = alignments.where("rname <> '*' and pos >= 1").withColumn("span", size.cast("int"))
    longest = mapped.agg(F.max("span")).first()[0] or 1
    step = min(max(STEP, longest), MOST_STEP)
    pieces = windows(contigs, step, longest + 2 * around).select("rname", "window", F.col("start").alias("piece_start"), F.col("bases").alias("piece"))
    begin = F.greatest(F.col("pos") - around, F.lit(1))
    joined = mapped.withColumn("begin", begin).withColumn("window", F.expr(f"cast((begin - 1) div {step} as int)")).join(pieces, ["rname", "window"])
    cut = lambda start, n: F.expr(f"substring(piece, cast({start} - piece_start + 1 as int), cast({n} as int))")
    added = {"reference": cut("pos", "span"), "left": cut("begin", "pos - begin"), "right": cut("pos + span", around)}
    return joined.withColumns(added).drop("piece", "piece_start", "window", "begin", "span")


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all strings of a column after one another, and where each begins."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]], offsets[:-1] - offsets[0]


def with_mismatches(compared: DataFrame) -> DataFrame:
    """compared (bases and reference, each pair of one length above 0) with mm: places where the two differ. Letters
    other than A, C, G, T match nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                (a, begins), (b, _) = (_flat(batch.column(batch.schema.get_field_index(c))) for c in ("bases", "reference"))
                a, b = code_of(a), code_of(b)
                mm = np.add.reduceat(((a != b) | (a > 3)).astype(np.int32), begins)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(mm, pa.int32())], names=[*batch.schema.names, "mm"])

    return compared.mapInArrow(run, T.StructType([*compared.schema.fields, T.StructField("mm", T.IntegerType())]))


def place_ancient(reads: DataFrame, contigs: DataFrame, mismatch: float = 0.01, index: ReferenceIndex | None = None) -> DataFrame:
    """read_id, strand, rname, pos, mm of every end-to-end placement of reads (read_id, seq) within their budget.

    What the index says of the bases around a seed settles most candidates where they are found; those that reach
    further are stored and compared with the contig whole. Seeds are shuffled for so many reads at once that the disk
    holds about as many as the index has rows, WAVE at least.
    """
    sizes, index = read_lengths(reads), index or ReferenceIndex(contigs)
    budgets = {n: mismatch_budget(n, mismatch) for n in sizes}
    made = sum(2 * p.looked * sizes[n] for n, p in plans_of(budgets, index).items())
    found = stored_in_waves((placements(part, index, budgets) for part in waves(reads, made, max(WAVE, index.bases))), "placements")
    bases = F.when(F.col("strand") == 16, reverse_complement(F.col("seq"))).otherwise(F.col("seq"))
    rest = found.where("mm is null").drop("mm").join(reads.select("read_id", "seq"), "read_id").withColumn("bases", bases).drop("seq")
    compared = _against(rest, contigs, max(budgets, default=1)).where("octet_length(reference) = octet_length(bases)")
    columns = ("read_id", "strand", "rname", "pos", "mm")
    return found.where("mm is not null").select(*columns).unionByName(with_mismatches(compared).where("mm <= budget").select(*columns))


def _best_of(hits: DataFrame, cost: str) -> DataFrame:
    """Per read the placement of least cost (then by contig, place and strand), how many share the cost, and the next
    cost, from one row per read and cost."""
    levels = hits.groupBy("read_id", cost).agg(F.count("*").alias("n"), F.min(F.struct("rname", "pos", "strand")).alias("hit"))
    ranked = levels.groupBy("read_id").agg(F.array_sort(F.collect_list(F.struct(cost, "n", "hit"))).alias("l"))
    return ranked.select("read_id", F.col("l")[0][cost].alias(cost), F.col("l")[0]["n"].alias("n"), F.col("l")[0]["hit"].alias("hit"), F.try_element_at("l", F.lit(2))[cost].alias("next")).select("read_id", cost, "n", "next", "hit.*")


def align_ancient(reads: DataFrame, contigs: DataFrame, mismatch: float = 0.01, index: ReferenceIndex | None = None) -> DataFrame:
    """read_id, flag, rname, pos, mapq, cigar, mm of every read; unmapped ones have flag 4, `*` and 0.

    mapq is 37 for the only placement, 25 if there are worse ones, and 0 if several are best, of which the first by
    contig, place and strand is given.
    """
    best = _best_of(place_ancient(reads.select("read_id", "seq"), contigs, mismatch, index), "mm")
    mapq = F.when(F.col("n") > 1, 0).when(F.col("next").isNotNull(), 25).otherwise(37)
    return _with_unmapped(reads, best.select("read_id", "strand", "rname", "pos", mapq.alias("mapq"), "mm", F.lit(None).cast("string").alias("clipped_cigar")))


def _with_unmapped(reads: DataFrame, best: DataFrame) -> DataFrame:
    lost = F.col("rname").isNull()
    return reads.select("read_id", F.length("seq").alias("bases")).join(best, "read_id", "left").select(
        "read_id", F.coalesce("strand", F.lit(4)).cast("int").alias("flag"), F.when(lost, "*").otherwise(F.col("rname")).alias("rname"), F.coalesce("pos", F.lit(0)).cast("long").alias("pos"),
        F.coalesce("mapq", F.lit(0)).cast("int").alias("mapq"), F.when(lost, "*").otherwise(F.coalesce("clipped_cigar", F.concat("bases", F.lit("M")))).alias("cigar"), "mm",
    )


def align_modern(reads: DataFrame, contigs: DataFrame, least_score: int = 30, index: ReferenceIndex | None = None) -> DataFrame:
    """Like align_ancient(), by local alignment with gaps of up to 16 bases: 1 for a base, -4 for a mismatch, -6 and -1
    a base for a gap; the rest is clipped. mm counts differing bases and those of gaps. mapq grows with the distance to
    the score of the next place, to 60."""
    hits = gapped.gapped_hits(reads, contigs, index or ReferenceIndex(contigs), read_lengths(reads), least_score)
    mapq = F.when(F.col("n") > 1, 0).otherwise(F.least(F.lit(60), (F.coalesce("next", F.lit(0)) - F.col("cost")) * 2))
    return _with_unmapped(reads, gapped.best_of(hits).select("read_id", "strand", "rname", "pos", mapq.alias("mapq"), "mm", F.col("cigar").alias("clipped_cigar")))


def as_pairs(placed: DataFrame, largest: int = 1000, by: tuple[str, ...] = ("qname",)) -> DataFrame:
    """placed (the columns `by`, which name a pair, mate and the columns of an aligner) with the bits of pairs in flag:
    which mate, what the other did, and proper if the two face each other on one contig within `largest` bases."""
    other = placed.select(*by, (3 - F.col("mate")).alias("mate"), F.col("flag").alias("m_flag"), F.col("rname").alias("m_rname"), F.col("pos").alias("m_pos"))
    both = placed.join(other, [*by, "mate"], "left")
    bit = lambda c, b: F.col(c).bitwiseAND(F.lit(b)) != 0
    ahead = F.when(bit("flag", 16), F.col("m_pos") <= F.col("pos")).otherwise(F.col("pos") <= F.col("m_pos"))
    proper = ~bit("flag", 4) & ~bit("m_flag", 4) & (F.col("rname") == F.col("m_rname")) & (bit("flag", 16) != bit("m_flag", 16)) & ahead & (F.abs(F.col("pos") - F.col("m_pos")) <= largest)
    flag = F.col("flag") + 1 + F.when(F.col("mate") == 1, 64).otherwise(128) + F.when(F.col("m_flag").isNull() | bit("m_flag", 4), 8).otherwise(0) + F.when(bit("m_flag", 16), 32).otherwise(0) + F.when(proper, 2).otherwise(0)
    return both.withColumn("flag", flag.cast("int")).drop("m_flag", "m_rname", "m_pos")
