"""Bits, positions and sequences of alignments."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bits of the alignment flag.
PAIRED, PROPER, UNMAPPED, MATE_UNMAPPED, REVERSE, MATE_REVERSE, READ1, READ2 = 1, 2, 4, 8, 16, 32, 64, 128
SECONDARY, FAILED, DUPLICATE, SUPPLEMENTARY = 256, 512, 1024, 2048
#: Left out of statistics, of the final alignments, and of coverage.
STATS_MASK = UNMAPPED | SECONDARY | FAILED | SUPPLEMENTARY
DEDUP_MASK = UNMAPPED | DUPLICATE
COVERAGE_MASK = UNMAPPED | SECONDARY | FAILED | DUPLICATE


def has(flag: Column, bits: int) -> Column:
    return flag.bitwiseAND(F.lit(bits)) != 0


def without(flag: Column, bits: int) -> Column:
    return flag.bitwiseAND(F.lit(bits)) == 0


def represents_fragment(flag: Column) -> Column:
    """Unpaired reads count as fragments, and of pairs READ1."""
    return without(flag, PAIRED) | has(flag, READ1)


def _sum_lengths(cigar: Column, operations: str) -> Column:
    return F.aggregate(F.regexp_extract_all(cigar, F.lit(rf"(\d+)[{operations}]"), 1), F.lit(0).cast("long"), lambda a, n: a + n.cast("long"))


def reference_length(cigar: Column) -> Column:
    """Bases of the reference that the alignment spans."""
    return _sum_lengths(cigar, "MDN=X")


def clipped(cigar: Column, end: bool) -> Column:
    """Bases clipped, softly or hard, at the alignment's start or end."""
    pattern = r"((?:\d+[SH])+)\z" if end else r"^((?:\d+[SH])+)"
    return _sum_lengths(F.regexp_extract(cigar, pattern, 1), "SH")


def five_prime(pos: Column, cigar: Column, flag: Column) -> Column:
    """Position of the read's 5' end as if nothing were clipped."""
    return F.when(has(flag, REVERSE), pos + reference_length(cigar) - 1 + clipped(cigar, end=True)).otherwise(pos - clipped(cigar, end=False))


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGTNacgtn", "TGCANtgcan"))


def qualities(qual: Column) -> Column:
    """Phred scores from their characters."""
    return F.transform(F.filter(F.split(qual, ""), lambda c: c != ""), lambda c: F.ascii(c) - 33)


def quality_score(qual: Column, least: int = 15) -> Column:
    """The sum of the scores from `least` on, by which duplicates are ranked."""
    return F.aggregate(F.filter(qualities(qual), lambda q: q >= least), F.lit(0).cast("long"), lambda a, q: a + q.cast("long"))
