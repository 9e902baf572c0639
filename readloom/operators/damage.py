"""Damage of ancient molecules: substitutions by distance from the ends, and fragment lengths."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.functions import alignment as A
from readloom.functions.cigars import Walk


_TURNED = np.frombuffer(bytes.maketrans(b"ACGT", b"TGCA"), np.uint8)


def _tally(strings: pa.Array, others: pa.Array, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of (place, byte of strings, byte of others) over rows of equal lengths up to depth, and how often each."""
    def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        column = column.cast(pa.binary())
        at = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
        return np.frombuffer(column.buffers()[2] or b"", np.uint8)[at[0] : at[-1]], np.diff(at)

    (one, sizes), (two, _) = flat(strings), flat(others)
    place = np.arange(len(one)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    counts = np.bincount((place << 16) + one.astype(np.int64) * 256 + two, minlength=depth << 16)
    codes = np.flatnonzero(counts)
    return codes, counts[codes]


def _counts(total: Counter) -> pa.RecordBatch:
    rows = [(end, (code >> 16) + 1, chr(code >> 8 & 255), chr(code & 255), n) for (end, code), n in total.items()]
    columns = list(zip(*rows, strict=True)) or [()] * 5
    kinds = (pa.string(), pa.int32(), pa.string(), pa.string(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["end", "place", "ref", "alt", "n"])


def substitutions(aligned: DataFrame, depth: int = 25) -> DataFrame:
    """end (5p or 3p), place (from 1), ref, alt, n over all contigs: aligned has flag, and seq and reference of one
    length without gaps, both in the contig's direction; rows where these are null or of two lengths are left out.
    Places count along the molecule, so reverse reads are turned.

    Only the `depth` bases at either end go to Python, where a batch is counted at once; a task hands on its counts, a
    row for each change it saw, so the shuffle doesn't grow with the reads.
    """
    back = A.has(F.col("flag"), A.REVERSE)
    turn = lambda c: F.when(back, A.reverse_complement(F.col(c))).otherwise(F.col(c))
    own = aligned.where("length(seq) = length(reference)").select(turn("seq").alias("s"), turn("reference").alias("r"))
    ends = own.selectExpr(f"left(r, {depth}) as r5", f"left(s, {depth}) as s5", f"reverse(right(r, {depth})) as r3", f"reverse(right(s, {depth})) as s3")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for end, (i, j) in (("5p", (0, 1)), ("3p", (2, 3))):
                codes, counts = _tally(batch.column(i), batch.column(j), depth)
                for code, n in zip(codes.tolist(), counts.tolist(), strict=True):
                    total[end, code] += n
        yield _counts(total)

    return ends.mapInArrow(run, "end string, place int, ref string, alt string, n long").groupBy("end", "place", "ref", "alt").agg(F.sum("n").alias("n"))


def substitutions_under_cigars(aligned: DataFrame, depth: int = 25) -> DataFrame:
    """The same of alignments with clips and gaps: aligned has flag, seq, cigar and reference, the contig's bases that
    the alignment spans. Places count columns from the first and the last aligned base, clipped bases not among them;
    a gap is a column, with - as ref or alt. Rows whose strings don't fit their CIGAR are left out."""
    plain = aligned.where(F.col("cigar").rlike(r"^\d+M$"))
    rest = aligned.where(~F.col("cigar").rlike(r"^\d+M$")).select("flag", "seq", "cigar", "reference").where("seq is not null and reference is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            walk = Walk(batch.column(2))
            (read, read_at), (ref, ref_at) = _letters(batch.column(1)), _letters(batch.column(3))
            row, on_read, on_ref = walk.columns()
            spans = [np.zeros(batch.num_rows, np.int64) for _ in range(2)]
            for span, ops, before in zip(spans, (b"MIS=X", b"MDN=X"), (walk.read_at, walk.reference_at), strict=True):
                np.maximum.at(span, walk.row, before + walk.size * np.isin(walk.op, list(ops)))
            fits = (spans[0] == np.diff(read_at)) & (spans[1] == np.diff(ref_at))
            use = fits[row]
            row, on_read, on_ref = row[use], on_read[use], on_ref[use]
            back = batch.column(0).to_numpy()[row] & A.REVERSE > 0
            many = np.bincount(row, minlength=batch.num_rows)
            place = np.arange(len(row)) - (np.cumsum(many) - many)[row]
            from_end = many[row] - 1 - place
            letters = []
            for text, at, on in ((ref, ref_at, on_ref), (read, read_at, on_read)):
                x = np.where(on < 0, ord("-"), np.append(text, 45)[np.where(on < 0, len(text), at[row] + on)])
                letters.append(np.where(back, _TURNED[x], x).astype(np.int64))
            for end, p in (("5p", np.where(back, from_end, place)), ("3p", np.where(back, place, from_end))):
                near = p < depth
                counts = np.bincount((p[near] << 16) + letters[0][near] * 256 + letters[1][near], minlength=1)
                for code in np.flatnonzero(counts).tolist():
                    total[end, code] += int(counts[code])
        yield _counts(total)

    counted = rest.mapInArrow(run, "end string, place int, ref string, alt string, n long")
    return substitutions(plain, depth).unionByName(counted).groupBy("end", "place", "ref", "alt").agg(F.sum("n").alias("n"))


def _letters(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.cast(pa.large_string())
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2] or b"", np.uint8)[at[0] : at[-1]], at - at[0]


def base_composition(aligned: DataFrame) -> DataFrame:
    """end, place (1 is next to the end), base, n: the contig's bases outside the ends of molecules. aligned has flag,
    and left and right, the contig's bases before and after the alignment in its direction; reverse reads are turned."""
    back = A.has(F.col("flag"), A.REVERSE)
    other = lambda c: F.translate(c, "ACGT", "TGCA")
    five = F.when(back, other(F.col("right"))).otherwise(F.reverse("left"))
    three = F.when(back, other(F.reverse("left"))).otherwise(F.col("right"))
    ends = aligned.select(five.alias("five"), three.alias("three"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for i, end in enumerate(("5p", "3p")):
                text, at = _letters(batch.column(i))
                place = np.arange(len(text)) - np.repeat(at[:-1], np.diff(at))
                counts = np.bincount((place << 8) + text, minlength=1)
                for code in np.flatnonzero(counts).tolist():
                    total[end, code] += int(counts[code])
        rows = [(end, (code >> 8) + 1, chr(code & 255), n) for (end, code), n in total.items()]
        columns = list(zip(*rows, strict=True)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int32(), pa.string(), pa.int64()), strict=True)], names=["end", "place", "base", "n"])

    return ends.mapInArrow(run, "end string, place int, base string, n long").groupBy("end", "place", "base").agg(F.sum("n").alias("n"))


def damage_profile(counts: DataFrame) -> DataFrame:
    """end, place, rate: of C read as T from the 5' end, and of G read as A from the 3' end."""
    five, three = (F.col("end") == "5p") & (F.col("ref") == "C"), (F.col("end") == "3p") & (F.col("ref") == "G")
    changed = (five & (F.col("alt") == "T")) | (three & (F.col("alt") == "A"))
    return counts.where(five | three).groupBy("end", "place").agg((F.sum(F.when(changed, F.col("n")).otherwise(0)) / F.sum("n")).alias("rate"))


def fragment_lengths(aligned: DataFrame) -> DataFrame:
    """length, strand, n of reads that stand for fragments."""
    strand = F.when(A.has(F.col("flag"), A.REVERSE), "-").otherwise("+")
    return aligned.where(A.represents_fragment(F.col("flag"))).groupBy(F.length("seq").alias("length"), strand.alias("strand")).agg(F.count("*").alias("n"))
