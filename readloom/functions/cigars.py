"""CIGARs of whole batches: which base of a read stands over which base of the reference."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

_READ, _REFERENCE = (np.isin(np.arange(256), list(ops)) for ops in (b"MIS=X", b"MDN=X"))
_MATCHED = np.isin(np.arange(256), list(b"M=X"))


class Walk:
    """The runs of CIGARs, in order: row, op (a byte), size, and how many bases of the read (soft clips among them) and
    of the reference (from the alignment's position) come before. Null and * have no runs."""

    def __init__(self, cigars: pa.Array):
        cigars = cigars.cast(pa.large_string())
        at = np.frombuffer(cigars.buffers()[1], np.int64)[cigars.offset : cigars.offset + len(cigars) + 1]
        letters = np.frombuffer(cigars.buffers()[2] or b"", np.uint8)[at[0] : at[-1]]
        digit = (letters >= 48) & (letters < 58)
        ends, digits = np.flatnonzero(~digit), np.flatnonzero(digit)
        of = np.searchsorted(ends, digits)
        size = np.bincount(of, weights=(letters[digits] - 48.0) * 10.0 ** (ends[of] - 1 - digits), minlength=len(ends)).astype(np.int64)
        op = letters[ends]
        known = op != ord("*")
        self.rows = len(cigars)
        self.row, self.op, self.size = (np.searchsorted(at - at[0], ends, side="right") - 1)[known], op[known], size[known]
        self.read_at, self.reference_at = self._before(_READ), self._before(_REFERENCE)

    def _before(self, moves: np.ndarray) -> np.ndarray:
        step = self.size * moves[self.op]
        total = np.cumsum(step) - step
        first = np.searchsorted(self.row, self.row)
        return total - total[first] if len(total) else total

    def matched(self) -> np.ndarray:
        """Which runs hold bases of both."""
        return _MATCHED[self.op]

    def columns(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A column for each base between the first and the last aligned one: its row, and its places on the read and on
        the reference, -1 in a gap. Clips and skipped stretches have none."""
        both, read, ref = _MATCHED[self.op], self.op == ord("I"), self.op == ord("D")
        use = np.flatnonzero(both | read | ref)
        run = np.repeat(use, self.size[use])
        nth = np.arange(len(run)) - np.repeat(np.cumsum(self.size[use]) - self.size[use], self.size[use])
        return self.row[run], np.where(ref[run], -1, self.read_at[run] + nth), np.where(read[run], -1, self.reference_at[run] + nth)


def matched_spans(pos: Column, cigar: Column) -> Column:
    """array of (start, end, inclusive): the stretches of the reference under bases of the read, without deletions."""
    runs = F.regexp_extract_all(cigar, F.lit(r"(\d+[MDN=X])"), 1)
    size = lambda x: F.expr("cast(1 as long)") * F.left(x, F.length(x) - 1).cast("long")
    span = lambda at, n: F.array(F.struct(at.alias("start"), (at + n - 1).alias("end")))
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    walked = F.aggregate(
        runs, F.struct(pos.cast("long").alias("at"), none.alias("spans")),
        lambda a, x: F.struct((a["at"] + size(x)).alias("at"), F.when(F.right(x, F.lit(1)).isin("M", "=", "X"), F.concat(a["spans"], span(a["at"], size(x)))).otherwise(a["spans"]).alias("spans")),
        lambda a: a["spans"],
    )
    whole = F.aggregate(runs, F.lit(0).cast("long"), lambda a, x: a + size(x))
    return F.when(cigar.rlike("[DN]"), walked).otherwise(span(pos.cast("long"), whole))
