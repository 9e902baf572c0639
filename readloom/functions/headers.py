"""Read names and mate directions from FASTQ headers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def qname(header: Column) -> Column:
    """The first blank-separated token without its leading @, and without one /1 and then one /2 at its end."""
    token = F.regexp_replace(F.split_part(header, F.lit(" "), F.lit(1)), "^@", "")
    return F.regexp_replace(F.regexp_replace(token, r"/1\z", ""), r"/2\z", "")


def direction(header: Column, sample: Column) -> Column:
    """R1, R2 or UNKNOWN; the first rule that holds decides.

    ` 1:` or ` 2:` anywhere; the second token ends in /1 or /2; the first token does; the second token is a bare 1
    or 2 and the same on all headers of sample, the file's first few.
    """
    first, second = F.split_part(header, F.lit(" "), F.lit(1)), F.split_part(header, F.lit(" "), F.lit(2))
    steady = F.forall(sample, lambda h: F.split_part(h, F.lit(" "), F.lit(2)) == second)
    return (
        F.when(header.contains(" 1:"), "R1").when(header.contains(" 2:"), "R2")
        .when(second.endswith("/1"), "R1").when(second.endswith("/2"), "R2")
        .when(first.endswith("/1"), "R1").when(first.endswith("/2"), "R2")
        .when((second == "1") & steady, "R1").when((second == "2") & steady, "R2")
        .otherwise("UNKNOWN")
    )
