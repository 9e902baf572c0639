"""Numbers out of step reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_int(report: Column, *paths: str) -> Column:
    """Of dotted paths into a JSON report: the first whole number that isn't 0, else the first there is, else 0."""
    found = [F.get_json_object(report, f"$.{p}").try_cast("bigint") for p in paths]
    return F.coalesce(*[F.nullif(x, F.lit(0)) for x in found], *found, F.lit(0)).cast("long")
