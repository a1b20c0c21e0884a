"""Row-wise helpers that pass over nulls."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_sum(*cols: Column) -> Column:
    """Sum across columns, null counting as zero."""
    total = F.lit(0)
    for c in cols:
        total = total + F.coalesce(c, F.lit(0))
    return total


def null_count(*cols: Column) -> Column:
    return row_sum(*[c.isNull().cast("int") for c in cols])


def whole_seconds(later: Column, earlier: Column) -> Column:
    """Whole seconds between two timestamps, cut towards zero."""
    micros = F.unix_micros(later) - F.unix_micros(earlier)
    return (micros - micros % 1_000_000).cast("long").__truediv__(1_000_000).cast("long")


def lag_seconds(published: Column, happened: Column) -> Column:
    """Seconds from an event to its publication, both as epochs."""
    return published - happened
