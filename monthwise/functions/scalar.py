"""Types of money columns and the helpers that are easier as Column expressions; all
others are SQL text in :mod:`monthwise.functions.sql`."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,6)"      # normalised money (MRR, ARR)
TOTAL = "decimal(28,6)"      # sums of MONEY


def ntz_lit(ts) -> Column:
    """A TIMESTAMP_NTZ literal built from its text (independent of the driver's
    and the session's time zones)."""
    return F.expr(f"TIMESTAMP_NTZ '{ts:%Y-%m-%d %H:%M:%S.%f}'")


def ntz_to_epoch(c: Column) -> Column:
    """Seconds since 1970-01-01 of a wall-clock (NTZ) timestamp, read as UTC."""
    return F.unix_seconds(c.cast("timestamp"))


def hours_between_boundaries(start: Column, end: Column) -> Column:
    """``datediff('hour', start, end)`` as warehouses define it: the number of
    hour boundaries crossed (00:59 -> 02:01 is 2), not elapsed hours."""
    return (F.floor(ntz_to_epoch(end) / 3600) - F.floor(ntz_to_epoch(start) / 3600)).cast("bigint")
