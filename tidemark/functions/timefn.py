"""Clock arithmetic with the reference's boundary-counting semantics."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def boundaries_crossed(unit: str, start, end) -> Column:
    """Number of ``unit`` boundaries between ``start`` and ``end`` (00:00:59 → 00:01:01 is one minute)."""
    u = unit.upper()
    a = F.date_trunc(u, _c(start))
    b = F.date_trunc(u, _c(end))
    return F.timestamp_diff(u, a, b)


def minute_boundaries(start, end) -> Column:
    return boundaries_crossed("MINUTE", start, end)


def second_boundaries(start, end) -> Column:
    return boundaries_crossed("SECOND", start, end)


def minus_minutes(ts: Column, minutes: int) -> Column:
    return ts - F.expr(f"INTERVAL {int(minutes)} MINUTES")


def minus_days(ts: Column, days: int) -> Column:
    return ts - F.expr(f"INTERVAL {abs(int(days))} DAYS")


def ts_literal(value) -> Column:
    """A TIMESTAMP_NTZ literal from a datetime or ISO text (no session-zone shift)."""
    text = value.isoformat(sep=" ") if hasattr(value, "isoformat") else str(value)
    return F.lit(text).cast("timestamp_ntz")
