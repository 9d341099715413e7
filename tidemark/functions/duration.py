"""Duration text ``H:MM:SS.mmm`` from an amount of time in a unit (hours not padded)."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted unit names; anything else counts as zero time.
HOUR_UNITS = ("hour", "hh")
MINUTE_UNITS = ("minute", "mi", "n")
SECOND_UNITS = ("second", "ss", "s")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def format_duration(time: Column | str, unit: Column | str = "second") -> Column:
    """``time`` (read as DECIMAL(28,3)) in ``unit`` → text; decimal arithmetic so no float rounding creeps in.

    ``unit`` is a Column, or a plain string taken as the unit name itself.
    """
    t = _c(time).cast("decimal(28,3)")
    u = F.lit(unit) if isinstance(unit, str) else unit
    secs = (F.when(u.isin(*HOUR_UNITS), t * F.lit(3600))
             .when(u.isin(*MINUTE_UNITS), t * F.lit(60))
             .when(u.isin(*SECOND_UNITS), t)
             .otherwise(F.lit(0))).cast("decimal(18,3)")
    hours = (secs / F.lit(3600)).cast("bigint")          # BIGINT: no overflow past 35,791,394 hours
    minutes = (secs / F.lit(60) - hours.cast("decimal(20,0)") * F.lit(60)).cast("int")
    rest = (secs % F.lit(60)).cast("decimal(18,3)")
    return F.concat(hours.cast("string"), F.lit(":"), F.lpad(minutes.cast("string"), 2, "0"), F.lit(":"),
                    F.lpad(rest.cast("string"), 6, "0"))
