"""Version ↔ time lookups and interval joins, as equi-joins instead of nested loops.

Checkpoints ``(date, rv)`` say which version had been issued at which time.  "Latest date whose version is at or
below v" is an as-of join.  A direct ``max(date) … WHERE ck.rv <= v`` plans as a broadcast nested loop (rows × points).
Here the checkpoints, numbered in key order, are dealt into at most ``RANGES`` ranges of equal *depth*: every range
holds the same number of them however unevenly the keys lie.  A point finds its range by a binary search in the
constant array of range bounds and equi-joins on it, so it meets only the few intervals of that range.

Keys are compared without a time zone: wall-clock values (timestamp_ntz, date) are never cast through the session's.
"""
from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.versions import rv_to_hex
from .versions import number_rows

# Most ranges of the interval join.
BUCKETS = 1024
# Most ranges of checkpoints; their bounds (one number each) reach the driver.
RANGES = 1 << 14
DEFAULT_BROADCAST_ROWS = 2_000_000       # rows of three or four fixed-width values: under 100 MB


def _is_wall(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.TimestampNTZType, T.DateType))


def _numeric(col: Column, dtype: T.DataType, wall: bool) -> Column:
    """Order-preserving BIGINT view of a key: micros for times, of the wall clock when ``wall`` (either side of the
    lookup is a wall-clock value), else of the instant."""
    if isinstance(dtype, T.TimestampType) and not wall:
        return F.unix_micros(col)
    if _is_wall(dtype) or isinstance(dtype, T.TimestampType):
        t = col.cast("timestamp_ntz")
        day = F.unix_date(t.cast("date")).cast("bigint")
        seconds = (day * 24 + F.hour(t)) * 3600 + F.minute(t) * 60
        return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), t) * 1_000_000).cast("bigint")
    return col.cast("bigint")


def _truncate(t: Column, unit: str) -> Column:
    """``date_trunc`` of a wall-clock value without a time zone."""
    part = F.extract(F.lit("SECOND"), t)
    none = F.lit(0)
    if unit == "second":
        return t - F.make_dt_interval(none, none, none, part - F.floor(part))
    if unit == "minute":
        return t - F.make_dt_interval(none, none, none, part)
    if unit == "hour":
        return t - F.make_dt_interval(none, none, F.minute(t), part)
    if unit == "day":
        return t.cast("date").cast("timestamp_ntz")
    return F.trunc(t.cast("date"), unit).cast("timestamp_ntz")


def build_checkpoints(changes: DataFrame, time_col: str, version_col: str, unit: str = "hour",
                      how: str = "min") -> DataFrame:
    """One checkpoint per ``unit`` of time: the version known at that time (``min`` or ``max`` in the bucket).
    Map-side partial aggregation; output size is the number of time buckets."""
    agg = F.min if how == "min" else F.max
    return (changes.groupBy(_truncate(F.col(time_col).cast("timestamp_ntz"), unit).alias("date"))
            .agg(agg(version_col).alias("rv")))


def checkpoint_ranges(ck: DataFrame, key_num: Column, val_col: str):
    """Checkpoints → (``_range``, ``_start``, ``_end``, ``_val``): disjoint intervals ``[_start, _end)`` of the numeric
    key that carry the running maximum of the value (right even when it falls); ``_end`` is NULL for the last one.

    Returns (intervals, first key of each range, number of intervals).  Lead and running maximum run inside a range;
    a summary of one row a range carries them across, so no window sees all checkpoints.
    """
    base = (ck.select(key_num.alias("_k"), F.col(val_col).alias("_v")).where("_k is not null and _v is not null")
            .groupBy("_k").agg(F.max("_v").alias("_v")))
    numbered = number_rows(base, ["_k"], -1, "_n")       # materialised: the uses below read the same numbers
    n = numbered.count()
    depth = max(-(-n // RANGES), 1)
    r = numbered.withColumn("_range", F.expr(f"cast(_n div {depth} as int)"))
    first = [x["_k"] for x in numbered.where(F.col("_n") % depth == 0).orderBy("_k").select("_k").collect()]
    inside = Window.partitionBy("_range").orderBy("_k")
    r = r.select("_range", "_k", F.lead("_k").over(inside).alias("_next"),
                 F.max("_v").over(inside.rowsBetween(Window.unboundedPreceding, 0)).alias("_run"), "_v")
    across = Window.orderBy("_range")                    # at most RANGES summary rows
    summary = r.groupBy("_range").agg(F.min("_k").alias("_first"), F.max("_v").alias("_top")).select(
        "_range", F.lead("_first").over(across).alias("_next_range"),
        F.max("_top").over(across.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"))
    iv = r.join(F.broadcast(summary), "_range").select(
        "_range", F.col("_k").alias("_start"), F.coalesce("_next", "_next_range").alias("_end"),
        F.greatest("_run", "_before").alias("_val"))
    return iv, first, n


def _range_of(key: Column, first: list) -> Column:
    """Number of the last range that starts at or below ``key`` (-1: none): a binary search in a constant array."""
    bounds = F.split(F.lit(",".join(map(str, first))), ",").cast("array<bigint>")      # folded into one literal
    steps = [1 << i for i in reversed(range(len(first).bit_length()))]
    found = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0),
                        lambda at, s: F.when((at + s <= len(first)) & (F.get(bounds, at + s - 1) <= key), at + s).otherwise(at))
    return F.when(key.isNotNull(), found - 1)


def asof_join(points: DataFrame, ck: DataFrame, point_col: str, key_col: str, val_col: str, out_col: str,
              broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Add ``out_col`` = max(``val_col``) over checkpoints with ``key_col`` ≤ the point's ``point_col`` (else NULL)."""
    out_type = ck.schema[val_col].dataType
    ptype, ktype = points.schema[point_col].dataType, ck.schema[key_col].dataType
    wall = _is_wall(ptype) or _is_wall(ktype)
    iv, first, n = checkpoint_ranges(ck, _numeric(F.col(key_col), ktype, wall), val_col)
    if not n:
        return points.withColumn(out_col, F.lit(None).cast(out_type))
    p = points.withColumn("_pk", _numeric(F.col(point_col), ptype, wall)).withColumn("_range", _range_of(F.col("_pk"), first))
    right = F.broadcast(iv) if n <= broadcast_rows else iv
    cond = ((p["_range"] == right["_range"]) & (p["_pk"] >= right["_start"])
            & (right["_end"].isNull() | (p["_pk"] < right["_end"])))
    j = p.join(right, cond, "left")
    return j.select(*[p[c] for c in points.columns], right["_val"].cast(out_type).alias(out_col))


def rv_to_date(df: DataFrame, ck: DataFrame, version_col: str = "rv", out_col: str = "date",
               ck_version: str = "rv", ck_date: str = "date") -> DataFrame:
    """Latest checkpoint date at or below each row's version."""
    return asof_join(df, ck, version_col, ck_version, ck_date, out_col)


def date_to_rv(df: DataFrame, ck: DataFrame, date_col: str, out_col: str = "rv", ck_version: str = "rv",
               ck_date: str = "date") -> DataFrame:
    """Highest checkpoint version at or before each row's date."""
    return asof_join(df, ck, date_col, ck_date, ck_version, out_col)


def asof_date(df: DataFrame, ck: DataFrame, version_col: str = "rv", out_col: str = "source_approx_date",
              ck_version: str = "rv", ck_date: str = "date") -> DataFrame:
    """Approximate time a row was last changed, from its version (compare reports)."""
    return asof_join(df, ck, version_col, ck_version, ck_date, out_col)


def range_join(points: DataFrame, intervals: DataFrame, point_col: str, lo_col: str, hi_col: str,
               inclusive: bool = True, on: Sequence[str] = (), broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Every (point, interval) pair with the point inside the interval; intervals may overlap.

    The intervals' ends, as many in one range as in the next, bound at most ``BUCKETS`` ranges (one pass of quantiles;
    ranges only deal the work out, so their accuracy does not touch the result).  An interval joins every range it
    meets, a point its own, so one far interval does not widen the ranges of the others.  ``on`` names columns of both
    sides that must be equal, such as a subscription.  Points and intervals with a NULL end or key match nothing.
    """
    ends = intervals.select(F.explode(F.array(F.col(lo_col).cast("bigint"), F.col(hi_col).cast("bigint"))).alias("e"))
    r = ends.agg(F.count("e").alias("n"), F.percentile_approx("e", [i / BUCKETS for i in range(BUCKETS + 1)], 4 * BUCKETS).alias("q")).first()
    extra = [c for c in intervals.columns if c not in points.columns]
    if not r["n"]:
        return points.select("*", *[F.lit(None).cast(intervals.schema[c].dataType).alias(c) for c in extra]).where(F.lit(False))
    first = sorted(set(r["q"]))
    ranges = F.sequence(_range_of(F.col(lo_col).cast("bigint"), first), _range_of(F.col(hi_col).cast("bigint"), first))
    ex = intervals.where(F.col(lo_col) <= F.col(hi_col)).withColumn("_b", F.explode(ranges))
    p = points.withColumn("_b", _range_of(F.col(point_col).cast("bigint"), first))
    covered = int(ex.select(F.count(F.lit(1))).first()[0])
    right = F.broadcast(ex) if covered <= broadcast_rows else ex                # broadcast only under the counted bound
    inside = (p[point_col] >= right[lo_col]) if inclusive else (p[point_col] > right[lo_col])
    cond = (p["_b"] == right["_b"]) & inside & (p[point_col] <= right[hi_col])
    for c in on:
        cond = cond & (p[c] == right[c])
    j = p.join(right, cond, "inner")
    return j.select(*[p[c] for c in points.columns], *[right[c] for c in extra])


def runs_containing(versions: DataFrame, runs: DataFrame, version_col: str = "rv", inclusive: bool = True,
                    on: Sequence[str] = ()) -> DataFrame:
    """Runs whose ``[rv_from, rv_to]`` contains each version (inclusive both ends by default, for tracing); with
    ``on=("subscription_id",)`` only those of the version's own subscription."""
    return range_join(versions, runs, version_col, "rv_from", "rv_to", inclusive, on)


def trace(versions: DataFrame, runs: DataFrame, version_col: str = "rv") -> DataFrame:
    """The runs of its subscription that moved each version (``subscription_id``, table_name, version), with the command
    that replays the run's window for that table."""
    hits = runs_containing(versions, runs, version_col, inclusive=False, on=("subscription_id",))
    window = F.concat(rv_to_hex("rv_from"), F.lit(" "), rv_to_hex("rv_to"))
    return hits.withColumn("replay", F.concat(F.lit("sync "), F.col("subscription_id").cast("string"), F.lit(" "), F.col("table_name"), F.lit(" "), window))


def window_counts(changes: DataFrame, windows: DataFrame, version_col: str = "rv", out_col: str = "total_rows",
                  max_bounds: int = RANGES) -> DataFrame:
    """``windows`` (rv_from, rv_to) with the number of changes inside (rv_from, rv_to], without change-window pairs.

    The windows' bounds cut the versions into steps; each change finds the last bound below it and is counted there, one
    partial count a bound and task.  Running sums over the bounds, which are as few as the windows, give the changes up
    to each bound, and a window's count is the difference of two of them.  Up to ``max_bounds`` bounds are searched in a
    constant array and summed on the driver; more are looked up by an as-of join, with equal results.
    """
    bounds = windows.select(F.explode(F.array(F.col("rv_from").cast("bigint"), F.col("rv_to").cast("bigint"))).alias("bound")).where("bound is not null").distinct()
    below = changes.where(F.col(version_col).isNotNull()).select((F.col(version_col) - 1).cast("bigint").alias("v"))
    first = sorted(r["bound"] for r in bounds.limit(max_bounds + 1).collect())
    if len(first) <= max_bounds:                                                # a search in a constant array
        at = below.groupBy(_range_of(F.col("v"), first).alias("i")).agg(F.count(F.lit(1)).alias("n")).collect()      # a row a bound
        steps = {r["i"]: r["n"] for r in at}
        before = [0]
        for i in range(len(first) - 1):
            before.append(before[-1] + steps.get(i, 0))
        sums = changes.sparkSession.createDataFrame(list(zip(first, before)), "bound bigint, before bigint")
    else:
        placed = asof_join(below, bounds.withColumn("at", F.col("bound")), "v", "bound", "at", "at")
        counted = placed.groupBy("at").agg(F.count(F.lit(1)).alias("n"))       # at NULL: before every bound
        sums = bounds.join(counted, bounds["bound"] == counted["at"], "left").select("bound", F.coalesce("n", F.lit(0)).alias("n"))
        upto = Window.orderBy("bound").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.select("bound", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("before"))
    a = sums.select(F.col("bound").alias("_a"), F.col("before").alias("_na"))
    b = sums.select(F.col("bound").alias("_b"), F.col("before").alias("_nb"))
    j = windows.join(a, windows["rv_from"] == a["_a"], "left").join(b, windows["rv_to"] == b["_b"], "left")
    count = F.when(F.col("rv_to") > F.col("rv_from"), F.col("_nb") - F.col("_na")).otherwise(0)
    return j.select(*[windows[c] for c in windows.columns], F.coalesce(count, F.lit(0)).cast("bigint").alias(out_col))
