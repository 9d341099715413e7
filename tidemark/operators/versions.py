"""Version stamping, delete capture and ordered neighbours, without any global single-task window.

* ``number_rows`` gives dense, ordered numbers in two passes: range-partition + sort, checkpoint, count rows per
  partition (one row per partition reaches the driver), then add per-partition offsets.
* ``previous_per_key`` is a per-key ``lag`` that survives a key holding a third of the data: rows are split by
  version range into segments, ``lag`` runs inside each (key, segment), and the first row of a segment takes the last
  row of the key's previous non-empty segment from a small per-segment table.
"""
from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.spec import ROW_VERSION, user_columns
from ..session import checkpoint_dir

# Largest number of version values one (key, segment) window may cover.
MAX_SEGMENT_SPAN = 1 << 22


def segment_span(lo: int, hi: int, segments: int = 64, floor: int = 1024, ceiling: int = MAX_SEGMENT_SPAN) -> int:
    """Segment width for a version range: about ``segments`` segments, never wider than ``ceiling``."""
    return int(min(max(math.ceil(max(hi - lo, 1) / segments), floor), ceiling))


def _null_safe_on(left: DataFrame, right: DataFrame, cols: Sequence[str]):
    cond = None
    for c in cols:
        e = left[c].eqNullSafe(right[c])
        cond = e if cond is None else cond & e
    return cond


def segment_of(order_col: str, span: int):
    """Version range a row falls in (integer division: exact for every BIGINT)."""
    return F.expr(f"`{order_col}` div {int(span)}")


def previous_per_key(df: DataFrame, keys: Sequence[str], order_col: str, cols: Sequence[str], span: int,
                     prefix: str = "prev_", with_last: bool = False) -> DataFrame:
    """Add ``prefix+c`` = value of ``c`` in the previous row of the same key ordered by ``order_col`` (integral).

    Plan: one shuffle by (keys, segment) feeds a window with ``lag`` / ``lead``.  Rows inside a segment take their
    predecessor from that window.  The edge rows of each segment (first and last — at most two per segment) are
    re-keyed by key alone and ordered by version, so a segment's first row finds the previous segment's last row
    with one more ``lag``; a key holding a third of the data contributes only two rows per segment there.  The two
    parts are put back together with a union (no join).
    With ``with_last`` the output also flags ``_is_last``: the key's newest row overall.
    """
    d = df.withColumn("_seg", segment_of(order_col, span))
    w = Window.partitionBy(*keys, "_seg").orderBy(order_col)
    d = d.select("*", F.row_number().over(w).alias("_pos"), F.lead(F.col(order_col)).over(w).alias("_next"),
                 *[F.lag(F.col(c)).over(w).alias(f"_lag_{c}") for c in cols])
    base_cols = [F.col(f"`{c}`") for c in df.columns]
    inner = d.where((F.col("_pos") > 1) & F.col("_next").isNotNull()).select(
        *base_cols, *[F.col(f"_lag_{c}").alias(prefix + c) for c in cols],
        *([F.lit(False).alias("_is_last")] if with_last else []))
    wk = Window.partitionBy(*keys).orderBy(order_col)
    edges = d.where((F.col("_pos") == 1) | F.col("_next").isNull()).select(
        *base_cols,
        *[F.when(F.col("_pos") == 1, F.lag(F.col(c)).over(wk)).otherwise(F.col(f"_lag_{c}")).alias(prefix + c)
          for c in cols],
        *([F.lead(F.col(order_col)).over(wk).isNull().alias("_is_last")] if with_last else []))
    return inner.unionByName(edges)


def number_rows(df: DataFrame, order_cols: Sequence[str], base: int = 0, col: str = ROW_VERSION) -> DataFrame:
    """Add ``col`` = ``base`` + 1, 2, … in ``order_cols`` order, without a single-partition window.

    Range partitioning + per-partition sort give a global order; the sorted rows are checkpointed to the shared
    checkpoint folder so both passes see identical partitions, then per-partition counts (one row per partition) are
    turned into offsets that are broadcast — their size is the partition count, not the data size.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    # the range partitioner samples its input and the sort then reads it: compute the input once
    src = df.checkpoint(eager=True) if order_cols else df
    ordered = src.repartitionByRange(*order_cols).sortWithinPartitions(*order_cols) if order_cols else src
    ordered = (ordered.withColumn("_pid", F.spark_partition_id())
               .withColumn("_mid", F.monotonically_increasing_id())
               .checkpoint(eager=True))
    counts = sorted((r["_pid"], r["n"]) for r in ordered.groupBy("_pid").agg(F.count(F.lit(1)).alias("n")).collect())
    offsets, running = [], 0
    for pid, n in counts:
        offsets.append((pid, running))
        running += n
    if not offsets:
        return ordered.drop("_pid", "_mid").withColumn(col, F.lit(None).cast("bigint"))
    off = spark.createDataFrame(offsets, "_pid int, _off bigint")
    low_bits = F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33)
    return (ordered.join(F.broadcast(off), "_pid")
            .withColumn(col, F.lit(base) + F.col("_off") + low_bits + F.lit(1))
            .drop("_pid", "_mid", "_off"))


def stamp_versions(prev: DataFrame | None, curr: DataFrame, keys: Sequence[str], base: int,
                   version_col: str = ROW_VERSION) -> DataFrame:
    """Give ``curr`` (a new snapshot without versions) its ``rv``: unchanged rows keep the previous version, new or
    changed rows get fresh versions above ``base`` in key order.  One shuffle join of the two snapshots by key."""
    cols = user_columns(curr)
    if prev is None:
        return number_rows(curr.select(*cols), list(keys), base, version_col)
    values = [c for c in cols if c not in keys]
    p = prev.select(*keys, *[F.col(c).alias(f"_p_{c}") for c in values], F.col(version_col).alias("_p_rv"))
    j = curr.select(*cols).join(p, list(keys), "left")
    changed = F.col("_p_rv").isNull()
    for c in values:
        changed = changed | ~F.col(c).eqNullSafe(F.col(f"_p_{c}"))
    j = j.withColumn("_changed", changed)
    same = j.where(~F.col("_changed")).select(*cols, F.col("_p_rv").alias(version_col))
    fresh = number_rows(j.where(F.col("_changed")).select(*cols), list(keys), base, version_col)
    return same.unionByName(fresh)


def capture_deletes(prev: DataFrame, curr: DataFrame, keys: Sequence[str], base: int, at=None,
                    track: Sequence[str] = (), version_col: str = ROW_VERSION) -> DataFrame:
    """Delete-log rows for keys of ``prev`` absent from ``curr``: new ``rv`` (above ``base``, key order), ``dt`` =
    ``at``, ``sourcerv`` = the row's last version, keys and tracked columns.  Anti-join by key (one shuffle)."""
    from ..functions.timefn import ts_literal
    gone = prev.join(curr.select(*keys), list(keys), "left_anti")
    gone = gone.select(F.col(version_col).alias("sourcerv"), *keys, *track)
    numbered = number_rows(gone, list(keys), base, "rv")
    dt = F.localtimestamp() if at is None else ts_literal(at)
    return numbered.select("rv", dt.alias("dt"), "sourcerv", *keys, *track)


def classify_snapshot(prev: DataFrame, curr: DataFrame, keys: Sequence[str], track: Sequence[str] = (),
                      version_col: str = ROW_VERSION) -> DataFrame:
    """One full outer join of two snapshots by key, written once.

    Rows are the user columns of ``curr`` (of ``prev`` for keys that are gone: keys and ``track`` columns), ``_p_rv`` =
    the previous version, and ``_kind``: 0 same, 1 changed or new, 2 gone.  Keys are not NULL and unique on both sides.
    """
    cols = user_columns(curr)
    values = [c for c in cols if c not in keys]
    kept = [c for c in track if c not in keys]
    c = curr.select(*keys, *[F.col(f"`{v}`").alias(f"_c_{v}") for v in values], F.lit(True).alias("_in_c"))
    p = prev.select(*keys, *[F.col(f"`{v}`").alias(f"_p_{v}") for v in dict.fromkeys([*values, *kept])],
                    F.col(version_col).alias("_p_rv"), F.lit(True).alias("_in_p"))
    same = F.col("_in_p").isNotNull() & F.col("_in_c").isNotNull()
    for v in values:
        same = same & F.col(f"_c_{v}").eqNullSafe(F.col(f"_p_{v}"))
    gone = F.col("_in_c").isNull()
    kind = F.when(gone, 2).when(same, 0).otherwise(1)
    j = c.join(p, list(keys), "full_outer").withColumn("_kind", kind)
    checkpoint_dir(curr.sparkSession)
    return j.select(*[F.col(k) if k in keys else F.col(f"_c_{k}").alias(k) for k in cols],
                    *[F.col(f"_p_{t}").alias(f"_t_{t}") for t in kept], "_p_rv", "_kind").checkpoint(eager=True)


def publish_changes(prev: DataFrame, curr: DataFrame, keys: Sequence[str], base: int, at=None, track: Sequence[str] = (),
                    version_col: str = ROW_VERSION):
    """(versioned table, delete-log rows) of a new snapshot, both from one classified join and one numbering.

    Changed and new rows get versions from ``base`` + 1 on in key order, then the deleted keys theirs; unchanged rows
    keep the version they have.
    """
    rows = classify_snapshot(prev, curr, keys, track, version_col)
    return number_classified(rows, user_columns(curr), keys, base, at, track, version_col)


def number_classified(rows: DataFrame, cols: Sequence[str], keys: Sequence[str], base: int, at=None, track: Sequence[str] = (),
                      version_col: str = ROW_VERSION):
    """(versioned table, delete-log rows) of the rows of ``classify_snapshot``."""
    from ..functions.timefn import ts_literal
    numbered = number_rows(rows.where("_kind > 0"), ["_kind", *keys], base, "_new_rv")
    fresh = numbered.where("_kind = 1").select(*cols, F.col("_new_rv").alias(version_col))
    table = rows.where("_kind = 0").select(*cols, F.col("_p_rv").alias(version_col)).unionByName(fresh)
    dt = F.localtimestamp() if at is None else ts_literal(at)
    deletes = numbered.where("_kind = 2").select(F.col("_new_rv").alias("rv"), dt.alias("dt"), F.col("_p_rv").alias("sourcerv"), *keys,
                                                 *[F.col(f"_t_{t}").alias(t) for t in track if t not in keys])
    return table, deletes


def current_version(table: DataFrame | None = None, delete_log: DataFrame | None = None, version_col: str = ROW_VERSION,
                    ledger=None) -> int:
    """Highest version issued so far (table and delete log); 0 when both are empty.

    With a ``ledger`` (``VersionLedger``) no table is read: it is the version up to which all writers are done.
    """
    if ledger is not None:
        return ledger.safe()
    best = table.agg(F.max(version_col)).first()[0] or 0
    if delete_log is not None:
        best = max(best, delete_log.agg(F.max(ROW_VERSION)).first()[0] or 0)
    return int(best)


def feed_from_log(log: DataFrame, keys: Sequence[str], value_cols: Sequence[str], version_col: str = ROW_VERSION,
                  op_col: str = "op", time_col: str | None = None, span: int = MAX_SEGMENT_SPAN):
    """Reduce an operation log (one row per change, op 'U' or 'D') to (current table, delete log).

    The table holds the last change per key when it is an upsert; the delete log holds every delete that removed
    a live row (the previous change of the key was an upsert), with the delete's version and the row's last one.
    Both come from one segmented pass (see ``previous_per_key``), so a key holding a third of the log is split
    into version segments instead of landing in one task.
    """
    extra = [time_col] if time_col else []
    base = log.select(*keys, *[c for c in value_cols if c not in keys], version_col, op_col, *extra)
    prev = previous_per_key(base, keys, version_col, [version_col, op_col], span, with_last=True)
    state = (prev.where(F.col("_is_last") & (F.col(op_col) == "U"))
             .select(*keys, *value_cols, version_col))
    dt = F.col(time_col) if time_col else F.lit(None).cast("timestamp_ntz")
    deletes = (prev.where((F.col(op_col) == "D") & (F.col(f"prev_{op_col}") == "U"))
               .select(F.col(version_col).alias("rv"), dt.alias("dt"), F.col(f"prev_{version_col}").alias("sourcerv"),
                       *keys))
    return state, deletes


def delete_log_schema(table: DataFrame, keys: Sequence[str], track: Sequence[str] = ()):
    """Schema of a table's delete log: own version, time, the row's last version, keys, tracked columns."""
    from pyspark.sql import types as T
    by_name = {f.name: f for f in table.schema.fields}
    return T.StructType([T.StructField("rv", T.LongType(), False), T.StructField("dt", T.TimestampNTZType(), True),
                         T.StructField("sourcerv", T.LongType(), True),
                         *[by_name[c] for c in [*keys, *track]]])


def empty_delete_log(table: DataFrame, keys: Sequence[str], track: Sequence[str] = ()) -> DataFrame:
    """A new (or rebuilt) delete log with no rows."""
    return table.sparkSession.createDataFrame([], delete_log_schema(table, keys, track))
