"""Extract: snapshot or the changes of a version window, collapsed to the last change per key."""
from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.spec import OP_COL, ROW_VERSION, SOURCE_VERSION, VersionWindow, user_columns


def latest_per_key(df: DataFrame, keys: Sequence[str], order_col: str = SOURCE_VERSION) -> DataFrame:
    """Keep the row with the highest ``order_col`` per key (versions are unique, so no ties).

    Plans as WindowGroupLimit(Partial) → Exchange(keys) → WindowGroupLimit(Final): every map task keeps one row per
    key before the shuffle, so a key holding a third of all changes sends at most one row per map task.
    """
    w = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(F.col(order_col).desc())
    return df.withColumn("_rpl_rowid", F.row_number().over(w)).where(F.col("_rpl_rowid") == 1).drop("_rpl_rowid")


def _in_window(version: str, window: VersionWindow, lower: bool = True):
    cond = F.col(version) <= F.lit(window.hi)
    if lower:
        cond = (F.col(version) > F.lit(window.lo)) & cond
    return cond


def extract_snapshot(table: DataFrame, window: VersionWindow = VersionWindow(), version_col: str = ROW_VERSION,
                     ignore: Sequence[str] = ()) -> DataFrame:
    """Every current row with ``rv <= hi``, tagged 'I', version exposed as ``sourcerv``.  No shuffle."""
    cols = user_columns(table, ignore)
    return (table.where(_in_window(version_col, window, lower=False))
            .select(F.lit("I").alias(OP_COL), *[F.col(f"`{c}`") for c in cols],
                    F.col(version_col).alias(SOURCE_VERSION)))


def extract_changes(table: DataFrame, delete_log: DataFrame | None, keys: Sequence[str], window: VersionWindow,
                    version_col: str = ROW_VERSION, ignore: Sequence[str] = (), collapse: bool = True) -> DataFrame:
    """Changes in ``(lo, hi]``: current rows tagged 'U' plus logged deletes tagged 'D' (keys only, other columns
    NULL, the log's own version as ``sourcerv``), collapsed to the last change per key.

    A snapshot window (``lo`` = beginning) reads the table only.  The bounds are literals, so both range filters
    reach the parquet scans; the union is shuffled once, by key.
    """
    if window.is_snapshot:
        return extract_snapshot(table, window, version_col, ignore)
    cols = user_columns(table, ignore)
    upserts = (table.where(_in_window(version_col, window))
               .select(F.lit("U").alias(OP_COL), *[F.col(f"`{c}`") for c in cols],
                       F.col(version_col).alias(SOURCE_VERSION)))
    changes = upserts
    if delete_log is not None:
        types = {f.name: f.dataType for f in table.schema.fields}
        deletes = (delete_log.where(_in_window(ROW_VERSION, window))
                   .select(F.lit("D").alias(OP_COL),
                           *[(F.col(f"`{c}`") if c in keys else F.lit(None).cast(types[c])).alias(c) for c in cols],
                           F.col(ROW_VERSION).alias(SOURCE_VERSION)))
        changes = upserts.unionByName(deletes)
    if not collapse:
        return changes
    return latest_per_key(changes, keys, SOURCE_VERSION).select(OP_COL, *cols, SOURCE_VERSION)
