"""Apply a stage (one change per key) to a target: deletes, then a guarded upsert.

Two plans, chosen by a measured size of the stage:

* ``broadcast`` — the stage (rows × estimated row width) fits under ``broadcast_limit``: the target is streamed once
  through a left join against the broadcast stage (no target shuffle), and inserts are the stage keys that no target
  key matched (a semi-join of the target's key columns against the same broadcast stage).
* ``shuffle`` — otherwise: one full outer sort-merge join, both sides hash-partitioned by key.

Keys are unique on both sides, so neither plan has key skew.
"""
from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.spec import OP_COL, SOURCE_VERSION, user_columns
from ..session import checkpoint_dir

DEFAULT_BROADCAST_LIMIT = 256 * 1024 * 1024


def _q(c: str) -> str:
    return f"`{c}`"


def _width(dtype: T.DataType) -> int:
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        return 64
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
        return 256
    if isinstance(dtype, T.DecimalType):
        return 16
    return 8


def estimated_bytes(df: DataFrame, rows: int) -> int:
    """In-memory size estimate of ``rows`` rows of ``df`` (a conservative width per type)."""
    return rows * (sum(_width(f.dataType) for f in df.schema.fields) + 16)


def choose_strategy(stage: DataFrame, strategy: str, limit: int, stage_rows: int | None = None):
    """(plan, stage): ``auto`` measures the stage — rows × estimated width — against ``limit``.

    A stage whose row count is not known is first checkpointed to the shared checkpoint folder, so counting it and
    joining it read the same materialised rows instead of computing the stage twice.
    """
    if strategy != "auto":
        return strategy, stage
    if stage_rows is None:
        checkpoint_dir(stage.sparkSession)
        stage = stage.checkpoint(eager=True)
        stage_rows = stage.count()
    return ("broadcast" if estimated_bytes(stage, stage_rows) <= limit else "shuffle"), stage


def version_guard(t_version: Column, s_version: Column) -> Column:
    """Update only when the versions differ or the target has none (3-valued: NULL counts as false)."""
    return (t_version != s_version) | t_version.isNull()


def apply_changes(target: DataFrame, stage: DataFrame, keys: Sequence[str], identity: Sequence[str] = (),
                  version_col: str = SOURCE_VERSION, strategy: str = "auto",
                  broadcast_limit: int = DEFAULT_BROADCAST_LIMIT, guard: str = "changed",
                  stage_rows: int | None = None) -> DataFrame:
    """New target state after applying ``stage`` (columns: op, user columns, ``sourcerv``; unique on key).

    ``guard='changed'`` (the reference's rule): 'D' rows delete the key with no version check; other rows update a
    matched key when its version differs or is NULL — every non-key, non-identity column plus the version — and
    insert unmatched keys.  ``guard='newer'`` updates and deletes only when the staged version is higher, so a
    re-delivered or late older change never moves a row back.  A delete leaves no row to compare with: pass the stage
    through ``without_stale`` and keep its deletes with ``next_tombstones`` where older inserts may arrive late.
    Untouched rows pass as they are.
    """
    cols = user_columns(target)
    keys = list(keys)
    stage_cols = set(stage.columns)
    updatable = [c for c in cols if c not in keys and c not in identity and c in stage_cols]
    plan, stage = choose_strategy(stage, strategy, broadcast_limit, stage_rows)

    s = stage.select(*[F.col(_q(k)) for k in keys],
                     *[F.col(_q(c)).alias(f"__stg__{c}") for c in cols if c not in keys and c in stage_cols],
                     F.col(OP_COL).alias("__stg_op__"), F.col(version_col).alias("__stg_ver__"), F.lit(True).alias("__stg_hit__"))
    t = target.select(*[F.col(_q(c)) for c in cols], F.col(version_col).alias("__tgt_ver__"), F.lit(True).alias("__tgt_hit__"))

    t_v, s_v = F.col("__tgt_ver__"), F.col("__stg_ver__")
    is_del = F.col("__stg_op__") == "D"
    if guard == "newer":
        wins = t_v.isNull() | (s_v > t_v)
        del_applies = is_del & wins
    else:
        wins = version_guard(t_v, s_v)
        del_applies = is_del

    def merged_columns():
        is_upd = F.col("__stg_hit__").isNotNull() & ~is_del & wins
        out = []
        for c in cols:
            if c in keys:
                out.append(F.col(_q(c)))
            elif c in updatable:
                out.append(F.when(F.col("__tgt_hit__").isNull(), F.col(f"__stg__{c}"))
                           .when(is_upd, F.col(f"__stg__{c}")).otherwise(F.col(_q(c))).alias(c))
            elif c in stage_cols:   # identity: inserted as given, never updated
                out.append(F.when(F.col("__tgt_hit__").isNull(), F.col(f"__stg__{c}")).otherwise(F.col(_q(c))).alias(c))
            else:
                out.append(F.col(_q(c)))
        out.append(F.when(F.col("__tgt_hit__").isNull() | is_upd, F.col("__stg_ver__")).otherwise(F.col("__tgt_ver__")).alias(version_col))
        return out

    keep = ~F.coalesce(del_applies, F.lit(False))
    if plan == "broadcast":
        bs = F.broadcast(s)
        kept = t.join(bs, keys, "left").where(keep).select(*merged_columns())
        matched = t.select(*keys).join(bs.select(*keys), keys, "left_semi")
        inserts = (s.where(F.col("__stg_op__") != "D").join(matched, keys, "left_anti")
                   .select(*[F.col(_q(k)) for k in keys],
                           *[F.col(f"__stg__{c}").alias(c) if c in stage_cols else F.lit(None).cast(target.schema[c].dataType).alias(c)
                             for c in cols if c not in keys],
                           F.col("__stg_ver__").alias(version_col)))
        return kept.unionByName(inserts.select(*cols, version_col))
    full = t.join(s, keys, "full_outer").where(keep & (F.col("__tgt_hit__").isNotNull() | F.col("__stg_hit__").isNotNull()))
    return full.select(*merged_columns())


def without_stale(stage: DataFrame, tombstones: DataFrame, keys: Sequence[str], version_col: str = SOURCE_VERSION) -> DataFrame:
    """The changes of ``stage`` that are newer than the delete of their key in ``tombstones`` (keys, ``deleted_at``)."""
    t = tombstones.select(*[F.col(_q(k)).alias(f"__key{i}__") for i, k in enumerate(keys)], F.col("deleted_at").alias("__deleted_at__"))
    on = None
    for i, k in enumerate(keys):
        same = F.col(_q(k)) == F.col(f"__key{i}__")
        on = same if on is None else on & same
    late = on & (F.col(version_col) <= F.col("__deleted_at__"))
    return stage.join(t, late, "left_anti")


def next_tombstones(tombstones: DataFrame | None, stage: DataFrame, keys: Sequence[str], horizon: int = 0,
                    version_col: str = SOURCE_VERSION) -> DataFrame:
    """Tombstones (keys, ``deleted_at``) after ``stage``: the newest delete of each key above ``horizon``.

    ``horizon`` is the mark up to which all changes have arrived: nothing older can come late, so older deletes need not
    be kept and the relation follows the open windows, not the history.
    """
    new = stage.where(F.col(OP_COL) == "D").select(*[F.col(_q(k)) for k in keys], F.col(version_col).cast("bigint").alias("deleted_at"))
    both = new if tombstones is None else tombstones.select(*[F.col(_q(k)) for k in keys], "deleted_at").unionByName(new)
    return both.groupBy(*[F.col(_q(k)) for k in keys]).agg(F.max("deleted_at").alias("deleted_at")).where(F.col("deleted_at") > horizon)


def deleted_rows(target: DataFrame, stage: DataFrame, keys: Sequence[str], version_col: str = SOURCE_VERSION) -> DataFrame:
    """Target rows a stage deletes, carrying the delete's version (what a chained delete log on the target logs)."""
    d = stage.where(F.col(OP_COL) == "D").select(*keys, F.col(version_col).alias("__del_ver__"))
    cols = user_columns(target)
    return (target.join(d, list(keys), "inner")
            .select(*[F.col(_q(c)) for c in cols], F.col("__del_ver__").alias(version_col)))


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], mode: str = "merge") -> DataFrame:
    """Natural-key upsert without a version guard.

    ``merge``: matched keys take the source's columns (others kept), new keys are inserted (missing columns NULL).
    ``replace``: every target row of a source key is removed, then the source rows are added.
    """
    keys = list(keys)
    cols = target.columns
    if mode == "replace":
        aligned = source.select(*[F.col(_q(c)) if c in source.columns else F.lit(None).cast(target.schema[c].dataType).alias(c)
                                  for c in cols])
        return target.join(source.select(*keys), keys, "left_anti").unionByName(aligned)
    src_cols = [c for c in source.columns if c not in keys and c in cols]
    s = source.select(*keys, *[F.col(_q(c)).alias(f"__stg__{c}") for c in src_cols], F.lit(True).alias("__stg_hit__"))
    t = target.withColumn("__tgt_hit__", F.lit(True))
    j = t.join(s, keys, "full_outer")
    out = []
    for c in cols:
        if c in keys:
            out.append(F.col(_q(c)))
        elif c in src_cols:
            out.append(F.when(F.col("__stg_hit__").isNotNull(), F.col(f"__stg__{c}")).otherwise(F.col(_q(c))).alias(c))
        else:
            out.append(F.col(_q(c)))
    return j.select(*out)


def load_full(snapshot: DataFrame) -> DataFrame:
    """Initial load: the snapshot extract without its op column, landing in an emptied target."""
    return snapshot.drop(OP_COL)


def stage_changes(changes: DataFrame, path: str, keys: Sequence[str] | None = None, check_unique: bool = False) -> DataFrame:
    """Write the collapsed changes of one run to ``path`` (overwrite) and read them back."""
    if check_unique and keys:
        dup = changes.groupBy(*keys).count().where("count > 1").limit(1).count()
        if dup:
            raise ValueError("stage is not unique on its key")
    changes.write.mode("overwrite").parquet(path)
    return changes.sparkSession.read.parquet(path)
