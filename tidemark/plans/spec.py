"""Feed configuration and column lists, derived from ``df.schema`` at call time."""
from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Optional, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.versions import BEGINNING, MAX_VERSION, parse_version

# Fixed names of the change-record columns.
OP_COL = "rpl_operation"
SOURCE_VERSION = "sourcerv"
ROW_VERSION = "rv"
RESERVED = (ROW_VERSION, SOURCE_VERSION)

# Date columns tried, in this order, to bound a compare of a big table.
DATE_COLUMN_PRIORITY = ("DateLastChanged", "DateCreated", "TimeRegistered", "DateLastModified", "Timestamp",
                        "DateLastChangedGMT")


@dataclass(frozen=True)
class VersionWindow:
    """Half-open version window ``(lo, hi]``; ``lo == 0`` is a snapshot read."""
    lo: int = BEGINNING
    hi: int = MAX_VERSION

    @classmethod
    def of(cls, lo=None, hi=None) -> "VersionWindow":
        return cls(parse_version(lo, BEGINNING), parse_version(hi, MAX_VERSION))

    @property
    def is_snapshot(self) -> bool:
        return self.lo <= BEGINNING

    @property
    def width(self) -> int:
        """Upper bound on the number of changes in the window."""
        return self.hi - self.lo


@dataclass
class FeedSpec:
    """One synchronised table: where its rows and delete log come from, and how it is keyed."""
    name: str
    keys: Sequence[str]
    source: Optional[Callable[..., DataFrame]] = None          # (spark) -> current table with ``rv``
    delete_log: Optional[Callable[..., DataFrame]] = None      # (spark) -> delete log with ``rv``
    target_name: Optional[str] = None                          # local name when it differs
    ignore_columns: Sequence[str] = ()
    ignore_key_column: Optional[str] = None
    identity_columns: Sequence[str] = ()
    compress_columns: Sequence[str] = ()
    track_columns: Sequence[str] = ()
    date_columns: Sequence[str] = DATE_COLUMN_PRIORITY
    initialize: bool = False
    routines: Sequence[Callable] = ()
    routine_order: int = 0                                     # among the routines of the subscription

    @property
    def local_name(self) -> str:
        return self.target_name or self.name

    @property
    def key_columns(self) -> list:
        return [k for k in self.keys if k != self.ignore_key_column]


@dataclass(frozen=True)
class ColumnLists:
    keys: tuple
    all: tuple          # user columns in table order
    update: tuple       # non-key, non-identity
    insert: tuple       # all user columns


def user_columns(df: DataFrame, ignore: Sequence[str] = ()) -> list:
    """User columns in table order, without the version columns and ignored names (exact match)."""
    drop = set(RESERVED) | {OP_COL} | set(ignore)
    return [c for c in df.columns if c not in drop]


def align_columns(df: DataFrame, keys: Sequence[str], ignore: Sequence[str] = (),
                  identity: Sequence[str] = ()) -> ColumnLists:
    cols = user_columns(df, ignore)
    missing = [k for k in keys if k not in cols]
    if missing:
        raise ValueError(f"key columns not in table: {missing}")
    if not cols:
        raise ValueError("table has no columns to synchronise")
    ks, ids = set(keys), set(identity)
    return ColumnLists(tuple(keys), tuple(cols), tuple(c for c in cols if c not in ks and c not in ids), tuple(cols))


def feed_schema(df: DataFrame, keys: Sequence[str], staged: bool = True, ignore: Sequence[str] = ()) -> T.StructType:
    """Schema of a change record: op (staged only), user columns in order, ``sourcerv`` last."""
    lists = align_columns(df, keys, ignore)
    by_name = {f.name: f for f in df.schema.fields}
    fields = [T.StructField(OP_COL, T.StringType(), False)] if staged else []
    fields += [by_name[c] for c in lists.all]
    fields.append(T.StructField(SOURCE_VERSION, T.LongType(), True))
    return T.StructType(fields)


def describe_columns(df: DataFrame, keys: Sequence[str] = (), identity: Sequence[str] = ()) -> list:
    """Column metadata rows (col_id, name, type name, length, is_key, is_identity) from the schema."""
    out = []
    for i, f in enumerate(df.schema.fields, start=1):
        if f.name in RESERVED:
            continue
        length = f.metadata.get("length", -1) if f.metadata else -1
        out.append(dict(col_id=i, column_name=f.name, data_type=f.dataType.simpleString(), column_length=length,
                        is_key=f.name in keys, is_identity=f.name in identity))
    return out


def pick_date_column(df: DataFrame, priority: Sequence[str] = DATE_COLUMN_PRIORITY) -> Optional[str]:
    """First name of ``priority`` that is a column of ``df``."""
    cols = set(df.columns)
    for name in priority:
        if name in cols:
            return name
    return None


def validate_key(df: DataFrame, keys: Sequence[str], name: str = "") -> DataFrame:
    """One row: rows, distinct keys, rows with a NULL key part, keys held by more than one row, verdict.

    One shuffle by key with map-side partial counts; a hot key costs one partial count per map task.
    """
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.max(any_null.cast("int")).alias("_null"))
    stats = per_key.agg(
        F.sum("_n").cast("bigint").alias("total_rows"),
        F.count(F.lit(1)).cast("bigint").alias("distinct_keys"),
        F.sum(F.when(F.col("_null") == 1, F.col("_n")).otherwise(0)).cast("bigint").alias("null_key_rows"),
        F.sum(F.when(F.col("_n") > 1, 1).otherwise(0)).cast("bigint").alias("duplicate_keys"))
    stats = stats.select(F.lit(name).alias("table_name"), F.lit(", ".join(keys)).alias("key_columns"),
                         F.coalesce("total_rows", F.lit(0).cast("bigint")).alias("total_rows"),
                         "distinct_keys",
                         F.coalesce("null_key_rows", F.lit(0).cast("bigint")).alias("null_key_rows"),
                         F.coalesce("duplicate_keys", F.lit(0).cast("bigint")).alias("duplicate_keys"))
    return stats.withColumn("is_valid", (F.col("null_key_rows") == 0) & (F.col("duplicate_keys") == 0))


def judge_keys(df: DataFrame, candidates: dict, name: str = "") -> DataFrame:
    """``validate_key`` of several candidate keys in one pass: {rank: key columns} → a row each, with ``rank``.

    Every row is tagged once for each candidate, with that key's hash and parts as text; one shuffle counts all keys
    together, with map-side partial counts.
    """
    def parts(keys):
        return F.array(*[F.col(f"`{k}`").cast("string") for k in keys])

    tagged = df.select(F.explode(F.array(*[F.struct(F.lit(r).alias("rank"), parts(k).alias("key")) for r, k in candidates.items()])).alias("c"))
    null = F.exists("c.key", lambda x: x.isNull())
    per_key = tagged.groupBy("c.rank", "c.key").agg(F.count(F.lit(1)).alias("n"), F.max(null.cast("int")).alias("has_null"))
    total = lambda cond, x: F.coalesce(F.sum(F.when(cond, x)), F.lit(0)).cast("bigint")
    found = per_key.groupBy("rank").agg(
        F.sum("n").cast("bigint").alias("total_rows"), F.count(F.lit(1)).cast("bigint").alias("distinct_keys"),
        total(F.col("has_null") == 1, F.col("n")).alias("null_key_rows"), total(F.col("n") > 1, F.lit(1)).alias("duplicate_keys"))
    names = F.create_map(*[F.lit(x) for r, k in candidates.items() for x in (r, ", ".join(k))])
    valid = (F.col("null_key_rows") == 0) & (F.col("duplicate_keys") == 0)
    return found.select(F.lit(name).alias("table_name"), "rank", names[F.col("rank")].alias("key_columns"), "total_rows",
                        "distinct_keys", "null_key_rows", "duplicate_keys", valid.alias("is_valid"))


def require_key(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise if a key part of ``df`` is NULL or a key is held by several rows."""
    r = validate_key(df, list(keys)).first()
    if not r["is_valid"]:
        raise ValueError(f"({', '.join(keys)}) is no key: {r['null_key_rows']} rows with a NULL part, {r['duplicate_keys']} repeated keys")


def choose_key(candidates: DataFrame) -> DataFrame:
    """Best valid key per table from ``validate_key`` rows with a ``rank`` column (1 = primary, 2 = unique)."""
    from pyspark.sql import Window
    w = Window.partitionBy("table_name").orderBy("rank", "key_columns")
    return (candidates.where("is_valid").withColumn("_rn", F.row_number().over(w))
            .where("_rn = 1").drop("_rn"))
