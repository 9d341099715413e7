"""Compare two copies of a keyed table and repair the differences.

One full outer sort-merge join by key (both copies hash-partitioned by key; co-located when both are stored
bucketed by the same key), a CASE chain naming the first differing column, an as-of join for the source row's
approximate change time (bucketed join against the checkpoint intervals), and a recency filter.
"""
from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.defaults import default_for
from ..functions.timefn import minus_minutes, ts_literal
from ..plans.spec import RESERVED, VersionWindow, pick_date_column
from ..session import checkpoint_dir
from .apply import apply_changes
from .asof import asof_join
from .extract import extract_changes
from .versions import number_rows

# Fixed texts of the difference column.
MISSING_IN_PUBLISHER = "Missing in Publisher"
MISSING_IN_SUBSCRIBER = "Missing in Subscriber"
COLUMN_MISMATCH = "Column does not match [{}]"
MATCHED = "Matched"
# Fixed value: name prefix of replicated checkpoint copies, which a multi-table compare leaves out.
CHECKPOINT_COPY_PREFIX = "DatesFromSubscription"
GRACE_MINUTES = 15


def compared_columns(sub: DataFrame, keys: Sequence[str], identity: Sequence[str] = ()) -> list:
    """Non-key columns in the subscriber's order, without versions and the identity columns that the caller names."""
    skip = set(keys) | set(RESERVED) | set(identity)
    return [f.name for f in sub.schema.fields if f.name not in skip]


def _differs(p: Column, s: Column, name: str, dtype: T.DataType, nulls: str, defaults: dict | None = None) -> Column:
    if nulls == "strict":
        return ~p.eqNullSafe(s)
    d = default_for(name, dtype, defaults)
    if d is None:
        return ~p.eqNullSafe(s)
    return F.coalesce(p, d) != F.coalesce(s, d)


def classify_pairs(pub: DataFrame, sub: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None,
                   pub_version: str = "rv", sub_version: str = "sourcerv", nulls: str = "default",
                   identity: Sequence[str] = (), defaults: dict | None = None,
                   date_column: str | None = None, since=None) -> DataFrame:
    """Full outer join of the copies with a ``difference`` for every key (``Matched`` when equal).
    ``defaults`` overrides the type default of named columns (e.g. a GUID column kept as text).

    ``since`` keeps the pairs whose ``date_column`` is at or after it on either side, or unknown on both.  It is
    applied to the joined pair, so a row with a different date in each copy is one pair, not two missing rows.  The
    column defaults to the usual date column of ``pub``; tables without one are compared whole."""
    keys = list(keys)
    if since is not None and date_column is None:
        date_column = pick_date_column(pub)
    bounded = since is not None and date_column is not None
    p_date, s_date = ([F.col(f"`{date_column}`").alias(n)] if bounded else [] for n in ("_p_date", "_s_date"))
    cols = list(columns) if columns is not None else compared_columns(sub, keys, identity)
    types = {f.name: f.dataType for f in sub.schema.fields}
    p = pub.select(*keys, *[F.col(f"`{c}`").alias(f"publisher_{c}") for c in cols],
                   F.col(pub_version).alias("publisher_rv"), F.lit(True).alias("_p_hit"), *p_date)
    s = sub.select(*keys, *[F.col(f"`{c}`").alias(f"subscriber_{c}") for c in cols],
                   F.col(sub_version).alias("subscriber_sourcerv"), F.lit(True).alias("_s_hit"), *s_date)
    j = s.join(p, keys, "full_outer")
    if bounded:
        newest = F.greatest("_p_date", "_s_date")
        j = j.where((newest >= ts_literal(since)) | newest.isNull())
    diff = F.when(F.col("_p_hit").isNull(), F.lit(MISSING_IN_PUBLISHER)) \
            .when(F.col("_s_hit").isNull(), F.lit(MISSING_IN_SUBSCRIBER))
    for c in cols:
        diff = diff.when(_differs(F.col(f"publisher_{c}"), F.col(f"subscriber_{c}"), c, types[c], nulls, defaults),
                         F.lit(COLUMN_MISMATCH.format(c)))
    diff = diff.otherwise(F.lit(MATCHED))
    side_cols = [x for c in cols for x in (f"publisher_{c}", f"subscriber_{c}")]
    return j.select(diff.alias("difference"), *keys, *side_cols, "publisher_rv", "subscriber_sourcerv")


def compare_tables(pub: DataFrame, sub: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None,
                   checkpoints: DataFrame | None = None, now=None, grace_minutes: int = GRACE_MINUTES,
                   nulls: str = "default", pub_version: str = "rv", sub_version: str = "sourcerv",
                   date_column: str | None = None, since=None,
                   ck_version: str = "rv", ck_date: str = "date", include_matched: bool = False,
                   identity: Sequence[str] = (), defaults: dict | None = None) -> DataFrame:
    """One row per difference: ``Missing in Publisher`` / ``Missing in Subscriber`` / ``Column does not match [c]``
    (first differing column in ``columns`` order), coalesced keys, both sides of each column, both versions and
    ``source_approx_date``.  Differences whose source time is within ``grace_minutes`` of ``now`` are left out
    (unknown time is kept).  ``nulls='default'`` makes NULL equal its type default; ``'strict'`` compares null-safely.
    ``since`` bounds the compare by date (see ``classify_pairs``); the size of a table never does.
    """
    pairs = classify_pairs(pub, sub, keys, columns, pub_version, sub_version, nulls, identity, defaults, date_column, since)
    if not include_matched:
        pairs = pairs.where(F.col("difference") != MATCHED)
    if checkpoints is not None:
        pairs = asof_join(pairs, checkpoints, "publisher_rv", ck_version, ck_date, "source_approx_date")
    else:
        pairs = pairs.withColumn("source_approx_date", F.lit(None).cast("timestamp_ntz"))
    if now is not None:
        recent = minus_minutes(ts_literal(now), grace_minutes)
        pairs = pairs.where((F.col("source_approx_date") < recent) | F.col("source_approx_date").isNull())
    return pairs


def compare_summary(pub: DataFrame, sub: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None,
                    nulls: str = "default", pub_version: str = "rv", sub_version: str = "sourcerv",
                    identity: Sequence[str] = (), defaults: dict | None = None,
                    date_column: str | None = None, since=None) -> DataFrame:
    """Count of keys per outcome, ``Matched`` included — the "matched N rows" message as data."""
    pairs = classify_pairs(pub, sub, keys, columns, pub_version, sub_version, nulls, identity, defaults, date_column, since)
    return pairs.groupBy("difference").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def repair_from_diff(diff: DataFrame, pub: DataFrame, keys: Sequence[str], base: int,
                     delete_log: DataFrame | None = None, version_col: str = "rv"):
    """Touch source rows so the differences flow again.

    Returns (re-versioned publisher rows for keys missing in the subscriber or mismatched, re-versioned delete-log
    rows for keys missing in the publisher).  New versions are above ``base`` in key order; semi-joins by key.
    """
    keys = list(keys)
    push = diff.where(F.col("difference") != MISSING_IN_PUBLISHER).select(*keys)
    rows = pub.join(push, keys, "left_semi").drop(version_col)
    patched = number_rows(rows, keys, base, version_col)
    deletes = None
    if delete_log is not None:
        gone = diff.where(F.col("difference") == MISSING_IN_PUBLISHER).select(*keys)
        dl = delete_log.join(gone, keys, "left_semi")
        n_rows = patched.count()
        deletes = number_rows(dl.drop("rv"), keys, base + n_rows, "rv").select(*delete_log.columns)
    return patched, deletes


def repair_step(pub: DataFrame, delete_log: DataFrame, diff: DataFrame, sub: DataFrame, keys: Sequence[str], base: int,
                at=None, version_col: str = "rv", sub_version: str = "sourcerv"):
    """(publisher table, delete log, highest version) after the rows of ``diff`` have been touched.

    Publisher rows that are missing or differ in the subscriber get new versions, then the delete-log rows of keys that
    only the subscriber holds get theirs.  Such a key without a logged delete gets a row in the log (``dt`` = ``at`` or
    now, ``sourcerv`` = the subscriber's version, tracked columns NULL): without it no extract would ever delete the key.
    """
    keys = list(keys)
    checkpoint_dir(pub.sparkSession)
    extra = diff.where(F.col("difference") == MISSING_IN_PUBLISHER).select(*keys)
    unlogged = extra.join(delete_log.select(*keys), keys, "left_anti").join(sub.select(*keys, F.col(sub_version).alias("sourcerv")), keys)
    dt = F.localtimestamp() if at is None else ts_literal(at)
    given = {"rv": F.lit(0).cast("bigint"), "dt": dt}
    full_log = delete_log.unionByName(unlogged.select(*[given[c].alias(c) if c in given else F.col(f"`{c}`") if c in unlogged.columns
                                                        else F.lit(None).cast(delete_log.schema[c].dataType).alias(c)
                                                        for c in delete_log.columns])).checkpoint(eager=True)
    patched, deletes = repair_from_diff(diff, pub, keys, base, full_log, version_col)
    patched, deletes = patched.checkpoint(eager=True), deletes.checkpoint(eager=True)
    table = pub.join(patched.select(*keys), keys, "left_anti").unionByName(patched.select(*pub.columns))
    log = full_log.join(extra, keys, "left_anti").unionByName(deletes)
    return table, log, base + patched.count() + deletes.count()


def repair_until_equal(pub: DataFrame, delete_log: DataFrame, sub: DataFrame, keys: Sequence[str], base: int,
                       columns: Sequence[str] | None = None, rounds: int = 3, at=None, **options):
    """(publisher table, delete log, subscriber table, highest version) once both copies compare as equal.

    Each round compares, touches what differs (``repair_step``), sends the touched versions through the ordinary extract
    and applies the stage to the subscriber, so a repair takes the path of any other change.  ``base`` is at least the
    highest version of both copies and the log.  One round is enough unless the copies change meanwhile; differences
    that are left after ``rounds`` rounds (a column the subscriber does not keep, say) end in an error, not in silence.
    ``options`` go to ``compare_tables``.
    """
    checkpoint_dir(pub.sparkSession)
    base = max(base, 1)                                  # a window from 0 would be a snapshot, without deletes
    for done in range(rounds + 1):
        diff = compare_tables(pub, sub, keys, columns, **options).checkpoint(eager=True)
        left = diff.count()
        if not left:
            return pub, delete_log, sub, base
        if done == rounds:
            break
        pub, delete_log, top = repair_step(pub, delete_log, diff, sub, keys, base, at)
        pub, delete_log = pub.checkpoint(eager=True), delete_log.checkpoint(eager=True)
        stage = extract_changes(pub, delete_log, keys, VersionWindow(base, top))
        sub, base = apply_changes(sub, stage, keys).checkpoint(eager=True), top
    raise RuntimeError(f"{left} keys still differ after {rounds} rounds of repair")


def compare_all(pairs: dict, keys_of: dict, skip_prefix: str = CHECKPOINT_COPY_PREFIX, **kw) -> DataFrame:
    """Compare many tables (dict name → (pub, sub)) and union their summaries; ``kw`` as in ``compare_summary``.

    Replicated checkpoint copies (``skip_prefix``) are left out; every other table is compared (the loop is over table
    specs, never over rows).
    """
    out = None
    for name, (pub, sub) in pairs.items():
        if skip_prefix and name.startswith(skip_prefix):
            continue
        s = compare_summary(pub, sub, keys_of[name], **kw).select(F.lit(name).alias("table_name"), "difference", "n")
        out = s if out is None else out.unionByName(s)
    return out
