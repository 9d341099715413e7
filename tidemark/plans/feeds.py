"""Run every table and routine of a feed configuration (``FeedSpec``): small tables first, then routines.

``run_subscription`` is one run of a subscription: one mark, one upper bound and one run id for all of its tables.
``sync_feed`` keeps a log and a mark for each table.
"""
from __future__ import annotations

from typing import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..functions.versions import BEGINNING
from ..operators.runs import clear_init_flags, delayed_version, end_run_flags, high_water_mark
from ..operators.versions import current_version
from ..sources.bucketed import BucketedTable
from ..sources.runlog import RunLog
from ..sources.stats import feed_stats, stage_path
from .spec import FeedSpec, VersionWindow
from .sync import move_table, sync_table


def sync_feed(spark: SparkSession, specs: Sequence[FeedSpec], target_root: str, log_root: str, subscription_id: int,
              current: int | None = None, num_buckets: int = 64, order_by_size: bool = True, parallel: int = 1) -> list:
    """Sync each table of the feed into ``target_root/<local name>`` with its own mark, then run its routines.

    Sources are resolved from the spec (a callable giving the current table).  Tables go smallest first, as a
    subscription's table list does; with ``parallel > 1`` independent tables are submitted from a thread pool
    (Spark runs jobs of several driver threads side by side; each table has its own store and run log).
    """
    tables = [s for s in specs if s.source is not None]
    if order_by_size and len(tables) > 1:
        sizes = {s.name: s.source(spark).count() for s in tables}
        tables = sorted(tables, key=lambda s: (sizes[s.name], s.name))

    def one(spec: FeedSpec) -> list:
        src = spec.source(spark)
        dels = spec.delete_log(spark) if spec.delete_log else None
        if spec.ignore_columns:
            src = src.drop(*spec.ignore_columns)
        target = BucketedTable(spark, f"{target_root}/{spec.local_name}", spec.key_columns, num_buckets)
        log = RunLog(spark, f"{log_root}/{spec.local_name}")
        res = [sync_table(spark, spec.local_name, spec.key_columns, src, dels, target, log, subscription_id,
                          f"{target_root}/_stage", current=current, initialize=spec.initialize,
                          identity=spec.identity_columns, compress=spec.compress_columns)]
        for routine in spec.routines:
            out = routine(spark, VersionWindow(res[0]["rv_from"], res[0]["rv_to"]))
            res.append(dict(routine=getattr(routine, "__name__", "routine"),
                            rows=out.count() if out is not None else 0))
        return res

    if parallel > 1:
        from concurrent.futures import ThreadPoolExecutor
        with ThreadPoolExecutor(max_workers=parallel) as pool:
            parts = list(pool.map(one, tables))
    else:
        parts = [one(t) for t in tables]
    return [r for part in parts for r in part]


def run_subscription(spark: SparkSession, specs: Sequence[FeedSpec], target_root: str, log: RunLog, subscription_id: int,
                     current: int | None = None, num_buckets: int = 64, double_read: bool = False, checkpoints=None, now=None, ledger=None) -> dict:
    """One run: every table of the subscription brought from the one mark to the one upper bound, then its routines.

    The upper bound is ``current``, or the version up to which the ``ledger``'s writers are done (no table is read for
    it), or the version of the newest checkpoint old enough (``checkpoints`` given), or the highest version in any table.  A table that is new or flagged ``initialize`` is loaded from the beginning.
    Routines run in the order of ``routine_order`` after all tables, with the run's window; a routine that returns a
    DataFrame is logged by its rows.  Before the run closes its detail is collected anew from what is stored: the stage of
    a table whose changes were staged, or the target of one that was loaded.  When the run moved rows or has a routine, the ``initialize`` flags of the tables it
    loaded are cleared.  A failure closes the run with success 0, flags stay, and the next run covers the window again.
    """
    tables = [s for s in specs if s.source is not None]
    sources = {s.local_name: (s.source(spark), s.delete_log(spark) if s.delete_log else None) for s in tables}
    if current is None and ledger is not None:
        current = current_version(ledger=ledger)
    elif current is None:
        current = max((current_version(src, dels) for src, dels in sources.values()), default=BEGINNING)
        current = current if checkpoints is None else delayed_version(checkpoints, now, current)
    mark = high_water_mark(log.runs().where(F.col("subscription_id") == subscription_id), double_read=double_read).first()
    rv_from = BEGINNING if mark is None else int(mark["hwm"])
    run_id = log.start_run(subscription_id, rv_from, current, now)
    staged, loaded = [], []
    try:
        for spec in tables:
            src, dels = sources[spec.local_name]
            target = BucketedTable(spark, f"{target_root}/{spec.local_name}", spec.key_columns, num_buckets)
            lo = BEGINNING if spec.initialize or not target.exists() else rv_from
            moved = move_table(spark, spec.local_name, spec.key_columns, src.drop(*spec.ignore_columns), dels, target, VersionWindow(lo, current),
                               stage_path(target_root, run_id, spec.local_name), spec.identity_columns, spec.compress_columns)
            log.log_table(run_id, moved["logged_as"], moved["rows"], moved["kbs"], moved["is_stage"])
            (staged if moved["is_stage"] else loaded).append(spec.local_name)
        routines = sorted(((spec.routine_order, i, r) for spec in specs for i, r in enumerate(spec.routines)), key=lambda x: x[:2])
        for _, _, routine in routines:
            out = routine(spark, VersionWindow(rv_from, current))
            if out is not None:
                log.log_table(run_id, routine.__name__, out.count())
        measured = (feed_stats(spark, staged, target_root, True, run_id).withColumn("is_stage", F.lit(True))
                    .unionByName(feed_stats(spark, loaded, target_root, False).withColumn("is_stage", F.lit(False))))
        log.recollect(run_id, measured, [r.__name__ for _, _, r in routines])
        total = log.end_run(run_id, True, "ok", now)
    except Exception as ex:
        log.end_run(run_id, False, f"{type(ex).__name__}: {ex}", now)
        raise
    flags = spark.createDataFrame([(s.local_name, int(s.initialize)) for s in tables], "table_name string, initialize int")
    left = {r["table_name"]: r["initialize"] for r in clear_init_flags(flags, log.detail(), run_id, True, total, bool(routines)).collect()}   # a row a table
    for s in tables:
        s.initialize = bool(left[s.local_name])
    return dict(run_id=run_id, rv_from=rv_from, rv_to=current, total_rows=total, cleared=end_run_flags(True, total, bool(routines)))
