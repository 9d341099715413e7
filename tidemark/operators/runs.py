"""Run log: windows, high-water marks, freshness and status reports.

The log is small metadata (one row per run); every report is a grouped or windowed DataFrame over it.  Column names:
``import_log_id, subscription_id, rv_from, rv_to, start_date, end_date, success, total_rows, …``.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timefn import minute_boundaries, second_boundaries, ts_literal
from ..functions.versions import BEGINNING


def last_success(log: DataFrame) -> DataFrame:
    """Newest end date of a successful run, per subscription."""
    return (log.where(F.col("success") == 1).groupBy("subscription_id")
            .agg(F.max("end_date").alias("last_date")))


def high_water_mark(log: DataFrame, subscriptions: DataFrame | None = None, double_read: bool | Column = False,
                    out_col: str = "hwm") -> DataFrame:
    """Lower bound of the next window per subscription: ``rv_to`` of the newest successful run, or — with double
    read — of the second newest (the newest when there is only one).  No success → the beginning (0).

    ``double_read`` may be a boolean or a column of ``subscriptions`` (per-feed flag).
    """
    w = Window.partitionBy("subscription_id").orderBy(F.col("import_log_id").desc())
    top2 = (log.where(F.col("success") == 1)
            .select("subscription_id", "rv_to", F.row_number().over(w).alias("_rn"))
            .where(F.col("_rn") <= 2))
    marks = top2.groupBy("subscription_id").agg(
        F.max(F.when(F.col("_rn") == 1, F.col("rv_to"))).alias("_m1"),
        F.max_by("rv_to", "_rn").alias("_m2"))
    if subscriptions is None:
        subscriptions = log.select("subscription_id").distinct()
    j = subscriptions.join(marks, "subscription_id", "left")
    flag = double_read if isinstance(double_read, Column) else F.lit(bool(double_read))
    pick = F.when(F.coalesce(flag.cast("boolean"), F.lit(False)), F.col("_m2")).otherwise(F.col("_m1"))
    return j.select(*subscriptions.columns, F.coalesce(pick, F.lit(BEGINNING).cast("bigint")).alias(out_col))


def contiguous_marks(windows: DataFrame, base: int = BEGINNING, out_col: str = "mark") -> DataFrame:
    """Per subscription, how far its closed ``windows`` (subscription_id, rv_from, rv_to) reach without a gap.

    Windows are half-open, arrive in any order and may overlap.  In the order of their lower bounds one begins a new
    island when all before it end below it; ``out_col`` is the end of the island that starts at or below ``base``
    (``base`` itself if none does), and ``waiting`` counts the windows beyond the first gap.  The list of windows is run
    metadata; a subscription's are ordered together.
    """
    w = Window.partitionBy("subscription_id").orderBy("rv_from", "rv_to")
    reach = F.coalesce(F.max("rv_to").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(base))
    gaps = windows.withColumn("_gap", (F.col("rv_from") > F.greatest(reach, F.lit(base))).cast("int"))
    beyond = gaps.withColumn("_beyond", F.sum("_gap").over(w.rowsBetween(Window.unboundedPreceding, 0)) > 0)
    return beyond.groupBy("subscription_id").agg(
        F.greatest(F.coalesce(F.max(F.when(~F.col("_beyond"), F.col("rv_to"))), F.lit(base)), F.lit(base)).cast("bigint").alias(out_col),
        F.sum(F.col("_beyond").cast("bigint")).alias("waiting"))


def closed_windows(published: DataFrame, received: DataFrame) -> DataFrame:
    """Windows (rv_from, rv_to, rows) of ``published`` whose rows have all arrived, by ``received`` (rv_to, batch, rows).

    A batch that was reported again counts once.
    """
    got = received.groupBy("rv_to", "batch").agg(F.max("rows").alias("rows")).groupBy("rv_to").agg(F.sum("rows").alias("_got"))
    return published.join(got, "rv_to", "left").where(F.coalesce("_got", F.lit(0)) >= F.col("rows")).drop("_got")


def run_window(subscriptions: DataFrame, log: DataFrame, current: int) -> DataFrame:
    """Window of the next run per subscription: init flag or no mark → (0, current] loaded directly (no stage);
    else (mark, current] through the stage.  ``rv_total_rows`` is the window width."""
    marks = high_water_mark(log, subscriptions.select("subscription_id", "double_read"),
                            F.col("double_read"))
    j = subscriptions.select("subscription_id", "initialize").join(marks.drop("double_read"), "subscription_id")
    init = F.coalesce(F.col("initialize").cast("boolean"), F.lit(False))
    rv_from = F.when(init, F.lit(BEGINNING).cast("bigint")).otherwise(F.col("hwm"))
    return j.select("subscription_id", rv_from.alias("rv_from"), F.lit(current).cast("bigint").alias("rv_to"),
                    (rv_from != BEGINNING).alias("use_stage"),
                    (F.lit(current).cast("bigint") - rv_from).alias("rv_total_rows"))


def open_run(log: DataFrame) -> DataFrame:
    """Newest run still open (no end date), per subscription."""
    w = Window.partitionBy("subscription_id").orderBy(F.col("import_log_id").desc())
    return (log.where(F.col("end_date").isNull()).withColumn("_rn", F.row_number().over(w))
            .where("_rn = 1").drop("_rn"))


def due_feeds(subscriptions: DataFrame, log: DataFrame, now, priority_group: int = 0,
              subscription_id: int = 0) -> DataFrame:
    """Subscriptions to run now: active, optional id / group filters, never succeeded or the last success is at
    least ``frequency_minutes`` clock-minute boundaries ago.  A forced id in the same group (NULL group = 0) runs
    regardless of activity and time."""
    j = subscriptions.join(last_success(log), "subscription_id", "left")
    now_c = ts_literal(now)
    grp = F.coalesce(F.col("priority_group"), F.lit(0))
    regular = ((F.col("is_active") == 1)
               & ((F.lit(subscription_id) == 0) | (F.col("subscription_id") == subscription_id))
               & ((F.lit(priority_group) == 0) | (grp == priority_group))
               & (F.col("last_date").isNull()
                  | (F.col("frequency_minutes") <= minute_boundaries(F.col("last_date"), now_c))))
    forced = (grp == priority_group) & (F.col("subscription_id") == subscription_id)
    return j.where(F.coalesce(regular, F.lit(False)) | F.coalesce(forced, F.lit(False)))


def recent_runs(log: DataFrame, n: int = 10) -> DataFrame:
    """Last ``n`` runs per subscription, newest first, with their duration in (boundary) seconds."""
    w = Window.partitionBy("subscription_id").orderBy(F.col("import_log_id").desc())
    return (log.withColumn("rn", F.row_number().over(w).cast("bigint")).where(F.col("rn") <= n)
            .withColumn("seconds", second_boundaries(F.col("start_date"), F.col("end_date"))))


def latest_run(subscriptions: DataFrame, log: DataFrame) -> DataFrame:
    """Each active subscription with its newest run (NULLs when it never ran)."""
    w = Window.partitionBy("subscription_id").orderBy(F.col("import_log_id").desc())
    newest = log.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
    return subscriptions.where(F.col("is_active") == 1).join(newest, "subscription_id", "left")


def run_detail_view(detail: DataFrame, log: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Detail rows with their run's window and subscription (inner joins; AQE picks the strategy)."""
    l = log.select("import_log_id", "subscription_id", "start_date", "success", "rv_from", "rv_to")
    s = subscriptions.select("subscription_id", "name")
    return detail.join(l, "import_log_id").join(s, "subscription_id")


def run_totals(log: DataFrame, detail: DataFrame) -> DataFrame:
    """Close-of-run totals: rows per run from its detail (no detail → 0)."""
    per = detail.groupBy("import_log_id").agg(F.sum("total_rows").cast("bigint").alias("_rows"))
    return (log.select("import_log_id", "subscription_id").join(per, "import_log_id", "left")
            .select("import_log_id", "subscription_id",
                    F.coalesce("_rows", F.lit(0).cast("bigint")).alias("total_rows")))


def table_stats(tables: dict) -> DataFrame:
    """Row count per named table (all columns pruned from each scan)."""
    parts = [df.groupBy().agg(F.count(F.lit(1)).cast("bigint").alias("total_rows"))
             .select(F.lit(name).alias("table_name"), "total_rows") for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def missing_from(candidates: DataFrame, existing: DataFrame, keys) -> DataFrame:
    """Rows of ``candidates`` whose key is not in ``existing`` (work lists: not yet published / subscribed)."""
    return candidates.join(existing.select(*keys), list(keys), "left_anti")


def end_run_flags(success: bool, total_rows: int, has_routine: bool) -> bool:
    """Whether a closing run may clear initialise flags: success and (rows moved or an active routine)."""
    return bool(success) and (total_rows > 0 or has_routine)


def recollect_detail(detail: DataFrame, run_id: int, routines: DataFrame, measured: DataFrame) -> DataFrame:
    """Detail after a run closes: this run's rows are replaced by ``measured`` except rows named like a routine.

    The exclusion is SQL ``NOT IN (subquery)`` — null-aware: one NULL routine name means no row is removed.
    ``routines`` is small metadata (broadcast by the null-aware anti-join).
    """
    this = F.col("import_log_id") == F.lit(run_id)
    names = routines.select(F.col("routine_name"))
    this_rows = detail.where(this)
    removed = this_rows.where(~F.col("table_name").isin(names)).select(F.col("table_name").alias("_gone")).distinct()
    kept_this = this_rows.join(removed, this_rows["table_name"].eqNullSafe(removed["_gone"]), "left_anti")
    return detail.where(~this).unionByName(kept_this).unionByName(measured.select(*detail.columns))


def tables_loaded(tables: DataFrame, detail: DataFrame, run_id: int, stage_prefix: str = "stg_",
                  stage_flag: str = "is_stage") -> DataFrame:
    """Tables of a feed that moved rows in a run: the detail names the table itself or its stage.

    A row names a stage only if its boolean ``stage_flag`` says so; then ``stage_prefix`` is taken off the name.  A real
    table whose name starts like a stage is matched as it is, also when the detail has no such column.  The two-branch
    OR of the match becomes one equi semi-join.
    """
    name = F.col("table_name")
    if stage_flag in detail.columns:
        name = F.when(F.col(stage_flag) & name.startswith(stage_prefix), F.expr(f"substring(table_name, {len(stage_prefix) + 1})")).otherwise(name)
    d = detail.where(F.col("import_log_id") == F.lit(run_id)).select(name.alias("table_name")).distinct()
    return tables.join(d, "table_name", "left_semi")


def clear_init_flags(tables: DataFrame, detail: DataFrame, run_id: int, success: bool, total_rows: int,
                     has_routine: bool) -> DataFrame:
    """``initialize`` after a run closes: cleared for loaded tables when the run may clear flags."""
    if not end_run_flags(success, total_rows, has_routine):
        return tables
    loaded = tables_loaded(tables.select("table_name"), detail, run_id).withColumn("_loaded", F.lit(True))
    return (tables.join(loaded, "table_name", "left")
            .withColumn("initialize", F.when(F.col("_loaded"), F.lit(0)).otherwise(F.col("initialize")))
            .drop("_loaded"))


def latest_detail(log: DataFrame, detail: DataFrame) -> DataFrame:
    """Detail rows of each subscription's newest run (the closed-run branch of the status report)."""
    newest = log.groupBy("subscription_id").agg(F.max("import_log_id").alias("import_log_id"))
    return detail.join(newest, "import_log_id")


def status_detail(log: DataFrame, detail: DataFrame, measured: DataFrame) -> DataFrame:
    """The tables of each subscription's newest run: its detail if it has ended, else what is stored so far.

    ``measured`` (subscription_id, table_name, total_rows) is the state of the stage or the target of the subscriptions'
    tables now, as ``feed_stats`` gives it; it stands in for the detail, which an open run does not have in full.
    """
    w = Window.partitionBy("subscription_id").orderBy(F.col("import_log_id").desc())
    newest = (log.select("subscription_id", "import_log_id", F.col("end_date").isNull().alias("is_open"), F.row_number().over(w).alias("_rn"))
              .where("_rn = 1").drop("_rn"))
    ended = detail.join(newest.where("not is_open"), "import_log_id")
    running = measured.join(newest.where("is_open"), "subscription_id")
    cols = ["subscription_id", "import_log_id", "is_open", "table_name", "total_rows"]
    return ended.select(*cols).unionByName(running.select(*cols))


def run_status(subscriptions: DataFrame, log: DataFrame, now, delay_alert_minutes: int | None = None) -> DataFrame:
    """Newest run per active subscription, its age in minutes, and a delay alert when the last success is older
    than the subscription's ``delay_alert_minutes`` (or the given default)."""
    lr = latest_run(subscriptions, log)
    ls = last_success(log)
    now_c = ts_literal(now)
    j = lr.join(ls, "subscription_id", "left").withColumn("minutes_since_success",
                                                          minute_boundaries(F.col("last_date"), now_c))
    limit = F.col("delay_alert_minutes") if "delay_alert_minutes" in subscriptions.columns else F.lit(delay_alert_minutes)
    return j.withColumn("delay_alert", F.coalesce(F.col("minutes_since_success") > limit, F.lit(False)))


def feed_catalog(subscriptions: DataFrame, tables: DataFrame, columns: DataFrame | None = None) -> DataFrame:
    """Subscription ⋈ table (⋈ column): the configuration as one flat view."""
    out = subscriptions.join(tables, "subscription_id")
    if columns is not None:
        out = out.join(columns, ["subscription_id", "table_name"])
    return out


def delayed_version(checkpoints: DataFrame, now, current: int, lag_seconds: int = 1, stale_minutes: int = 60) -> int:
    """Upper bound that trails the clock: the version of the newest checkpoint older than ``lag_seconds``; when
    that checkpoint is older than ``stale_minutes`` (the checkpoint writer stopped) the current version."""
    now_c = ts_literal(now)
    cutoff = now_c - F.expr(f"INTERVAL {int(lag_seconds)} SECONDS")
    row = (checkpoints.where(F.col("date") < cutoff)
           .agg(F.max_by("rv", "date").alias("rv"), F.max("date").alias("date"))
           .select("rv", minute_boundaries(F.col("date"), now_c).alias("age")).first())
    if row is None or row["rv"] is None or row["age"] > stale_minutes:
        return int(current)
    return int(row["rv"])


def ordered_tables(tables: DataFrame) -> DataFrame:
    """Table list in load order: smallest first (unknown size first), then by name."""
    return tables.orderBy(F.col("initial_row_count").asc_nulls_first(), "schema_name", "table_name")


def ordered_subscriptions(subscriptions: DataFrame) -> DataFrame:
    """Subscriptions in run order: sequence (unset first), then id."""
    return subscriptions.orderBy(F.col("subscription_sequence").asc_nulls_first(), "subscription_id")
