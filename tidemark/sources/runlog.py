"""Append-only run log in parquet: a 'start' row when a run opens, an 'end' row when it closes, merged by run id.

Parquet files cannot be updated in place, so closing a run appends its final state; ``runs()`` keeps the newest row
per run (the run log is small metadata: one row per run).
"""
from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.extract import latest_per_key
from ..operators.runs import recollect_detail
from ..functions.versions import BEGINNING
from .fs import HadoopFs

LOG_SCHEMA = ("import_log_id bigint, subscription_id bigint, seq bigint, rv_from bigint, rv_to bigint, "
              "start_date timestamp_ntz, end_date timestamp_ntz, success int, total_rows bigint, rv_total_rows bigint, "
              "total_kbs bigint, use_stage boolean, message string")
DETAIL_SCHEMA = "import_log_id bigint, table_name string, total_rows bigint, total_kbs bigint, seq bigint, is_stage boolean"
BASELINE_MESSAGE = "baseline: the copy already holds this state"


def _now(now=None) -> dt.datetime:
    return now if isinstance(now, dt.datetime) else (dt.datetime.fromisoformat(now) if now else dt.datetime.now())


class RunLog:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._seq = 0
        self._open = {}          # run id → start row written by this process (saves re-reading the log)
        self._rows = {}          # run id → rows logged by this process

    @property
    def _log_path(self):
        return f"{self.root}/import_log"

    @property
    def _detail_path(self):
        return f"{self.root}/import_log_detail"

    def _has(self, path) -> bool:
        return HadoopFs(self.spark, path).exists()

    def _append(self, path, rows, schema):
        self.spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)

    def _next_seq(self) -> int:
        self._seq += 1
        return int(dt.datetime.now().timestamp() * 1_000_000) * 1000 + self._seq

    # ---- views --------------------------------------------------------------------------------------------------
    def entries(self) -> DataFrame:
        if not self._has(self._log_path):
            return self.spark.createDataFrame([], LOG_SCHEMA)
        return self.spark.read.schema(LOG_SCHEMA).parquet(self._log_path)

    def runs(self) -> DataFrame:
        """Current state of every run (newest row per run id)."""
        return latest_per_key(self.entries(), ["import_log_id"], "seq").drop("seq")

    def detail(self) -> DataFrame:
        if not self._has(self._detail_path):
            return self.spark.createDataFrame([], DETAIL_SCHEMA).drop("seq")
        d = self.spark.read.schema(DETAIL_SCHEMA).parquet(self._detail_path)
        return latest_per_key(d, ["import_log_id", "table_name"], "seq").drop("seq").where("total_rows IS NOT NULL")

    # ---- events -------------------------------------------------------------------------------------------------
    def start_run(self, subscription_id: int, rv_from: int, rv_to: int, now=None) -> int:
        """Open a run (success 0 until closed); returns its id.  ``use_stage`` is false for direct loads."""
        last = self.entries().agg(F.max("import_log_id")).first()[0]
        run_id = int(last or 0) + 1
        row = (run_id, subscription_id, self._next_seq(), rv_from, rv_to, _now(now), None, 0, None, rv_to - rv_from,
               None, rv_from != BEGINNING, None)
        self._append(self._log_path, [row], LOG_SCHEMA)
        self._open[run_id] = dict(zip(["import_log_id", "subscription_id", "seq", "rv_from", "rv_to", "start_date",
                                       "end_date", "success", "total_rows", "rv_total_rows", "total_kbs", "use_stage",
                                       "message"], row))
        self._rows[run_id] = {}
        return run_id

    def log_table(self, run_id: int, table_name: str, rows: int, kbs: int | None = None, is_stage: bool = False) -> None:
        self._append(self._detail_path, [(run_id, table_name, int(rows), kbs, self._next_seq(), is_stage)], DETAIL_SCHEMA)
        if run_id in self._rows:
            self._rows[run_id][table_name] = (int(rows), kbs)

    def recollect(self, run_id: int, measured: DataFrame, routines: Sequence[str] = ()) -> None:
        """Replace a run's detail by ``measured`` (table_name, total_rows, total_kbs, is_stage); rows named like one of
        ``routines`` stay.  The log only grows: a row that goes is appended once more without a number of rows.
        """
        own = self.detail().where(F.col("import_log_id") == run_id)
        names = self.spark.createDataFrame([(r,) for r in routines], "routine_name string")
        after = recollect_detail(own, run_id, names, measured.withColumn("import_log_id", F.lit(run_id).cast("bigint")))
        gone = (own.join(after.select("table_name"), "table_name", "left_anti")
                .withColumn("total_rows", F.lit(None).cast("bigint")).withColumn("total_kbs", F.lit(None).cast("bigint")))
        rows = after.unionByName(gone).withColumn("seq", F.lit(self._next_seq()).cast("bigint"))
        rows.select(*self.spark.createDataFrame([], DETAIL_SCHEMA).columns).coalesce(1).write.mode("append").parquet(self._detail_path)
        self._rows.pop(run_id, None)                # the totals come from the detail now

    def end_run(self, run_id: int, success: bool, message: str = "", now=None) -> int:
        """Close a run: totals from its detail rows (NULL → 0), end date, success flag and message."""
        cur = self._open.pop(run_id, None) or self.runs().where(F.col("import_log_id") == run_id).first()
        if run_id in self._rows:
            logged = list(self._rows.pop(run_id).values())
            total = sum(r for r, _ in logged)
            kbs = sum(k for _, k in logged if k is not None) if any(k is not None for _, k in logged) else None
        else:
            agg = (self.detail().where(F.col("import_log_id") == run_id)
                   .agg(F.sum("total_rows"), F.sum("total_kbs")).first())
            total, kbs = agg[0] or 0, agg[1]
        row = (run_id, cur["subscription_id"], self._next_seq(), cur["rv_from"], cur["rv_to"], cur["start_date"],
               _now(now), 1 if success else 0, int(total), cur["rv_total_rows"], kbs, cur["use_stage"], message)
        self._append(self._log_path, [row], LOG_SCHEMA)
        return int(total)

    def set_baseline(self, subscription_id: int, rv_to: int, now=None) -> int:
        """Record a successful run (beginning, rv_to] without copying: the target already holds that state."""
        last = self.entries().agg(F.max("import_log_id")).first()[0]
        run_id = int(last or 0) + 1
        t = _now(now)
        self._append(self._log_path, [(run_id, subscription_id, self._next_seq(), BEGINNING, rv_to, t, t, 1, -1, -1,
                                       None, False, BASELINE_MESSAGE)], LOG_SCHEMA)
        return run_id
