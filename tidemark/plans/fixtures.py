"""Derived inputs built by Spark from the given tables (FIXTURES.md F1–F6).

* F1 ``feed``: ``events`` read as an operation log on key (user_id, slot) — version ``event_id + 1``, 'D' for
  error events — reduced to the current table ``src`` and its delete log ``del_log``.
* F2 ``window``: the collapsed stage of the window (lo, hi] and the target as it stood at ``lo``.
* F3 hourly checkpoints; F4 a run log of five subscriptions; F5 two copies of ``orders`` with planted
  differences; F6 five subscription configurations.

Window bounds scale with the data: lo = floor(0.6 × (max(event_id) + 1)), hi = max(event_id) + 1, computed on the
driver and passed as literals so the range filters reach the scans.
"""
from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.asof import build_checkpoints, window_counts
from ..operators.extract import extract_changes, latest_per_key
from ..operators.versions import feed_from_log, number_rows, segment_span
from ..plans.spec import VersionWindow
from ..sources.tables import read_table

FEED_KEYS = ("user_id", "slot")
FEED_VALUES = ("event_type", "value")
PAIR_KEYS = ("o_orderkey",)
# F5 column order for "first differing column".
PAIR_COLUMNS = ("o_orderstatus", "o_totalprice", "o_orderpriority")
# F6 subscription rows: (subscription_id, name, priority_group, is_active, frequency_minutes).
SUBSCRIPTIONS = [(0, "a", 1, 1, 60), (1, "b", 1, 1, 1440), (2, "c", 2, 0, 60), (3, "d", None, 1, None),
                 (9, "never", 2, 1, None)]
DUE_AT = "2024-01-30 23:59:00"
COMPARE_NOW = "2024-01-31 00:00:00"


class Fixtures:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    # ---- bounds ---------------------------------------------------------------------------------------------
    @cached_property
    def max_event_id(self) -> int:
        return int(self.table("events").agg(F.max("event_id")).first()[0])

    @property
    def hi(self) -> int:
        return self.max_event_id + 1

    @property
    def lo(self) -> int:
        import math
        return int(math.floor(0.6 * (self.max_event_id + 1)))

    @property
    def window(self) -> VersionWindow:
        return VersionWindow(self.lo, self.hi)

    @cached_property
    def last_event_time(self) -> str:
        return str(self.table("events").agg(F.max("ts").cast("string")).first()[0])

    # ---- F1 ------------------------------------------------------------------------------------------------------
    @property
    def chg(self) -> DataFrame:
        e = self.table("events")
        return e.select("user_id", (F.col("event_id") % 7).alias("slot"), "event_type", "value", "props", "ts",
                        (F.col("event_id") + 1).alias("rv"),
                        F.when(F.col("event_type") == "error", "D").otherwise("U").alias("op"))

    @cached_property
    def _feed(self):
        span = segment_span(0, self.hi)
        return feed_from_log(self.chg, list(FEED_KEYS), list(FEED_VALUES), "rv", "op", "ts", span)

    @property
    def src(self) -> DataFrame:
        return self._feed[0]

    @property
    def del_log(self) -> DataFrame:
        return self._feed[1]

    # ---- F2 ------------------------------------------------------------------------------------------------------
    @property
    def stg(self) -> DataFrame:
        return extract_changes(self.src, self.del_log, list(FEED_KEYS), self.window)

    @property
    def tgt(self) -> DataFrame:
        early = self.chg.where(F.col("rv") <= F.lit(self.lo))
        return (latest_per_key(early, list(FEED_KEYS), "rv").where(F.col("op") == "U")
                .select(*FEED_KEYS, *FEED_VALUES, F.col("rv").alias("sourcerv")))

    # ---- F3 / F4 -------------------------------------------------------------------------------------------------
    @property
    def ck(self) -> DataFrame:
        return build_checkpoints(self.table("events"), "ts", "event_id", "hour", "min")

    @cached_property
    def import_log(self) -> DataFrame:
        lg = number_rows(self.ck.select(F.col("rv").alias("rv_to"), F.col("date").alias("start_date")), ["rv_to"],
                         0, "import_log_id")
        lg = lg.withColumn("subscription_id", F.col("import_log_id") % 5)
        w_back = Window.partitionBy("subscription_id").orderBy(F.col("import_log_id").desc())
        lg = lg.withColumn("back", F.row_number().over(w_back))
        lg = lg.withColumn("success", F.when((F.col("back") == 1) | (F.col("import_log_id") % 7 == 0), 0).otherwise(1))
        w_prior = (Window.partitionBy("subscription_id").orderBy("import_log_id")
                   .rowsBetween(Window.unboundedPreceding, -1))
        rv_from = F.coalesce(F.max(F.when(F.col("success") == 1, F.col("rv_to"))).over(w_prior),
                             F.lit(0).cast("bigint"))
        return lg.select("import_log_id", "subscription_id", "start_date",
                         F.when(F.col("back") == 1, F.lit(None).cast("timestamp_ntz"))
                          .otherwise(F.col("start_date") + F.expr("INTERVAL 90 SECONDS")).alias("end_date"),
                         "success", "rv_to", rv_from.alias("rv_from"))

    @cached_property
    def import_log_detail(self) -> DataFrame:
        """Rows each run moved, per table: changes and logged deletes inside its window (rv_from, rv_to]."""
        runs = self.import_log.select("import_log_id", "rv_from", "rv_to")
        parts = []
        for name, df in (("events", self.chg.select("rv")), ("del_log", self.del_log.select("rv"))):
            moved = window_counts(df, runs).where("total_rows > 0")
            parts.append(moved.select("import_log_id", F.lit(name).alias("table_name"), "total_rows"))
        return parts[0].unionByName(parts[1])

    # ---- F5 ------------------------------------------------------------------------------------------------------
    @property
    def pair(self):
        o = self.table("orders")
        k = F.col("o_orderkey")
        p = o.select("o_orderkey", "o_orderstatus",
                     F.when(k % 109 == 0, F.lit(None).cast("string")).otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
                     "o_totalprice", (k + 1).alias("rv"))
        s_main = o.where(k % 101 != 0).select(
            "o_orderkey", F.when(k % 103 == 0, F.lit("X")).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
            F.when(k % 109 == 0, F.lit("")).otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
            F.when(k % 107 == 0, F.lit(None).cast("double")).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
            (k + 1).alias("sourcerv"))
        s_extra = o.where(k % 211 == 0).select((-k - 1).alias("o_orderkey"), "o_orderstatus", "o_orderpriority",
                                               "o_totalprice", (k + 1).alias("sourcerv"))
        return p, s_main.unionByName(s_extra)

    # ---- F6 ------------------------------------------------------------------------------------------------------
    @property
    def subscriptions(self) -> DataFrame:
        return self.spark.createDataFrame(
            SUBSCRIPTIONS, "subscription_id bigint, name string, priority_group int, is_active int, frequency_minutes int")
