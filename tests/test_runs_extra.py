"""Close-of-run detail (null-aware NOT IN), loaded tables, flags, status, delayed bound, catalog, feed sync."""
import tempfile

from pyspark.sql import functions as F

from tidemark.operators import runs
from tidemark.operators.versions import empty_delete_log
from tidemark.plans.feeds import sync_feed
from tidemark.plans.spec import FeedSpec
from tidemark.sources.runlog import BASELINE_MESSAGE, RunLog


def _detail(spark):
    return spark.createDataFrame([(1, "a", 5), (1, "r1", 7), (1, "stg_b", 3), (2, "a", 9)],
                                 "import_log_id bigint, table_name string, total_rows bigint")


def test_recollect_detail_null_aware(spark):
    d = _detail(spark)
    measured = spark.createDataFrame([(1, "a", 50)], "import_log_id bigint, table_name string, total_rows bigint")
    ok = spark.createDataFrame([("r1",)], "routine_name string")
    got = sorted(map(tuple, runs.recollect_detail(d, 1, ok, measured).collect()))
    assert got == [(1, "a", 50), (1, "r1", 7), (2, "a", 9)]
    with_null = spark.createDataFrame([("r1",), (None,)], "routine_name string")
    got = sorted(map(tuple, runs.recollect_detail(d, 1, with_null, measured).collect()))
    assert got == sorted([(1, "a", 5), (1, "r1", 7), (1, "stg_b", 3), (2, "a", 9), (1, "a", 50)])


def test_tables_loaded_and_flags(spark):
    d = _detail(spark).withColumn("is_stage", F.col("table_name") == "stg_b")
    tables = spark.createDataFrame([("a", 1), ("b", 1), ("c", 1)], "table_name string, initialize int")
    assert sorted(r[0] for r in runs.tables_loaded(tables.select("table_name"), d, 1).collect()) == ["a", "b"]
    real = spark.createDataFrame([("b",), ("stg_b",)], "table_name string")          # a real table named like a stage
    for detail in (d.drop("is_stage"), d.withColumn("is_stage", F.lit(False))):
        assert [r[0] for r in runs.tables_loaded(real, detail, 1).collect()] == ["stg_b"]
    flags = dict(runs.clear_init_flags(tables, d, 1, True, 8, False).collect())
    assert flags == {"a": 0, "b": 0, "c": 1}
    assert dict(runs.clear_init_flags(tables, d, 1, True, 0, False).collect()) == {"a": 1, "b": 1, "c": 1}


def test_status_and_latest_detail(spark, fx01):
    st = runs.run_status(fx01.subscriptions, fx01.import_log, "2024-01-31 06:00:00", delay_alert_minutes=60)
    rows = {r["subscription_id"]: r for r in st.collect()}
    assert set(rows) == {0, 1, 3, 9}
    assert rows[9]["import_log_id"] is None and rows[0]["delay_alert"]
    ld = runs.latest_detail(fx01.import_log, fx01.import_log_detail)
    newest = {r[0] for r in fx01.import_log.groupBy("subscription_id").agg(F.max("import_log_id")).collect()}
    assert {r["import_log_id"] for r in ld.collect()} <= {r for r in
                                                          [x[1] for x in fx01.import_log.groupBy("subscription_id").agg(F.max("import_log_id")).collect()]}
    assert newest


def test_delayed_version(spark, fx01):
    ck = fx01.ck
    assert runs.delayed_version(ck, "2024-01-30 23:30:00", 99999) == \
        ck.where("date = '2024-01-30 23:00:00'").first()["rv"]
    assert runs.delayed_version(ck, "2024-03-01 00:00:00", 99999) == 99999


def test_feed_catalog_and_empty_delete_log(spark, fx01):
    tables = spark.createDataFrame([(0, "events"), (0, "orders"), (1, "orders")], "subscription_id bigint, table_name string")
    cat = runs.feed_catalog(fx01.subscriptions, tables)
    assert cat.count() == 3 and "name" in cat.columns
    dl = empty_delete_log(fx01.table("orders"), ["o_orderkey"], ["o_custkey"])
    assert dl.columns == ["rv", "dt", "sourcerv", "o_orderkey", "o_custkey"] and dl.count() == 0


def test_sync_feed_tables_then_routines(spark, fx01):
    root = tempfile.mkdtemp(prefix="tm-feed-")
    seen = []

    def routine(sp, window):
        seen.append((window.lo, window.hi))
        return sp.range(3)

    specs = [
        FeedSpec("customer", ["c_custkey"], source=lambda sp: fx01.table("customer").withColumn("rv", F.col("c_custkey") + 1)),
        FeedSpec("nation", ["n_nationkey"], source=lambda sp: fx01.table("nation").withColumn("rv", F.col("n_nationkey") + 1),
                 routines=[routine]),
    ]
    out = sync_feed(spark, specs, f"{root}/t", f"{root}/log", 1, current=10_000, num_buckets=4)
    assert [r.get("mode") for r in out if "mode" in r] == ["full", "full"]
    assert seen == [(0, 10_000)]


def test_baseline_run_sets_mark(spark):
    root = tempfile.mkdtemp(prefix="tm-base-")
    log = RunLog(spark, root)
    log.set_baseline(3, 12345, now="2024-01-01 00:00:00")
    r = log.runs().first()
    assert (r["rv_from"], r["rv_to"], r["success"], r["total_rows"], r["message"]) == (0, 12345, 1, -1,
                                                                                        BASELINE_MESSAGE)
    assert runs.high_water_mark(log.runs()).first()["hwm"] == 12345


def test_orderings_and_describe(spark, fx01):
    from tidemark.plans.spec import describe_columns
    t = spark.createDataFrame([("s", "b", 5), ("s", "a", None), ("r", "c", 1)],
                              "schema_name string, table_name string, initial_row_count bigint")
    assert [r["table_name"] for r in runs.ordered_tables(t).collect()] == ["a", "c", "b"]
    cols = describe_columns(fx01.table("orders"), keys=["o_orderkey"])
    assert cols[0]["column_name"] == "o_orderkey" and cols[0]["is_key"] and cols[0]["data_type"] == "bigint"


def test_sync_logs_sizes(spark, fx01):
    from tidemark.sources.tables import input_kbs
    assert input_kbs(fx01.table("orders")) > 0


def test_double_read_with_one_success(spark):
    log = spark.createDataFrame([(1, 7, 100, 1), (2, 7, 200, 0), (3, 8, 50, 0)],
                                "import_log_id bigint, subscription_id bigint, rv_to bigint, success int")
    single = dict(map(tuple, runs.high_water_mark(log).collect()))
    double = dict(map(tuple, runs.high_water_mark(log, double_read=True).collect()))
    assert single == {7: 100, 8: 0} and double == {7: 100, 8: 0}


def test_sync_feed_parallel(spark, fx01):
    root = tempfile.mkdtemp(prefix="tm-feedp-")
    specs = [FeedSpec(n, [k], source=(lambda sp, n=n, k=k: fx01.table(n).withColumn("rv", F.col(k) + 1)))
             for n, k in (("customer", "c_custkey"), ("nation", "n_nationkey"), ("supplier", "s_suppkey"))]
    out = sync_feed(spark, specs, f"{root}/t", f"{root}/log", 1, current=10_000, num_buckets=4, parallel=3)
    assert sorted(r["rows"] for r in out) == sorted([fx01.table(n).count() for n in ("customer", "nation", "supplier")])
