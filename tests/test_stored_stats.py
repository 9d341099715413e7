"""Statistics from the files of stored tables, the detail collected at the close of a run, and the open-run report."""
import glob
import os

from pyspark.sql import functions as F

from tidemark.operators.runs import status_detail
from tidemark.plans.feeds import run_subscription
from tidemark.plans.spec import FeedSpec
from tidemark.session import scratch_path
from tidemark.sources.bucketed import BucketedTable
from tidemark.sources.runlog import RunLog
from tidemark.sources.stats import feed_stats, stage_path, stored_stats


def _kbs(*folders):
    files = [f for d in folders for f in glob.glob(f"{d}/**/*.parquet", recursive=True)]
    return -(-sum(map(os.path.getsize, files)) // 1024)


def _stats(df):
    return {r["table_name"]: (r["total_rows"], r["total_kbs"]) for r in df.collect()}


def test_rows_and_kb_of_files(spark):
    root = scratch_path(spark, "stats")
    spark.range(1000).withColumn("t", F.sha2(F.col("id").cast("string"), 256)).repartition(3).write.parquet(f"{root}/a")
    spark.range(10).withColumn("p", F.col("id") % 2).write.partitionBy("p").parquet(f"{root}/b")
    spark.range(0).write.parquet(f"{root}/empty")
    found = stored_stats(spark, {"a": spark.read.parquet(f"{root}/a"), "b": spark.read.parquet(f"{root}/b"),
                                 "empty": spark.read.parquet(f"{root}/empty"), "none": None})
    assert _stats(found) == {"a": (1000, _kbs(f"{root}/a")), "b": (10, _kbs(f"{root}/b")), "empty": (0, 0), "none": (0, 0)}
    assert stored_stats(spark, {}).count() == 0


def test_a_file_of_many_tasks_counts_once(spark):
    root = scratch_path(spark, "stats-split")
    spark.range(0, 300_000, 1, 1).withColumn("t", F.sha2(F.col("id").cast("string"), 256)).write.option("parquet.block.size", 1 << 20).parquet(f"{root}/a")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 20))
    try:
        df = spark.read.parquet(f"{root}/a")
        assert df.rdd.getNumPartitions() > 3
        assert _stats(stored_stats(spark, {"a": df})) == {"a": (300_000, _kbs(f"{root}/a"))}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_no_column_is_read(spark, capsys):
    root = scratch_path(spark, "stats-plan")
    spark.range(5).withColumn("t", F.lit("x")).write.parquet(f"{root}/a")
    stored_stats(spark, {"a": spark.read.parquet(f"{root}/a")}).explain("formatted")
    said = capsys.readouterr().out
    assert "ReadSchema: struct<>" in said


def test_detail_is_collected_at_the_close(spark):
    root = scratch_path(spark, "close")
    rows = {"n": 40}
    source = lambda s: s.range(rows["n"]).select(F.col("id").alias("k"), (F.col("id") + 1).alias("rv"))

    def report(s, window):
        return s.range(3)

    specs = [FeedSpec("a", ["k"], source), FeedSpec("b", ["k"], source, routines=[report])]
    log = RunLog(spark, f"{root}/log")
    run_subscription(spark, specs, f"{root}/t", log, 1, num_buckets=2)
    rows["n"] = 45
    specs[1].initialize = True                               # b is loaded anew, a goes through its stage
    second = run_subscription(spark, specs, f"{root}/t", log, 1, num_buckets=2)
    detail = {r["table_name"]: (r["total_rows"], r["total_kbs"], r["is_stage"]) for r in log.detail().where("import_log_id = 2").collect()}
    manifest = BucketedTable(spark, f"{root}/t/b", ["k"]).manifest()
    folders = {f"{root}/t/b/{f}" for f in manifest["buckets"].values()}
    assert detail["stg_a"] == (5, _kbs(stage_path(f"{root}/t", 2, "a")), True)
    assert detail["b"][::2] == (45, False) and detail["report"] == (3, None, False) and len(detail) == 3
    assert detail["b"][1] == _kbs(*folders)
    assert second["total_rows"] == 53
    assert _stats(feed_stats(spark, ["a", "b", "c"], f"{root}/t", False)).keys() == {"a", "b"}
    assert _stats(feed_stats(spark, ["a", "b"], f"{root}/t", True, 2)).keys() == {"stg_a"}


def test_collected_detail_replaces_what_was_logged(spark):
    log = RunLog(spark, f"{scratch_path(spark, 'recollect')}/log")
    run = log.start_run(1, 0, 10)
    for name, n in (("old", 4), ("t", 1), ("routine", 7)):
        log.log_table(run, name, n)
    other = log.start_run(2, 0, 10)
    log.log_table(other, "old", 9)
    log.recollect(run, spark.createDataFrame([("t", 5, 2, False)], "table_name string, total_rows bigint, total_kbs bigint, is_stage boolean"), ["routine"])
    assert sorted((r["import_log_id"], r["table_name"], r["total_rows"]) for r in log.detail().collect()) == [(1, "routine", 7), (1, "t", 5), (2, "old", 9)]
    assert log.end_run(run, True) == 12
    assert log.runs().where("import_log_id = 1").first()["total_kbs"] == 2


def test_status_of_open_and_ended_runs(spark):
    log = spark.createDataFrame([(1, 1, "2024-01-01"), (2, 1, None), (3, 2, "2024-01-01"), (4, 3, None)], "import_log_id bigint, subscription_id bigint, end_date string")
    detail = spark.createDataFrame([(1, "a", 5), (2, "a", 1), (3, "b", 6)], "import_log_id bigint, table_name string, total_rows bigint")
    measured = spark.createDataFrame([(1, "stg_a", 2), (2, "b", 60)], "subscription_id bigint, table_name string, total_rows bigint")
    got = sorted(map(tuple, status_detail(log, detail, measured).collect()))
    assert got == [(1, 2, True, "stg_a", 2), (2, 3, False, "b", 6)]
