"""Bucketed target store, batch sync runs and the Structured Streaming sync (incl. restart from checkpoint)."""
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tidemark.operators.extract import extract_changes, extract_snapshot
from tidemark.plans.fixtures import FEED_KEYS
from tidemark.plans.spec import VersionWindow
from tidemark.plans.sync import sync_table
from tidemark.sources.bucketed import BucketedTable
from tidemark.sources.runlog import RunLog
from tidemark.streaming.sync import _source_at, publish_window, sync_stream

K = list(FEED_KEYS)


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_apply_rewrites_only_touched_buckets(spark):
    root = tempfile.mkdtemp(prefix="tm-bucket-")
    t = BucketedTable(spark, root, ["k"], num_buckets=8)
    base = spark.range(0, 1000).select(F.col("id").alias("k"), F.lit("a").alias("a"), F.col("id").alias("sourcerv"))
    t.write_full(base)
    before = t.manifest()
    stage = spark.createDataFrame([("U", 5, "b", 2000), ("D", 6, None, 2001)],
                                  "rpl_operation string, k bigint, a string, sourcerv bigint")
    stats = t.apply(stage)
    after = t.manifest()
    assert stats["touched"] <= 2
    changed = [b for b in before["buckets"] if after["buckets"].get(b) != before["buckets"][b]]
    assert 1 <= len(changed) <= 2
    rows = {r["k"]: r["a"] for r in t.read().collect()}
    assert rows[5] == "b" and 6 not in rows and len(rows) == 999
    # the previous version is still readable
    assert t.read(version=before["version"]).count() == 1000


def test_sync_table_runs_and_log(spark, fx01):
    root = tempfile.mkdtemp(prefix="tm-sync-")
    target = BucketedTable(spark, f"{root}/t", K, num_buckets=8)
    log = RunLog(spark, f"{root}/log")
    for v in (4000, 7000, fx01.hi):
        src, dels = _source_at(fx01, v)
        sync_table(spark, "feed", K, src, dels, target, log, 1, f"{root}/stage", current=v)
    assert _same(target.read(), fx01.src.withColumnRenamed("rv", "sourcerv"))
    runs = log.runs().orderBy("import_log_id").collect()
    assert [(r["rv_from"], r["rv_to"], r["success"]) for r in runs] == [(0, 4000, 1), (4000, 7000, 1), (7000, fx01.hi, 1)]
    assert runs[0]["use_stage"] is False and runs[1]["use_stage"] is True
    assert all(r["total_rows"] > 0 for r in runs)
    # nothing new: an empty window is a successful no-op run
    src, dels = _source_at(fx01, fx01.hi)
    out = sync_table(spark, "feed", K, src, dels, target, log, 1, f"{root}/stage", current=fx01.hi)
    assert out["rows"] == 0


def test_failed_run_is_retried(spark, fx01):
    root = tempfile.mkdtemp(prefix="tm-fail-")
    target = BucketedTable(spark, f"{root}/t", K, num_buckets=4)
    log = RunLog(spark, f"{root}/log")
    src, dels = _source_at(fx01, 5000)
    sync_table(spark, "feed", K, src, dels, target, log, 1, f"{root}/stage", current=5000)
    src2, dels2 = _source_at(fx01, fx01.hi)
    try:   # a source whose key no longer has the target's type makes the apply fail
        sync_table(spark, "feed", K, src2.withColumn("slot", F.lit("x")), dels2, target, log, 1, f"{root}/stage",
                   current=fx01.hi)
    except Exception:
        pass
    runs = log.runs().orderBy("import_log_id").collect()
    assert runs[-1]["success"] == 0
    out = sync_table(spark, "feed", K, src2, dels2, target, log, 1, f"{root}/stage", current=fx01.hi)
    assert out["rv_from"] == 5000
    assert _same(target.read(), fx01.src.withColumnRenamed("rv", "sourcerv"))


def test_stream_restart_from_checkpoint(spark, fx01):
    root = tempfile.mkdtemp(prefix="tm-stream-")
    changes, ckpt = f"{root}/changes", f"{root}/ckpt"
    ends = [3000, 6000, 8000, fx01.hi]
    schema = None
    target = BucketedTable(spark, f"{root}/t", K, num_buckets=8)

    def publish(lo, hi):
        src, dels = _source_at(fx01, hi)
        w = VersionWindow(lo, hi)
        ch = extract_snapshot(src, w) if w.is_snapshot else extract_changes(src, dels, K, w)
        publish_window(ch, changes)
        return ch.schema

    schema = publish(0, ends[0])
    schema = publish(ends[0], ends[1]) or schema
    target.write_full(spark.createDataFrame([], "user_id bigint, slot bigint, event_type string, value double, sourcerv bigint"))
    sync_stream(spark, changes, schema, target, ckpt, K, max_files_per_trigger=3).awaitTermination()
    mid, _ = _source_at(fx01, ends[1])
    assert _same(target.read(), mid.withColumnRenamed("rv", "sourcerv"))
    publish(ends[1], ends[2])
    publish(ends[2], ends[3])
    sync_stream(spark, changes, schema, target, ckpt, K).awaitTermination()     # restart: only new files
    assert _same(target.read(), fx01.src.withColumnRenamed("rv", "sourcerv"))


def test_changelog_window_prunes_blocks(spark, fx01):
    from tidemark.sources.changelog import ChangeLog
    root = tempfile.mkdtemp(prefix="tm-clog-")
    log = ChangeLog(spark, root, K, block=1000)
    rec = fx01.chg.select(F.col("op").alias("rpl_operation"), *K, "event_type", "value", F.col("rv").alias("sourcerv"))
    log.append(rec)
    w = log.window(VersionWindow(8000, 9000), collapse=False)
    plan = w._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(rv_block" in plan
    files = set(w.select(F.input_file_name()).distinct().collect())
    assert len(files) <= 3                          # blocks 8 and 9 only, out of 11
    assert w.count() == rec.where("sourcerv > 8000 AND sourcerv <= 9000").count()


def test_bucket_apply_plans_agree(spark, fx01):
    outs = []
    for strategy in ("broadcast", "shuffle"):
        root = tempfile.mkdtemp(prefix=f"tm-{strategy}-")
        t = BucketedTable(spark, root, K, num_buckets=8)
        t.write_full(fx01.tgt)
        t.apply(fx01.stg, strategy=strategy)
        outs.append(t.read())
    assert _same(outs[0], outs[1])
    assert _same(outs[1], fx01.src.withColumnRenamed("rv", "sourcerv"))
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"


def test_sync_table_double_read(spark, fx01):
    root = tempfile.mkdtemp(prefix="tm-dbl-")
    target = BucketedTable(spark, f"{root}/t", K, num_buckets=4)
    log = RunLog(spark, f"{root}/log")
    ends = [3000, 6000, 8000, fx01.hi]
    for v in ends:
        src, dels = _source_at(fx01, v)
        sync_table(spark, "feed", K, src, dels, target, log, 1, f"{root}/stage", current=v, double_read=True)
    runs = [(r["rv_from"], r["rv_to"]) for r in log.runs().orderBy("import_log_id").collect()]
    assert runs == [(0, 3000), (3000, 6000), (3000, 8000), (6000, fx01.hi)]
    assert _same(target.read(), fx01.src.withColumnRenamed("rv", "sourcerv"))


def test_sync_with_compressed_column(spark, fx01):
    root = tempfile.mkdtemp(prefix="tm-gz-")
    target = BucketedTable(spark, f"{root}/t", K, num_buckets=4)
    log = RunLog(spark, f"{root}/log")
    for v in (5000, fx01.hi):
        src, dels = _source_at(fx01, v)
        sync_table(spark, "feed", K, src, dels, target, log, 1, f"{root}/stage", current=v, compress=["event_type"])
    staged = spark.read.parquet(f"{root}/stage/run=2/feed")
    assert dict(staged.dtypes)["event_type"] == "binary"
    assert _same(target.read(), fx01.src.withColumnRenamed("rv", "sourcerv"))


def test_sync_logs_sizes(spark, fx01):
    root = tempfile.mkdtemp(prefix="tm-kb-")
    target = BucketedTable(spark, f"{root}/t", K, num_buckets=4)
    log = RunLog(spark, f"{root}/log")
    for v in (5000, fx01.hi):
        src, dels = _source_at(fx01, v)
        sync_table(spark, "feed", K, src, dels, target, log, 1, f"{root}/stage", current=v)
    kbs = [r["total_kbs"] for r in log.runs().orderBy("import_log_id").collect()]
    assert len(kbs) == 2 and all(k is not None and k > 0 for k in kbs)


def test_replayed_batches_change_nothing(spark, fx01):
    root = tempfile.mkdtemp(prefix="tm-replay-")
    changes = f"{root}/changes"
    prev, schema = 0, None
    for v in (4000, fx01.hi):
        src, dels = _source_at(fx01, v)
        w = VersionWindow(prev, v)
        ch = extract_snapshot(src, w) if w.is_snapshot else extract_changes(src, dels, K, w)
        schema = schema or ch.schema
        publish_window(ch, changes)
        prev = v
    target = BucketedTable(spark, f"{root}/t", K, num_buckets=4)
    target.write_full(spark.createDataFrame([], "user_id bigint, slot bigint, event_type string, value double, sourcerv bigint"))
    sync_stream(spark, changes, schema, target, f"{root}/ck1", K).awaitTermination()
    first = target.read()
    assert _same(first, fx01.src.withColumnRenamed("rv", "sourcerv"))
    # a fresh checkpoint re-delivers every file: the guarded apply leaves the target as it was
    sync_stream(spark, changes, schema, target, f"{root}/ck2", K).awaitTermination()
    assert _same(target.read(), fx01.src.withColumnRenamed("rv", "sourcerv"))


def test_rows_of_a_crashed_attempt_never_return(spark, tmp_path):
    """Rows written before a crash, whose manifest never appeared, are not read by the attempt that follows."""
    from tidemark.sources.bucketed import BucketedTable
    table = BucketedTable(spark, str(tmp_path / "t"), ["id"], num_buckets=4, version_col="rv")
    rows = spark.createDataFrame([(i, 1) for i in range(20)], "id long, rv long")
    publish, table._publish = table._publish, lambda *a: (_ for _ in ()).throw(OSError("crash"))
    with pytest.raises(OSError):
        table.write_full(rows)
    table._publish = publish
    table.write_full(rows.filter("id < 3"))
    assert sorted(r["id"] for r in table.read().collect()) == [0, 1, 2]
