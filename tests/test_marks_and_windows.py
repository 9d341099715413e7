"""Marks of closed windows, tombstones, window counts, tracing, key judgement and one run per subscription."""
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import apply as ap
from tidemark.operators.asof import range_join, trace, window_counts
from tidemark.operators.runs import closed_windows, contiguous_marks
from tidemark.operators.versions import publish_changes
from tidemark.plans.feeds import run_subscription
from tidemark.plans.publish import publish_snapshot
from tidemark.plans.spec import FeedSpec, choose_key, judge_keys, require_key
from tidemark.session import scratch_path
from tidemark.sources.runlog import RunLog


def marks(spark, windows, base=0):
    rows = spark.createDataFrame([(1, a, b) for a, b in windows], "subscription_id bigint, rv_from bigint, rv_to bigint")
    return [(r["mark"], r["waiting"]) for r in contiguous_marks(rows, base).collect()]


def test_a_mark_stops_at_the_first_gap(spark):
    assert marks(spark, [(0, 5000), (8000, 9000)]) == [(5000, 1)]                      # 9000 came before 7000
    assert marks(spark, [(0, 5000), (8000, 9000), (5000, 8000)]) == [(9000, 0)]
    assert marks(spark, [(0, 10), (5, 20), (3, 4), (21, 30)]) == [(20, 1)]             # overlaps, one inside another
    assert marks(spark, [(5, 10)]) == [(0, 1)] and marks(spark, [(5, 10)], base=7) == [(10, 0)]
    assert marks(spark, []) == []
    rng = random.Random(4)
    for _ in range(5):
        windows = [(a, a + rng.randint(1, 6)) for a in rng.sample(range(40), 12)]
        at, grew = 0, True
        while grew:
            further = max([b for a, b in windows if a <= at] + [at])
            grew, at = further > at, further
        assert marks(spark, windows)[0][0] == at


def test_a_window_is_closed_by_all_its_rows(spark):
    published = spark.createDataFrame([(1, 0, 10, 5), (1, 10, 20, 3), (1, 20, 30, 0)], "subscription_id bigint, rv_from bigint, rv_to bigint, rows bigint")
    received = spark.createDataFrame([(10, 0, 2), (10, 1, 3), (20, 1, 2), (20, 1, 2)], "rv_to bigint, batch bigint, rows bigint")
    assert sorted(r["rv_to"] for r in closed_windows(published, received).collect()) == [10, 30]


def test_late_inserts_stay_deleted(spark):
    rng = random.Random(7)
    schema = "rpl_operation string, k int, v string, sourcerv bigint"
    log = [(rng.choice("UUD"), rng.randint(0, 15), f"v{i}", i) for i in range(1, 121)]
    windows = [log[i:i + 20] for i in range(0, 120, 20)]

    def collapsed(rows):
        last = {}
        for r in rows:
            last[r[1]] = r if r[0] == "U" else (r[0], r[1], None, r[3])
        return spark.createDataFrame(list(last.values()), schema)

    want = {k: v for k, (op, v) in {r[1]: (r[0], r[2]) for r in log}.items() if op == "U"}
    for order in ([0, 2, 1, 5, 3, 4], [5, 4, 3, 2, 1, 0]):
        target = spark.createDataFrame([], "k int, v string, sourcerv bigint")
        gone, done = None, set()
        for w in order:
            stage = collapsed(windows[w])
            stage = (stage if gone is None else ap.without_stale(stage, gone, ["k"])).checkpoint()
            target = ap.apply_changes(target, stage, ["k"], guard="newer").checkpoint()
            done.add(w)
            horizon = 20 * next(i for i in range(7) if i not in done)
            gone = ap.next_tombstones(gone, stage, ["k"], horizon).checkpoint()
        assert {r["k"]: r["v"] for r in target.collect()} == want
        assert gone.count() == 0                             # all windows have arrived


def test_window_counts_both_ways(spark):
    rng = random.Random(2)
    versions = [rng.randint(1, 500) for _ in range(800)] + [None]
    windows = [(i, *sorted(rng.sample(range(0, 520), 2))) for i in range(60)] + [(98, 7, 7), (99, 9, 3)]
    changes = spark.createDataFrame([(v,) for v in versions], "rv bigint")
    frame = spark.createDataFrame(windows, "run int, rv_from bigint, rv_to bigint")
    want = {i: sum(1 for v in versions if v and a < v <= b) for i, a, b in windows}
    for limit in (1 << 14, 3):
        assert {r["run"]: r["total_rows"] for r in window_counts(changes, frame, max_bounds=limit).collect()} == want
    assert {r["total_rows"] for r in window_counts(changes.limit(0), frame).collect()} == {0}
    assert window_counts(changes, frame.limit(0)).count() == 0


def test_intervals_by_subscription(spark):
    rng = random.Random(3)
    runs = [(i, i % 3, a, a + rng.randint(0, 40)) for i, a in enumerate(rng.choices(range(1000), k=200))] + [(900, 1, 0, 10 ** 12), (901, 0, None, 5)]
    points = [(rng.randint(-5, 1050), s, "t") for s in range(3) for _ in range(50)] + [(10 ** 11, 1, "t"), (None, 1, "t")]
    r = spark.createDataFrame(runs, "run int, subscription_id int, rv_from bigint, rv_to bigint")
    p = spark.createDataFrame(points, "rv bigint, subscription_id int, table_name string")
    got = sorted((x["rv"], x["subscription_id"], x["run"]) for x in range_join(p, r, "rv", "rv_from", "rv_to", on=["subscription_id"]).collect())
    assert got == sorted((v, s, i) for v, s, _ in points for i, t, a, b in runs if s == t and None not in (v, a) and a <= v <= b)
    one = trace(spark.createDataFrame([(260, 1, "orders")], "rv bigint, subscription_id bigint, table_name string"),
                spark.createDataFrame([(4, 1, 255, 300), (5, 2, 0, 999), (6, 1, 260, 300)], "import_log_id bigint, subscription_id bigint, rv_from bigint, rv_to bigint")).collect()
    assert [(x["import_log_id"], x["replay"]) for x in one] == [(4, "sync 1 orders 0x00000000000000FF 0x000000000000012C")]


def test_keys_are_judged_and_enforced(spark):
    rows = spark.createDataFrame([(1, 1, "a"), (2, 1, "b"), (3, 2, None), (4, 2, "b")], "a int, b int, c string")
    judged = judge_keys(rows, {1: ["b"], 2: ["c"], 3: ["a"], 4: ["b", "a"]}, "t")
    assert {r["rank"]: (r["duplicate_keys"], r["null_key_rows"]) for r in judged.collect()} == {1: (2, 0), 2: (1, 1), 3: (0, 0), 4: (0, 0)}
    assert [r["key_columns"] for r in choose_key(judged).collect()] == ["a"]
    require_key(rows, ["a"])
    for bad in (["b"], ["c"]):
        with pytest.raises(ValueError):
            publish_snapshot(None, rows, bad)


def test_one_pass_publish(spark):
    prev = spark.createDataFrame([(1, "a", 5), (2, "b", 6), (3, None, 7), (4, "d", 8)], "k int, v string, rv bigint")
    curr = spark.createDataFrame([(5, "n"), (2, "B"), (3, None), (1, "a")], "k int, v string")
    table, deletes = publish_changes(prev, curr, ["k"], 100, "2024-01-01 00:00:00", track=["v"])
    assert sorted(map(tuple, table.collect())) == [(1, "a", 5), (2, "B", 101), (3, None, 7), (5, "n", 102)]
    assert [(r["rv"], r["sourcerv"], r["k"], r["v"]) for r in deletes.collect()] == [(103, 8, 4, "d")]
    assert publish_snapshot(prev, curr, ["k"])[2] == 11


def test_one_run_for_all_tables(spark):
    root = scratch_path(spark, "subscription")
    rows = {"n": 4}
    source = lambda s: s.range(rows["n"]).select(F.col("id").alias("k"), (F.col("id") + 1).alias("rv"))
    seen = []

    def late(s, window):
        seen.append(("late", window.lo, window.hi))

    def early(s, window):
        seen.append(("early", window.lo, window.hi))
        return s.range(2)

    specs = [FeedSpec("a", ["k"], source, initialize=True, routines=[late], routine_order=2), FeedSpec("b", ["k"], source, routines=[early], routine_order=1)]
    log = RunLog(spark, f"{root}/log")
    first = run_subscription(spark, specs, f"{root}/t", log, 7, num_buckets=2)
    assert (first["rv_from"], first["rv_to"], first["total_rows"]) == (0, 4, 10) and not specs[0].initialize
    rows["n"] = 6
    second = run_subscription(spark, specs, f"{root}/t", log, 7, num_buckets=2)
    assert (second["run_id"], second["rv_from"], second["rv_to"], second["total_rows"]) == (2, 4, 6, 6)
    assert seen == [("early", 0, 4), ("late", 0, 4), ("early", 4, 6), ("late", 4, 6)]
    detail = {(r["import_log_id"], r["table_name"]): (r["total_rows"], r["is_stage"]) for r in log.detail().collect()}
    assert detail[(1, "a")] == (4, False) and detail[(2, "stg_a")] == (2, True) and detail[(2, "early")] == (2, False)

    def broken(s):
        raise RuntimeError("gone")

    rows["n"] = 8
    specs[0].initialize = True
    specs[1].routines = [lambda s, w: broken(s)]
    with pytest.raises(RuntimeError):
        run_subscription(spark, specs, f"{root}/t", log, 7, num_buckets=2)
    assert specs[0].initialize                               # flags stay, and the next run covers the window again
    specs[1].routines = []
    again = run_subscription(spark, specs, f"{root}/t", log, 7, num_buckets=2)
    assert (again["rv_from"], again["rv_to"]) == (6, 8) and not specs[0].initialize
