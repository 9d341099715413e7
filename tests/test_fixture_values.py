"""Expected values at sf0.01 (FIXTURES.md §4), computed by the library's own operators."""
from pyspark.sql import functions as F

from tidemark.operators import apply as ap
from tidemark.operators import compare, runs
from tidemark.operators.extract import extract_changes
from tidemark.plans.fixtures import DUE_AT, FEED_KEYS, PAIR_COLUMNS, PAIR_KEYS
from tidemark.plans.spec import VersionWindow

K = list(FEED_KEYS)


def test_feed_counts(fx01):
    assert fx01.src.count() == 850
    assert fx01.del_log.count() == 1452


def test_window_stage(fx01):
    raw = extract_changes(fx01.src, fx01.del_log, K, fx01.window, collapse=False)
    assert raw.count() == 1466
    ops = dict(fx01.stg.groupBy("rpl_operation").count().collect())
    assert ops == {"U": 833, "D": 192}


def test_apply_converges(fx01):
    assert fx01.tgt.count() == 828
    out = ap.apply_changes(fx01.tgt, fx01.stg, K)
    src = fx01.src.withColumnRenamed("rv", "sourcerv")
    assert out.count() == 850
    assert out.exceptAll(src).count() == 0 and src.exceptAll(out).count() == 0


def test_replay_old_window_emits_live_deletes(fx01):
    old = extract_changes(fx01.src, fx01.del_log, K, VersionWindow(3000, 6000))
    live = old.where("rpl_operation = 'D'").join(fx01.src.select(*K), K, "left_semi")
    assert live.count() == 329


def test_checkpoints_and_runs(fx01):
    assert fx01.ck.count() == 720
    log = fx01.import_log
    done = log.where(F.col("end_date").isNotNull())
    assert done.where("success = 1").count() == 613
    assert done.where("success = 0").count() == 102
    assert log.where(F.col("end_date").isNull()).count() == 5


def test_high_water_marks(fx01):
    single = dict((r[0], r[1]) for r in runs.high_water_mark(fx01.import_log).collect())
    double = dict((r[0], r[1]) for r in runs.high_water_mark(fx01.import_log, double_read=True).collect())
    assert single == {0: 9916, 1: 9858, 2: 9873, 3: 9893, 4: 9826}
    assert double == {0: 9845, 1: 9797, 2: 9747, 3: 9815, 4: 9773}


def test_due_feeds(fx01):
    due = sorted(r[0] for r in runs.due_feeds(fx01.subscriptions, fx01.import_log, DUE_AT).collect())
    assert due == [0, 9]


def _counts(df):
    return dict(df.groupBy("difference").count().collect())


def test_compare_default_and_strict(fx01):
    p, s = fx01.pair
    summ = dict(compare.compare_summary(p, s, list(PAIR_KEYS), list(PAIR_COLUMNS)).collect())
    assert summ == {"Missing in Subscriber": 149, "Missing in Publisher": 72,
                    "Column does not match [o_orderstatus]": 144, "Column does not match [o_totalprice]": 138,
                    "Matched": 14569}
    strict = dict(compare.compare_summary(p, s, list(PAIR_KEYS), list(PAIR_COLUMNS), nulls="strict").collect())
    assert strict["Column does not match [o_orderpriority]"] == 134
    assert strict["Matched"] == 14435
