"""Plan properties the scale design relies on."""
import tempfile

from tidemark.operators.extract import extract_changes
from tidemark.operators.versions import feed_from_log, segment_span
from tidemark.plans.fixtures import FEED_KEYS
from tidemark.plans.spec import VersionWindow

K = list(FEED_KEYS)


def test_window_bounds_reach_the_scan(spark, fx01):
    root = tempfile.mkdtemp(prefix="tm-plan-")
    fx01.src.write.parquet(f"{root}/src")
    fx01.del_log.write.parquet(f"{root}/del")
    src, dels = spark.read.parquet(f"{root}/src"), spark.read.parquet(f"{root}/del")
    df = extract_changes(src, dels, K, VersionWindow(6000, 10000))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PushedFilters: [IsNotNull(rv), GreaterThan(rv,6000), LessThanOrEqual(rv,10000)]") == 2
    assert "WindowGroupLimit" in plan


def test_segmented_pass_reuses_its_exchange(spark, fx01):
    _, dels = feed_from_log(fx01.chg, K, ["event_type", "value"], "rv", "op", "ts", segment_span(0, fx01.hi))
    dels.collect()
    final = dels._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in final
