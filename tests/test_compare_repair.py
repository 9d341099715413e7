"""Compare → repair → re-sync → compare shows only what cannot be repaired without a delete log."""
import pytest
from pyspark.sql import functions as F

from tidemark.operators import apply as ap
from tidemark.operators import compare
from tidemark.operators.extract import extract_changes
from tidemark.plans.fixtures import COMPARE_NOW, PAIR_COLUMNS, PAIR_KEYS
from tidemark.plans.spec import VersionWindow

KEYS = list(PAIR_KEYS)


def test_repair_then_resync_clears_differences(spark, fx01):
    p, s = fx01.pair
    diff = compare.compare_tables(p, s, KEYS, list(PAIR_COLUMNS), checkpoints=fx01.ck, now=COMPARE_NOW)
    base = p.agg(F.max("rv")).first()[0]
    # the extra subscriber rows were deleted at the publisher: give them a delete log
    extra = diff.where(F.col("difference") == compare.MISSING_IN_PUBLISHER).select(
        F.lit(0).cast("bigint").alias("rv"), F.lit(None).cast("timestamp_ntz").alias("dt"),
        F.lit(0).cast("bigint").alias("sourcerv"), *KEYS)
    patched, deletes = compare.repair_from_diff(diff, p, KEYS, base, delete_log=extra)
    assert patched.count() == 149 + 144 + 138
    assert deletes.count() == 72
    p2 = ap.upsert(p, patched, KEYS)
    hi = base + patched.count() + deletes.count()
    stage = extract_changes(p2, deletes, KEYS, VersionWindow(base, hi))
    s2 = ap.apply_changes(s, stage, KEYS)
    after = compare.compare_tables(p2, s2, KEYS, list(PAIR_COLUMNS))
    assert after.count() == 0


def test_repair_loop_ends_with_equal_copies(spark):
    pub = spark.createDataFrame([(1, "a", 11), (2, "b", 12), (3, None, 13)], "k bigint, v string, rv bigint")
    sub = spark.createDataFrame([(2, "x", 5), (3, "", 6), (7, "gone", 7), (8, "unlogged", 8)], "k bigint, v string, sourcerv bigint")
    log = spark.createDataFrame([(9, None, 4, 7, "t")], "rv bigint, dt timestamp_ntz, sourcerv bigint, k bigint, v string")
    table, log2, fixed, top = compare.repair_until_equal(pub, log, sub, ["k"], 13, ["v"], at="2024-01-01 00:00:00")
    assert sorted(map(tuple, fixed.collect())) == [(1, "a", 14), (2, "b", 15), (3, "", 6)]
    assert sorted((r["rv"], r["sourcerv"], r["k"], r["v"]) for r in log2.collect()) == [(16, 4, 7, "t"), (17, 8, 8, None)]
    assert top == 17 and table.count() == 3
    with pytest.raises(RuntimeError, match="still differ"):
        compare.repair_until_equal(pub, log, sub, ["k"], 13, ["v"], rounds=0)


def test_repair_of_equal_and_empty_copies_changes_nothing(spark):
    pub = spark.createDataFrame([(1, "a", 3)], "k bigint, v string, rv bigint")
    log = spark.createDataFrame([], "rv bigint, dt timestamp_ntz, sourcerv bigint, k bigint")
    sub = pub.withColumnRenamed("rv", "sourcerv")
    assert compare.repair_until_equal(pub, log, sub, ["k"], 3)[3] == 3
    assert compare.repair_until_equal(pub.limit(0), log, sub.limit(0), ["k"], 0)[2].count() == 0


def test_compare_all_skips_only_checkpoint_copies(spark, fx01):
    p, s = fx01.pair
    out = compare.compare_all({"orders": (p, s), "DatesFromSubscription_1": (p, s), "big": (p, s)},
                              {"orders": KEYS, "big": KEYS, "DatesFromSubscription_1": KEYS})
    assert {r["table_name"] for r in out.collect()} == {"orders", "big"}


def test_compared_columns_skip_keys_versions_identity(spark):
    sub = spark.createDataFrame([(1, 2, "a", bytearray(b"x"), 5)], "k bigint, ident bigint, a string, img binary, sourcerv bigint")
    pub = spark.createDataFrame([(1, 3, "a", bytearray(b"y"), 6)], "k bigint, ident bigint, a string, img binary, rv bigint")
    assert compare.compared_columns(sub, ["k"], ["ident"]) == ["a", "img"]
    assert compare.compare_tables(pub, sub, ["k"], identity=["ident"]).first()["difference"] == "Column does not match [img]"
    assert compare.compare_tables(pub, sub, ["k"]).first()["difference"] == "Column does not match [ident]"
    assert compare.compare_tables(pub, sub, ["k"], identity=["ident", "img"]).count() == 0


def test_since_bounds_the_pair_not_each_side(spark):
    pub = spark.sql("select * from values (1, date'2024-05-01', 'a', 1L), (2, date'2023-01-01', 'b', 2L), (3, null, 'c', 3L) t(k, updated, v, rv)")
    sub = spark.sql("select * from values (1, date'2023-01-01', 'x', 1L), (2, date'2023-01-01', 'x', 2L), (3, null, 'x', 3L) t(k, updated, v, sourcerv)")
    out = compare.compare_tables(pub, sub, ["k"], ["v"], date_column="updated", since="2024-01-01")
    assert sorted((r["k"], r["difference"]) for r in out.collect()) == [(1, "Column does not match [v]"), (3, "Column does not match [v]")]
    assert compare.compare_tables(pub, sub, ["k"], ["v"], since="2024-01-01").count() == 3       # no usual date column: compared whole
