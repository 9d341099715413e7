"""Numbering, stamping, delete capture, skew-safe previous row, as-of and interval joins — against brute force."""
import random

import pandas as pd
from pyspark.sql import functions as F

from tidemark.operators.asof import asof_join, build_checkpoints, date_to_rv, range_join
from tidemark.operators.versions import capture_deletes, number_rows, previous_per_key, stamp_versions


def test_number_rows_dense_and_ordered(spark):
    df = spark.range(0, 5000, numPartitions=7).select((F.col("id") * 7919 % 5003).alias("k"))
    out = number_rows(df, ["k"], base=100).toPandas().sort_values("k")
    assert list(out["rv"]) == list(range(101, 5101))


def test_previous_per_key_hot_key_matches_brute_force(spark):
    rnd = random.Random(7)
    rows = []
    for v in range(1, 3001):
        key = 0 if v % 3 == 0 else rnd.randint(1, 40)     # key 0 holds a third of all rows
        rows.append((key, v, rnd.choice("UD")))
    df = spark.createDataFrame(rows, "k bigint, rv bigint, op string")
    got = previous_per_key(df, ["k"], "rv", ["rv", "op"], span=37, with_last=True).toPandas()
    pdf = pd.DataFrame(rows, columns=["k", "rv", "op"]).sort_values(["k", "rv"])
    pdf["prev_rv"] = pdf.groupby("k")["rv"].shift(1)
    pdf["prev_op"] = pdf.groupby("k")["op"].shift(1)
    pdf["_is_last"] = pdf.groupby("k")["rv"].transform("max") == pdf["rv"]
    got = got.sort_values(["k", "rv"]).reset_index(drop=True)
    exp = pdf.reset_index(drop=True)
    assert len(got) == len(exp)
    assert (got["prev_rv"].fillna(-1).astype(int) == exp["prev_rv"].fillna(-1).astype(int)).all()
    assert (got["prev_op"].fillna("") == exp["prev_op"].fillna("")).all()
    assert (got["_is_last"] == exp["_is_last"]).all()


def test_stamp_and_capture(spark):
    prev = spark.createDataFrame([(1, "a", 5), (2, "b", 6), (3, "c", 7)], "k bigint, a string, rv bigint")
    curr = spark.createDataFrame([(1, "a"), (2, "B"), (4, "d")], "k bigint, a string")
    stamped = sorted(map(tuple, stamp_versions(prev, curr, ["k"], base=7).collect()))
    assert stamped == [(1, "a", 5), (2, "B", 8), (4, "d", 9)]
    log = capture_deletes(prev, curr, ["k"], base=9, at="2024-01-02 03:04:05").collect()
    assert [(r["rv"], r["sourcerv"], r["k"]) for r in log] == [(10, 7, 3)]
    assert str(log[0]["dt"]) == "2024-01-02 03:04:05"


def test_asof_matches_brute_force_non_monotone(spark):
    rnd = random.Random(3)
    ck = [(rnd.randint(0, 10_000), pd.Timestamp("2024-01-01") + pd.Timedelta(minutes=rnd.randint(0, 50_000)))
          for _ in range(300)]
    pts = [rnd.randint(-100, 10_500) for _ in range(2000)] + [None]
    ck_df = spark.createDataFrame([(r, d.to_pydatetime()) for r, d in ck], "rv bigint, date timestamp_ntz")
    p_df = spark.createDataFrame([(i, v) for i, v in enumerate(pts)], "id bigint, v bigint")
    got = {r["id"]: r["d"] for r in asof_join(p_df, ck_df, "v", "rv", "date", "d").collect()}
    for i, v in enumerate(pts):
        cand = [d for r, d in ck if v is not None and r <= v]
        exp = max(cand).to_pydatetime() if cand else None
        assert got[i] == exp, (i, v)


def test_date_to_version(spark):
    ck = spark.createDataFrame([("2024-01-01 00:00:00", 10), ("2024-01-01 01:00:00", 20)],
                               "date string, rv bigint").select(F.col("date").cast("timestamp_ntz").alias("date"), "rv")
    pts = spark.createDataFrame([("2023-12-31 23:00:00",), ("2024-01-01 00:30:00",), ("2024-01-02 00:00:00",)], "t string") \
        .select(F.col("t").cast("timestamp_ntz").alias("t"))
    got = sorted((str(r["t"]), r["rv"]) for r in asof_join(pts, ck, "t", "date", "rv", "rv").collect())
    assert got == [("2023-12-31 23:00:00", None), ("2024-01-01 00:30:00", 10), ("2024-01-02 00:00:00", 20)]


def test_range_join_matches_brute_force(spark):
    rnd = random.Random(5)
    iv = []
    for i in range(200):
        a = rnd.randint(0, 9000)
        iv.append((i, a, a + rnd.randint(0, 800)))
    pts = [rnd.randint(-50, 10_000) for _ in range(1500)]
    iv_df = spark.createDataFrame(iv, "run bigint, rv_from bigint, rv_to bigint")
    p_df = spark.createDataFrame([(v,) for v in pts], "rv bigint")
    got = sorted((r["rv"], r["run"]) for r in range_join(p_df, iv_df, "rv", "rv_from", "rv_to").collect())
    exp = sorted((v, i) for v in pts for i, a, b in iv if a <= v <= b)
    assert got == exp


def test_lookups_do_not_depend_on_the_time_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:                                                  # 02:30 does not exist on that day in New York
        ck = spark.sql("select * from values (timestamp_ntz'2024-03-10 02:00:00', 10L), (timestamp_ntz'2024-03-10 03:00:00', 20L) t(date, rv)")
        at = spark.sql("select timestamp_ntz'2024-03-10 02:30:15.250' as ts, 7L as rv")
        assert date_to_rv(at.drop("rv"), ck, "ts").first()["rv"] == 10
        assert build_checkpoints(at, "ts", "rv").selectExpr("cast(date as string) d", "rv").first() == ("2024-03-10 02:00:00", 7)
        for unit, want in [("second", "2024-03-10 02:30:15"), ("minute", "2024-03-10 02:30:00"), ("day", "2024-03-10 00:00:00"), ("month", "2024-03-01 00:00:00")]:
            assert build_checkpoints(at, "ts", "rv", unit).selectExpr("cast(date as string) d").first()["d"] == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_asof_with_one_far_key_and_a_hot_one(spark):
    n = 60_000
    ck = spark.range(n).selectExpr("case when id = 0 then 1000000000000 else id * 2 end as rv", "id as val")
    pts = spark.range(n).selectExpr("case when id % 3 = 0 then 777 else id * 2 + 1 end as v")
    for limit in (10, 2_000_000):                         # shuffled, broadcast
        got = asof_join(pts, ck, "v", "rv", "val", "d", broadcast_rows=limit)
        bad = got.where("not (d <=> case when v < 2 then null else v div 2 end)")
        assert got.count() == n and bad.count() == 0
