import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions import (fill_type_defaults, format_duration, format_version, hex_to_rv, minute_boundaries,
                                parse_version, rv_to_hex)
from tidemark.functions.compress import compress_columns, decompress_columns
from tidemark.plans.spec import VersionWindow, feed_schema, validate_key


def test_format_duration(spark):
    df = spark.createDataFrame([(3725.25, "second"), (1.5, "hh"), (2.0, "mi"), (7.0, "fortnight"), (59.9996, "s")],
                               "t double, u string")
    got = [r[0] for r in df.select(format_duration(F.col("t"), F.col("u"))).collect()]
    assert got == ["1:02:05.250", "1:30:00.000", "0:02:00.000", "0:00:00.000", "0:01:00.000"]


def test_version_text(spark):
    assert parse_version("0x", 7) == 0 and parse_version(None, 7) == 7 and parse_version("", 9) == 9
    assert parse_version("0x00000000000000FF", 0) == 255
    assert parse_version("0x9999999999999999", 0) == (1 << 63) - 1
    assert format_version(255) == "0x00000000000000FF" and format_version(0) == "0x"
    r = spark.createDataFrame([(255,), (0,)], "v bigint").select(rv_to_hex("v").alias("h")).select("h", hex_to_rv("h").alias("v")).collect()
    assert [(x["h"], x["v"]) for x in r] == [("0x00000000000000FF", 255), ("0x0000000000000000", 0)]
    w = VersionWindow.of("0x", "")
    assert w.is_snapshot and w.hi == (1 << 63) - 1


def test_fill_type_defaults(spark):
    df = spark.createDataFrame([(None, None, None, None, None)],
                               "s string, i int, d double, t timestamp_ntz, b boolean")
    r = fill_type_defaults(df).first()
    assert (r["s"], r["i"], r["d"], r["t"], r["b"]) == ("", 0, 0.0, dt.datetime(1999, 1, 1), False)


def test_minute_boundaries(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:59", "2024-01-01 00:01:01")], "a string, b string") \
        .select(F.col("a").cast("timestamp_ntz").alias("a"), F.col("b").cast("timestamp_ntz").alias("b"))
    assert df.select(minute_boundaries("a", "b")).first()[0] == 1


def test_compress_roundtrip(spark):
    df = spark.createDataFrame([(1, "héllo " * 100), (2, None)], "id bigint, text string")
    z = compress_columns(df, ["text"])
    assert dict(z.dtypes)["text"] == "binary"
    assert sorted(map(tuple, decompress_columns(z, ["text"]).collect())) == sorted(map(tuple, df.collect()))


def test_feed_schema_and_key_checks(spark, fx01):
    sch = feed_schema(fx01.src, ["user_id", "slot"])
    assert sch.fieldNames() == ["rpl_operation", "user_id", "slot", "event_type", "value", "sourcerv"]
    bad = validate_key(fx01.table("lineitem"), ["l_orderkey", "l_linenumber"], "lineitem").first()
    assert not bad["is_valid"] and bad["distinct_keys"] == 45832
    good = validate_key(fx01.table("orders"), ["o_orderkey"], "orders").first()
    assert good["is_valid"]


def test_default_overrides(spark):
    from tidemark.functions.defaults import DEFAULT_GUID
    from tidemark.operators.compare import compare_tables
    df = spark.createDataFrame([(1, None)], "k bigint, g string")
    assert fill_type_defaults(df, overrides={"g": DEFAULT_GUID}).first()["g"] == DEFAULT_GUID
    pub = spark.createDataFrame([(1, None, 1)], "k bigint, g string, rv bigint")
    sub = spark.createDataFrame([(1, DEFAULT_GUID, 1)], "k bigint, g string, sourcerv bigint")
    assert compare_tables(pub, sub, ["k"]).count() == 1
    assert compare_tables(pub, sub, ["k"], defaults={"g": DEFAULT_GUID}).count() == 0
