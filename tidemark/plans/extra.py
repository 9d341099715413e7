"""Registered query for column compression: gzip every document text and back, in Arrow batches."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.compress import gunzip_text, gzip_text
from ..sources.tables import read_table


def compress_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents").select("doc_id", "n_chars", "text")
    packed = d.withColumn("_z", gzip_text(F.col("text")))
    back = packed.withColumn("_t", gunzip_text(F.col("_z")))
    return back.select("doc_id", "n_chars", F.length("text").cast("bigint").alias("text_len"),
                       F.coalesce(F.col("_t") == F.col("text"), F.col("text").isNull() & F.col("_t").isNull())
                       .alias("roundtrip_ok"))
