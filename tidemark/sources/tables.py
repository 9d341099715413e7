"""Reading the input tables: one parquet dataset per table name."""
from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    for n in names:
        if os.path.exists(table_path(sf_dir, n)):
            read_table(spark, sf_dir, n).createOrReplaceTempView(n)


def input_kbs(df: DataFrame) -> int:
    """Size on storage of the files behind ``df`` in KB (file lengths from the Hadoop file system; the driver sees
    one length per file, never rows)."""
    from .fs import file_length
    total = sum(file_length(df.sparkSession, f) for f in df.inputFiles())
    return (total + 1023) // 1024
