"""Row counts and sizes of stored tables, from what their files say about themselves."""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bucketed import BucketedTable
from .fs import HadoopFs

STATS_SCHEMA = "table_name string, total_rows bigint, total_kbs bigint"


def stage_path(target_root: str, run_id: int, name: str) -> str:
    """The folder that a run stages a table's changes in."""
    return f"{target_root.rstrip('/')}/_stage/run={run_id}/{name}"


def stored_stats(spark: SparkSession, tables: Mapping[str, DataFrame | None]) -> DataFrame:
    """(table_name, total_rows, total_kbs) of tables read from Parquet files.

    Only the files' own metadata columns are selected: the rows are the row counts of the Parquet footers, no column
    is decoded, and one row a file (of a task) is shuffled.  Rows and sizes come from the same pass.  Files without
    rows add nothing, KB are rounded up, and a table that is not stored (None) has 0 of both.
    """
    parts = [spark.createDataFrame([(n, 0, 0) for n, df in tables.items() if df is None], STATS_SCHEMA)]
    for name, df in tables.items():
        if df is None:
            continue
        files = (df.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"))
                 .groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.max("bytes").alias("bytes")))
        total = files.agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"))
        parts.append(total.select(F.lit(name).alias("table_name"), F.coalesce("n", F.lit(0)).cast("bigint").alias("total_rows"),
                                  F.ceil(F.coalesce("bytes", F.lit(0)) / 1024).cast("bigint").alias("total_kbs")))
    return reduce(DataFrame.unionByName, parts)


def feed_stats(spark: SparkSession, names: Sequence[str], target_root: str, use_stage: bool, run_id: int | None = None) -> DataFrame:
    """``stored_stats`` of a subscription's tables: of what run ``run_id`` staged, or of the target tables.

    Tables are named ``stg_<name>`` when the stage is measured.  A table that the run did not stage, or that has no
    target yet, has no row.
    """
    if use_stage:
        folders = {n: stage_path(target_root, run_id, n) for n in names}
        return stored_stats(spark, {f"stg_{n}": spark.read.parquet(p) for n, p in folders.items() if HadoopFs(spark, p).exists()})
    found = {}
    for n in names:
        manifest = BucketedTable(spark, f"{target_root.rstrip('/')}/{n}", []).manifest()
        if manifest is not None:
            found[n] = BucketedTable(spark, f"{target_root.rstrip('/')}/{n}", manifest["keys"]).read() if manifest["buckets"] else None
    return stored_stats(spark, found)
