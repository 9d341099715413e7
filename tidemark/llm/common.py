"""Helpers shared by the training-data operators: written intermediates, folds and small numeric fits."""
from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.session import scratch_path


ROWS_A_FILE = 250_000


def written(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """``df`` written as Parquet below the shared checkpoint folder and read back.

    Cuts the lineage at a table that every executor can read, so losing an executor repeats only the work after it.
    ``rows``, if the number of (short) rows is known or bounded, sets how many files are written: the last shuffle's
    partitions are joined until each has about ``ROWS_A_FILE`` rows, whatever the number of shuffle partitions.
    """
    spark = df.sparkSession
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // ROWS_A_FILE)))
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release_memory():
    """Give memory that a task has freed back to the system.

    Python workers are used again for later tasks, of other stages too, and would hold the peaks of all of them.
    """
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):                 # glibc only
        libc.malloc_trim(0)


def col(name: str) -> Column:
    """The column of exactly this name, also if it holds dots."""
    return F.col("`" + name.replace("`", "``") + "`")


def all_columns(df: DataFrame) -> list[Column]:
    return [col(c) for c in df.columns]


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; -1 for a null id (which is in no fold)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds, F.lit(-1))


def row_key(df: DataFrame, id_col: str, text_col: str) -> Column:
    """A hash of a row's id and text, or of its text and place if there is no such id, by which samples are chosen."""
    return F.xxhash64(F.lit(6), col(id_col) if id_col in df.columns else F.monotonically_increasing_id(), col(text_col))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, l2: float = 1e-2, steps: int = 50):
    """Weighted logistic regression by Newton steps on standardised columns: (mean, scale, coefficients, intercept)."""
    if len(x) == 0:
        return np.zeros(x.shape[1]), np.ones(x.shape[1]), np.zeros(x.shape[1]), 0.0
    total = weight.sum()
    mean = (x * weight[:, None]).sum(0) / total
    scale = np.sqrt(((x - mean) ** 2 * weight[:, None]).sum(0) / total) + 1e-9
    a = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    beta = np.zeros(a.shape[1])
    ridge = np.eye(a.shape[1]) * l2 * max(1.0, total / 1000)
    ridge[-1, -1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        grad = a.T @ (weight * (p - y)) + ridge @ beta
        hess = (a * (weight * p * (1 - p) + 1e-9)[:, None]).T @ a + ridge
        step = np.linalg.solve(hess, grad)
        beta -= step
        if np.abs(step).max() < 1e-7:
            break
    return mean, scale, beta[:-1], float(beta[-1])


def numbered(df: DataFrame, order: list, name: str, col: str = "number") -> DataFrame:
    """``df`` with ``col`` = 0, 1, 2, ... in the order of the columns ``order``, and no window over all rows.

    Rows are dealt by range, sorted and written with their partition and place; the partitions' row counts, one number
    each, are all that reaches the driver.  ``df`` is read twice (the ranges are sampled), so it should be a written table.
    """
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = written(placed.withColumn("_part_", F.spark_partition_id()).withColumn("_at_", F.monotonically_increasing_id()), name)
    before, offsets = 0, []
    for part, n in sorted((r["_part_"], r["n"]) for r in placed.groupBy("_part_").agg(F.count(F.lit(1)).alias("n")).collect()):
        offsets.append((part, before))
        before += n
    spark = df.sparkSession
    first = F.broadcast(spark.createDataFrame(offsets, "_part_ int, _before_ long"))
    at = F.col("_at_").bitwiseAND(F.lit((1 << 33) - 1))                  # the place in the partition
    return placed.join(first, "_part_").withColumn(col, F.col("_before_") + at).drop("_part_", "_at_", "_before_")
