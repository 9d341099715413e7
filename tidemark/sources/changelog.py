"""Append-only change log: change records (op, columns, ``sourcerv``) stored by version block.

Records are written under ``rv_block = sourcerv div block`` folders, so reading a version window prunes whole
folders (``PartitionFilters``) before the row filter reaches the files (``PushedFilters``): an extract costs the
window, not the table.  This is also the folder a streaming sync reads.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.extract import latest_per_key
from ..plans.spec import OP_COL, SOURCE_VERSION, VersionWindow

BLOCK_COL = "rv_block"
DEFAULT_BLOCK = 1 << 20


class ChangeLog:
    def __init__(self, spark: SparkSession, root: str, keys, block: int = DEFAULT_BLOCK):
        self.spark = spark
        self.root = root.rstrip("/")
        self.keys = list(keys)
        self.block = int(block)

    def append(self, changes: DataFrame) -> None:
        """Add change records.  Rows are range-partitioned by version, so a large block is written by many tasks and each
        file holds a narrow, sorted stretch of versions."""
        out = changes.withColumn(BLOCK_COL, F.expr(f"`{SOURCE_VERSION}` div {self.block}"))
        (out.repartitionByRange(BLOCK_COL, SOURCE_VERSION).sortWithinPartitions(BLOCK_COL, SOURCE_VERSION)
         .write.mode("append").partitionBy(BLOCK_COL).parquet(self.root))

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.root)

    def window(self, window: VersionWindow, collapse: bool = True) -> DataFrame:
        """Change records in ``(lo, hi]`` — the last one per key when ``collapse``."""
        lo_b, hi_b = window.lo // self.block, window.hi // self.block
        df = self.read().where((F.col(BLOCK_COL) >= F.lit(lo_b)) & (F.col(BLOCK_COL) <= F.lit(hi_b))
                               & (F.col(SOURCE_VERSION) > F.lit(window.lo)) & (F.col(SOURCE_VERSION) <= F.lit(window.hi)))
        df = df.drop(BLOCK_COL)
        if not collapse:
            return df
        cols = [c for c in df.columns if c not in (OP_COL, SOURCE_VERSION)]
        return latest_per_key(df, self.keys, SOURCE_VERSION).select(OP_COL, *cols, SOURCE_VERSION)
