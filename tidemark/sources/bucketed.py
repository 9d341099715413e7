"""A keyed parquet table stored as key-hash buckets, updated by rewriting only the buckets a stage touches.

Plain parquet has no MERGE / DELETE.  Rows are spread over ``num_buckets`` buckets by ``pmod(xxhash64(keys), n)``
(``partitionBy`` directories).  Each apply reads the touched buckets only (the set of bucket ids in the stage — at
most ``num_buckets`` integers reach the driver), rewrites them into a new version folder, and then publishes a new
manifest that points every bucket at the folder holding its current files.  Readers use the newest manifest, so a
failed apply leaves the previous version intact, and old versions stay readable.
"""
from __future__ import annotations

import json
import uuid
from contextlib import contextmanager
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.apply import DEFAULT_BROADCAST_LIMIT, apply_changes
from .fs import HadoopFs

BUCKET_COL = "tm_bucket"
SLICE_SEED = 7919        # seeds the second hash that splits a bucket over several write tasks
SLICE_COL = "tm_slice"


@contextmanager
def co_partition_on_subset(spark: SparkSession):
    """Let a sort-merge join accept children hash-partitioned on a subset of its keys (here: bucket, slice)."""
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(key, "true")
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def bucket_of(keys: Sequence[str], num_buckets: int):
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(num_buckets)).cast("int")


def attempt_folder(version: int) -> str:
    """A folder name that no other attempt at this version uses."""
    return f"v{version:08d}-{uuid.uuid4().hex[:12]}"


class BucketedTable:
    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], num_buckets: int = 64,
                 version_col: str = "sourcerv"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.keys = list(keys)
        self.num_buckets = num_buckets
        self.version_col = version_col
        self._fs = HadoopFs(spark, self.root)

    # ---- manifest -----------------------------------------------------------------------------------------------
    def versions(self) -> list:
        names = [n for n in self._fs.list_names("_manifest") if n.endswith(".json") and not n.startswith(".")]
        return sorted(int(n[1:-5]) for n in names)

    def manifest(self, version: int | None = None) -> dict | None:
        vs = self.versions()
        if not vs:
            return None
        v = vs[-1] if version is None else version
        return json.loads(self._fs.read_text("_manifest", f"v{v:08d}.json"))

    def _publish(self, version: int, buckets: dict, schema: T.StructType) -> None:
        doc = dict(version=version, keys=self.keys, num_buckets=self.num_buckets, schema=schema.json(),
                   buckets={str(k): v for k, v in sorted(buckets.items())})
        self._fs.write_text(json.dumps(doc), "_manifest", f"v{version:08d}.json")

    # ---- read ---------------------------------------------------------------------------------------------------
    def read(self, version: int | None = None, buckets: Sequence[int] | None = None) -> DataFrame:
        m = self.manifest(version)
        if m is None:
            raise FileNotFoundError(f"no table at {self.root}")
        schema = T.StructType.fromJson(json.loads(m["schema"]))
        wanted = m["buckets"] if buckets is None else {str(b): m["buckets"][str(b)] for b in buckets
                                                      if str(b) in m["buckets"]}
        paths = [f"{self.root}/{folder}/{BUCKET_COL}={b}" for b, folder in sorted(wanted.items(), key=lambda x: int(x[0]))]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def exists(self) -> bool:
        return bool(self.versions())

    # ---- write --------------------------------------------------------------------------------------------------
    def _write(self, df: DataFrame, version: int, slices: int | None = None) -> dict:
        """Write rows into bucket folders of a new version.

        Rows are spread over ``buckets x slices`` tasks by (bucket, second key hash), so each task writes one file of
        one bucket and no bucket is funnelled into one task.  Every attempt writes to a folder of its own: what a
        failed attempt left behind is never read.
        """
        name = attempt_folder(version)
        folder = f"{self.root}/{name}"
        out = df.withColumn(BUCKET_COL, bucket_of(self.keys, self.num_buckets))
        k = slices or self._slices(self.num_buckets)
        sub = F.pmod(F.xxhash64(F.lit(SLICE_SEED), *[F.col(c) for c in self.keys]), F.lit(k))
        out = out.repartition(self.num_buckets * k, F.col(BUCKET_COL), sub)
        if self.version_col in df.columns:
            # files sorted by version: row-group min/max stats let a version-window filter skip old row groups
            out = out.sortWithinPartitions(BUCKET_COL, self.version_col)
        out.write.mode("overwrite").partitionBy(BUCKET_COL).parquet(folder)
        return self._written_buckets(name)

    def _written_buckets(self, name: str) -> dict:
        """Bucket -> folder of one attempt; the folder is that attempt's alone, so it lists what the job wrote."""
        return {int(n.split("=", 1)[1]): name for n in self._fs.list_names(name) if n.startswith(BUCKET_COL + "=")}

    def _slices(self, buckets: int) -> int:
        """Tasks for each bucket, so that a write uses at least the session's shuffle partitions."""
        return max(1, -(-int(self.spark.conf.get("spark.sql.shuffle.partitions")) // max(buckets, 1)))

    def co_partitioned_rows(self, target: DataFrame, stage: DataFrame, identity=(), guard: str = "changed",
                            slices: int = 1) -> DataFrame:
        """New rows of the touched buckets, with target and stage each hash-partitioned once by (bucket, slice)
        and joined on (bucket, slice, keys); carries the bucket column for the write."""
        n = self.num_buckets * slices

        def spread(df):
            sub = F.pmod(F.xxhash64(F.lit(SLICE_SEED), *[F.col(c) for c in self.keys]), F.lit(slices))
            return (df.withColumn(BUCKET_COL, bucket_of(self.keys, self.num_buckets)).withColumn(SLICE_COL, sub)
                    .repartition(n, F.col(BUCKET_COL), F.col(SLICE_COL)))

        return apply_changes(spread(target), spread(stage), [BUCKET_COL, SLICE_COL, *self.keys], identity,
                             strategy="shuffle", guard=guard)

    def _apply_co_partitioned(self, target: DataFrame, stage: DataFrame, identity, guard, schema, version: int,
                              touched: int) -> dict:
        """Shuffle plan: with ``requireAllClusterKeysForCoPartition`` off for this write, the sort-merge join
        accepts the (bucket, slice) partitioning of both sides as is, and every output task holds one slice of one
        bucket — one shuffle per side, one file per task."""
        k = self._slices(touched)
        merged = self.co_partitioned_rows(target, stage, identity, guard, k)
        out = merged.select(*schema.fieldNames(), BUCKET_COL)
        if self.version_col in schema.fieldNames():
            out = out.sortWithinPartitions(BUCKET_COL, self.version_col)
        name = attempt_folder(version)
        with co_partition_on_subset(self.spark):
            out.write.mode("overwrite").partitionBy(BUCKET_COL).parquet(f"{self.root}/{name}")
        return self._written_buckets(name)

    def write_full(self, df: DataFrame) -> int:
        """Replace the whole table (initial load)."""
        vs = self.versions()
        version = (vs[-1] + 1) if vs else 1
        self._publish(version, self._write(df, version), df.schema)
        return version

    def apply(self, stage: DataFrame, identity: Sequence[str] = (), strategy: str = "auto", guard: str = "changed",
              stage_rows: int | None = None) -> dict:
        """Apply a collapsed stage; only buckets holding a staged key are read and rewritten."""
        m = self.manifest()
        if m is None:
            raise FileNotFoundError(f"no table at {self.root}")
        schema = T.StructType.fromJson(json.loads(m["schema"]))
        staged = stage.withColumn(BUCKET_COL, bucket_of(self.keys, self.num_buckets))
        touched = sorted(r[0] for r in staged.select(BUCKET_COL).distinct().collect())
        if not touched:
            return dict(version=m["version"], touched=0, buckets=self.num_buckets)
        target = self.read(buckets=touched)
        plan = strategy
        if plan == "auto":
            from ..operators.apply import choose_strategy
            plan, stage = choose_strategy(stage, "auto", DEFAULT_BROADCAST_LIMIT, stage_rows)
        version = m["version"] + 1
        if plan == "broadcast":
            new_rows = apply_changes(target, stage, self.keys, identity, strategy="broadcast", guard=guard)
            written = self._write(new_rows.select(*schema.fieldNames()), version)
        else:
            written = self._apply_co_partitioned(target, stage, identity, guard, schema, version, len(touched))
        buckets = {int(b): f for b, f in m["buckets"].items()}
        for b in touched:
            if b in written:
                buckets[b] = written[b]
            else:
                buckets.pop(b, None)      # every row of the bucket was deleted
        self._publish(version, buckets, schema)
        return dict(version=version, touched=len(touched), buckets=self.num_buckets)
