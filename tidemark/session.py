"""Session helpers: a configured local session for tests, and shared scratch/checkpoint folders.

On a cluster the session is created by the platform; the library only reads ``spark.checkpoint.dir`` from it and
sets its own checkpoint folder when none is configured (tests, local runs).
"""
from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def get_spark(master: str = "local[8]", partitions: int = 8, app: str = "tidemark", **conf) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    for k, v in {**DEFAULT_CONF, "spark.sql.shuffle.partitions": str(partitions), **conf}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    Uses ``spark.checkpoint.dir`` (or a folder already set on the context); only when neither is set — a local test
    session — a private folder under the system temp dir is created and registered.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    sc.setCheckpointDir(conf_dir)
    got = sc._jsc.sc().getCheckpointDir()
    return got.get() if got.isDefined() else conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared checkpoint folder, for written intermediate tables."""
    base = checkpoint_dir(spark)
    return os.path.join(base.replace("file:", "", 1) if base.startswith("file:") else base,
                        f"{name}-{uuid.uuid4().hex[:12]}")
