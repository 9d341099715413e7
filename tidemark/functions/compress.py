"""Column compression for wide text columns in a change feed (gzip), and the inverse at apply time.

Spark has no gzip SQL function, so this is the one place a vectorised Pandas UDF is used: Arrow batches in, one
small per-value call to ``gzip`` per row.  Only changed rows of a window pass through it.
"""
from __future__ import annotations

import gzip

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.BinaryType())
def gzip_text(s: pd.Series) -> pd.Series:
    return s.map(lambda v: None if v is None else gzip.compress(v.encode("utf-8"), compresslevel=6))


@F.pandas_udf(T.StringType())
def gunzip_text(s: pd.Series) -> pd.Series:
    return s.map(lambda v: None if v is None else gzip.decompress(bytes(v)).decode("utf-8"))


def compress_columns(df: DataFrame, columns) -> DataFrame:
    cols = set(columns)
    return df.select(*[gzip_text(F.col(f"`{c}`")).alias(c) if c in cols else F.col(f"`{c}`") for c in df.columns])


def decompress_columns(df: DataFrame, columns) -> DataFrame:
    cols = set(columns)
    return df.select(*[gunzip_text(F.col(f"`{c}`")).alias(c) if c in cols else F.col(f"`{c}`") for c in df.columns])
