"""Type defaults used where NULL must compare equal to "empty" (the compare's default mode)."""
from __future__ import annotations

import datetime as _dt
import decimal as _dec

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The default each kind of type stands for when NULL.
#   text ''            numbers 0            binary empty
#   boolean false      date / datetime 1999-01-01
DEFAULT_TEXT = ""
DEFAULT_NUMBER = 0
DEFAULT_DATE = _dt.date(1999, 1, 1)
DEFAULT_DATETIME_TEXT = "1999-01-01 00:00:00"
DEFAULT_GUID = "00000000-0000-0000-0000-000000000000"   # for GUID columns kept as text (pass as an override)


def null_default(dtype: T.DataType) -> Column | None:
    """A literal of ``dtype`` standing for NULL; None for types without a default (arrays, maps, structs)."""
    if isinstance(dtype, (T.StringType, T.CharType, T.VarcharType)):
        return F.lit(DEFAULT_TEXT)
    if isinstance(dtype, T.DecimalType):
        return F.lit(_dec.Decimal(DEFAULT_NUMBER)).cast(dtype)
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)):
        return F.lit(DEFAULT_NUMBER).cast(dtype)
    if isinstance(dtype, T.BooleanType):
        return F.lit(False)
    if isinstance(dtype, T.BinaryType):
        return F.lit(bytearray())
    if isinstance(dtype, T.DateType):
        return F.lit(DEFAULT_DATE.isoformat()).cast(dtype)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.lit(DEFAULT_DATETIME_TEXT).cast(dtype)
    return None


def with_default(col: Column, dtype: T.DataType) -> Column:
    d = null_default(dtype)
    return col if d is None else F.coalesce(col, d)


def default_for(name: str, dtype: T.DataType, overrides: dict | None = None) -> Column | None:
    """The default of one column: an override by column name (e.g. ``DEFAULT_GUID``), else its type default."""
    if overrides and name in overrides:
        return F.lit(overrides[name]).cast(dtype)
    return null_default(dtype)


def fill_type_defaults(df: DataFrame, columns=None, overrides: dict | None = None) -> DataFrame:
    """Replace NULL by the type default in ``columns`` (default: all); one projection, no shuffle."""
    wanted = set(columns) if columns is not None else None
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if wanted is None or f.name in wanted:
            d = default_for(f.name, f.dataType, overrides)
            c = (c if d is None else F.coalesce(c, d)).alias(f.name)
        out.append(c)
    return df.select(*out)
