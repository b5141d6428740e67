"""Null handling."""
from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, functions as F, types as T

# The typed defaults of the metadata row builder.
DEFAULT_STRING = ""
DEFAULT_INT = 0
DEFAULT_FLOAT = 0.0
DEFAULT_BOOL = False
DEFAULT_TIMESTAMP = _dt.datetime(1970, 1, 1, 0, 0, 0)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def default(c, value) -> Column:
    """Null -> typed default (``coalesce``)."""
    return F.coalesce(_col(c), F.lit(value))


def typed_default(dtype: T.DataType):
    """The N1 default for a Spark type, or None when the type has no default."""
    if isinstance(dtype, T.StringType):
        return DEFAULT_STRING
    if isinstance(dtype, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
        return DEFAULT_INT
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return DEFAULT_FLOAT
    if isinstance(dtype, T.BooleanType):
        return DEFAULT_BOOL
    if isinstance(dtype, T.TimestampNTZType):
        return DEFAULT_TIMESTAMP
    return None


def falsy_default(c, value: str = "") -> Column:
    """Python ``x or ""`` on text: null and '' both become ``value``."""
    return F.coalesce(F.nullif(_col(c), F.lit("")), F.lit(value))


def first_non_empty(*cols, value: str = "") -> Column:
    """Fallback chain ``a or b or ""`` (first non-null, non-empty text)."""
    return F.coalesce(*[F.nullif(_col(c), F.lit("")) for c in cols], F.lit(value))


def fill_strings(df: DataFrame, value: str = "NA") -> DataFrame:
    """``fillna("NA")`` touches string columns only; other types keep their nulls."""
    return df.na.fill(value)
