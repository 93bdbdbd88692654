"""Projections that tolerate fields the input does not have."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def field_type(schema: T.StructType, path: str) -> T.DataType | None:
    """Type at a dotted path, None where the path leaves the schema."""
    at: T.DataType = schema
    for name in path.split("."):
        if not isinstance(at, T.StructType) or name not in at.names:
            return None
        at = at[name].dataType
    return at


def has_column(df: DataFrame, name: str) -> bool:
    return name in df.columns


def column_or_null(df: DataFrame, path: str, dtype: str) -> Column:
    """The column at a dotted path cast to ``dtype``, a NULL of it if absent."""
    if field_type(df.schema, path) is None:
        return F.lit(None).cast(dtype)
    return F.col(path).try_cast(dtype)
