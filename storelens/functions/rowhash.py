"""Null-safe content hash of a row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def canonical_text(column: Column, dtype: T.DataType) -> Column:
    """Text of a value that does not depend on the session time zone."""
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(column).cast("string")
    nested = isinstance(dtype, (T.ArrayType, T.StructType, T.MapType))
    return F.to_json(column, {"timeZone": "UTC"}) if nested else column.cast("string")


def row_hash(schema: T.StructType, names: list[str]) -> Column:
    """md5 over the named columns, each behind its length; NULL has none, so no two rows give one text."""
    texts = [canonical_text(F.col(n), schema[n].dataType) for n in names]
    parts = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.md5(F.concat(*parts).cast("binary"))
