"""Hashing of personal data at any nesting depth, chosen by field name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens.functions import convert

Rule = Callable[[str, Column, T.DataType], "Column | None"]


def normalize_phone(raw: Column) -> Column:
    """Phone text in one form: ``+7`` and ten digits where that can be told."""
    digits = F.regexp_replace(raw, "[^0-9]", "")
    trunk = F.when(
        (F.length(digits) == 11) & digits.startswith("8"),
        F.concat(F.lit("7"), F.substring(digits, 2, 10)),
    ).otherwise(digits)
    national = F.when(F.length(trunk) == 10, F.concat(F.lit("7"), trunk)).otherwise(trunk)
    is_home = (F.length(national) == 11) & national.startswith("7")
    is_foreign = (national != "") & ~raw.startswith("+")
    return (
        F.when(raw.isNull(), "")
        .when(is_home | is_foreign, F.concat(F.lit("+"), national))
        .otherwise(raw)
    )


def rewrite_fields(df: DataFrame, rule: Rule) -> DataFrame:
    """Apply ``rule(name, column, type)`` to every field, inside structs, arrays and maps too.

    A rule returns the new column, or None to leave the field. Branches in
    which nothing changes are passed on untouched.
    """
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        changed = _rewrite(field.name, column, field.dataType, rule)
        columns.append((column if changed is None else changed).alias(field.name))
    return df.select(*columns)


def _rewrite(name: str, column: Column, dtype: T.DataType, rule: Rule) -> Column | None:
    replaced = rule(name, column, dtype)
    if replaced is not None:
        return replaced
    if isinstance(dtype, T.StructType):
        inner = {
            f.name: _rewrite(f.name, column.getField(f.name), f.dataType, rule)
            for f in dtype.fields
        }
        if all(c is None for c in inner.values()):
            return None
        rebuilt = F.struct(
            *[
                (column.getField(n) if c is None else c).alias(n)
                for n, c in inner.items()
            ]
        )
        return F.when(column.isNotNull(), rebuilt)
    if isinstance(dtype, T.ArrayType):
        if _touches(dtype.elementType, rule):
            return F.transform(
                column, lambda e: _rewrite("", e, dtype.elementType, rule)
            )
        return None
    if isinstance(dtype, T.MapType) and _touches(dtype.valueType, rule):
        return F.transform_values(
            column, lambda k, v: _rewrite("", v, dtype.valueType, rule)
        )
    return None


def _touches(dtype: T.DataType, rule: Rule) -> bool:
    return _rewrite("", F.lit(None).cast(dtype), dtype, rule) is not None


def _as_text(column: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(column)
    return column.cast("string")


def pii_rule(keep_null: bool = False, salt: str | None = None) -> Rule:
    """Rule that hashes fields whose name holds ``phone`` or ``email``.

    A missing value hashes like empty text unless ``keep_null`` is set. With a
    ``salt`` the digest is a salted sha-256, which cannot be reversed by
    enumerating phone numbers; the plain md5 form can.
    """

    def digest(text: Column, original: Column) -> Column:
        hashed = (
            F.md5(text.cast("binary"))
            if salt is None
            else F.sha2(F.concat(F.lit(salt), text), 256)
        )
        return F.when(original.isNotNull(), hashed) if keep_null else hashed

    def rule(name: str, column: Column, dtype: T.DataType) -> Column | None:
        lowered = name.lower()
        if "phone" in lowered:
            return digest(normalize_phone(_as_text(column, dtype)), column)
        if "email" in lowered:
            text = F.coalesce(F.lower(_as_text(column, dtype)), F.lit(""))
            return digest(text, column)
        return None

    return rule


def mask_pii(df: DataFrame, keep_null: bool = False, salt: str | None = None) -> DataFrame:
    return rewrite_fields(df, pii_rule(keep_null, salt))


def iso_times(df: DataFrame) -> DataFrame:
    """Timestamps at any depth as ISO text, dates as ``yyyy-MM-dd`` text."""

    def rule(name: str, column: Column, dtype: T.DataType) -> Column | None:
        if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
            return convert.iso_text(column)
        if isinstance(dtype, T.DateType):
            return column.cast("string")
        return None

    return rewrite_fields(df, rule)
