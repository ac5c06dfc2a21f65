"""Duplicate removal by row hash, within a batch and against a stored table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.sources.specs import TableSpec


def unique_rows(parsed: DataFrame, spec: TableSpec) -> DataFrame:
    """One row per hash.

    Rows that share a hash agree in every hashed column, so a plain distinct does
    it with hash aggregation and combines copies before the shuffle.
    """
    if not spec.unhashed:
        return parsed.distinct()
    kept = [c for c in parsed.columns if c not in spec.unhashed]
    first = [F.min(c).alias(c) for c in parsed.columns if c in spec.unhashed]
    return parsed.groupBy(*kept).agg(*first).select(*parsed.columns)


def absent(batch: DataFrame, target: DataFrame | None, key: str) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``target``.

    Both sides are shuffled by key and merged, whatever they are estimated at: what is read from documents is taken for
    many times smaller than it is, and a broadcast planned on that goes through the driver. As an outer join it also
    stays above the aggregation of ``batch``, where an anti join would meet every copy of a row with all its columns.
    """
    if target is None:
        return batch
    known = target.select(key, F.lit(True).alias(f"{key}_known")).hint("merge")
    return batch.join(known, key, "left").where(F.col(f"{key}_known").isNull()).select(*batch.columns)


def new_rows(batch: DataFrame, target: DataFrame | None) -> DataFrame:
    return absent(batch, target, "row_hash")


def load_new(parsed: DataFrame, spec: TableSpec, target: DataFrame | None) -> DataFrame:
    """Unique rows of ``parsed`` that ``target`` lacks."""
    return new_rows(unique_rows(parsed, spec), target)
