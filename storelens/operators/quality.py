"""Count, duplicate and threshold checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Alert limits, expected counts and dashboard steps per table.
COUNT_LIMITS = {"purchases": 200, "stores": 45}
EXPECTED_COUNTS = {"purchases": 200, "stores": 45}
STATUS_STEPS = {
    "purchases": ((150, "yellow"), (300, "red")),
    "stores": ((40, "yellow"), (50, "red")),
}
DUPLICATE_LIMIT = 0.5


def table_counts(df: DataFrame, key: str) -> DataFrame:
    """Row count and number of distinct keys.

    Keys are counted one row each first, so a key with very many copies is
    combined before the shuffle.
    """
    per_key = df.groupBy(key).agg(F.count("*").alias("copies"))
    return per_key.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("row_count"),
        F.count(key).alias("distinct_count"),
    )


def duplicate_ratio(df: DataFrame, key: str, limit: float = DUPLICATE_LIMIT) -> DataFrame:
    ratio = 1 - F.try_divide("distinct_count", "row_count")
    return table_counts(df, key).select(
        "row_count",
        "distinct_count",
        ratio.alias("duplicate_ratio"),
        F.coalesce(ratio > limit, F.lit(False)).alias("firing"),
    )


def threshold_check(df: DataFrame, limit: int) -> DataFrame:
    counted = df.agg(F.count("*").alias("row_count"))
    return counted.withColumns({
        "row_limit": F.lit(limit).cast("bigint"),
        "firing": F.col("row_count") > limit,
    })


def status(value: Column, steps: tuple[tuple[float, str], ...], base: str = "green") -> Column:
    """Name of the highest step the value reaches."""
    named = F.lit(base)
    for start, name in sorted(steps):
        named = F.when(value >= start, name).otherwise(named)
    return named


def expected_count(df: DataFrame, expected: int) -> DataFrame:
    counted = df.agg(F.count("*").alias("row_count"))
    return counted.withColumns({
        "expected": F.lit(expected).cast("bigint"),
        "as_expected": F.col("row_count") == expected,
    })
