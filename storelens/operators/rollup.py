"""Daily event rollups from mergeable states, and age limits."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.functions import convert

RAW_EVENT_DAYS = 30
ROLLUP_DAYS = 180


def event_states(events: DataFrame, precision: int = 12) -> DataFrame:
    """Partial state per day and type; states of different inputs can be merged later."""
    return events.groupBy(
        F.to_date("event_time").alias("event_date"), "event_type"
    ).agg(
        F.hll_sketch_agg("user_id", precision).alias("uniq_users"),
        F.sum("points_spent").alias("total_points_spent"),
        F.count("*").alias("actions_count"),
    )


def fold_states(states: DataFrame) -> DataFrame:
    """One state per day and type, of the same form."""
    return states.groupBy("event_date", "event_type").agg(
        F.hll_union_agg("uniq_users").alias("uniq_users"),
        F.sum("total_points_spent").alias("total_points_spent"),
        F.sum("actions_count").alias("actions_count"),
    )


def merge_states(states: DataFrame) -> DataFrame:
    return fold_states(states).select(
        "event_date", "event_type", F.hll_sketch_estimate("uniq_users").alias("unique_users"),
        F.col("total_points_spent").alias("total_spent"), F.col("actions_count").alias("total_actions"),
    ).orderBy("event_date", "event_type")


def exact_rollup(events: DataFrame) -> DataFrame:
    """The same report with an exact user count.

    Events are reduced to one row per (day, type, user) first, which spreads a
    frequent day or type over all tasks.
    """
    per_user = events.groupBy(
        F.to_date("event_time").alias("event_date"), "event_type", "user_id"
    ).agg(F.sum("points_spent").alias("points"), F.count("*").alias("actions"))
    return (
        per_user.groupBy("event_date", "event_type")
        .agg(
            F.count("user_id").alias("unique_users"),
            F.sum("points").alias("total_spent"),
            F.sum("actions").alias("total_actions"),
        )
        .orderBy("event_date", "event_type")
    )


def apply_ttl(df: DataFrame, column: str, days: int, now: datetime) -> DataFrame:
    """Rows younger than ``days``; the limit is a literal, so the scan can skip files."""
    dtype = df.schema[column].dataType.typeName()
    limit = now - timedelta(days=days)
    if dtype == "date":
        return df.where(F.col(column).cast("timestamp") > convert.at(limit))
    return df.where(F.col(column) > convert.at(limit).cast(dtype))
