"""Archiving of users who registered long ago and are no longer active."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.functions.convert import at


def _before(now: datetime, days: int):
    return at(now - timedelta(days=days))


def inactive_users(
    events: DataFrame,
    now: datetime,
    registered_days: int = 30,
    idle_days: int = 14,
    registration: DataFrame | None = None,
) -> DataFrame:
    """Ids of users registered more than ``registered_days`` ago with no event in ``idle_days``.

    The registration date is read from ``events`` or, when given, from
    ``registration(user_id, registration_date)``.
    """
    source = events if registration is None else registration
    long_known = source.where(F.col("registration_date") < _before(now, registered_days))
    active = events.where(F.col("event_time") >= _before(now, idle_days))
    return long_known.select("user_id").distinct().join(
        active.select("user_id").distinct(), "user_id", "left_anti"
    )


def tag_archived(events: DataFrame, ids: DataFrame) -> DataFrame:
    """Every event with ``archived``: one pass gives both sides of the split."""
    marks = ids.select("user_id", F.lit(True).alias("archived"))
    tagged = events.join(marks, "user_id", "left")
    return tagged.withColumn("archived", F.coalesce("archived", F.lit(False)))


def archive_split(events: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All events of the given users, and all other events."""
    tagged = tag_archived(events, ids)
    return (
        tagged.where("archived").drop("archived"),
        tagged.where("NOT archived").drop("archived"),
    )


def archive_counts(archived: DataFrame) -> DataFrame:
    """Archived documents per user; the base of the report."""
    return archived.groupBy("user_id").agg(F.count("*").alias("documents"))


def archive_totals(per_user: DataFrame, now: datetime) -> DataFrame:
    """From ``archive_counts`` one row with date, documents and users, or none when nothing was archived."""
    totals = per_user.agg(
        F.sum("documents").alias("archived_documents_count"),
        F.count("*").alias("archived_users_count"),
    )
    found = totals.where("archived_users_count > 0")
    return found.select(F.lit(now.strftime("%Y-%m-%d")).alias("date"), *totals.columns)


def archive_report(archived: DataFrame, now: datetime) -> DataFrame:
    """Report as rows: one per archived user, with the totals of the run beside it."""
    totals = archive_totals(archive_counts(archived), now)
    total = totals.select(F.struct(*totals.columns)).scalar()
    return archive_counts(archived).select(
        F.col("user_id").alias("archived_user_id"),
        F.col("documents").alias("user_documents"),
        total.alias("total"),
    ).select("total.*", "archived_user_id", "user_documents")
