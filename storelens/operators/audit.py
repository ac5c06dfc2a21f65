"""Field-level audit log of changes between two snapshots of a table."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.functions import convert

AUDITED = ("name", "email", "role")
EXPORT_COLUMNS = ["user_id", "field_changed", "old_value", "new_value", "changed_by", "changed_at"]


def audit_changes(
    old: DataFrame,
    new: DataFrame,
    key: str = "id",
    columns: tuple[str, ...] = AUDITED,
    actor: str = "system",
    changed_at: datetime | None = None,
) -> DataFrame:
    """One row per changed field of each key found in both snapshots."""
    before = old.select(key, *[F.col(c).cast("string").alias(f"old_{c}") for c in columns])
    after = new.select(key, *[F.col(c).cast("string").alias(f"new_{c}") for c in columns])
    change = F.array(*[
        F.when(
            ~F.col(f"old_{c}").eqNullSafe(F.col(f"new_{c}")),
            F.struct(
                F.lit(c).alias("field_changed"),
                F.col(f"old_{c}").alias("old_value"),
                F.col(f"new_{c}").alias("new_value"),
            ),
        )
        for c in columns
    ])
    return (
        before.join(after, key)
        .select(F.col(key).alias("user_id"), F.explode(F.array_compact(change)).alias("change"))
        .select(
            "user_id",
            "change.*",
            F.lit(actor).alias("changed_by"),
            convert.at(changed_at).alias("changed_at"),
        )
    )


def recent_audit(audit: DataFrame, now: datetime, calendar_day: bool = False) -> DataFrame:
    """Changes of the last 24 hours, or of the calendar day of ``now``, in time order."""
    start = now.replace(hour=0, minute=0, second=0, microsecond=0) if calendar_day else now - timedelta(days=1)
    fresh = audit.where(F.col("changed_at") >= convert.at(start))
    return fresh.select(*EXPORT_COLUMNS).orderBy("changed_at", "user_id", "field_changed")
