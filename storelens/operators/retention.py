"""Seven-day return rate of daily cohorts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RETURN_DAYS = 7


def visits(events: DataFrame) -> DataFrame:
    """One row per user and day."""
    return events.select(F.to_date("event_time").alias("ds"), "user_id").distinct()


def _next_visits(events: DataFrame) -> DataFrame:
    """Visits with the following visit day of the user.

    After ``visits`` a user has at most one row per calendar day, which bounds the window.
    """
    per_user = Window.partitionBy("user_id").orderBy("ds")
    return visits(events.where(F.col("user_id").isNotNull())).select(
        "ds",
        "user_id",
        F.lead("ds").over(per_user).alias("next_ds"),
        F.row_number().over(per_user).alias("visit_no"),
    )


def _cohorts(rows: DataFrame, days: int) -> DataFrame:
    returned: Column = F.datediff("next_ds", "ds") <= days
    counted = rows.groupBy(F.col("ds").alias("ds_cohort")).agg(
        F.count("*").alias("total_users_day_0"),
        F.count_if(returned).alias("returned_in_7_days"),
    )
    share = F.col("returned_in_7_days") / F.col("total_users_day_0") * 100
    return counted.withColumn("retention_7d_percent", F.round(share, 2)).orderBy("ds_cohort")


def retention_daily(events: DataFrame, days: int = RETURN_DAYS) -> DataFrame:
    """Every visit day is a cohort of the users seen on it."""
    return _cohorts(_next_visits(events), days)


def retention_first_visit(events: DataFrame, days: int = RETURN_DAYS) -> DataFrame:
    """Users belong to the cohort of their first visit only."""
    return _cohorts(_next_visits(events).where("visit_no = 1"), days)
