"""Incremental copy of login rows over a message bus."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.functions import convert
from storelens.sources.specs import LOGIN_SCHEMA

UINT32_MAX = 4294967295


def not_sent(source: DataFrame, ledger: DataFrame | None, key: str = "id") -> DataFrame:
    """Rows whose key is not in the ledger of sent keys."""
    if ledger is None:
        return source
    return source.join(ledger.select(key), key, "left_anti")


def read_unsent(
    source: DataFrame, ledger: DataFrame | None, n: int = 10, key: str = "id"
) -> DataFrame:
    """The ``n`` oldest rows that were not sent; rows without a time come last."""
    oldest = F.col("event_timestamp").asc_nulls_last()
    return not_sent(source, ledger, key).orderBy(oldest, key).limit(n)


def login_messages(rows: DataFrame) -> DataFrame:
    """JSON message per row; a missing time stays in the object as null."""
    body = F.struct(
        "id", "user_id", "event_type",
        convert.iso_text(F.col("event_timestamp")).alias("event_timestamp"),
    )
    return rows.select(
        F.col("id").cast("string").alias("key"),
        F.to_json(body, {"ignoreNullFields": "false"}).alias("value"),
    )


def _checked(messages: DataFrame) -> DataFrame:
    """Messages with their ``body``, its time ``at`` and ``readable``.

    As in ``documents.opened``, the one-element explode keeps the filters from
    repeating the parse.
    """
    text = F.col("value").cast("string")
    parsed = messages.select(
        text.alias("value"), F.explode(F.array(F.from_json(text, LOGIN_SCHEMA))).alias("body")
    )
    written = F.col("body.event_timestamp")
    timed = parsed.withColumn("at", convert.to_moment(written))
    time_ok = F.coalesce(written, F.lit("")).isin("") | F.col("at").isNotNull()
    ids_ok = F.col("body.id").between(0, UINT32_MAX) & F.col("body.user_id").between(0, UINT32_MAX)
    readable = ids_ok & F.col("body.event_type").isNotNull() & time_ok
    return timed.withColumn("readable", F.coalesce(readable, F.lit(False)))


def parse_logins(messages: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Typed login rows; unreadable messages are left out."""
    return _checked(messages).where("readable").select(
        "body.id",
        "body.user_id",
        "body.event_type",
        F.col("at").alias("event_timestamp"),
        convert.at(as_of).alias("processed_at"),
    )


def rejected_logins(messages: DataFrame) -> DataFrame:
    return _checked(messages).where("NOT readable").select("value")


def first_version(rows: DataFrame, key: str = "id") -> DataFrame:
    """One row per key: the one with the earliest event time, NULL last, then the least of the other columns."""
    others = [c for c in rows.columns if c not in (key, "event_timestamp")]
    order = F.struct(F.col("event_timestamp").isNull().alias("late_"), "event_timestamp", *others)
    best = F.min_by(F.struct(*rows.columns), order).alias("row_")
    return rows.groupBy(F.col(key).alias("key_")).agg(best).select("row_.*")
