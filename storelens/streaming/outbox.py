"""Rows of a growing table sent oldest first, some at a time, without reading what was sent before.

The state is a high-water mark: time and id of the last row sent in order, and up to which file time the table was looked at. All
rows behind the mark are unsent, which a scan finds from the statistics of row groups. Rows that turn up below the mark in files
written later, and rows without a time, are put into a table of late rows once and sent from there.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens.operators import relay
from storelens.sources import hadoop, messages
from storelens.streaming import store

ROW = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("event_timestamp", T.TimestampType()),
])
# Times in microseconds, as the driver's clock zone must not matter.
MARK = T.StructType([T.StructField(n, T.LongType()) for n in ("mark_us", "mark_id", "seen_ms")])
LATE = store.Layout(ROW, key="id")
SENT_LATE = store.Layout(T.StructType([T.StructField("id", T.LongType())]), key="id")
RUN = "outbox"


def behind(rows: DataFrame, mark_us: int | None, mark_id: int | None) -> DataFrame:
    """Rows later than the mark in the order of time and id; the first condition is one a scan can use."""
    at, timed = F.col("event_timestamp"), rows.where("event_timestamp IS NOT NULL")
    if mark_us is None:
        return timed
    mark = F.timestamp_micros(F.lit(mark_us))
    return timed.where(at >= mark).where((at > mark) | (F.col("id") > mark_id))


def late_rows(rows: DataFrame, mark_us: int | None, mark_id: int | None) -> DataFrame:
    """Rows of new files that the mark has passed already or never reaches: those without a time."""
    timeless = F.col("event_timestamp").isNull()
    if mark_us is None:
        return rows.where(timeless)
    at, mark = F.col("event_timestamp"), F.timestamp_micros(F.lit(mark_us))
    return rows.where(timeless | (at < mark) | ((at == mark) & (F.col("id") <= mark_id)))


def _state(spark: SparkSession, state: str) -> tuple[int, tuple[int | None, int | None, int]]:
    """Number of the next round, and mark and file time after the last one."""
    last = max((n for _, n in store.batches(spark, f"{state}/mark")), default=-1)
    if last < 0:
        return 0, (None, None, 0)
    row = spark.read.schema(MARK).parquet(f"{state}/mark/run={RUN}/batch={last}").first()
    return last + 1, (row["mark_us"], row["mark_id"], row["seen_ms"])


def next_rows(spark: SparkSession, source: str, state: str, n: int = 10) -> tuple[DataFrame, int, int]:
    """The ``n`` oldest unsent rows with ``late_``, the number of this round and the file time it looks up to.

    Rows without a time come last. Only files written since the last round are read for late rows.
    """
    number, (mark_us, mark_id, seen) = _state(spark, state)
    now = max((changed for _, changed, _ in hadoop.file_stamps(spark, source, ".parquet")), default=seen)
    table = spark.read.schema(ROW).parquet(source)
    written = F.unix_millis(F.col("_metadata.file_modification_time"))
    if now > seen:
        late = late_rows(table.where((written > seen) & (written <= now)), mark_us, mark_id)
        store.write_batch(late, f"{state}/late", RUN, number, LATE)
    order = [F.col("event_timestamp").asc_nulls_last(), "id"]
    ahead = behind(table.where(written <= now), mark_us, mark_id).orderBy(*order).limit(n)
    waiting = store.read_store(spark, f"{state}/late", LATE)
    sent = store.read_store(spark, f"{state}/sent_late", SENT_LATE, (RUN, number))
    open_ = waiting.join(sent, "id", "left_anti").orderBy(*order).limit(n)
    both = ahead.withColumn("late_", F.lit(False)).unionByName(open_.withColumn("late_", F.lit(True)))
    return both.orderBy(*order).limit(n), number, now


def send_next(spark: SparkSession, source: str, channel: dict[str, str], state: str, n: int = 10) -> int:
    """One round: deliver the next rows, then move the mark; gives the number of rows.

    A round that breaks off is repeated whole, so a row may be delivered twice but is never left out. Run one
    sender per state.
    """
    rows, number, now = next_rows(spark, source, state, n)
    taken = spark.createDataFrame(rows.collect(), rows.schema)  # at most n rows
    _, (mark_us, mark_id, _) = _state(spark, state)
    count = taken.count()
    if count:
        messages.write_messages(relay.login_messages(taken), channel)
        store.write_batch(taken.where("late_").select("id"), f"{state}/sent_late", RUN, number, SENT_LATE)
        ordered = taken.where("NOT late_").select(F.unix_micros("event_timestamp").alias("us"), "id")
        last = ordered.agg(F.max(F.struct("us", "id")).alias("last")).first()["last"]
        if last is not None:
            mark_us, mark_id = last["us"], last["id"]
    moved = spark.createDataFrame([(mark_us, mark_id, now)], MARK)
    store.write_batch(moved.coalesce(1), f"{state}/mark", RUN, number)
    return count


def mark_time(spark: SparkSession, state: str) -> datetime | None:
    """How far the sender has come."""
    mark_us = _state(spark, state)[1][0]
    return None if mark_us is None else spark.range(1).select(F.timestamp_micros(F.lit(mark_us))).first()[0]
