"""Streaming queries: landing, typed tables, event states, relay, counts.

Every function returns the running query. The default trigger works off what is
there and stops; pass ``trigger={"processingTime": "1 minute"}`` to keep running.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from storelens.operators import clean, dedupe, documents, relay, rollup
from storelens.session import release
from storelens.sources import messages
from storelens.sources.specs import LOGIN_SCHEMA, RAW_SCHEMA, TableSpec
from storelens.streaming import store

ONCE = {"availableNow": True}
# Bytes of raw files that a micro-batch takes for each core. Larger than for messages, as every one reads the stored hashes.
RAW_CORE_BYTES = 64 << 20

SENT_SCHEMA = T.StructType([T.StructField("id", T.LongType())])

STATE_SCHEMA = T.StructType([
    T.StructField("event_date", T.DateType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("uniq_users", T.BinaryType()),
    T.StructField("total_points_spent", T.LongType()),
    T.StructField("actions_count", T.LongType()),
])

TYPED_LOGIN_SCHEMA = T.StructType([
    *LOGIN_SCHEMA.fields[:3],
    T.StructField("event_timestamp", T.TimestampType()),
    T.StructField("processed_at", T.TimestampType()),
])

STATES = store.Layout(STATE_SCHEMA, day="event_date")
SENT = store.Layout(SENT_SCHEMA, key="id")
LOGINS = store.Layout(TYPED_LOGIN_SCHEMA, key="id")


def typed_layout(spec: TableSpec) -> store.Layout:
    return store.Layout(spec.schema, key="row_hash")


def _each_batch(
    stream: DataFrame,
    checkpoint: str,
    handle: Callable[[DataFrame, str, int], None],
    trigger: dict | None,
) -> StreamingQuery:
    run = store.run_id(stream.sparkSession, checkpoint)

    def on_batch(batch: DataFrame, number: int) -> None:
        handle(batch, run, number)
        release(batch.sparkSession)  # else shuffle files of all batches stay until the driver happens to collect garbage

    writer = stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or ONCE)).start()


def stream_raw(
    stream: DataFrame, target: str, rejects: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Messages to the raw table; unusable ones to the reject table."""

    def handle(batch: DataFrame, run: str, number: int) -> None:
        checked = clean.keep(documents.check_messages(batch))
        store.write_batch(documents.landed(checked), target, run, number)
        store.write_batch(documents.rejected(checked), rejects, run, number)
        checked.unpersist()

    return _each_batch(stream, checkpoint, handle, trigger)


def read_raw_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The raw table as a stream of its new files, in micro-batches of ``max_files`` or else of bounded size."""
    limit = {"maxFilesPerTrigger": str(max_files)} if max_files else messages.bounded(spark, {}, RAW_CORE_BYTES)
    reader = spark.readStream.schema(RAW_SCHEMA).options(**limit)
    return reader.option("recursiveFileLookup", True).parquet(path)


def stream_parse(
    raw: DataFrame, spec: TableSpec, target: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Raw rows to the typed table of ``spec``; a row whose hash is stored is not added again.

    Run one query per target: two writers could both miss a row of the other.
    """

    def handle(batch: DataFrame, run: str, number: int) -> None:
        add_typed(batch, spec, target, run, number)

    return _each_batch(raw, checkpoint, handle, trigger)


def add_typed(raw: DataFrame, spec: TableSpec, target: str, run: str, number: int) -> None:
    """One batch of raw rows to the typed table; only the buckets its hashes fall into are opened."""
    unique = clean.keep(dedupe.unique_rows(documents.parse_documents(raw, spec), spec))
    layout = typed_layout(spec)
    store.write_batch(store.absent(unique, target, layout, (run, number)), target, run, number, layout)
    unique.unpersist()


def stream_event_states(
    events: DataFrame, target: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Partial daily states of each micro-batch in folders by day, merged by whoever reads them and by ``compact_states``."""

    def handle(batch: DataFrame, run: str, number: int) -> None:
        add_states(batch, target, run, number)

    return _each_batch(events, checkpoint, handle, trigger)


def add_states(events: DataFrame, target: str, run: str, number: int) -> None:
    store.write_batch(rollup.event_states(events), target, run, number, STATES)


def stream_relay(
    logins: DataFrame,
    channel: dict[str, str],
    ledger: str,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Login rows to a topic, each id once as far as the ledger knows.

    The ledger is written after delivery. A failure in between sends the batch
    again, which the reader removes by id.
    """

    def handle(batch: DataFrame, run: str, number: int) -> None:
        rows = clean.keep(batch.dropDuplicates(["id"]))
        ready = store.absent(rows, ledger, SENT, (run, number))
        messages.write_messages(relay.login_messages(ready), channel)
        mark_sent(ready, ledger, run, number)
        rows.unpersist()

    return _each_batch(logins, checkpoint, handle, trigger)


def mark_sent(rows: DataFrame, ledger: str, run: str, batch: int) -> None:
    """Add the ids of delivered rows to the ledger; repeating a batch changes nothing."""
    store.write_batch(rows.select(F.col("id").cast("bigint").alias("id")), ledger, run, batch, SENT)


def consume_logins(
    stream: DataFrame, target: str, rejects: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Messages to versions of login rows, one per id and batch; unreadable ones to the reject table.

    History is not looked at: ``read_logins`` and ``compact_logins`` choose among the versions of an id, and that choice
    does not depend on how the stream was cut into batches.
    """

    def handle(batch: DataFrame, run: str, number: int) -> None:
        add_logins(batch, target, rejects, run, number)

    return _each_batch(stream, checkpoint, handle, trigger)


def add_logins(messages_: DataFrame, target: str, rejects: str, run: str, number: int) -> None:
    cached = clean.keep(messages_)
    store.write_batch(relay.first_version(relay.parse_logins(cached)), target, run, number, LOGINS)
    store.write_batch(relay.rejected_logins(cached), rejects, run, number)
    cached.unpersist()


def read_logins(spark: SparkSession, target: str) -> DataFrame:
    """One row per login id: of all its versions the one with the earliest event time."""
    return relay.first_version(store.read_store(spark, target, LOGINS))


def compact_logins(spark: SparkSession, target: str) -> bool:
    """Maintenance of the login table: one version per id in a base."""
    return store.compact(spark, target, LOGINS, relay.first_version)


def compact_typed(spark: SparkSession, spec: TableSpec, target: str) -> bool:
    """Maintenance of a typed table: few files a bucket, sorted by hash."""
    return store.compact(spark, target, typed_layout(spec))


def compact_sent(spark: SparkSession, ledger: str) -> bool:
    """Maintenance of a ledger of sent ids."""
    return store.compact(spark, ledger, SENT, DataFrame.distinct)


def compact_states(spark: SparkSession, target: str) -> bool:
    """Maintenance of the daily states: one merged state per day and type in a base."""
    return store.compact(spark, target, STATES, rollup.fold_states)


def expire_states(spark: SparkSession, target: str, keep_from: date) -> int:
    """Remove the states of days before ``keep_from``; gives the number of folders removed."""
    return store.expire_days(spark, target, STATES, keep_from.isoformat())


def watch_counts(
    stream: DataFrame, limit: int, target: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Running row count of a stream, checked against ``limit`` on every trigger."""
    counted = stream.groupBy().agg(F.count("*").alias("row_count"))

    def handle(batch: DataFrame, run: str, number: int) -> None:
        checked = batch.withColumns({
            "row_limit": F.lit(limit).cast("bigint"),
            "firing": F.col("row_count") > limit,
        })
        store.write_batch(checked, target, run, number)

    run = store.run_id(stream.sparkSession, checkpoint)
    writer = (
        counted.writeStream.outputMode("complete")
        .foreachBatch(lambda batch, number: handle(batch, run, number))
        .option("checkpointLocation", checkpoint)
    )
    return writer.trigger(**(trigger or ONCE)).start()
