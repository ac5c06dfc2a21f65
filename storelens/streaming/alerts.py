"""Alert rules whose limit has to be exceeded for some time before they fire, as keyed state with timers."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from storelens.streaming import store

CHECKS = T.StructType([
    T.StructField("rule", T.StringType()),
    T.StructField("at", T.TimestampType()),
    T.StructField("value", T.LongType()),
    T.StructField("row_limit", T.LongType()),
])
TRANSITIONS = T.StructType([
    T.StructField("rule", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("at", T.TimestampType()),
    T.StructField("value", T.LongType()),
])
_STATE = T.StructType([
    T.StructField("since", T.LongType()),
    T.StructField("firing", T.BooleanType()),
    T.StructField("value", T.LongType()),
    T.StructField("last", T.LongType()),
])
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_SECOND = 1_000


def _ms(at: datetime) -> int:
    return round((at if at.tzinfo else at.astimezone()).timestamp() * 1000)


def _moment(ms: int) -> datetime:
    return datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(milliseconds=ms)


class PendingAlert(StatefulProcessor):
    """One row of state per rule: since when the limit is exceeded, whether it fires, the last value and its time."""

    def __init__(self, pending_ms: int):
        self.pending_ms = pending_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("alert", _STATE)

    def _fire(self, rule: str, since: int, value: int) -> Row:
        return Row(rule=rule, state="firing", at=_moment(since + self.pending_ms), value=value)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        since, firing, held, last = self.state.get() if self.state.exists() else (None, False, None, None)
        begun = since
        for row in sorted(rows, key=lambda r: (r["at"], r["value"])):
            now, above = _ms(row["at"]), row["value"] > row["row_limit"]
            if last is not None and now < last:
                continue
            last = now
            due = since is not None and not firing and (now - since > self.pending_ms or (above and now - since == self.pending_ms))
            if due:
                firing = True
                yield self._fire(key[0], since, held)
            if above:
                if since is None:
                    since = now
                    yield Row(rule=key[0], state="pending", at=_moment(now), value=row["value"])
                held = row["value"]
            elif since is not None:
                since, firing, held = None, False, None
                yield Row(rule=key[0], state="normal", at=_moment(now), value=row["value"])
        if begun != since:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
        if since is not None and not firing and begun != since:
            # A check at the very end of the time may still end it, so the timer waits for the moment after.
            self.handle.registerTimer(since + self.pending_ms + 1)
        self.state.update((since, firing, held, last))

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        since, firing, held, last = self.state.get()
        if since is not None and not firing and expiredTimerInfo.getExpiryTimeInMs() > since + self.pending_ms:
            self.state.update((since, True, held, last))
            yield self._fire(key[0], since, held)

    def close(self) -> None:
        pass


def watch_alerts(
    checks: DataFrame, pending_seconds: int, target: str, checkpoint: str, late: str = "0 seconds", trigger: dict | None = None,
) -> StreamingQuery:
    """The transitions of each rule of a stream of checks (rule, at, value, row_limit) to ``target``.

    A rule whose value exceeds its limit is pending; it fires once the limit was exceeded for ``pending_seconds``, told by later
    checks of the rule or by the watermark, and is normal again with the first value within the limit. A check at the
    very end of that time which is within the limit prevents it. Checks older than the last one of their rule are ignored,
    as are those without rule, time, value or limit. The state is one row per rule, kept in RocksDB.
    """
    spark = checks.sparkSession
    usable = checks.select(*CHECKS.names).na.drop("any").withWatermark("at", late)
    moves = usable.groupBy("rule").transformWithState(
        PendingAlert(pending_seconds * _SECOND), TRANSITIONS, "Append", "EventTime")
    run = store.run_id(spark, checkpoint)
    writer = moves.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, number: store.write_batch(batch, target, run, number))
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        return writer.trigger(**(trigger or {"availableNow": True})).start()
    finally:
        spark.conf.set(_PROVIDER, before)


def current_alerts(transitions: DataFrame) -> DataFrame:
    """The state each rule is in: its last transition."""
    last = F.max_by(F.struct(*transitions.columns), F.struct("at", F.expr("CASE state WHEN 'normal' THEN 0 WHEN 'pending' THEN 1 ELSE 2 END")))
    return transitions.groupBy("rule").agg(last.alias("row_")).select("row_.*")
