"""Tables that micro-batches add to: safe to repeat, laid out so that reads can skip files, and compacted.

A batch is a folder ``run=<run>/batch=<number>``. Writing a batch again replaces it. ``compact`` merges the batches that can no longer be
written again into a base, a batch of the run ``base``. A base counts from the moment its cover list is there, which names the
last batch of each run that went into it; folders a live base covers are not read any more, deleted or not. So a job that breaks
off at any point leaves a table that reads the same as before or after it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens.sources import hadoop

BASE = "base"
BUCKET = "bucket_"
PARTS = 64
# So many bases are kept side by side before a compaction also merges them, so a row is rewritten seldom.
MOST_BASES = 8
# The keys of a batch up to this number go to the scan as values, which lets it skip row groups by statistics and Bloom filters.
POINT_KEYS = 1000

# These tables are kept, and JSON texts take less than half of what they take under the codec of the session.
CODEC = "zstd"

_COVER = T.StructType([T.StructField("run", T.StringType()), T.StructField("upto", T.LongType())])


@dataclass(frozen=True)
class Layout:
    """Columns of a table and how its rows lie: folders by ``day``, or hash buckets sorted by ``key``, or plain files."""

    schema: T.StructType
    day: str | None = None
    key: str | None = None
    buckets: int = 64

    def bucket(self):
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")


def run_id(spark: SparkSession, checkpoint: str) -> str:
    """Name of the run that owns ``checkpoint``; a new checkpoint gets a new name.

    Batch numbers restart with a new checkpoint, so they are unique only within a run.
    """
    marker = f"{checkpoint}/_run"
    if hadoop.exists(spark, marker):
        return spark.read.text(marker).first()[0]
    name = uuid.uuid4().hex
    spark.range(1).select(F.lit(name).alias("value")).coalesce(1).write.text(marker)
    return name


def write_batch(df: DataFrame, path: str, run: str, batch: int, layout: Layout | None = None) -> None:
    """Write one micro-batch; writing the same batch again replaces it.

    Rows of a keyed table are dealt by bucket and a part of the key's hash, so a large bucket is no single task and a
    small batch no more than one file a bucket. A base is split by ranges instead, whose statistics exclude each other.
    """
    writer = df.write
    if layout is not None and layout.key:
        placed = df.withColumn(BUCKET, layout.bucket())
        part = F.shiftright(F.xxhash64(layout.key), 32) % PARTS
        dealt = placed.repartitionByRange(BUCKET, layout.key) if run == BASE else placed.repartition(F.col(BUCKET), part)
        writer = dealt.sortWithinPartitions(BUCKET, layout.key).write.partitionBy(BUCKET)
        # Filters as large as their keys ask for; else each takes the 1 MB allowed to it, however few rows its file has.
        bloom = {f"enabled#{layout.key}": "true", "adaptive.enabled": "true", f"candidates.number#{layout.key}": "10"}
        writer = writer.options(**{f"parquet.bloom.filter.{name}": value for name, value in bloom.items()})
    elif layout is not None and layout.day:
        writer = df.repartition(layout.day).write.partitionBy(layout.day)
    target = f"{path}/run={run}/batch={batch}"
    writer.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", CODEC).parquet(target)


def batches(spark: SparkSession, path: str) -> set[tuple[str, int]]:
    """All (run, batch) folders."""
    if not hadoop.exists(spark, path):
        return set()
    runs = [n.removeprefix("run=") for n in hadoop.folder_names(spark, path) if n.startswith("run=")]
    return {
        (run, int(n.removeprefix("batch=")))
        for run in runs for n in hadoop.folder_names(spark, f"{path}/run={run}") if n.startswith("batch=")
    }


def _covers(spark: SparkSession, path: str) -> dict[int, dict[str, int]]:
    """For each base with a cover list the last batch of each run that is in it."""
    if not hadoop.exists(spark, f"{path}/_covered"):
        return {}
    found = {}
    for name in hadoop.folder_names(spark, f"{path}/_covered"):
        if hadoop.data_files(spark, f"{path}/_covered/{name}"):
            rows = spark.read.schema(_COVER).json(f"{path}/_covered/{name}").collect()
            found[int(name)] = {r["run"]: r["upto"] for r in rows}
    return found


def _live(spark: SparkSession, path: str) -> set[tuple[str, int]]:
    """Batches and bases to be read."""
    covers = _covers(spark, path)
    gone: dict[str, int] = {}
    for cover in covers.values():
        for run, upto in cover.items():
            gone[run] = max(gone.get(run, -1), upto)
    return {
        (run, number) for run, number in batches(spark, path)
        if number > gone.get(run, -1) and (run != BASE or number in covers)
    }


def _read(spark: SparkSession, path: str, layout: Layout, wanted: set[tuple[str, int]]) -> DataFrame:
    fields = list(layout.schema.fields) + ([T.StructField(BUCKET, T.IntegerType())] if layout.key else [])
    full = T.StructType(fields)
    if not wanted:
        return spark.createDataFrame([], full)
    folders = [f"{path}/run={run}/batch={number}" for run, number in sorted(wanted)]
    return spark.read.schema(full).option("basePath", path).parquet(*folders).select(*full.names)


def read_store(
    spark: SparkSession, path: str, layout: Layout | T.StructType, without: tuple[str, int] | None = None
) -> DataFrame:
    """Rows of all live batches; none when nothing was written yet.

    ``without`` leaves out one (run, batch), which a retry must not see.
    """
    layout = layout if isinstance(layout, Layout) else Layout(layout)
    return _read(spark, path, layout, _live(spark, path) - {without}).select(*layout.schema.names)


def stored_keys(batch: DataFrame, path: str, layout: Layout, without: tuple[str, int] | None = None) -> DataFrame:
    """The stored rows' keys that can be among those of ``batch``: only the buckets of its keys are opened.

    At most ``buckets`` numbers reach the driver, and up to ``POINT_KEYS`` keys, which are then looked up as values.
    """
    spark = batch.sparkSession
    stored = _read(spark, path, layout, _live(spark, path) - {without})
    buckets = [r[0] for r in batch.select(layout.bucket().alias(BUCKET)).distinct().collect()]
    stored = stored.where(F.col(BUCKET).isin(buckets)).select(layout.key)
    keys = [r[0] for r in batch.select(layout.key).where(F.col(layout.key).isNotNull()).limit(POINT_KEYS + 1).collect()]
    return stored.where(F.col(layout.key).isin(keys)) if len(keys) <= POINT_KEYS else stored


def absent(batch: DataFrame, path: str, layout: Layout, without: tuple[str, int] | None = None) -> DataFrame:
    """Rows of ``batch`` whose key is not stored; ``batch`` is read several times, so cache it.

    The stored keys are cut down to those of the batch first, so the anti join meets no more keys than the batch has.
    """
    known = stored_keys(batch, path, layout, without).join(batch.select(layout.key), layout.key, "left_semi")
    return batch.join(known, layout.key, "left_anti").select(*batch.columns)


def compact(
    spark: SparkSession, path: str, layout: Layout, merge: Callable[[DataFrame], DataFrame] | None = None, whole: bool = False,
) -> bool:
    """Merge finished batches into a base, and all bases as well when there are too many or ``whole`` is set.

    The last batch of each run is left alone, as only that one may be written again. ``merge`` folds rows that belong
    together and must give the same whichever rows were folded before. Gives whether anything was merged. Let no reader
    keep a table open over a compaction, which deletes what the base replaces.
    """
    clean_up(spark, path)
    live = _live(spark, path)
    last = {run: max(n for r, n in live if r == run) for run, _ in live}
    pending = {(run, n) for run, n in live if run != BASE and n < last[run]}
    bases = {(run, n) for run, n in live if run == BASE}
    whole = len(bases) > 1 if whole or len(bases) + 1 > MOST_BASES else False
    if not pending and not whole:
        return False
    sources = pending | (bases if whole else set())
    rows = _read(spark, path, layout, sources).select(*layout.schema.names)
    number = max([*_covers(spark, path), -1]) + 1
    write_batch(merge(rows) if merge else rows, path, BASE, number, layout)
    cover = [(run, max(n for r, n in sources if r == run)) for run in {run for run, _ in sources}]
    _write_cover(spark, path, number, cover)  # from here on the base counts
    clean_up(spark, path)
    return True


def _write_cover(spark: SparkSession, path: str, number: int, cover: list[tuple[str, int]]) -> None:
    spark.createDataFrame(cover, _COVER).coalesce(1).write.mode("overwrite").json(f"{path}/_covered/{number}")


def clean_up(spark: SparkSession, path: str) -> None:
    """Delete what live bases cover, also what an earlier run left behind."""
    live = _live(spark, path)
    covers = _covers(spark, path)
    for run, number in batches(spark, path) - live:
        if run != BASE or number in covers:
            hadoop.remove(spark, f"{path}/run={run}/batch={number}")
    # The list of a covered base goes only when nothing it covers is left.
    for number in covers:
        if (BASE, number) not in live and (BASE, number) not in batches(spark, path):
            hadoop.remove(spark, f"{path}/_covered/{number}")


def expire_days(spark: SparkSession, path: str, layout: Layout, keep_from: str) -> int:
    """Remove the folders of days before ``keep_from`` (as written in folder names) from every batch; gives how many."""
    removed = 0
    for run, number in batches(spark, path):
        removed += expire(spark, f"{path}/run={run}/batch={number}", layout.day, keep_from)
    return removed


def expire(spark: SparkSession, path: str, column: str, keep_from: str) -> int:
    """Remove the partition folders of ``column`` below ``keep_from``; gives how many."""
    prefix = f"{column}="
    old = [
        n for n in hadoop.folder_names(spark, path)
        if n.startswith(prefix) and n[len(prefix):] < keep_from
    ]
    for name in old:
        hadoop.remove(spark, f"{path}/{name}")
    return len(old)
