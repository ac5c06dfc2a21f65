"""Session settings and the few driver-side helpers every job shares."""

from __future__ import annotations

import gc
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings a cluster job should start with. AQE sizes the reducers, so the
# shuffle partition number is only the upper bound it coalesces from.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "snappy",
    # The default form of a timestamp has no statistics, so no file or row group could be skipped by time.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # Checkpointed rows go once nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(name: str, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Checkpoint folder of the session; only local mode may fall back to a temp folder."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="storelens-checkpoint-")
    context.setCheckpointDir(shared)
    return shared


def release(spark: SparkSession) -> None:
    """Lets Spark delete shuffle files and cached rows that neither Python nor the driver refers to any more.

    What Python let go of reaches the driver up to a second late and goes with the next call.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder once and read it back from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
