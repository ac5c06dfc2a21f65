"""Message bus: documents to messages, and reading or writing a topic.

A channel is a dict with ``format`` and the options of that format, for example
``{"format": "kafka", "kafka.bootstrap.servers": ..., "topic": ...}``. File
formats with a ``path`` work the same way and need no connector.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens.functions.privacy import iso_times

MESSAGE_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
])

# A micro-batch over files takes about so many bytes of them for each core; what it caches and shuffles is many times that.
CORE_BYTES = 16 << 20


def to_messages(df: DataFrame, key_col: str = "_id") -> DataFrame:
    """Key and JSON text of each document; times as ISO text, nulls kept."""
    key = F.coalesce(F.col(key_col).cast("string"), F.lit("")) if key_col in df.columns else F.lit("")
    texts = iso_times(df)
    body = F.to_json(F.struct(*[F.col(f"`{c}`") for c in texts.columns]), {"ignoreNullFields": "false"})
    return texts.select(key.alias("key"), body.alias("value"))


def _split(channel: dict[str, str]) -> tuple[str, dict[str, str]]:
    options = dict(channel)
    return options.pop("format"), options


def write_messages(messages: DataFrame, channel: dict[str, str]) -> None:
    """Send and return once everything is delivered."""
    fmt, options = _split(channel)
    messages.write.format(fmt).options(**options).mode("append").save()


def _reader_options(fmt: str, options: dict[str, str]) -> dict[str, str]:
    if fmt != "kafka":
        return options
    topic = {"subscribe": options.pop("topic")} if "topic" in options else {}
    return {"startingOffsets": "earliest", **topic, **options}


def _as_text(df: DataFrame) -> DataFrame:
    return df.select(F.col("key").cast("string"), F.col("value").cast("string"))


def read_messages(spark: SparkSession, channel: dict[str, str]) -> DataFrame:
    """All messages of a topic from its start, as a batch."""
    fmt, options = _split(channel)
    reader = spark.read.format(fmt).options(**_reader_options(fmt, options))
    return _as_text((reader if fmt == "kafka" else reader.schema(MESSAGE_SCHEMA)).load())


def bounded(spark: SparkSession, options: dict[str, str], core_bytes: int) -> dict[str, str]:
    """Options of a stream over files with a bound on its micro-batches, unless they name one."""
    if {"maxfilespertrigger", "maxbytespertrigger"} & {name.lower() for name in options}:
        return options
    return {**options, "maxBytesPerTrigger": str(core_bytes * spark.sparkContext.defaultParallelism)}


def stream_messages(spark: SparkSession, channel: dict[str, str]) -> DataFrame:
    """The same as a stream; its checkpoint keeps the position.

    Files are taken in micro-batches of bounded size. Other sources have an option of their own for that, such as
    ``maxOffsetsPerTrigger``, which belongs in the channel.
    """
    fmt, options = _split(channel)
    options = _reader_options(fmt, options)
    reader = spark.readStream.format(fmt).options(**(bounded(spark, options, CORE_BYTES) if "path" in options else options))
    return _as_text((reader if fmt == "kafka" else reader.schema(MESSAGE_SCHEMA)).load())
