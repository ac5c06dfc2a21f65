"""From JSON files to typed tables: collection, topic, raw table, typed table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from storelens.functions.privacy import mask_pii
from storelens.sources import files, hadoop, messages
from storelens.sources.specs import SPECS
from storelens.streaming import jobs


def load_documents(
    spark: SparkSession, directory: str, collection_path: str, schema: T.StructType | None = None
) -> int:
    """Append the documents of all JSON files to the collection; broken files are skipped."""
    documents, _ = files.read_json_documents(spark, directory, schema)
    return files.append_documents(documents, collection_path)


def publish_documents(
    collection: DataFrame,
    channel: dict[str, str],
    condition: Column | None = None,
    key_col: str = "_id",
) -> int:
    """Send the documents with hashed personal data and return how many were sent."""
    sent = Observation("published")
    masked = mask_pii(files.scan(collection, condition))
    outgoing = messages.to_messages(masked, key_col)
    messages.write_messages(outgoing.observe(sent, F.count(F.lit(1)).alias("documents")), channel)
    return sent.get["documents"]


def stream_collection(
    spark: SparkSession, collection: str, channel: dict[str, str], root: str, trigger: dict | None = None
) -> StreamingQuery:
    """Start the raw table of a collection and, from it, its typed table; gives the latter.

    With the default trigger landing is worked off first, so one call takes a message
    all the way. A running trigger keeps both queries alive.
    """
    place = f"{root}/{collection}"
    hadoop.make_folder(spark, f"{place}/raw")  # the typed stream may look before anything has landed
    landing = jobs.stream_raw(
        messages.stream_messages(spark, channel),
        f"{place}/raw", f"{place}/rejects", f"{place}/checkpoints/raw", trigger,
    )
    if trigger is None:
        landing.awaitTermination()
    raw = jobs.read_raw_stream(spark, f"{place}/raw")
    return jobs.stream_parse(
        raw, SPECS[collection], f"{place}/typed", f"{place}/checkpoints/typed", trigger
    )
