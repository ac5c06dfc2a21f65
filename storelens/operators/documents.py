"""Landing of raw JSON messages and their typed form."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.functions import convert, documents
from storelens.functions.rowhash import row_hash
from storelens.sources.specs import TableSpec

_ID_SCHEMA = documents.document_schema({"_id": "text"})


def check_messages(messages: DataFrame) -> DataFrame:
    """Messages with their document id and ``valid``; base of both functions below."""
    texts = messages.select(F.col("value").cast("string").alias("value"))
    return documents.opened(texts, F.col("value"), _ID_SCHEMA)


def landed(checked: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Valid messages as ``(id, full_data, created_at)``; ``as_of`` fixes the arrival time."""
    return checked.where("valid").select(
        F.coalesce("document._id", F.lit("")).alias("id"),
        F.col("value").alias("full_data"),
        convert.at(as_of).alias("created_at"),
    )


def rejected(checked: DataFrame) -> DataFrame:
    return checked.where("NOT valid").select("value")


def land_raw(messages: DataFrame, as_of: datetime | None = None) -> DataFrame:
    return landed(check_messages(messages), as_of)


def parse_documents(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """Typed columns of ``spec`` and ``row_hash`` for each valid document of ``full_data``."""
    schema = documents.document_schema({f.path: f.kind for f in spec.fields})
    read = documents.opened(raw.select("full_data"), F.col("full_data"), schema)
    typed = read.where("valid").select(
        *[
            documents.typed(F.col(f"document.{f.path}"), f.kind).alias(f.name)
            for f in spec.fields
        ]
    )
    return typed.withColumn("row_hash", row_hash(typed.schema, spec.hashed))
