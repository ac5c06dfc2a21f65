"""From raw documents to packed training sequences, as stages that each call one corpus operator."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from storelens.llm import bag_minhash, exact_dedup, packing, quality, source_mixing
from storelens.llm.common import release, ship, tokenizer_path
from storelens.session import ensure_checkpoint_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier rejects go; it learns from ``labels``."""
    ship(spark)
    return quality.drop_poor(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group with the same text stays, the one with the largest id."""
    release(spark)
    return exact_dedup.drop_exact(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near duplicates stays, the one with the smallest id."""
    ship(spark)
    release(spark)
    return bag_minhash.drop_near(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mixture takes it."""
    ship(spark)
    release(spark)
    return source_mixing.resample(docs)


def best_fit(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as pieces with their place in sequences of 2048 tokens."""
    ship(spark)
    release(spark)
    return packing.packed(docs, tokenizer_path(), kept=300_000, slice_bytes=2_000_000)


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_quality),
    ("exact_dedup", exact_copies),
    ("near_dedup", near_copies),
    ("source_mix", source_mix),
    ("best_fit", best_fit),
]

# The classifier, the signatures and the tokenizer have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage is written to the shared folder and read again."""
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES, 1):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
