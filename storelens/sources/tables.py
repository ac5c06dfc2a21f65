"""Catalog and JDBC tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def read_jdbc(
    spark: SparkSession,
    options: dict[str, str],
    key: str,
    lower: int,
    upper: int,
    partitions: int,
) -> DataFrame:
    """JDBC table read in parallel by ranges of a numeric key."""
    ranges = {
        "partitionColumn": key,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }
    return spark.read.format("jdbc").options(**options, **ranges).load()


def list_databases(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW DATABASES")


def list_tables(spark: SparkSession) -> DataFrame:
    """Tables of every database of the current catalog."""
    names = [d.name for d in spark.catalog.listDatabases()]
    shown = [spark.sql(f"SHOW TABLES IN `{n}`") for n in names]
    return reduce(DataFrame.unionByName, shown).where("NOT isTemporary")


def create_if_absent(spark: SparkSession, schemas: Mapping[str, T.StructType]) -> None:
    for name, schema in schemas.items():
        if not spark.catalog.tableExists(name):
            spark.catalog.createTable(name, schema=schema, source="parquet")


def reset_tables(spark: SparkSession, schemas: Mapping[str, T.StructType]) -> None:
    """Drop the tables with all their rows and create them empty."""
    for name in schemas:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    create_if_absent(spark, schemas)


def run_collections(mapping: Mapping[str, dict], step: Callable[..., object]) -> dict[str, object]:
    """Run one step per collection; the mapping gives its keyword arguments."""
    return {collection: step(collection, **settings) for collection, settings in mapping.items()}
