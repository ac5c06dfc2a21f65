"""File sources: sales CSV, JSON documents, partitioned tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens.sources import hadoop
from storelens.sources.specs import SALES_CSV_SCHEMA

BROKEN = "_broken"


def read_sales_csv(
    spark: SparkSession, path: str, schema: T.StructType = SALES_CSV_SCHEMA
) -> DataFrame:
    """Columns of ``schema`` by the names in the header, whatever their order; other columns are left out.

    A column that the header lacks is an error. A value that does not fit its type is NULL.
    """
    raw = spark.read.option("header", True).option("ignoreLeadingWhiteSpace", True).csv(path)
    found = {name.strip(): name for name in raw.columns}
    missing = [f.name for f in schema if f.name not in found]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    return raw.select(*[F.col(f"`{found[f.name]}`").try_cast(f.dataType).alias(f.name) for f in schema])


def read_json_documents(
    spark: SparkSession, directory: str, schema: T.StructType | None = None
) -> tuple[DataFrame, DataFrame]:
    """Documents of all ``*.json`` files, each an object or a list, and the broken files.

    Without a schema the files are read twice, once to find it.
    """
    reader = spark.read.option("multiLine", True).option("pathGlobFilter", "*.json")
    if schema is None:
        schema = reader.option("mode", "DROPMALFORMED").json(directory).schema
    wanted = [f for f in schema.fields if f.name != BROKEN]
    full = T.StructType([*wanted, T.StructField(BROKEN, T.StringType())])
    everything = (
        reader.schema(full)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", BROKEN)
        .json(directory)
    )
    names = [f"`{f.name}`" for f in wanted]
    documents = everything.where(F.col(BROKEN).isNull()).select(*names)
    # The reader refuses queries that need nothing but the text of broken records,
    # so the condition also looks at what could be read of them.
    readable = F.length(F.concat_ws("", *[F.to_json(F.struct(n)) for n in names])) >= 0
    broken = everything.where(F.col(BROKEN).isNotNull() & readable).select(
        F.col(BROKEN).alias("text"), F.col("_metadata.file_path").alias("file")
    )
    return documents, broken


def append_documents(df: DataFrame, path: str) -> int:
    """Append to a collection and return the number of documents written."""
    seen = Observation("appended")
    counted = df.observe(seen, F.count(F.lit(1)).alias("documents"))
    counted.write.mode("append").parquet(path)
    return seen.get["documents"]


def scan(df: DataFrame, condition: Column | None = None) -> DataFrame:
    """Collection scan; without a condition all rows."""
    return df if condition is None else df.where(condition)


def latest_partition(spark: SparkSession, path: str, column: str = "ds") -> str | None:
    """Greatest partition value that holds data, from the folder listing alone."""
    prefix = f"{column}="
    names = [n for n in hadoop.folder_names(spark, path) if n.startswith(prefix)]
    for name in sorted(names, reverse=True):
        if hadoop.data_files(spark, f"{path}/{name}"):
            return name[len(prefix):]
    return None


def read_latest_partition(
    spark: SparkSession, path: str, schema: T.StructType, column: str = "ds"
) -> DataFrame:
    """Only the newest day; ``schema`` keeps the partition value text."""
    newest = latest_partition(spark, path, column)
    table = spark.read.schema(schema).parquet(path)
    return table.where(F.col(column) == F.lit(newest))
