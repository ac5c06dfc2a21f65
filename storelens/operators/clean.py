"""Column naming, casting, null handling and profiles."""

from __future__ import annotations

import re

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from storelens.functions import convert


def snake_case(name: str) -> str:
    words = re.sub(r"[^\w\s]", " ", name).split()
    return "_".join(words).lower()


def snake_case_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*map(snake_case, df.columns))


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast by name; values that do not fit, NaN included, become NULL."""
    casts = {name: F.col(name).try_cast(dtype) for name, dtype in types.items()}
    return df.withColumns(casts)


def null_if_value(df: DataFrame, column: str, sentinel: object) -> DataFrame:
    return df.withColumn(column, convert.null_if(F.col(column), sentinel))


def require(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows in which all the named columns are present."""
    return df.na.drop(subset=columns)


def drop_incomplete(df: DataFrame) -> DataFrame:
    return df.na.drop("any")


def keep(df: DataFrame) -> DataFrame:
    """Cache for reuse; a lost block is recomputed from its source."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)


def null_profile(df: DataFrame, tests: dict[str, Column]) -> DataFrame:
    """One row with the number of rows that meet each test."""
    return df.agg(*[F.count_if(test).alias(name) for name, test in tests.items()])


def null_tests(columns: list[str], zero: tuple[str, ...] = ()) -> dict[str, Column]:
    """Tests for missing values; columns in ``zero`` count the value 0 as well."""
    tests = {}
    for name in columns:
        missing = F.col(name).isNull()
        tests[f"null_{name}"] = missing | (F.col(name) == 0) if name in zero else missing
    return tests


def compare_profiles(before: DataFrame, after: DataFrame, tests: dict[str, Column]) -> DataFrame:
    """Both profiles as ``(test, before, after)`` rows."""

    def tall(df: DataFrame, side: str) -> DataFrame:
        return null_profile(df, tests).unpivot([], list(tests), "test", side)

    return tall(before, "before").join(tall(after, "after"), "test")


def complete_flag(df: DataFrame) -> Column:
    whole = F.lit(True)
    for name in df.columns:
        whole = whole & F.col(f"`{name}`").isNotNull()
    return whole


def clean_counts(df: DataFrame) -> DataFrame:
    """Rows read, kept and removed by ``drop_incomplete``."""
    whole = complete_flag(df)
    return df.agg(
        F.count("*").alias("rows_read"),
        F.count_if(whole).alias("rows_kept"),
        F.count_if(~whole).alias("rows_removed"),
    )


def observed_clean(df: DataFrame, name: str = "cleaning") -> tuple[DataFrame, Observation]:
    """``drop_incomplete`` whose counts are known once the result has been written."""
    whole = complete_flag(df)
    seen = Observation(name)
    watched = df.observe(
        seen,
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(whole).alias("rows_kept"),
        F.count_if(~whole).alias("rows_removed"),
    )
    return watched.where(whole), seen
