"""Partitioned tables, named CSV files and JSON reports."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.operators import archive, audit
from storelens.sources import hadoop


def write_partition(df: DataFrame, path: str, column: str = "ds") -> None:
    """Write by day and replace only the days written."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(column)
        .parquet(path)
    )


def export_single_csv(
    df: DataFrame,
    directory: str,
    name: str,
    order: list[str] | None = None,
    clear: bool = True,
    single_file: bool = True,
) -> str:
    """Write ``{directory}/{name}.csv`` with header and no marker file.

    ``clear`` empties the directory first. Rows are written beside the target and
    renamed at the end. With ``single_file`` one task writes it all; without, the same
    name is a folder with one CSV file per task, whatever the number of rows.
    """
    spark = df.sparkSession
    target, staging = f"{directory}/{name}.csv", f"{directory}__tmp__/{name}"
    for old in (directory if clear else target, staging):
        if hadoop.exists(spark, old):
            hadoop.remove(spark, old)
    if single_file:
        # A shuffle into the file keeps the work before it parallel, unlike coalesce(1).
        one = df.repartition(1)
        shaped = one.sortWithinPartitions(*order) if order else one
    else:
        shaped = df.orderBy(*order) if order else df
    (
        shaped.write.mode("overwrite")
        .option("header", True)
        .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
        .csv(staging)
    )
    parts = [n for n in hadoop.data_files(spark, staging) if n.endswith(".csv")]
    if not parts:
        raise RuntimeError(f"no CSV file was written for {target}")
    hadoop.move(spark, f"{staging}/{parts[0]}" if single_file else staging, target)
    hadoop.remove(spark, f"{directory}__tmp__")
    return target


def export_recent_audit(
    log: DataFrame, now: datetime, directory: str, calendar_day: bool = False
) -> str:
    """CSV of the fresh audit rows in time order, named by the minute of the run."""
    stamp = now.strftime("%Y%m%d_%H%M")
    fresh = audit.recent_audit(log, now, calendar_day)
    order = ["changed_at", "user_id", "field_changed"]
    return export_single_csv(
        fresh, directory, f"users_audit_export_{stamp}", order=order, clear=False
    )


def write_csv_if_any(df: DataFrame, path: str) -> bool:
    if df.isEmpty():
        return False
    df.write.mode("overwrite").option("header", True).csv(path)
    return True


def write_archive_report(archived: DataFrame, directory: str, now: datetime) -> str | None:
    """``{date}_{time}.json`` with the counts and the folder ``{date}_{time}_ids``; None when nothing was archived.

    The folder holds the archived ids with their documents as JSON lines. Both are named by the time of the run, so
    every run of a day keeps its own and a repeated run replaces only what it wrote itself.
    """
    spark = archived.sparkSession
    name = now.strftime("%Y-%m-%d_%H%M%S")
    stem, counts = f"{directory}/{name}", archive.archive_counts(archived)
    counts.write.mode("overwrite").json(f"{stem}_ids")
    per_user = spark.read.schema(counts.schema).json(f"{stem}_ids")
    report = archive.archive_totals(per_user, now).withColumn("archived_user_ids_folder", F.lit(f"{name}_ids"))
    if report.isEmpty():
        hadoop.remove(spark, f"{stem}_ids")
        return None
    staging, target = f"{stem}__tmp__", f"{stem}.json"
    report.coalesce(1).write.mode("overwrite").json(staging)
    if hadoop.exists(spark, target):
        hadoop.remove(spark, target)
    part = next(n for n in hadoop.data_files(spark, staging) if n.endswith(".json"))
    hadoop.move(spark, f"{staging}/{part}", target)
    hadoop.remove(spark, staging)
    return target
