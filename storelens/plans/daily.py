"""Entry points of the daily jobs, as functions and from the command line."""

from __future__ import annotations

import argparse
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens.operators import archive
from storelens.operators.features import FeatureConfig, customer_features
from storelens.session import build_session
from storelens.sources import hadoop
from storelens.sources.files import latest_partition, read_latest_partition
from storelens.sources.sinks import export_single_csv, write_archive_report, write_partition
from storelens.sources.tables import read_table


def run_features(
    spark: SparkSession,
    table_in: str,
    path_out: str,
    ds: str,
    as_of: datetime | None = None,
    config: FeatureConfig | None = None,
) -> None:
    """Flags of one day from the purchase table to ``path_out/ds=...``."""
    purchases = read_table(spark, table_in)
    write_partition(customer_features(purchases, ds, as_of, config), path_out)


def features_schema(spark: SparkSession, path: str) -> T.StructType:
    """Schema of the stored flags with ``ds`` as text."""
    found = spark.read.parquet(path).schema
    kept = [f for f in found if f.name != "ds"]
    return T.StructType([*kept, T.StructField("ds", T.StringType())])


def run_report(spark: SparkSession, path_in: str, directory: str, name: str) -> str:
    """Newest day of the flags as ``{name}_{ds}.csv``."""
    newest = latest_partition(spark, path_in)
    if newest is None:
        raise ValueError(f"no partition with data in {path_in}")
    report = read_latest_partition(spark, path_in, features_schema(spark, path_in))
    return export_single_csv(report, directory, f"{name}_{newest}")


_RUN = T.StructType([T.StructField("seen_until", T.TimestampType())])


def _runs(spark: SparkSession, root: str) -> list[str]:
    """Stamps of the finished archive runs, oldest first. A run is finished once its record is there."""
    if not hadoop.exists(spark, f"{root}/runs"):
        return []
    names = [n for n in hadoop.folder_names(spark, f"{root}/runs") if hadoop.data_files(spark, f"{root}/runs/{n}")]
    return sorted(n.removeprefix("run_at=") for n in names)


def current_events(spark: SparkSession, events_path: str, root: str) -> DataFrame:
    """The events that are not archived: what the last run kept, and what came to ``events_path`` after it."""
    arrived = spark.read.parquet(events_path) if hadoop.data_files(spark, events_path) else None
    runs = _runs(spark, root)
    if not runs:
        return arrived
    seen = spark.read.schema(_RUN).json(f"{root}/runs/run_at={runs[-1]}").first()["seen_until"]
    data = spark.read.option("basePath", f"{root}/data").parquet(f"{root}/data/run_at={runs[-1]}")
    kept = data.where("archived = 'false'").drop("run_at", "archived")
    if arrived is None:
        return kept
    return kept.unionByName(arrived.where(F.col("_metadata.file_modification_time") > F.lit(seen)).select(*kept.columns))


def read_archive(spark: SparkSession, root: str) -> DataFrame:
    """Archived events of all finished runs with the stamp of their run, ``run_at``."""
    runs = [f"{root}/data/run_at={stamp}" for stamp in _runs(spark, root)]
    stored = spark.read.option("basePath", f"{root}/data").parquet(*runs)
    return stored.where("archived = 'true'").drop("archived").withColumn("run_at", F.col("run_at").cast("string"))


def run_archive(
    spark: SparkSession, events_path: str, root: str, now: datetime, registered_days: int = 30, idle_days: int = 14,
) -> str | None:
    """Take the events of inactive users out of the current ones, into the archive, and report them.

    One pass writes both sides to ``root/data/run_at=<stamp>``, as partitions; no folder is moved. Then the report is written,
    and last the record ``root/runs/run_at=<stamp>``, from which on ``current_events`` and ``read_archive`` see the run.
    What a run that broke off before left behind is not seen and goes with the next run; files of ``events_path`` and kept
    rows that a finished run has replaced are deleted at its end or by the next run. A run that archives nobody changes
    nothing, a finished run is not repeated.
    """
    stamp = now.strftime("%Y%m%dT%H%M%S")
    _drop_replaced(spark, events_path, root)
    if stamp in _runs(spark, root):
        return None
    events = current_events(spark, events_path, root)
    stamps = hadoop.file_stamps(spark, events_path, "")
    seen = spark.range(1).select(F.timestamp_millis(F.lit(max((s[1] for s in stamps), default=0))).alias("seen_until"))
    target = f"{root}/data/run_at={stamp}"
    tagged = archive.tag_archived(events, archive.inactive_users(events, now, registered_days, idle_days))
    tagged.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("archived").parquet(target)
    written = spark.read.schema(tagged.schema).parquet(target)
    report = write_archive_report(written.where("archived"), f"{root}/reports", now)
    if report is None:
        hadoop.remove(spark, target)
        return None
    _finish_run(seen, f"{root}/runs/run_at={stamp}")
    _drop_replaced(spark, events_path, root)
    return report


def _finish_run(seen: DataFrame, path: str) -> None:
    seen.coalesce(1).write.mode("overwrite").json(path)


def _drop_replaced(spark: SparkSession, events_path: str, root: str) -> None:
    """Delete unfinished runs, kept rows of earlier runs and the files of ``events_path`` that the last run has read."""
    if not hadoop.exists(spark, f"{root}/data"):
        return
    runs = _runs(spark, root)
    for name in hadoop.folder_names(spark, f"{root}/data"):
        stamp, place = name.removeprefix("run_at="), f"{root}/data/{name}"
        if stamp not in runs:
            hadoop.remove(spark, place)
        elif stamp != runs[-1] and hadoop.exists(spark, f"{place}/archived=false"):
            hadoop.remove(spark, f"{place}/archived=false")
    if runs:
        record = spark.read.schema(_RUN).json(f"{root}/runs/run_at={runs[-1]}")
        until = record.select(F.unix_millis("seen_until")).first()[0]
        for name, changed, _ in hadoop.file_stamps(spark, events_path, ""):
            if changed <= until:
                hadoop.remove(spark, f"{events_path}/{name}")


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="storelens")
    jobs = parser.add_subparsers(dest="job", required=True)
    features = jobs.add_parser("features")
    features.add_argument("--table-in", required=True)
    features.add_argument("--path-out", required=True)
    features.add_argument("--ds", required=True, help="day as yyyyMMdd")
    report = jobs.add_parser("report")
    report.add_argument("--path-in", required=True)
    report.add_argument("--directory", required=True)
    report.add_argument("--file-name", required=True)
    cleanup = jobs.add_parser("archive")
    cleanup.add_argument("--events-path", required=True)
    cleanup.add_argument("--root", required=True)
    cleanup.add_argument("--now", required=True, help="ISO time of the run")
    args = parser.parse_args(argv)
    spark = build_session(f"storelens-{args.job}")
    if args.job == "features":
        run_features(spark, args.table_in, args.path_out, args.ds)
    elif args.job == "report":
        run_report(spark, args.path_in, args.directory, args.file_name)
    else:
        run_archive(spark, args.events_path, args.root, datetime.fromisoformat(args.now))


if __name__ == "__main__":
    main()
