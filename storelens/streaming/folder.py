"""A folder into which CSV files are dropped: complete rows to an output, files to an archive, by a ledger of files.

What is new is decided by the ledger alone: a file is a name, the time of its last change and its length. So a name may be used
again, and a round that broke off is finished by the next one from what the ledger says, without guessing.
"""

from __future__ import annotations

import csv
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from storelens.operators import clean
from storelens.sources import hadoop
from storelens.streaming import store

# state: 'read' for a file whose rows are taken, otherwise why it is left where it lies.
LEDGER = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("changed", T.LongType()),
    T.StructField("length", T.LongType()),
    T.StructField("label", T.StringType()),
    T.StructField("header", T.StringType()),
    T.StructField("state", T.StringType()),
])
_STAMP = T.StructType(LEDGER.fields[:3])
_DONE = T.StructType([T.StructField("round", T.LongType())])
RUN = "folder"


def load_csv_folder(
    spark: SparkSession, folder: str, output: str, archive: str, ledger: str, schema: T.StructType, max_files: int = 100,
) -> int:
    """Works off the ``*.csv`` files of ``folder`` and gives how many were read; at most ``max_files`` are taken a round.

    Columns are found by the names in each file's header, in any order; other columns are left out and values that
    do not fit are NULL. Rows with a NULL are dropped. ``output`` is partitioned by ``source_file``, the file's label: its name,
    or for a name used before its name with a number. Then the file moves to ``archive`` under its label, also when it has no
    rows. A file without header, or whose header lacks a column or names one twice, stays where it is and is
    in the ledger with the reason; a changed file is a new one. Run one loader per folder.
    """
    _finish(spark, folder, output, archive, ledger, schema)
    taken = 0
    while True:
        number = _next_round(spark, folder, ledger, schema, max_files)
        if number is None:
            return taken
        taken += _finish(spark, folder, output, archive, ledger, schema)


def csv_folder_stream(
    spark: SparkSession, folder: str, output: str, archive: str, ledger: str, schema: T.StructType, checkpoint: str,
    max_files: int = 100, every: str = "10 seconds",
) -> StreamingQuery:
    """``load_csv_folder`` again and again until the query is stopped."""
    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()

    def look(batch: DataFrame, number: int) -> None:
        load_csv_folder(spark, folder, output, archive, ledger, schema, max_files)

    writer = ticks.writeStream.foreachBatch(look).option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=every).start()


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    return store.read_store(spark, f"{ledger}/taken", LEDGER)


def _next_round(
    spark: SparkSession, folder: str, ledger: str, schema: T.StructType, max_files: int
) -> int | None:
    """Enters the oldest new files into the ledger and gives the number of the round; None without any."""
    listed = spark.createDataFrame(hadoop.file_stamps(spark, folder, ".csv"), _STAMP)
    known = read_ledger(spark, ledger)
    new = listed.join(known, _STAMP.names, "left_anti").orderBy("changed", "name").limit(max_files).collect()
    if not new:
        return None
    names = spark.createDataFrame([(r["name"],) for r in new], "name string")
    used = {r["name"]: r["count"] for r in known.where("state = 'read'").join(F.broadcast(names), "name").groupBy("name").count().collect()}
    rows = []
    for row in new:
        header, state = _header(hadoop.first_line(spark, f"{folder}/{row['name']}"), schema)
        times = used.get(row["name"], 0)
        stem = row["name"].removesuffix(".csv")
        label = row["name"] if not times else f"{stem}.{times}.csv"
        rows.append((row["name"], row["changed"], row["length"], label, json.dumps(header), state))
    number = max((n for _, n in store.batches(spark, f"{ledger}/taken")), default=-1) + 1
    store.write_batch(spark.createDataFrame(rows, LEDGER).coalesce(1), f"{ledger}/taken", RUN, number)
    return number


def _header(line: str | None, schema: T.StructType) -> tuple[list[str], str]:
    if not line or not line.strip():
        return [], "no header"
    names = [name.strip() for name in next(csv.reader([line]))]
    lacking = [f.name for f in schema if f.name not in names]
    if lacking:
        return names, f"no column {', '.join(lacking)}"
    twice = [f.name for f in schema if names.count(f.name) > 1]
    return names, f"several columns {', '.join(twice)}" if twice else "read"


def _finish(
    spark: SparkSession, folder: str, output: str, archive: str, ledger: str, schema: T.StructType
) -> int:
    """Writes and archives what open rounds of the ledger have taken."""
    done = {n for _, n in store.batches(spark, f"{ledger}/done")}
    rounds = sorted(n for _, n in store.batches(spark, f"{ledger}/taken") if n not in done)
    count = 0
    for number in rounds:
        entries = [r for r in spark.read.schema(LEDGER).parquet(f"{ledger}/taken/run={RUN}/batch={number}").collect() if r["state"] == "read"]
        there = {(n, t, size) for n, t, size in hadoop.file_stamps(spark, folder, ".csv")}
        # A file that is gone or was replaced since: either its rows are written, as it is archived only then, or it was taken away.
        here = [r for r in entries if (r["name"], r["changed"], r["length"]) in there]
        if here:
            _write(spark, folder, output, here, schema)
        for row in here:
            hadoop.move(spark, f"{folder}/{row['name']}", f"{archive}/{row['label']}")
        store.write_batch(spark.createDataFrame([(number,)], _DONE).coalesce(1), f"{ledger}/done", RUN, number)
        count += len(here)
    return count


def _write(spark: SparkSession, folder: str, output: str, files: list[T.Row], schema: T.StructType) -> None:
    """Complete rows of the files, those of one header read together; a file written before is replaced."""
    labels = F.broadcast(spark.createDataFrame([(r["name"], r["label"]) for r in files], "name_ string, source_file string"))
    by_header: dict[str, list[str]] = {}
    for row in files:
        by_header.setdefault(row["header"], []).append(f"{folder}/{row['name']}")
    parts = []
    for header, paths in by_header.items():
        names = json.loads(header)
        # Names by place, as other columns of a file may repeat or clash.
        raw = spark.read.schema(T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))]))
        raw = raw.option("header", True).option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True)
        columns = [F.col(f"c{names.index(f.name)}").try_cast(f.dataType).alias(f.name) for f in schema]
        path = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
        name = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
        parts.append(raw.csv(paths).select(*columns, name.alias("name_")))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    labelled = clean.drop_incomplete(rows).join(labels, "name_").drop("name_")
    (
        labelled.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("header", True)
        .partitionBy("source_file")
        .csv(output)
    )
