"""Layout, compaction and expiry of the tables that streams write, the ledger of a CSV folder, and alerts."""

import json
import os
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens.operators import relay, rollup
from storelens.sources import hadoop, messages
from storelens.sources.specs import PURCHASES
from storelens.streaming import alerts, folder, jobs, outbox, store

KEYS = store.Layout(T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType())]), key="k", buckets=16)


def frame(spark, rows):
    return spark.createDataFrame(rows, KEYS.schema)


def values(df):
    return sorted(tuple(r) for r in df.collect())


def data_files(root):
    return [os.path.join(d, n) for d, _, names in os.walk(root) for n in names if n.endswith(".parquet")]


def test_a_batch_opens_only_its_buckets(spark, tmp_path):
    path = str(tmp_path / "t")
    store.write_batch(frame(spark, [(f"k{i}", i) for i in range(2000)]), path, "r", 0, KEYS)
    batch = frame(spark, [("k5", 1), ("new", 2), (None, 3)])
    opened = store.stored_keys(batch, path, KEYS)
    buckets = {r[0] for r in batch.select(KEYS.bucket()).collect()}
    assert [r["k"] for r in opened.collect()] == ["k5"]
    scan = opened._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert 0 < scan.metrics().get("numFiles").get().value() <= len(buckets) < len(data_files(path))
    plan = opened._jdf.queryExecution().executedPlan().toString()
    filters = [line for line in plan.splitlines() if "PartitionFilters" in line]
    assert filters and store.BUCKET in filters[0].split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "In(k, [" in plan
    assert sorted(store.absent(batch, path, KEYS).collect(), key=str) == [("new", 2), (None, 3)]


def test_files_of_a_keyed_table_are_as_small_as_their_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    store.write_batch(frame(spark, [(f"k{i}", i) for i in range(2000)]), path, "r", 0, KEYS)
    assert max(os.path.getsize(f) for f in data_files(path)) < 20_000


def test_many_keys_are_joined_without_values(spark, tmp_path):
    path = str(tmp_path / "t")
    store.write_batch(frame(spark, [(f"k{i}", i) for i in range(3000)]), path, "r", 0, KEYS)
    batch = frame(spark, [(f"k{i}", i) for i in range(1500, 4500)])
    assert "In(k" not in store.stored_keys(batch, path, KEYS)._jdf.queryExecution().executedPlan().toString()
    assert store.absent(batch, path, KEYS).count() == 1500


def test_compaction_keeps_rows_and_bounds_files(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(f"k{i}", i) for i in range(300)]
    for number in range(12):
        store.write_batch(frame(spark, rows[number * 25:][:25]), path, "r", number, KEYS)
    before = len(data_files(path))
    assert store.compact(spark, path, KEYS)
    assert not store.compact(spark, path, KEYS)
    assert values(store.read_store(spark, path, KEYS)) == sorted(rows)
    assert {run for run, _ in store.batches(spark, path)} == {"r", store.BASE}
    assert store.batches(spark, path) == {("r", 11), (store.BASE, 0)}
    assert len(data_files(path)) < before / 3
    # The last batch may be written again, also with other rows.
    store.write_batch(frame(spark, rows[275:290]), path, "r", 11, KEYS)
    assert store.read_store(spark, path, KEYS).count() == 290


def test_bases_are_merged_when_there_are_many(spark, tmp_path):
    path = str(tmp_path / "t")
    for number in range(store.MOST_BASES + 3):
        store.write_batch(frame(spark, [(f"k{number}", number)]), path, "r", number, KEYS)
        store.compact(spark, path, KEYS)
    assert len([1 for run, _ in store.batches(spark, path) if run == store.BASE]) <= store.MOST_BASES
    assert store.read_store(spark, path, KEYS).count() == store.MOST_BASES + 3
    assert store.compact(spark, path, KEYS, whole=True)
    assert [run for run, _ in store.batches(spark, path)].count(store.BASE) == 1
    assert store.read_store(spark, path, KEYS).count() == store.MOST_BASES + 3


@pytest.mark.parametrize("step", ["write_batch", "cover", "clean_up"])
def test_a_broken_compaction_reads_the_same(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "t")
    for number in range(4):
        store.write_batch(frame(spark, [(f"k{number}", number)]), path, "r", number, KEYS)
    wanted = values(store.read_store(spark, path, KEYS))
    calls = {"clean_up": 0}

    def broken(*args, **kwargs):
        raise OSError("gone")

    def second_time(*args):
        calls["clean_up"] += 1
        if calls["clean_up"] == 2:
            raise OSError("gone")

    with monkeypatch.context() as patch:
        if step == "write_batch":
            patch.setattr(store, "write_batch", broken)
        elif step == "cover":
            patch.setattr(store, "_write_cover", broken)
        else:
            patch.setattr(store, "clean_up", second_time)
        with pytest.raises(Exception):  # noqa: B017
            store.compact(spark, path, KEYS)
    assert values(store.read_store(spark, path, KEYS)) == wanted
    store.compact(spark, path, KEYS)
    assert values(store.read_store(spark, path, KEYS)) == wanted
    assert store.batches(spark, path) == {("r", 3), (store.BASE, 0)}


def test_typed_table_after_fifty_batches(spark, tmp_path):
    path = str(tmp_path / "typed")
    documents = [json.dumps({"_id": str(i), "purchase_id": f"P{i % 60}"}) for i in range(100)]
    raw = [spark.createDataFrame([(d,) for d in documents[n * 2:n * 2 + 2]], "full_data string") for n in range(50)]
    for number, batch in enumerate(raw):
        jobs.add_typed(batch, PURCHASES, path, "r", number)
        if number % 20 == 19:
            jobs.compact_typed(spark, PURCHASES, path)
    layout = jobs.typed_layout(PURCHASES)
    assert sorted(r["purchase_id"] for r in store.read_store(spark, path, layout).collect()) == sorted(f"p{i}" for i in range(60))
    jobs.add_typed(raw[49], PURCHASES, path, "r", 49)
    for number in range(3):
        jobs.add_typed(raw[number * 7], PURCHASES, path, "again", number)
    assert store.read_store(spark, path, layout).count() == 60


def test_logins_do_not_depend_on_how_the_stream_is_cut(spark, tmp_path):
    draw = random.Random(3)
    start = datetime(2024, 1, 1)
    rows = [(i % 8, draw.randrange(3), draw.choice(["in", "out"]), start + timedelta(hours=draw.randrange(5)) if draw.random() < 0.8 else None) for i in range(60)]
    schema = "id long, user_id long, event_type string, event_timestamp timestamp"
    wanted = None
    for cuts in ([60], [1] * 10 + [50], [20, 20, 20], [7] * 8 + [4]):
        path, at = str(tmp_path / str(len(cuts))), 0
        for number, size in enumerate(cuts):
            sent = relay.login_messages(spark.createDataFrame(rows[at:at + size], schema))
            jobs.add_logins(sent, path, f"{path}-bad", "r", number)
            at += size
        found = [values(jobs.read_logins(spark, path).drop("processed_at").select("id", "user_id", "event_type", F.col("event_timestamp").cast("string")))]
        jobs.compact_logins(spark, path)
        found.append(values(jobs.read_logins(spark, path).drop("processed_at").select("id", "user_id", "event_type", F.col("event_timestamp").cast("string"))))
        wanted = wanted or found[0]
        assert found == [wanted, wanted] and len(wanted) == 8


def test_later_version_first_then_earlier_one(spark, tmp_path):
    path = str(tmp_path / "t")
    for number, hour in enumerate((10, 9)):
        sent = spark.createDataFrame([(1, 1, "in", datetime(2024, 1, 1, hour))], "id long, user_id long, event_type string, event_timestamp timestamp")
        jobs.add_logins(relay.login_messages(sent), path, f"{path}-bad", "r", number)
    assert [r["event_timestamp"].hour for r in jobs.read_logins(spark, path).collect()] == [9]


def test_states_of_a_day_are_merged_and_expire(spark, tmp_path):
    path = str(tmp_path / "states")
    start = datetime(2024, 1, 1)
    rows = [(i * 7919 % 5000, "buy" if i % 3 else "view", i, start + timedelta(days=i % 3)) for i in range(20_000)]
    events = spark.createDataFrame(rows, "user_id long, event_type string, points_spent long, event_time timestamp").cache()
    for number in range(100):
        store.write_batch(
            rollup.event_states(events.where(F.col("points_spent") % 100 == number).coalesce(1)), path, "r", number, jobs.STATES)
    before = values(rollup.merge_states(store.read_store(spark, path, jobs.STATES)))
    assert jobs.compact_states(spark, path)
    assert values(rollup.merge_states(store.read_store(spark, path, jobs.STATES))) == before
    per_day = [f for f in data_files(path) if "event_date=2024-01-02" in f]
    assert len(per_day) <= 2
    assert jobs.expire_states(spark, path, date(2024, 1, 3)) == 4
    left = values(rollup.merge_states(store.read_store(spark, path, jobs.STATES)))
    assert left == [r for r in before if r[0] >= date(2024, 1, 3)]


ROW = T.StructType([T.StructField("id", T.StringType()), T.StructField("name", T.StringType())])


class Drop:
    """A folder of CSV files and its loader."""

    def __init__(self, spark, root):
        self.spark, self.root, self.places = spark, root, [root / n for n in ("in", "out", "archive", "ledger")]
        self.places[0].mkdir()

    def put(self, name, text, at=None):
        file = self.places[0] / name
        file.write_text(text, encoding="utf-8")
        if at:
            os.utime(file, (at, at))

    def load(self, **options):
        return folder.load_csv_folder(self.spark, *map(str, self.places), ROW, **options)

    def rows(self):
        if not self.places[1].exists():
            return []
        return values(self.spark.read.option("header", True).csv(str(self.places[1])).select("id", "name", "source_file"))

    def names(self, place):
        folder_ = self.places[place]
        return sorted(p.name for p in folder_.iterdir() if not p.name.startswith(".")) if folder_.exists() else []


def test_csv_folder_reads_by_header_and_reuses_names(spark, tmp_path):
    drop = Drop(spark, tmp_path)
    drop.put("one file.csv", "id, name\n1, a\n2,\n", 1000)
    drop.put("turned.csv", "name,more,id\nb,x,3\n", 2000)
    drop.put("empty.csv", "id,name\n", 3000)
    drop.put("notes.txt", "no table")
    drop.put("short.csv", "id\n1\n", 4000)
    drop.put("nothing.csv", "", 5000)
    drop.put("twice.csv", "id,name,id\n1,b,2\n", 6000)
    drop.put("a+b%41.csv", "id,name\n9,plus\n", 7000)
    assert drop.load(max_files=2) == 4
    wanted = [("1", "a", "one file.csv"), ("3", "b", "turned.csv"), ("9", "plus", "a+b%41.csv")]
    assert drop.rows() == sorted(wanted)
    assert drop.names(0) == ["notes.txt", "nothing.csv", "short.csv", "twice.csv"]
    assert drop.names(2) == ["a+b%41.csv", "empty.csv", "one file.csv", "turned.csv"]
    states = {r["name"]: r["state"] for r in folder.read_ledger(spark, str(drop.places[3])).collect()}
    assert states["short.csv"] == "no column name" and states["nothing.csv"] == "no header" and states["twice.csv"] == "several columns id"
    assert drop.load() == 0
    drop.put("one file.csv", "id,name\n5,again\n", 8000)
    drop.put("short.csv", "id,name\n6,mended\n", 9000)
    assert drop.load() == 2
    assert drop.rows() == sorted([*wanted, ("5", "again", "one file.1.csv"), ("6", "mended", "short.csv")])
    assert "one file.1.csv" in drop.names(2) and "one file.csv" in drop.names(2)


@pytest.mark.parametrize("step", ["before_write", "after_write", "between_moves", "before_done"])
def test_a_broken_round_is_finished_by_the_next(spark, tmp_path, monkeypatch, step):
    drop = Drop(spark, tmp_path)
    for n in range(3):
        drop.put(f"f{n}.csv", f"id,name\n{n},x\n", 1000 + n)
    moves, real_move, real_write, real_batch = [], hadoop.move, folder._write, store.write_batch

    def write(*args):
        if step == "before_write":
            raise OSError("gone")
        real_write(*args)
        if step == "after_write":
            raise OSError("gone")

    def move(*args):
        if step == "between_moves" and len(moves) == 1:
            raise OSError("gone")
        moves.append(args)
        real_move(*args)

    def batch(df, path, *rest):
        if step == "before_done" and path.endswith("/done"):
            raise OSError("gone")
        real_batch(df, path, *rest)

    with monkeypatch.context() as patch:
        patch.setattr(folder, "_write", write)
        patch.setattr(hadoop, "move", move)
        patch.setattr(store, "write_batch", batch)
        with pytest.raises(OSError):
            drop.load()
    drop.load()
    assert drop.rows() == [(str(n), "x", f"f{n}.csv") for n in range(3)]
    assert drop.names(0) == [] and drop.names(2) == [f"f{n}.csv" for n in range(3)]


def test_folder_is_watched_until_stopped(spark, tmp_path):
    drop = Drop(spark, tmp_path)
    drop.put("a.csv", "id,name\n1,a\n")
    query = folder.csv_folder_stream(spark, *map(str, drop.places), ROW, str(tmp_path / "c"), every="1 second")
    for _ in range(60):
        query.awaitTermination(1)
        if drop.names(2):
            break
    query.stop()
    assert drop.rows() == [("1", "a", "a.csv")]


def transitions(spark, tmp_path, batches, pending=60, name="a"):
    root = tmp_path / name
    start = datetime(2024, 1, 1)
    for number, rows in enumerate(batches):
        checks = [(rule, start + timedelta(seconds=s), value, 10) for rule, s, value in rows]
        spark.createDataFrame(checks, alerts.CHECKS).coalesce(1).write.mode("append").parquet(str(root / "checks"))
        source = spark.readStream.schema(alerts.CHECKS).parquet(str(root / "checks"))
        alerts.watch_alerts(source, pending, str(root / "out"), str(root / "checkpoint")).awaitTermination()
    found = store.read_store(spark, str(root / "out"), alerts.TRANSITIONS)
    return sorted((r["rule"], int((r["at"] - start).total_seconds()), r["state"]) for r in found.collect()), found


def test_alert_waits_for_its_time(spark, tmp_path):
    short = [("short", 0, 11), ("short", 30, 12), ("short", 60, 5), ("short", 200, 1)]
    long_ = [("long", 0, 11), ("long", 60, 12), ("long", 90, 13), ("long", 120, 3), ("long", 130, 20), ("long", 150, 4)]
    silent = [("silent", 10, 99)]
    wanted = sorted([
        ("short", 0, "pending"), ("short", 60, "normal"), ("long", 0, "pending"), ("long", 60, "firing"), ("long", 120, "normal"),
        ("long", 130, "pending"), ("long", 150, "normal"), ("silent", 10, "pending"), ("silent", 70, "firing"),
    ])
    everything = sorted(short + long_ + silent, key=lambda r: r[1])
    got, found = transitions(spark, tmp_path, [everything], name="one")
    assert got == wanted
    got, _ = transitions(spark, tmp_path, [everything[:4], everything[4:8], everything[8:]], name="three")
    assert got == wanted
    now = {r["rule"]: r["state"] for r in alerts.current_alerts(found).collect()}
    assert now == {"short": "normal", "long": "normal", "silent": "firing"}


def test_outbox_sends_everything_once_and_reads_on_from_its_mark(spark, tmp_path, monkeypatch):
    source, state = str(tmp_path / "source"), str(tmp_path / "state")
    channel = {"format": "json", "path": str(tmp_path / "topic")}
    start = datetime(2024, 1, 1)

    def put(rows):
        frame = spark.createDataFrame([(i, i, "in", None if m is None else start + timedelta(minutes=m)) for i, m in rows], outbox.ROW)
        frame.coalesce(1).write.mode("append").parquet(source)

    def sent():
        return [int(r["key"]) for r in messages.read_messages(spark, channel).collect()] if (tmp_path / "topic").exists() else []

    put([(i, i) for i in range(20)] + [(100, None)])
    put([(i, 5) for i in range(20, 24)])
    assert outbox.send_next(spark, source, channel, state, 8) == 8
    assert sorted(sent()) == [0, 1, 2, 3, 4, 5, 20, 21]
    put([(50, 1), (51, 5), (52, 30), (101, None)])  # late, at the mark's time, later, and without a time
    assert outbox.send_next(spark, source, channel, state, 3) == 3
    assert sorted(set(sent()) - {0, 1, 2, 3, 4, 5, 20, 21}) == [22, 23, 50]
    # A round that breaks off after delivery is repeated.
    with monkeypatch.context() as patch:
        patch.setattr(store, "write_batch", lambda *args: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            outbox.send_next(spark, source, channel, state, 4)
    while outbox.send_next(spark, source, channel, state, 6):
        pass
    assert set(sent()) == {*range(24), 50, 51, 52, 100, 101}
    assert outbox.mark_time(spark, state) == start + timedelta(minutes=30)
    again = outbox.behind(spark.read.schema(outbox.ROW).parquet(source), 1704067200000000 + 60_000_000 * 25, 0)
    plan = again._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(event_timestamp" in plan
    assert [r["id"] for r in again.collect()] == [52]


def test_outbox_scan_skips_what_was_sent(spark, tmp_path):
    source = str(tmp_path / "source")
    start = datetime(2024, 1, 1)
    for part in range(10):
        rows = [(part * 100 + i, 1, "in", start + timedelta(minutes=part * 100 + i)) for i in range(100)]
        spark.createDataFrame(rows, outbox.ROW).coalesce(1).write.mode("append").parquet(source)
    ahead = outbox.behind(spark.read.schema(outbox.ROW).parquet(source), 1704067200000000 + 60_000_000 * 900, 0)
    assert ahead.count() >= 99
    ahead.collect()
    scan = ahead._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert scan.metrics().get("numOutputRows").get().value() <= 200
