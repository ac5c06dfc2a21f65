"""Audit, archive, quality, sources, sinks, pages and the daily jobs."""

import csv
import json
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens.operators import archive, audit, quality, retention, web
from storelens.plans import daily
from storelens.sources import files, messages, sinks, tables
from storelens.sources.specs import PURCHASES

NOW = datetime(2025, 8, 4, 3, 0)


def test_audit_of_one_update(spark):
    schema = "id long, name string, email string, role string"
    old = spark.createDataFrame(
        [(1, "anna", "anna@mail.com", "user"), (2, "a", "a@x", "user"), (3, "b", None, "user"), (4, "c", "c@x", "user"), (5, "gone", "g", "user")], schema)
    new = spark.createDataFrame(
        [(1, "Anna", "anna@mail.org", "admin"), (2, "a", "a@x", "user"), (3, "b", "b@x", "user"), (4, "c", None, "user"), (6, "new", "n", "user")], schema)
    rows = audit.audit_changes(old, new, actor="me", changed_at=NOW).orderBy("user_id", "field_changed").collect()
    assert [tuple(r) for r in rows] == [
        (1, "email", "anna@mail.com", "anna@mail.org", "me", NOW),
        (1, "name", "anna", "Anna", "me", NOW),
        (1, "role", "user", "admin", "me", NOW),
        (3, "email", None, "b@x", "me", NOW),
        (4, "email", "c@x", None, "me", NOW),
    ]


def test_audit_export_is_one_named_file(spark, tmp_path):
    rows = [(i, "name", "a,b", None, "me", NOW - timedelta(hours=h)) for i, h in enumerate((30, 24, 5, 1))]
    log = spark.createDataFrame(rows, "user_id long, field_changed string, old_value string, new_value string, changed_by string, changed_at timestamp")
    target = sinks.export_recent_audit(log, NOW, f"{tmp_path}/export")
    assert target.endswith("users_audit_export_20250804_0300.csv")
    with open(target, encoding="utf-8", newline="") as handle:
        lines = list(csv.reader(handle))
    assert lines[0] == audit.EXPORT_COLUMNS
    assert [line[0] for line in lines[1:]] == ["1", "2", "3"]
    today = audit.recent_audit(log, NOW, calendar_day=True)
    assert [r["user_id"] for r in today.collect()] == [3]


def archive_events(spark):
    rows = []
    for user in range(123, 133):
        rows += [(user, NOW - timedelta(days=20 + n), NOW - timedelta(days=60)) for n in range(2)]
    rows.append((200, NOW - timedelta(days=14), NOW - timedelta(days=60)))
    rows.append((201, NOW - timedelta(days=20), NOW - timedelta(days=30)))
    rows.append((202, NOW - timedelta(days=20), NOW - timedelta(days=31)))
    rows.append((202, NOW - timedelta(days=1), NOW - timedelta(days=31)))
    return spark.createDataFrame(rows, "user_id long, event_time timestamp, registration_date timestamp")


def test_archive_report_file(spark, tmp_path):
    events = archive_events(spark)
    ids = archive.inactive_users(events, NOW)
    archived, kept = archive.archive_split(events, ids)
    assert archived.count() == 20 and kept.count() == 4
    assert archived.unionByName(kept).exceptAll(events).isEmpty()
    target = sinks.write_archive_report(archived, str(tmp_path), NOW)
    with open(target, encoding="utf-8") as handle:
        report = json.load(handle)
    assert report == {
        "date": "2025-08-04", "archived_documents_count": 20, "archived_users_count": 10,
        "archived_user_ids_folder": f"2025-08-04_{NOW:%H%M%S}_ids"}
    ids = spark.read.json(f"{tmp_path}/{report['archived_user_ids_folder']}")
    assert sorted(r["user_id"] for r in ids.collect()) == list(range(123, 133))


def test_archive_runs_add_up(spark, tmp_path):
    source, root = f"{tmp_path}/events", f"{tmp_path}/store"
    everything = archive_events(spark)
    everything.write.parquet(source)
    first = daily.run_archive(spark, source, root, NOW)
    assert first.endswith(f"/2025-08-04_{NOW:%H%M%S}.json")
    left = daily.current_events(spark, source, root)
    assert left.count() == 4
    assert daily.run_archive(spark, source, root, NOW) is None
    later = NOW + timedelta(days=60)
    left.limit(1).withColumn("event_time", F.lit(later)).write.mode("append").parquet(source)
    assert daily.current_events(spark, source, root).count() == 5
    same_day = [daily.run_archive(spark, source, root, later + timedelta(hours=n)) for n in (0, 1)]
    assert same_day[0] and same_day[1] is None
    with open(same_day[0], encoding="utf-8") as handle:
        told = json.load(handle)
    archived = daily.read_archive(spark, root)
    assert told["archived_documents_count"] == archived.where(F.col("run_at") == f"{later:%Y%m%dT%H%M%S}").count()
    assert archived.count() + daily.current_events(spark, source, root).count() == 25
    with open(first, encoding="utf-8") as handle:
        assert json.load(handle)["archived_documents_count"] == 20


@pytest.mark.parametrize("step", ["write_archive_report", "_finish_run", "_drop_replaced"])
def test_a_broken_archive_run_loses_nothing(spark, tmp_path, monkeypatch, step):
    source, root = f"{tmp_path}/events", f"{tmp_path}/store"
    everything = archive_events(spark)
    everything.write.parquet(source)
    real, calls = getattr(daily, step), []

    def broken(*args):
        calls.append(args)
        if step != "_drop_replaced" or len(calls) == 2:
            raise OSError("gone")
        return real(*args)

    with monkeypatch.context() as patch:
        patch.setattr(daily, step, broken)
        with pytest.raises(OSError):
            daily.run_archive(spark, source, root, NOW)
    daily.run_archive(spark, source, root, NOW + timedelta(minutes=1))
    archived = daily.read_archive(spark, root).drop("run_at")
    both = archived.unionByName(daily.current_events(spark, source, root).select(*archived.columns))
    assert both.exceptAll(everything.select(*archived.columns)).isEmpty() and both.count() == everything.count()
    assert archived.count() == 22  # two more users pass the limits in that minute


def test_nothing_archived_gives_no_report(spark, tmp_path):
    nobody = archive_events(spark).limit(0)
    assert sinks.write_archive_report(nobody, str(tmp_path), NOW) is None
    assert archive.archive_report(nobody, NOW).isEmpty()


def test_retention_on_literal_visits(spark):
    days = {1: (1, 1, 3), 2: (1, 8), 3: (1, 9), 4: (2,)}
    rows = [(u, datetime(2024, 1, d, h)) for u, ds in days.items() for h, d in enumerate(ds)]
    events = spark.createDataFrame(rows, "user_id long, event_time timestamp")
    first = [tuple(r) for r in retention.retention_first_visit(events).collect()]
    assert first == [(date(2024, 1, 1), 3, 2, 66.67), (date(2024, 1, 2), 1, 0, 0.0)]
    daily_rows = {r["ds_cohort"].day: (r[1], r[2]) for r in retention.retention_daily(events).collect()}
    assert daily_rows == {1: (3, 2), 2: (1, 0), 3: (1, 0), 8: (1, 0), 9: (1, 0)}


def test_quality_checks(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,), (None,)], "id int")
    row = quality.duplicate_ratio(df, "id").first()
    assert (row["row_count"], row["distinct_count"], row["firing"]) == (5, 2, True)
    assert quality.duplicate_ratio(df.limit(0), "id").first()["firing"] is False
    assert quality.threshold_check(df, 5).first()["firing"] is False
    assert quality.threshold_check(df, 4).first()["firing"] is True
    assert quality.expected_count(df, 5).first()["as_expected"] is True
    steps = quality.STATUS_STEPS["purchases"]
    seen = spark.createDataFrame([(149,), (150,), (299,), (300,)], "n int")
    assert [r[0] for r in seen.select(quality.status(F.col("n"), steps)).collect()] == ["green", "yellow", "yellow", "red"]


def test_json_documents_objects_lists_and_broken_files(spark, tmp_path):
    folder = tmp_path / "docs"
    folder.mkdir()
    (folder / "one.json").write_text('{"_id": "1",\n "name": "Ж"}', encoding="utf-8")
    (folder / "many.json").write_text('[{"_id": "2"}, {"_id": "3", "name": null}]', encoding="utf-8")
    (folder / "broken.json").write_text('{"_id": "4", ', encoding="utf-8")
    (folder / "skip.txt").write_text('{"_id": "5"}', encoding="utf-8")
    for schema in (None, T.StructType([T.StructField("_id", T.StringType()), T.StructField("name", T.StringType())])):
        docs, broken = files.read_json_documents(spark, str(folder), schema)
        assert {(r["_id"], r["name"]) for r in docs.collect()} == {("1", "Ж"), ("2", None), ("3", None)}
        assert [r["file"].rsplit("/", 1)[-1] for r in broken.collect()] == ["broken.json"]
    assert files.append_documents(docs, f"{tmp_path}/store") == 3
    assert files.append_documents(docs, f"{tmp_path}/store") == 3
    stored = spark.read.parquet(f"{tmp_path}/store")
    assert stored.count() == 6
    assert files.scan(stored).count() == 6
    assert files.scan(stored, F.col("_id") == "2").count() == 2


def test_messages_keep_nulls_times_and_letters(spark):
    df = spark.createDataFrame(
        [("1", "Ж", None, {"at": datetime(2024, 1, 1), "on": date(2024, 2, 3)})], "_id string, name string, gone string, seen struct<at:timestamp,on:date>")
    row = messages.to_messages(df).first()
    assert row["key"] == "1"
    assert "Ж" in row["value"]
    assert json.loads(row["value"]) == {"_id": "1", "name": "Ж", "gone": None, "seen": {"at": "2024-01-01T00:00:00", "on": "2024-02-03"}}
    assert messages.to_messages(df.drop("_id")).first()["key"] == ""


def test_tables_are_listed_created_and_reset(spark):
    schemas = {"purchases_parsed": PURCHASES.schema}
    tables.create_if_absent(spark, schemas)
    spark.table("purchases_parsed").limit(0).write.insertInto("purchases_parsed")
    tables.create_if_absent(spark, schemas)
    assert "purchases_parsed" in [r["tableName"] for r in tables.list_tables(spark).collect()]
    assert tables.list_databases(spark).count() >= 1
    tables.reset_tables(spark, schemas)
    assert tables.read_table(spark, "purchases_parsed").schema.names == PURCHASES.schema.names
    spark.sql("DROP TABLE purchases_parsed")
    done = tables.run_collections({"a": {"topic": "t1"}, "b": {"topic": "t2"}}, lambda name, topic: f"{name}:{topic}")
    assert done == {"a": "a:t1", "b": "b:t2"}


def test_daily_jobs_write_replace_and_report(spark, tmp_path):
    rows = [(str(i), f"c{i}", "s1", "city", 100.0, "card", False, "[]", datetime(2024, 3, 30)) for i in range(3)]
    purchases = spark.createDataFrame(
        rows, "purchase_id string, customer_id string, store_id string, store_city string, total_amount double, payment_method string, "
        "is_delivery boolean, items string, purchase_datetime timestamp")
    purchases.createOrReplaceTempView("daily_purchases")
    path = f"{tmp_path}/features"
    for ds in ("20240330", "20240331", "20240331"):
        daily.run_features(spark, "daily_purchases", path, ds)
    assert spark.read.parquet(path).count() == 6
    assert files.latest_partition(spark, path) == "20240331"
    (tmp_path / "features" / "ds=20240401").mkdir()
    assert files.latest_partition(spark, path) == "20240331"
    target = daily.run_report(spark, path, f"{tmp_path}/report", "customers")
    assert [p.name for p in (tmp_path / "report").iterdir() if not p.name.startswith(".")] == ["customers_20240331.csv"]
    with open(target, encoding="utf-8", newline="") as handle:
        lines = list(csv.DictReader(handle))
    assert sorted(r["customer_id"] for r in lines) == ["c0", "c1", "c2"]
    assert len(lines[0]) == 32 and {r["ds"] for r in lines} == {"20240331"}
    schema = daily.features_schema(spark, path)
    plan = files.read_latest_partition(spark, path, schema)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ds" in plan


def test_report_of_an_empty_table_fails(spark, tmp_path):
    (tmp_path / "none").mkdir()
    with pytest.raises(ValueError):
        daily.run_report(spark, str(tmp_path / "none"), f"{tmp_path}/report", "x")


def test_csv_report_as_a_folder(spark, tmp_path):
    rows = spark.range(0, 100, 1, 4).toDF("id")
    target = sinks.export_single_csv(rows, f"{tmp_path}/big", "ids", single_file=False)
    assert spark.read.option("header", True).csv(target).count() == 100
    names = [p.name for p in (tmp_path / "big" / "ids.csv").iterdir() if p.name.endswith(".csv")]
    assert len(names) == 4
    assert sinks.write_csv_if_any(spark.range(0), f"{tmp_path}/none") is False
    assert sinks.write_csv_if_any(spark.range(2), f"{tmp_path}/some") is True


PAGES = {
    "nested": ("<ul class='x breadcrumb'><li><a>x</a><ul><li><a>b</a></li></ul></li><li><a>c</a></li><li>d</li></ul><a>out</a>", "x > b > c"),
    "unclosed": ("<ul class=breadcrumb><li><a>one<li><a>two</ul><li><a>no</a></li>", "one > two"),
    "two": ("<ul class='breadcrumb'><li><a>1</a></ul><ul class='breadcrumb'><li><a>2</a></li></ul>", "1 > 2"),
    "bracket": ("<ul class='breadcrumb' title='a > b'><li><a title=\"</a>\">in &lt;b&gt;</a></li></ul>", "in <b>"),
    "open end": ("<ul class='breadcrumb'><li><a>never closed", "never closed"),
    "no items": ("<ul class='breadcrumb'><a>no item</a></ul>", ""),
}
PRICES = {
    "£1 234,50": ("£", 1234.5), "$ 5": ("$", 5.0), "12": ("", 12.0), "1.2.3 EUR": ("", None), "free": ("free", 0.0), ".": ("", None),
    "€&nbsp;7": ("€", 7.0), "": ("", 0.0),
}
STOCKS = {
    "In stock (5 available)": 5, "In stock (5 available now)": None, "(7&nbsp;AVAILABLE)": 7, "( 5 available)": None,
    "(99999999999999999999 available)": None, "": None,
}


def test_item_pages_are_read_by_their_structure(spark):
    pages = spark.createDataFrame([(u, h) for u, (h, _) in PAGES.items()], "url string, html string")
    got = {r["url"]: r["breadcrumbs"] for r in web.extract_fields(pages, ["breadcrumbs"]).collect()}
    assert got == {u: trail for u, (_, trail) in PAGES.items()}


def test_price_and_stock_rules(spark):
    rows = [(p, f"<h1>a<b> c </b></h1><p class='price_color'>{p}<p class='other'>9</p>") for p in PRICES]
    got = {r["url"]: (r["price_currency"], r["price_amount"]) for r in web.extract_fields(spark.createDataFrame(rows, "url string, html string")).collect()}
    assert got == PRICES
    rows = [(s, f"<P CLASS='availability  instock'><i></i> {s} </P>") for s in STOCKS]
    got = {r["url"]: r["instock_qty"] for r in web.extract_fields(spark.createDataFrame(rows, "url string, html string")).collect()}
    assert got == STOCKS


def test_fields_come_from_one_reading_of_the_page(spark):
    pages = spark.createDataFrame([("u", "<h1>x</h1>")], "url string, html string")
    kept = web.extract_fields(pages).where("instock_qty > 0 and price_amount > 1")
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp") <= 20 and plan.count("tag") > 1 and plan.count("price_color") == 1


ITEM = """<html><body><ul class='breadcrumb'><li><a href="/">Home</a></li><li> <a href="/b"> Books </a></li><li class="active">X</li></ul>
<h1>Tom <b>&amp; Jerry</b></h1><p class="other price_color">&pound;51.77</p>
<p class="instock availability"><i></i> In stock (22 available) </p><p class="instock availability">Other</p></body></html>"""


def test_item_fields(spark):
    pages = spark.createDataFrame([("u1", ITEM), ("u2", "<p>nothing</p>"), ("u3", None), ("u4", "<h1>A</h1><p class='price_color'>free</p>")], "url string, html string")
    got = {r["url"]: r for r in web.extract_fields(pages, [*web.EXTRACTORS, "unknown"]).collect()}
    assert set(got) == {"u1", "u2", "u4"}
    assert tuple(got["u1"]) == ("Tom& Jerry", "£", 51.77, "Home > Books", "In stock (22 available)", 22, True, None, "u1")
    bare = got["u2"]
    assert (bare["product_name"], bare["price_amount"], bare["instock_text"], bare["instock"]) == (None, None, None, None)
    assert bare["breadcrumbs"] == ""
    assert (got["u4"]["price_currency"], got["u4"]["price_amount"]) == ("free", 0.0)


def test_the_plan_of_a_round_does_not_grow(spark, monkeypatch):
    sizes, real = [], web.maybe_among

    def watched(frame, keys, key):
        found = real(frame, keys, key)
        sizes.append(len(keys.join(found, key, "left_anti")._jdf.queryExecution().optimizedPlan().toString()))
        return found

    monkeypatch.setattr(web, "maybe_among", watched)
    pages, links = site(spark, {f"n{n:03}": [f"n{n + 1:03}", "n000"] for n in range(30)})
    got = web.crawl_frontier(pages, links, "http://h.example/n000", 100).orderBy("url").collect()
    assert [(r["url"][-3:], r["round"], r["visited"]) for r in got] == [(f"{n:03}", n, n < 30) for n in range(31)]
    assert len(sizes) == 30 and max(sizes) <= min(sizes) + 100


def site(spark, graph):
    rows = [(f"http://h.example/{p}", "".join(f'<a href="/{q}">x</a>' for q in qs) or "<p>end</p>") for p, qs in graph.items()]
    pages = spark.createDataFrame(rows, "url string, html string")
    return pages, web.page_links(pages)


def walk(graph, start, limit):
    """Breadth-first rounds in URL order, in plain Python."""
    found, visited, frontier, number = {start: 0}, [], [start], 0
    while frontier and len(visited) < limit:
        ready = sorted(p for p in frontier if p in graph)[: limit - len(visited)]
        visited += ready
        number += 1
        frontier = sorted({q for p in ready for q in graph[p]} - set(found))
        found.update(dict.fromkeys(frontier, number))
    return {(f"http://h.example/{p}", n, p in visited) for p, n in found.items()}


@pytest.mark.parametrize("limit", [1, 3, 5, 100])
def test_crawl_against_a_plain_walk(spark, limit):
    graph = {"a": ["c", "b", "missing"], "b": ["a", "d", "e"], "c": ["f", "d"], "d": [], "e": ["g"], "f": ["a"], "g": ["a"], "island": ["a"]}
    pages, links = site(spark, graph)
    got = web.crawl_frontier(pages, links, "http://h.example/a", limit)
    assert {tuple(r) for r in got.collect()} == walk(graph, "a", limit)


def test_crawl_from_an_unknown_page_finds_nothing(spark):
    pages, links = site(spark, {"a": ["b"]})
    assert web.crawl_frontier(pages, links, "http://h.example/zzz", 5).count() == 0


def test_item_urls(spark):
    urls = spark.createDataFrame([("http://h/",), ("http://h/cat/1",), ("http://h/i/1",), ("http://h/i/1",)], "url string")
    assert [r["url"] for r in web.item_urls(urls, "http://h/cat/", "http://h/").collect()] == ["http://h/i/1"]
