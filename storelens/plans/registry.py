"""Named queries over the supplied tables, one per capability."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.functions import convert
from storelens.functions.privacy import mask_pii, normalize_phone
from storelens.operators import (
    archive, audit, clean, dedupe, documents, quality, relay, retention, rollup, sales, web,
)
from storelens.operators.features import (
    PURCHASE_COLUMNS, FeatureConfig, customer_features, customer_metrics,
)
from storelens.plans import daily
from storelens.plans.daily import features_schema
from storelens.plans.views import table, view
from storelens.session import ensure_checkpoint_dir, release
from storelens.sources import files, hadoop, messages, sinks, tables
from storelens.sources.specs import CUSTOMERS, PRODUCTS, PURCHASES, SPECS, STORES, TableSpec
from storelens.streaming import alerts, folder, jobs, outbox, store

Query = Callable[[SparkSession, str], DataFrame]

RUN_DS = "20010801"
PREVIOUS_DS = "20010731"
EVENTS_NOW = datetime(2024, 1, 31)
STATES_FROM = date(2024, 1, 11)
ALERTS_SPLIT = datetime(2024, 1, 15, 0, 30)
ARCHIVE_RUNS = (datetime(2024, 1, 31, 3), datetime(2024, 1, 31, 21))
AUDIT_NOW = datetime(2024, 1, 2, 12)
RETAIL_CONFIG = FeatureConfig(
    groups={
        "milk": "SMALL", "fruits": "LARGE", "veggies": "MEDIUM",
        "meat": "PROMO", "bakery": "ECONOMY", "organic": "STANDARD",
    },
    items_are_json=False,
    new_customer_days=90,
    bulk_over=300000,
    low_cost_under=200000,
    high_spender_over=400000,
)
PROFILED = ["category", "item", "price_per_unit", "quantity", "total_spent"]
METRIC_GROUPS = {
    "customer_stats": [
        "total_purchases", "avg_cart_value", "max_cart_value", "min_cart_value",
        "unique_cities", "unique_stores", "unique_purchase_days", "delivery_purchases",
        "cash_purchases", "card_purchases", "weekend_purchases", "weekday_purchases",
        "night_purchases", "morning_purchases", "early_bird_purchases",
        "recent_7d_purchases", "recent_14d_purchases", "recent_30d_purchases",
        "recent_90d_purchases", "last_purchase_date", "first_purchase_date",
    ],
    "category_stats": [
        "milk_purchases", "fruits_purchases", "veggies_purchases", "bakery_purchases",
        "meat_purchases", "organic_purchases", "milk_purchases_30d", "fruits_purchases_30d",
        "fruits_purchases_14d", "veggies_purchases_14d", "meat_purchases_7d",
        "meat_purchases_90d", "total_spent_7d",
    ],
    "cart_stats": ["avg_cart_size", "single_item_purchases"],
    "category_diversity": ["unique_categories"],
}


def scratch(spark: SparkSession) -> str:
    """A new folder for files a query writes, in the folder all executors share."""
    return f"{ensure_checkpoint_dir(spark)}/scratch-{uuid.uuid4().hex}"


def _over(name: str, step: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: step(view(spark, sf, name))


def _sold(step: Callable[[DataFrame], DataFrame]) -> Query:
    return _over("v_sales", lambda df: step(sales.sold(df)))


def _profile(df: DataFrame) -> DataFrame:
    return clean.null_profile(df, clean.null_tests(PROFILED, zero=("quantity",)))


def _profiles(df: DataFrame) -> DataFrame:
    """Both profiles and the names to fill in come from one reading of the sales, kept as the columns they look at."""
    tests = clean.null_tests(PROFILED, zero=("quantity",))
    profiled, path = df.select(*PROFILED), f"{scratch(df.sparkSession)}/profiled"
    profiled.write.parquet(path)
    rows = df.sparkSession.read.schema(profiled.schema).parquet(path)
    return clean.compare_profiles(rows, sales.fill_sales(rows), tests)


def _repaired(df: DataFrame) -> DataFrame:
    return sales.repair_sales(df).withColumn("total_spent", F.col("total_spent").cast("decimal(18,2)"))


def _snake_case(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    raw = part.toDF("P Part-Key", " P.Name ", "Brand (P)", "P  Type", "p_SIZE", "Retail Price, $")
    return clean.snake_case_columns(raw)


def _metrics(columns: list[str]) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        metrics = customer_metrics(view(spark, sf, "v_purchases"), RUN_DS, None, RETAIL_CONFIG)
        doubles = {"max_cart_value", "min_cart_value", "total_spent_7d"}
        return metrics.select(
            "customer_id",
            *[F.col(c).cast("double").alias(c) if c in doubles else F.col(c) for c in columns],
        )

    return query


def _features(spark: SparkSession, sf: str) -> DataFrame:
    return customer_features(view(spark, sf, "v_purchases"), RUN_DS, None, RETAIL_CONFIG)


def _json_features(spark: SparkSession, sf: str) -> DataFrame:
    """The flags from carts that are JSON arrays of several items."""
    return customer_features(view(spark, sf, "v_purchases_json"), RUN_DS, None, replace(RETAIL_CONFIG, items_are_json=True))


def _latest_report(spark: SparkSession, sf: str) -> DataFrame:
    path = f"{scratch(spark)}/features"
    purchases = view(spark, sf, "v_purchases")
    for ds in (PREVIOUS_DS, RUN_DS):
        sinks.write_partition(customer_features(purchases, ds, None, RETAIL_CONFIG), path)
        # The shuffle files of a day go before those of the next one are written.
        release(spark)
    report = files.read_latest_partition(spark, path, features_schema(spark, path))
    folder = f"{scratch(spark)}/report"
    name = f"customers_{RUN_DS}"
    target = sinks.export_single_csv(report, folder, name)
    return spark.read.option("header", True).schema(report.schema).csv(target)


def _event_ttl(spark: SparkSession, sf: str) -> DataFrame:
    return rollup.apply_ttl(view(spark, sf, "v_events"), "event_time", 14, EVENTS_NOW)


def _sketch_rollup(df: DataFrame) -> DataFrame:
    return rollup.merge_states(rollup.event_states(df))


def _sketch_error(df: DataFrame) -> DataFrame:
    """Per day and type whether the sketched user count is within 5 percent of the exact one."""
    exact = rollup.exact_rollup(df).select("event_date", "event_type", F.col("unique_users").alias("exact_users"))
    both = _sketch_rollup(df).join(exact, ["event_date", "event_type"])
    error = F.abs(F.col("unique_users") - F.col("exact_users"))
    return both.select(
        "event_date", "event_type", "total_spent", "total_actions", "exact_users",
        (error <= 0.05 * F.col("exact_users")).alias("within_bound"),
    )


def _audit(spark: SparkSession, sf: str) -> DataFrame:
    return audit.audit_changes(
        view(spark, sf, "v_users_old"), view(spark, sf, "v_users_new"), changed_at=EVENTS_NOW
    )


def _recent_audit_log(spark: SparkSession, sf: str) -> DataFrame:
    changes = audit.audit_changes(view(spark, sf, "v_users_old"), view(spark, sf, "v_users_new"))
    hours = F.make_interval(hours=(F.col("user_id") % 48).cast("int"))
    return changes.withColumn("changed_at", convert.at(AUDIT_NOW) - hours)


def _recent_audit(spark: SparkSession, sf: str) -> DataFrame:
    return audit.recent_audit(_recent_audit_log(spark, sf), AUDIT_NOW)


def _inactive(spark: SparkSession, sf: str) -> DataFrame:
    buys = view(spark, sf, "v_events").where("event_type = 'purchase'")
    registered = view(spark, sf, "v_registration")
    return archive.inactive_users(buys, EVENTS_NOW, 10, 3, registered)


def _archive_split(spark: SparkSession, sf: str) -> DataFrame:
    archived, kept = archive.archive_split(view(spark, sf, "v_events"), _inactive(spark, sf))
    return archived.withColumn("side", F.lit("archived")).unionByName(
        kept.withColumn("side", F.lit("kept"))
    )


def _archive_report(spark: SparkSession, sf: str) -> DataFrame:
    archived, _ = archive.archive_split(view(spark, sf, "v_events"), _inactive(spark, sf))
    return archive.archive_report(archived, EVENTS_NOW)


def _archive_two_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Two archive runs on one day: every event with the run that archived it, and what both reports say."""
    root = scratch(spark)
    events = view(spark, sf, "v_events").join(view(spark, sf, "v_registration"), "user_id", "left")
    events.write.parquet(f"{root}/events")
    for now in ARCHIVE_RUNS:
        daily.run_archive(spark, f"{root}/events", f"{root}/store", now, 10, 3)
    stored = daily.read_archive(spark, f"{root}/store").select("id", "user_id", "run_at")
    kept = daily.current_events(spark, f"{root}/events", f"{root}/store")
    reports = spark.read.schema("archived_documents_count long, archived_users_count long").json(f"{root}/store/reports/*.json")
    told = reports.agg(F.sum("archived_documents_count").alias("documents"), F.sum("archived_users_count").alias("users"))
    rows = stored.unionByName(kept.select("id", "user_id", F.lit("kept").alias("run_at")))
    return rows.join(F.broadcast(told))


def _sales_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Sales rows through a CSV file with headings, blanks and the text NaN, read by name and prepared."""
    root = scratch(spark)
    rows = view(spark, sf, "v_sales").select(
        F.col("transaction_date").cast("string").alias("Transaction Date"), F.col("customer_id").cast("string").alias("Customer ID"),
        F.col("transaction_id").cast("string").alias("Transaction ID"), F.col("category").alias("Category"),
        F.coalesce("item", F.lit("NaN")).alias("Item"), F.col("price_per_unit").alias("Price Per Unit"),
        F.col("quantity").alias("Quantity"), F.col("total_spent").alias("Total Spent"), F.col("payment_method").alias("Payment Method"),
        F.col("location").alias("Location"), F.lit(None).cast("string").alias("Discount Applied"),
    )
    rows.write.option("header", True).csv(f"{root}/sales")
    return sales.prepare_sales(files.read_sales_csv(spark, f"{root}/sales")).drop("discount_applied")


def _json_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Stores as JSON files that each hold a list, one of them broken: appended to a collection and scanned."""
    root = scratch(spark)
    stores = view(spark, sf, "v_raw_stores").where("full_data IS NOT NULL")
    place = F.pmod(F.xxhash64("full_data"), F.lit(6)).cast("int").alias("place")
    lists = stores.groupBy(place).agg(F.concat(F.lit("["), F.array_join(F.collect_list("full_data"), ","), F.lit("]")).alias("text"))
    whole = lists.unionByName(spark.createDataFrame([(6, "[{")], "place int, text string"))
    whole.repartition("place").write.partitionBy("place").text(f"{root}/parts")
    for name in hadoop.folder_names(spark, f"{root}/parts"):
        for part in hadoop.data_files(spark, f"{root}/parts/{name}"):
            hadoop.move(spark, f"{root}/parts/{name}/{part}", f"{root}/json/{name.removeprefix('place=')}.json")
    found, _ = files.read_json_documents(spark, f"{root}/json")
    files.append_documents(found, f"{root}/collection")
    collection = spark.read.parquet(f"{root}/collection")
    return files.scan(collection, F.col("delivery_available")).select("_id", "store_id", F.col("manager.email").alias("email"))


def _audit_export(spark: SparkSession, sf: str) -> DataFrame:
    """The fresh audit rows through the CSV file of the export."""
    target = sinks.export_recent_audit(_recent_audit_log(spark, sf), AUDIT_NOW, f"{scratch(spark)}/audit")
    kinds = "user_id long, field_changed string, old_value string, new_value string, changed_by string, changed_at timestamp"
    return spark.read.option("header", True).schema(kinds).csv(target)


def _items_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Complete item records through CSV; a table without rows writes nothing."""
    root = scratch(spark)
    items = _complete_items(spark, sf)
    if sinks.write_csv_if_any(items.limit(0), f"{root}/none"):
        raise RuntimeError("an empty table wrote a file")
    sinks.write_csv_if_any(items, f"{root}/items")
    return spark.read.option("header", True).schema(items.schema).csv(f"{root}/items")


def _catalog(spark: SparkSession, sf: str) -> DataFrame:
    """The typed table of each collection, rebuilt, filled by one step per collection and listed with its rows."""
    mark = uuid.uuid4().hex
    names = {c: f"typed_{c}_{mark}" for c in SPECS}
    schemas = {name: SPECS[c].schema for c, name in names.items()}
    tables.create_if_absent(spark, schemas)
    tables.reset_tables(spark, schemas)

    def fill(collection: str, target: str) -> DataFrame:
        typed = documents.parse_documents(view(spark, sf, f"v_raw_{collection}"), SPECS[collection])
        typed.write.insertInto(target)
        return tables.read_table(spark, target).agg(F.count("*").alias("row_count")).select(F.lit(target).alias("tableName"), "row_count")

    counts = tables.run_collections({c: {"target": name} for c, name in names.items()}, fill)
    listed = tables.list_tables(spark).where(F.col("tableName").endswith(mark))
    every = reduce(DataFrame.unionByName, counts.values())
    return listed.join(every, "tableName").select(F.split("tableName", "_")[1].alias("collection"), "row_count")


def _daily_main(spark: SparkSession, sf: str) -> DataFrame:
    """The daily jobs by their command line: flags of a table to a partition, then the report of the newest one."""
    root, name = scratch(spark), f"purchases_{uuid.uuid4().hex}"
    typed = documents.parse_documents(view(spark, sf, "v_raw_purchases"), PURCHASES)
    dedupe.unique_rows(typed, PURCHASES).write.saveAsTable(name)
    daily.main(["features", "--table-in", name, "--path-out", f"{root}/flags", "--ds", RUN_DS])
    daily.main(["report", "--path-in", f"{root}/flags", "--directory", f"{root}/report", "--file-name", "customers"])
    report = spark.read.option("header", True).csv(f"{root}/report/customers_{RUN_DS}.csv")
    return report.select("customer_id", F.col("delivery_user").cast("int").alias("delivery_user"), "ds")


def _unsent(spark: SparkSession, sf: str) -> DataFrame:
    return relay.read_unsent(view(spark, sf, "v_logins"), view(spark, sf, "v_sent"), 10)


def _outbox(spark: SparkSession, sf: str) -> DataFrame:
    """Two rounds over four fifths of the rows, and a third one after the others, many of them older, have come."""
    root = scratch(spark)
    rows = view(spark, sf, "v_logins")
    early = F.col("id") % 5 != 0
    channel = {"format": "json", "path": f"{root}/topic"}
    rows.where(early).repartition(2).write.parquet(f"{root}/source")
    for _ in range(2):
        outbox.send_next(spark, f"{root}/source", channel, f"{root}/state", 100)
    rows.where(~early).write.mode("append").parquet(f"{root}/source")
    outbox.send_next(spark, f"{root}/source", channel, f"{root}/state", 200)
    return relay.parse_logins(messages.read_messages(spark, channel), EVENTS_NOW).drop("processed_at")


def _relay_messages(spark: SparkSession, sf: str) -> DataFrame:
    fresh = relay.not_sent(view(spark, sf, "v_logins"), view(spark, sf, "v_sent"))
    return relay.login_messages(fresh)


def _relay_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    return relay.parse_logins(_relay_messages(spark, sf), EVENTS_NOW)


def _relay_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs of producer and consumer over files: the second must add nothing."""
    root = scratch(spark)
    view(spark, sf, "v_logins").write.parquet(f"{root}/source")
    schema = view(spark, sf, "v_logins").schema
    channel = {"format": "json", "path": f"{root}/topic"}
    for attempt in ("first", "again"):
        source = spark.readStream.schema(schema).parquet(f"{root}/source")
        jobs.stream_relay(
            source, channel, f"{root}/ledger", f"{root}/relay-{attempt}"
        ).awaitTermination()
    jobs.consume_logins(
        messages.stream_messages(spark, channel), f"{root}/logins", f"{root}/rejects", f"{root}/consume"
    ).awaitTermination()
    return jobs.read_logins(spark, f"{root}/logins").drop("processed_at")


def _parsed(spec: TableSpec) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        typed = documents.parse_documents(view(spark, sf, f"v_raw_{spec.collection}"), spec)
        lists = [f.name for f in spec.fields if f.kind == "strings"]
        return typed.withColumns({c: F.array_join(c, "|") for c in lists})

    return query


def _dedupe(spark: SparkSession, sf: str) -> DataFrame:
    incoming = documents.parse_documents(view(spark, sf, "v_raw_purchases"), PURCHASES)
    stored = documents.parse_documents(view(spark, sf, "v_stored_purchases"), PURCHASES)
    return dedupe.load_new(incoming, PURCHASES, stored).select("row_hash", "purchase_id")


def _typed_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """From JSON documents to metrics: unique purchases with JSON carts and organic products."""
    typed = documents.parse_documents(view(spark, sf, "v_raw_purchases"), PURCHASES)
    products = documents.parse_documents(view(spark, sf, "v_raw_products"), PRODUCTS)
    # Rows of one hash agree in all columns, so the others need not be shuffled to find copies.
    unique = dedupe.unique_rows(typed.select("row_hash", *PURCHASE_COLUMNS), PURCHASES)
    return customer_metrics(unique, RUN_DS, products=products).select(
        "customer_id", "total_purchases", "card_purchases", "delivery_purchases", "unique_stores",
        "milk_purchases", "organic_purchases", "avg_cart_size", "single_item_purchases", "unique_categories",
    )


def _typed_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Messages through landing and typing as streams; everything arrives twice."""
    root = scratch(spark)
    sent = view(spark, sf, "v_raw_purchases").select(
        F.lit(None).cast("string").alias("key"), F.col("full_data").alias("value")
    )
    channel = {"format": "parquet", "path": f"{root}/topic", "compression": "zstd"}
    for _ in ("first", "again"):
        # Like a topic with several partitions; the hint also splits uneven ones.
        messages.write_messages(sent.hint("rebalance"), channel)
        release(spark)
        jobs.stream_raw(
            messages.stream_messages(spark, channel),
            f"{root}/raw", f"{root}/rejects", f"{root}/land",
        ).awaitTermination()
        jobs.stream_parse(
            jobs.read_raw_stream(spark, f"{root}/raw"), PURCHASES, f"{root}/typed", f"{root}/parse"
        ).awaitTermination()
    stored = store.read_store(spark, f"{root}/typed", jobs.typed_layout(PURCHASES))
    return stored.select("row_hash", "purchase_id")


def _states_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Additive part of the rollup, from states written by a stream in several batches."""
    root = scratch(spark)
    events = view(spark, sf, "v_events")
    events.repartition(4, "id").write.parquet(f"{root}/events")
    source = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2)
    jobs.stream_event_states(
        source.parquet(f"{root}/events"), f"{root}/states", f"{root}/checkpoint"
    ).awaitTermination()
    return _read_states(spark, root)


def _read_states(spark: SparkSession, root: str) -> DataFrame:
    states = store.read_store(spark, f"{root}/states", jobs.STATES)
    return rollup.merge_states(states).select("event_date", "event_type", "total_spent", "total_actions")


def _states_expired(spark: SparkSession, sf: str) -> DataFrame:
    """States of a stream in several batches, merged by maintenance twice and expired by day folder."""
    root = scratch(spark)
    events = view(spark, sf, "v_events")
    for number in range(4):
        jobs.add_states(events.where(F.col("id") % 4 == number), f"{root}/states", "run", number)
        if number % 2:
            jobs.compact_states(spark, f"{root}/states")
    jobs.expire_states(spark, f"{root}/states", STATES_FROM)
    return _read_states(spark, root)


def _login_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Three versions of each login in batches of their own, with maintenance between: the earliest one stays."""
    root = scratch(spark)
    logins = view(spark, sf, "v_logins")
    for number, hours in enumerate((2, 0, 1)):
        sent = logins.withColumn("event_timestamp", F.expr(f"event_timestamp + make_interval(0, 0, 0, 0, {hours})"))
        jobs.add_logins(relay.login_messages(sent), f"{root}/logins", f"{root}/rejects", "run", number)
    jobs.compact_logins(spark, f"{root}/logins")
    return jobs.read_logins(spark, f"{root}/logins").drop("processed_at")


def _alerts(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of each hour and event type as evaluations, in two files; a count above the limit for three hours fires."""
    root = scratch(spark)
    hourly = view(spark, sf, "v_events").groupBy(
        F.col("event_type").alias("rule"), F.date_trunc("hour", "event_time").alias("at")
    ).agg(F.count("*").alias("value"))
    limits = hourly.groupBy("rule").agg((F.sum("value") / F.count("*")).cast("bigint").alias("row_limit"))
    checks = hourly.join(limits, "rule").select(*alerts.CHECKS.names)
    for early in (True, False):
        part = checks.where((F.col("at") < convert.at(ALERTS_SPLIT)) == early)
        part.coalesce(1).write.mode("append").parquet(f"{root}/checks")
    source = spark.readStream.schema(alerts.CHECKS).option("maxFilesPerTrigger", 1).parquet(f"{root}/checks")
    alerts.watch_alerts(source, 3 * 3600, f"{root}/alerts", f"{root}/checkpoint").awaitTermination()
    return store.read_store(spark, f"{root}/alerts", alerts.TRANSITIONS).select("rule", "state", "at")


def _counts_stream(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch(spark)
    orders = table(spark, sf, "orders").select("o_orderkey")
    source = spark.readStream.schema(orders.schema).option("pathGlobFilter", "orders.parquet").parquet(sf)
    jobs.watch_counts(source, 200, f"{root}/checks", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/checks").select("row_count", "row_limit", "firing")


def _land(spark: SparkSession, sf: str) -> DataFrame:
    sent = view(spark, sf, "v_raw_purchases").select(F.col("full_data").alias("value"))
    return documents.land_raw(sent, EVENTS_NOW)


def _rejected(spark: SparkSession, sf: str) -> DataFrame:
    sent = view(spark, sf, "v_raw_purchases").select(F.col("full_data").alias("value"))
    return documents.rejected(documents.check_messages(sent))


def _contacts(spark: SparkSession, sf: str) -> DataFrame:
    phones = view(spark, sf, "v_phones")
    mail = F.concat(F.lit("User."), F.col("c_custkey").cast("string"), F.lit("@Example.COM"))
    person = F.struct(F.col("phone"), F.struct(mail.alias("work_email")).alias("mail"))
    nested = phones.select(
        F.col("c_custkey").alias("_id"),
        person.alias("person"),
        F.array(F.struct(F.col("phone").alias("Phone_2"), F.lit("x").alias("note"))).alias("others"),
    )
    masked = mask_pii(nested)
    return masked.select(
        "_id",
        F.col("person.phone").alias("phone"),
        F.col("person.mail.work_email").alias("work_email"),
        F.col("others")[0]["Phone_2"].alias("other_phone"),
        F.col("others")[0]["note"].alias("note"),
    )


def _to_messages(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("_id"), "o_orderstatus",
        F.struct(F.col("o_orderdate").cast("timestamp").alias("at")).alias("seen"),
    )
    return messages.to_messages(orders)


def _phones(df: DataFrame) -> DataFrame:
    return df.select("c_custkey", normalize_phone(F.col("phone")).alias("phone"))


def _status(spark: SparkSession, sf: str) -> DataFrame:
    per_store = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.count("*").alias("row_count"))
    steps = quality.STATUS_STEPS["purchases"]
    return per_store.withColumn("status", quality.status(F.col("row_count"), steps))


def _folder_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Files with the columns in two orders, one without rows, and a second delivery, taken two files a round."""
    root = scratch(spark)
    rows = view(spark, sf, "v_folder")
    columns = rows.columns
    late = F.pmod("id", F.lit(10)) == 3
    for part, order in ((rows.where(~late), columns), (rows.limit(0), columns), (rows.where(late), columns[::-1])):
        part.select(*order).repartition(2).write.mode("append").option("header", True).csv(f"{root}/in")
        folder.load_csv_folder(spark, f"{root}/in", f"{root}/out", f"{root}/archive", f"{root}/ledger", rows.schema, 2)
    written = spark.read.option("header", True).schema(rows.schema).csv(f"{root}/out")
    return written.select(*columns)


def _links(spark: SparkSession, sf: str) -> DataFrame:
    return web.page_links(table(spark, sf, "pages"))


def _item_urls(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages")
    urls = web.all_urls(pages, web.same_host_links(web.page_links(pages)))
    start = "http://ththre.example.com/fr/825?page=2&ref=x"
    return web.item_urls(urls, ".example.com/the", start)


def _site_crawl(spark: SparkSession, sf: str) -> DataFrame:
    """A walk over half of the given pages by their own links, each page at one of the addresses they link to."""
    pages = view(spark, sf, "v_linked_site")
    start = pages.where("place = 0").first()["url"]
    return web.crawl_frontier(pages, web.page_links(pages), start, pages.count() // 2)


def _crawl(spark: SparkSession, sf: str) -> DataFrame:
    pages = view(spark, sf, "v_site")
    return web.crawl_frontier(pages, web.page_links(pages), "http://shop.example/p/0", 100)


def _page_fields(spark: SparkSession, sf: str) -> DataFrame:
    return web.extract_fields(table(spark, sf, "pages"), ["product_name", "instock_qty", "no_such_field"])


def _item_fields(spark: SparkSession, sf: str) -> DataFrame:
    return web.extract_fields(view(spark, sf, "v_item_pages"))


def _complete_items(spark: SparkSession, sf: str) -> DataFrame:
    return clean.drop_incomplete(_item_fields(spark, sf))


def queries() -> dict[str, Query]:
    found: dict[str, Query] = {
        "snake_case_columns": _snake_case,
        "null_profile": _over("v_sales", _profile),
        "null_profile_compare": _over("v_sales", _profiles),
        "sales_repair": _over("v_sales", _repaired),
        "price_dense_rank": _over("v_sales", lambda df: sales.rank_prices(sales.recover_price(df))),
        "price_hypothesis": _over("v_sales", lambda df: sales.price_hypothesis(sales.recover_price(df))),
        "item_dictionary": _over("v_sales", lambda df: sales.item_dictionary(sales.recover_price(df))),
        "units_by_category": _sold(sales.units_by_category),
        "top5_categories": _sold(sales.top_categories),
        "avg_by_payment": _sold(lambda df: sales.average_ticket(df, "payment_method")),
        "avg_by_location": _sold(lambda df: sales.average_ticket(df, "location")),
        "sales_by_weekday": _sold(sales.sales_by_weekday),
        "sales_by_month": _sold(sales.sales_by_month),
        "customer_ltv_top10": _sold(sales.top_customers),
        "customer_features": _features,
        "customer_features_json": _json_features,
        "latest_partition_report": _latest_report,
        "event_rollup_exact": _over("v_events", rollup.exact_rollup),
        "event_sketch_error": _over("v_events", _sketch_error),
        "event_states_stream": _states_stream,
        "states_expired": _states_expired,
        "alert_transitions": _alerts,
        "login_versions": _login_versions,
        "event_ttl": _event_ttl,
        "retention_daily": _over("v_events", retention.retention_daily),
        "retention_first_visit": _over(
            "v_events", lambda df: retention.retention_first_visit(df.where("event_type = 'purchase'"))
        ),
        "audit_changes": _audit,
        "recent_audit": _recent_audit,
        "inactive_users": _inactive,
        "archive_split": _archive_split,
        "archive_report": _archive_report,
        "archive_two_runs": _archive_two_runs,
        "sales_csv_prepared": _sales_csv,
        "json_documents": _json_documents,
        "audit_export_csv": _audit_export,
        "items_csv": _items_csv,
        "catalog_tables": _catalog,
        "daily_jobs": _daily_main,
        "unsent_batch": _unsent,
        "unsent_after_mark": _outbox,
        "relay_messages": _relay_messages,
        "relay_roundtrip": _relay_roundtrip,
        "relay_stream": _relay_stream,
        "row_hash_dedupe": _dedupe,
        "typed_stream": _typed_stream,
        "land_raw": _land,
        "rejected_raw": _rejected,
        "to_messages": _to_messages,
        "mask_pii": _contacts,
        "normalize_phone": _over("v_phones", _phones),
        "duplicate_ratio": _over("v_sources_dup", lambda df: quality.duplicate_ratio(df, "o_orderkey")),
        "table_counts": lambda spark, sf: quality.table_counts(table(spark, sf, "orders"), "o_custkey"),
        "threshold_check": lambda spark, sf: quality.threshold_check(
            table(spark, sf, "orders"), quality.COUNT_LIMITS["purchases"]
        ),
        "threshold_stream": _counts_stream,
        "status_steps": _status,
        "expected_counts": lambda spark, sf: quality.expected_count(
            table(spark, sf, "orders"), quality.EXPECTED_COUNTS["purchases"]
        ),
        "typed_customer_metrics": _typed_metrics,
        "csv_folder_stream": _folder_stream,
        "clean_counts": _over("v_folder", clean.clean_counts),
        "page_links": _links,
        "page_links_same_host": lambda spark, sf: web.same_host_links(_links(spark, sf)),
        "item_pages": _item_urls,
        "crawl_frontier": _crawl,
        "crawl_site": _site_crawl,
        "page_fields": _page_fields,
        "item_fields": _item_fields,
        "complete_items": _complete_items,
    }
    for name, columns in METRIC_GROUPS.items():
        found[name] = _metrics(columns)
    for spec in (PRODUCTS, CUSTOMERS, PURCHASES, STORES):
        found[f"parse_{spec.collection}"] = _parsed(spec)
    return found
