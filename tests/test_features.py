"""One-pass features against separate aggregates joined together, and edge rows."""

import json
import re
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import functions as F

from tables import SF_DIR
from storelens.operators import dedupe, documents, features
from storelens.plans import registry
from storelens.plans.registry import RETAIL_CONFIG, RUN_DS, queries
from storelens.plans.views import view
from storelens.sources.specs import PURCHASES

AS_OF = datetime(2001, 8, 2)


def joined_form(df):
    """Each measure as an aggregate of its own, attached by left join, gaps filled with 0."""
    df = df.where("customer_id IS NOT NULL")

    def per(rows, **measures):
        return rows.groupBy("customer_id").agg(*[m.alias(n) for n, m in measures.items()])

    def since(days):
        return df.where(F.expr(f"purchase_datetime >= TIMESTAMP'2001-08-02' - INTERVAL {days} DAYS"))

    def with_text(rows, text):
        return rows.where(F.col("items").contains(text))

    parts = [
        per(df, total_purchases=F.count("*"), unique_cities=F.countDistinct("store_city"), unique_stores=F.countDistinct("store_id")),
        per(df, unique_purchase_days=F.countDistinct(F.to_date("purchase_datetime"))),
        per(df.where("payment_method = 'card'"), card_purchases=F.count("*")),
        per(with_text(since(30), "SMALL"), milk_purchases_30d=F.count("*")),
        per(with_text(since(7), "PROMO"), meat_purchases_7d=F.count("*")),
        per(with_text(since(14), "MEDIUM"), veggies_purchases_14d=F.count("*")),
        per(since(7), total_spent_7d=F.sum("total_amount")),
        per(df.where("size(split(items, ',')) = 1"), single_item_purchases=F.count("*")),
        per(df.select("customer_id", F.explode(F.split("items", ",")).alias("c")), unique_categories=F.countDistinct("c")),
    ]
    return reduce(lambda a, b: a.join(b, "customer_id", "left"), parts).fillna(0)


def test_one_pass_equals_joined_aggregates(spark):
    purchases = view(spark, SF_DIR, "v_purchases")
    naive = joined_form(purchases)
    metrics = features.customer_metrics(purchases, RUN_DS, None, RETAIL_CONFIG).select(*naive.columns)
    assert metrics.count() == 1500
    assert metrics.exceptAll(naive).isEmpty() and naive.exceptAll(metrics).isEmpty()


SCHEMA = """purchase_id string, customer_id string, store_id string, store_city string, total_amount double, payment_method string,
is_delivery boolean, items string, purchase_datetime timestamp"""
MILK = '[{"product_id":"p1","category":"молочные продукты"},{"product_id":"p2","category":"фрукты и ягоды"}]'


def purchase(number, customer, at, items=MILK, amount=1500.0, store="s1", city="c1", pay="card"):
    return (number, customer, store, city, amount, pay, False, items, at)


def test_json_carts_and_edge_customers(spark):
    day = datetime(2024, 3, 30, 13, 0)
    rows = [
        purchase("1", "a", day),
        purchase("2", "a", day, store="s2", city="c2", pay="cash"),
        purchase("3", "a", datetime(2023, 1, 1, 22, 0)),
        purchase("4", "null amounts", day, items=None, amount=None),
        purchase("5", None, day),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r["customer_id"]: r for r in features.customer_features(df, "20240331").collect()}
    assert set(got) == {"a", "null amounts"}
    a = got["a"]
    assert len(a) == 32 and a["ds"] == "20240331"
    for name in ("bought_milk_last_30d", "bought_fruits_last_14d", "not_bought_veggies_14d", "bulk_buyer", "multicity_buyer",
                 "switching_store", "night_shopper", "early_bird", "loyal_customer", "vegetarian_profile", "weekend_shopper",
                 "recent_high_spender"):
        assert a[name] == 1, name
    for name in ("new_customer", "store_loyal", "low_cost_buyer", "single_item_buyer", "varied_shopper", "family_shopper",
                 "no_purchases", "prefers_card", "prefers_cash", "fruit_lover", "recurrent_buyer", "morning_shopper"):
        assert a[name] == 0, name
    bare = got["null amounts"]
    assert bare["low_cost_buyer"] == 1 and bare["new_customer"] == 1 and bare["vegetarian_profile"] == 1
    assert bare["inactive_14_30"] == 0


def test_bounded_leaves_out_later_purchases(spark):
    rows = [purchase("1", "a", datetime(2024, 3, 1)), purchase("2", "a", datetime(2024, 5, 1))]
    df = spark.createDataFrame(rows, SCHEMA)
    config = features.FeatureConfig(bounded=True)
    assert features.customer_metrics(df, "20240331").first()["total_purchases"] == 2
    assert features.customer_metrics(df, "20240331", config=config).first()["total_purchases"] == 1


def test_organic_comes_from_the_product_table(spark):
    rows = [purchase("1", "a", datetime(2024, 3, 1)), purchase("2", "b", datetime(2024, 3, 1), items="[]"), purchase("3", "c", datetime(2024, 3, 1), items=None)]
    df = spark.createDataFrame(rows, SCHEMA)
    products = spark.createDataFrame([("p2", True), ("p1", False)], "product_id string, is_organic boolean")
    found = features.customer_features(df, "20240331", products=products)
    flags = {r["customer_id"]: r["organic_preference"] for r in found.collect()}
    assert flags == {"a": 1, "b": 0, "c": 0}


def test_organic_purchases_are_counted_once(spark):
    both = '[{"product_id":"p1","category":"x"},{"product_id":"P2","category":"x"}]'
    rows = [purchase(str(n), "a", datetime(2024, 3, 1), items=both) for n in range(3)] + [purchase("9", "a", datetime(2024, 3, 1), items="[]")]
    products = spark.createDataFrame([("p1", True), ("p2", True), ("p2", True), (None, True)], "product_id string, is_organic boolean")
    got = features.customer_metrics(spark.createDataFrame(rows, SCHEMA), "20240331", products=products).first()
    assert (got["organic_purchases"], got["total_purchases"], got["unique_categories"]) == (3, 4, 1)


def test_cubes_of_parts_give_the_same_metrics(spark):
    purchases = view(spark, SF_DIR, "v_purchases")
    whole = features.customer_metrics(purchases, RUN_DS, None, RETAIL_CONFIG)
    cubes = [features.customer_cube(purchases.where(F.col("purchase_id") % 3 == n), RUN_DS, None, RETAIL_CONFIG) for n in range(3)]
    merged = features.metrics_of(features.merge_cubes(reduce(lambda a, b: a.unionByName(b), cubes))).select(*whole.columns)
    assert merged.count() == whole.count()
    assert merged.exceptAll(whole).isEmpty()


def test_purchases_are_read_once_and_nothing_is_sorted_to_aggregate(spark):
    purchases = view(spark, SF_DIR, "v_purchases").checkpoint()
    products = spark.createDataFrame([("p2", True)], "product_id string, is_organic boolean")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plain = features.customer_metrics(purchases, RUN_DS, AS_OF, RETAIL_CONFIG)
        json_ = features.customer_metrics(purchases, RUN_DS, AS_OF, products=products)
        plans = [df._jdf.queryExecution().executedPlan().toString() for df in (plain, json_)]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert plans[0].count("Exchange hashpartitioning") == 2 and "Join" not in plans[0]
    for plan in plans:
        assert plan.count("ExistingRDD[purchase_id") == 1
        assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_only_what_differs_within_a_day_is_aggregated(spark):
    plan = features.customer_features(view(spark, SF_DIR, "v_purchases"), RUN_DS, None, RETAIL_CONFIG)._jdf.queryExecution()
    # A count that takes days whole has no place in the hash table.
    kept = re.search(r"HashAggregate\(keys=\[customer_id#\d+L, kind#\d+, value#\d+\], functions=\[(partial_.*)", plan.executedPlan().toString())[1]
    assert kept.split("output=")[0].count("partial_") <= 19


def test_counts_of_whole_days_on_odd_rows(spark):
    start = datetime(2024, 3, 31)
    rows = [purchase(str(n), "a", start - timedelta(hours=5 * n)) for n in range(200)]
    rows += [purchase(None, "a", None, amount=None, pay=None), purchase("1", "b", None, items=None), rows[3], rows[3]]
    df = spark.createDataFrame(rows, SCHEMA)
    for as_of in (None, datetime(2024, 4, 1), datetime(2024, 3, 31, 13, 17)):
        now = as_of or datetime(2024, 4, 1)
        got = {r["customer_id"]: r for r in features.customer_metrics(df, "20240331", as_of).collect()}
        for who in "ab":
            mine = [r for r in rows if r[1] == who]
            at = [r[8] for r in mine if r[8]]
            want = {
                "total_purchases": len(mine),
                "weekend_purchases": sum(t.weekday() > 4 for t in at), "weekday_purchases": sum(t.weekday() < 5 for t in at),
                "unique_purchase_days": len({t.date() for t in at}),
                "total_spent_7d": sum(r[4] for r in mine if r[8] and r[8] >= now - timedelta(days=7)),
                "milk_purchases_30d": sum(t >= now - timedelta(days=30) for t in at),
                "fruits_purchases_14d": sum(t >= now - timedelta(days=14) for t in at),
            }
            want |= {f"recent_{d}d_purchases": sum(t >= start - timedelta(days=d) for t in at) for d in (7, 14, 30, 90)}
            assert {k: got[who][k] for k in want} == want, (as_of, who)


def test_copies_are_found_without_shuffling_columns_nobody_reads(spark):
    plan = queries()["typed_customer_metrics"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    shuffled = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert any("row_hash" in line for line in shuffled)
    assert not any(name in line for line in shuffled for name in ("customer_first_name", "store_name", "delivery_street"))


def test_read_columns_and_hash_keep_as_many_rows_as_all_columns(spark):
    bought = {"purchase_id": "1", "customer": {"customer_id": "a", "first_name": "x"}, "total_amount": 0.0}
    other = {"purchase_id": "1", "customer": {"customer_id": "a", "first_name": "y"}, "total_amount": -0.0}
    texts = [json.dumps(d) for d in (bought, bought, other, {}, {}, {"customer": {"customer_id": None}}, {"total_amount": "NaN"})] + ["", "[1] [2]", None]
    typed = documents.parse_documents(spark.createDataFrame([(t,) for t in texts], "full_data string"), PURCHASES)
    whole = dedupe.unique_rows(typed, PURCHASES).select("row_hash", *features.PURCHASE_COLUMNS)
    narrow = dedupe.unique_rows(typed.select("row_hash", *features.PURCHASE_COLUMNS), PURCHASES)
    assert narrow.count() == whole.count() >= 3
    assert narrow.exceptAll(whole).isEmpty() and whole.exceptAll(narrow).isEmpty()


def test_products_meet_carts_before_purchases_become_rows(spark):
    carts = ['[{"product_id":"p1"},{"product_id":null},{"product_id":"P1"},{"product_id":"p3"}]', '[{"product_id":null}]', "[]", None, "bad"]
    rows = [purchase(n, "a", datetime(2024, 3, 1), items=cart) for n, cart in enumerate(carts)]
    rows = [(None if r[0] is None else str(r[0]), *r[1:]) for r in [*rows, purchase(None, "a", None, items=carts[0]), purchase(0, "a", None, items=carts[0])]]
    products = spark.createDataFrame([("p1", True), ("p2", True), ("p3", True), (None, True), ("p4", None)], "product_id string, is_organic boolean")
    cube = features.customer_cube(spark.createDataFrame(rows, SCHEMA), "20240331", products=products)
    plan = cube._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode(CASE WHEN isnull(product") < plan.index("Join LeftOuter")
    got = sorted((r["kind"], r["value"] or "", r["total_purchases"]) for r in cube.collect())
    assert got == [("city", "c1", 0), ("day", "", 2), ("day", "2024-03-01", 5), ("organic", "0", 0), ("store", "s1", 0)]


def test_shuffle_files_of_a_day_go_before_the_next_day(spark, monkeypatch):
    done = []
    monkeypatch.setattr(registry.sinks, "write_partition", lambda df, path, write=registry.sinks.write_partition: done.append("written") or write(df, path))
    monkeypatch.setattr(registry, "release", lambda session: done.append("released"))
    assert queries()["latest_partition_report"](spark, SF_DIR).count() == 1500
    assert done == ["written", "released"] * 2
