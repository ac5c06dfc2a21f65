"""Repair, ranking and profile of sales rows."""

from decimal import Decimal as D

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from storelens.operators import clean, sales
from storelens.plans.registry import queries
from storelens.plans.views import view
from storelens.sources.files import read_sales_csv
from storelens.sources.specs import SALES_CSV_SCHEMA
from tables import SF_DIR

SCHEMA = """transaction_id string, customer_id string, category string, item string, price_per_unit decimal(10,2),
quantity int, total_spent decimal(10,2), payment_method string, location string, transaction_date string"""


def sale(number, item, price, quantity, total, category="Food"):
    return (number, "C1", category, item, price and D(price), quantity, total and D(total), "card", "Online", "2024-01-01")


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


ROWS = [
    sale("whole", "milk", "2.50", 4, "10.00"),
    sale("no price", "milk", None, 4, "10.00"),
    sale("no item", None, "2.50", 2, "5.00"),
    sale("no amounts", "milk", "2.50", None, None),
    sale("nothing", None, None, None, None),
    sale("zero quantity", "tea", None, 0, "3.00"),
    sale("unknown price", None, "9.99", 1, "9.99"),
    sale("no category", None, "2.50", 1, "2.50", None),
]


def test_fill_sales(spark):
    got = {r["transaction_id"]: r for r in sales.fill_sales(frame(spark, ROWS)).collect()}
    assert len(got) == len(ROWS)
    assert got["no price"]["price_per_unit"] == D("2.50")
    assert got["no item"]["item"] == "milk"
    assert got["no amounts"]["quantity"] is None and got["no amounts"]["total_spent"] is None
    assert got["nothing"]["item"] is None and got["nothing"]["price_per_unit"] is None
    assert got["zero quantity"]["price_per_unit"] is None and got["zero quantity"]["quantity"] is None
    assert got["unknown price"]["item"] is None and got["unknown price"]["quantity"] == 1
    assert got["no category"]["item"] is None


def test_repair_drops_incomplete_rows(spark):
    kept = {r["transaction_id"] for r in sales.repair_sales(frame(spark, ROWS)).collect()}
    assert kept == {"whole", "no price", "no item", "unknown price", "no category"}


def test_quantity_is_truncated(spark):
    row = sales.fill_amounts(frame(spark, [sale("x", "a", "3.00", 9, "10.00")])).first()
    assert row["quantity"] == 3 and row["total_spent"] == D("9.00")


def test_bucketed_rank_equals_dense_rank(spark):
    prices = [None, "0.01", "0.02", "99.99", "100.00", "100.00", "250.50", "-5.00", "-100.00", "99999999.99"]
    rows = [sale(str(i), f"i{i % 3}", p, 1, "1.00", c) for c in ("A", "B", None) for i, p in enumerate(prices)]
    df = frame(spark, rows)
    window = Window.partitionBy("category").orderBy("price_per_unit")
    naive = df.select("category", "item", "price_per_unit").distinct().withColumn("rank", F.dense_rank().over(window))
    got = sales.rank_prices(df)
    naive = naive.withColumn("rank", F.col("rank").cast("bigint"))
    assert got.exceptAll(naive).isEmpty() and naive.exceptAll(got).isEmpty()


def test_price_hypothesis_counts_agree(spark):
    rows = sales.price_hypothesis(sales.recover_price(view(spark, SF_DIR, "v_sales"))).collect()
    assert rows
    assert all(r["distinct_ranks"] - r["distinct_prices"] in (0, 1) for r in rows)


def test_repair_never_adds_gaps(spark):
    names = ["category", "item", "price_per_unit", "quantity", "total_spent"]
    df = view(spark, SF_DIR, "v_sales")
    for row in clean.compare_profiles(df, sales.fill_sales(df), clean.null_tests(names)).collect():
        assert row["after"] <= row["before"]


def test_profiles_read_the_sales_once(spark):
    found = queries()["null_profile_compare"](spark, SF_DIR)
    assert all("/profiled/" in name for name in found.inputFiles())
    want = clean.compare_profiles(df := view(spark, SF_DIR, "v_sales"), sales.fill_sales(df), clean.null_tests(
        ["category", "item", "price_per_unit", "quantity", "total_spent"], zero=("quantity",)))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))


def test_dictionary_sorts_distinct_names_only(spark):
    rows = [*ROWS, sale("greater", "tea", "2.50", 1, "2.50"), sale("again", "tea", "2.50", 1, "2.50"), sale("no price", "x", None, 1, None), sale("no keys", "x", None, 1, None, None), sale("empty", "", "7.00", 1, "7.00")]
    found = sales.item_dictionary(frame(spark, rows))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate(keys=[category" in plan
    got = {(r["category"], r["price_per_unit"]): r["known_item"] for r in found.collect()}
    assert found.count() == len(got)
    assert got == {("Food", D("2.50")): "tea", ("Food", None): "x", ("Food", D("9.99")): None, (None, D("2.50")): None, (None, None): "x", ("Food", D("7.00")): ""}


def test_csv_file_to_prepared_rows(spark, tmp_path):
    (tmp_path / "sales.csv").write_text(
        "Transaction ID,Customer ID,Category,Item,Price Per Unit,Quantity,Total Spent,Payment Method,Location,Transaction Date,Discount Applied\n"
        "T1,C1,Food,NaN,2.5,4.0,10.0,Cash,Online,2024-01-07,True\n"
        "T2,C1,Food,milk,NaN,NaN,,Cash,Online,not a date,\n",
        encoding="utf-8",
    )
    raw = read_sales_csv(spark, str(tmp_path / "sales.csv"))
    assert clean.preview(raw, 1).count() == 1
    rows = {r["transaction_id"]: r for r in sales.prepare_sales(raw).collect()}
    assert rows["T1"]["item"] is None and rows["T1"]["price_per_unit"] == D("2.50") and rows["T1"]["quantity"] == 4
    assert rows["T2"]["price_per_unit"] is None and rows["T2"]["quantity"] is None
    calendar = {r["transaction_id"]: r for r in sales.with_calendar(sales.prepare_sales(raw)).collect()}
    assert (calendar["T1"]["day_of_week"], calendar["T1"]["day_of_week_num"]) == ("Sun", 7)
    assert (calendar["T1"]["transaction_month_name"], calendar["T1"]["transaction_month"]) == ("January", 1)
    assert calendar["T2"]["day_of_week"] is None


def test_ties_are_cut_by_key(spark):
    rows = [sale(str(i), "x", "1.00", 1, "1.00", c) for i, c in enumerate("FEDCBA")]
    assert [r["category"] for r in sales.top_categories(sales.sold(frame(spark, rows)), 3).collect()] == ["A", "B", "C"]


def test_observed_counts(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (None, "c")], "x int, y string")
    kept, seen = clean.observed_clean(df)
    assert kept.count() == 1
    assert seen.get == {"rows_read": 3, "rows_kept": 1, "rows_removed": 2}


def test_sales_csv_is_read_by_header_names(spark, tmp_path):
    names = [f.name for f in SALES_CSV_SCHEMA]
    (tmp_path / "turned.csv").write_text(
        ",".join(reversed(["Extra", *names])) + "\n" + ",".join(reversed(["x", *(["1"] * (len(names) - 1)), "True"])) + "\n")
    row = read_sales_csv(spark, str(tmp_path / "turned.csv")).first()
    assert row["Discount Applied"] == "True" and row["Quantity"] == 1.0 and "Extra" not in row.asDict()
    (tmp_path / "short.csv").write_text("Item\nmilk\n")
    with pytest.raises(ValueError, match="Quantity"):
        read_sales_csv(spark, str(tmp_path / "short.csv"))
