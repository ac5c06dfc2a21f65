"""Repair and exploration of retail sales rows.

Columns: transaction_id, customer_id, category, item, price_per_unit,
quantity, total_spent, payment_method, location, transaction_date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storelens.functions import convert
from storelens.operators import clean

MONEY = "decimal(10,2)"
SALES_TYPES = {"price_per_unit": MONEY, "total_spent": MONEY, "quantity": "int"}
# A bucket of this many whole currency units holds at most 100 times as many prices.
PRICE_BUCKET = 100


def prepare_sales(df: DataFrame) -> DataFrame:
    """Names, types and the textual NaN of the CSV file put right."""
    named = clean.snake_case_columns(df)
    typed = clean.cast_columns(named, SALES_TYPES)
    return clean.null_if_value(typed, "item", "NaN")


def recover_price(df: DataFrame) -> DataFrame:
    derived = F.try_divide("total_spent", "quantity").try_cast(MONEY)
    return df.withColumn("price_per_unit", F.coalesce("price_per_unit", derived))


def recover_quantity(df: DataFrame) -> DataFrame:
    """Whole units of every row from its total and price."""
    return df.withColumn("quantity", F.try_divide("total_spent", "price_per_unit").try_cast("int"))


def item_dictionary(df: DataFrame) -> DataFrame:
    """One item per (category, price): the greatest known name.

    Distinct rows first: they are hashed and combined before the shuffle, and only they are sorted. An aggregate with
    ``max`` would be planned without the distinct, which changes nothing in its result, and sort the whole input.
    """
    names = df.select("category", "price_per_unit", "item").distinct()
    greatest = Window.partitionBy("category", "price_per_unit").orderBy(F.desc_nulls_last("item"))
    first = names.withColumn("place", F.row_number().over(greatest)).where("place = 1")
    return first.select("category", "price_per_unit", F.col("item").alias("known_item"))


def recover_item(df: DataFrame) -> DataFrame:
    """Missing items from the dictionary; rows without category or price stay as they are.

    The dictionary is small or it is not: the join is planned by its measured size, and a frequent price is split.
    """
    named = df.where("item IS NOT NULL AND category IS NOT NULL AND price_per_unit IS NOT NULL")
    found = df.join(item_dictionary(named), ["category", "price_per_unit"], "left")
    return found.withColumn("item", F.coalesce("item", "known_item")).select(*df.columns)


def recompute_total(df: DataFrame) -> DataFrame:
    return df.withColumn("total_spent", F.col("quantity") * F.col("price_per_unit"))


def fill_sales(df: DataFrame) -> DataFrame:
    """Price, quantity, item and total recovered; no row is dropped."""
    return recompute_total(recover_item(recover_quantity(recover_price(df))))


def fill_amounts(df: DataFrame) -> DataFrame:
    """``fill_sales`` without the item names, for reports that do not read them: no join."""
    return recompute_total(recover_quantity(recover_price(df)))


def complete_sales(df: DataFrame) -> DataFrame:
    return clean.require(df, ["total_spent", "quantity", "price_per_unit"])


def repair_sales(df: DataFrame) -> DataFrame:
    return complete_sales(fill_sales(df))


def sold(df: DataFrame) -> DataFrame:
    """Complete rows for reports by category, payment, place, day or customer."""
    return complete_sales(fill_amounts(df))


def price_ranks(df: DataFrame) -> DataFrame:
    """``dense_rank`` of each distinct price within its category, NULL price first.

    Prices are ranked inside buckets of bounded width and shifted by the number of
    prices in the buckets below, so no task has to sort a whole category.
    """
    price = F.col("price_per_unit")
    bucketed = (
        df.select("category", "price_per_unit")
        .distinct()
        .withColumn("bucket", F.floor(price / PRICE_BUCKET))
    )
    in_bucket = Window.partitionBy("category", "bucket").orderBy("price_per_unit")
    below = Window.partitionBy("category").orderBy("bucket")
    shifts = (
        bucketed.groupBy("category", "bucket")
        .agg(F.count("*").alias("width"))
        .withColumn("shift", F.sum("width").over(below) - F.col("width"))
        .withColumnsRenamed({"category": "_category", "bucket": "_bucket"})
    )
    matched = F.col("category").eqNullSafe(F.col("_category")) & F.col("bucket").eqNullSafe(F.col("_bucket"))
    return (
        bucketed.withColumn("local", F.dense_rank().over(in_bucket))
        .join(shifts, matched)
        .select(
            "category",
            "price_per_unit",
            (F.col("local") + F.col("shift")).alias("rank"),
        )
    )


def rank_prices(df: DataFrame) -> DataFrame:
    """Distinct (category, item, price) rows with the rank of the price in its category."""
    rows = df.select("category", "item", "price_per_unit").distinct()
    ranks = price_ranks(rows).withColumnsRenamed(
        {"category": "_category", "price_per_unit": "_price"}
    )
    matched = F.col("category").eqNullSafe(F.col("_category")) & F.col("price_per_unit").eqNullSafe(F.col("_price"))
    return rows.join(ranks, matched).select("category", "item", "price_per_unit", "rank")


def price_hypothesis(df: DataFrame) -> DataFrame:
    """Per category the number of distinct ranks and of distinct prices."""
    return price_ranks(df).groupBy("category").agg(
        F.count("rank").alias("distinct_ranks"),
        F.count("price_per_unit").alias("distinct_prices"),
    )


def units_by_category(df: DataFrame) -> DataFrame:
    units = df.groupBy("category").agg(F.sum("quantity").alias("units"))
    return units.orderBy(F.desc("units"), "category")


def top_categories(df: DataFrame, n: int = 5) -> DataFrame:
    return units_by_category(df).limit(n)


def average_ticket(df: DataFrame, by: str) -> DataFrame:
    mean = F.round(F.avg("total_spent"), 2).alias("avg_total_spent")
    return df.groupBy(by).agg(mean).orderBy(F.desc("avg_total_spent"), by)


def with_calendar(df: DataFrame) -> DataFrame:
    """Weekday and month of the transaction, as name and as number."""
    day = F.col("transaction_date").try_cast("date")
    return df.withColumns({
        "day_of_week": F.date_format(day, "E"),
        "day_of_week_num": convert.monday_first(day),
        "transaction_month_name": F.date_format(day, "MMMM"),
        "transaction_month": F.month(day),
    })


def _sales_by(df: DataFrame, name: str, number: str) -> DataFrame:
    totals = with_calendar(df).groupBy(name, number).agg(
        F.sum("total_spent").alias("total_spent"),
        F.round(F.avg("total_spent"), 2).alias("avg_total_spent"),
    )
    return totals.orderBy(number).drop(number)


def sales_by_weekday(df: DataFrame) -> DataFrame:
    return _sales_by(df, "day_of_week", "day_of_week_num")


def sales_by_month(df: DataFrame) -> DataFrame:
    return _sales_by(df, "transaction_month_name", "transaction_month")


def lifetime_value(df: DataFrame) -> DataFrame:
    return df.groupBy("customer_id").agg(F.sum("total_spent").alias("clv"))


def top_customers(df: DataFrame, n: int = 10) -> DataFrame:
    return lifetime_value(df).orderBy(F.desc("clv"), "customer_id").limit(n)
