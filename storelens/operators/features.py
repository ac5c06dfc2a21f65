"""Customer metrics and daily feature flags from purchases.

Expected columns: customer_id, store_id, store_city, total_amount,
payment_method, is_delivery, items, purchase_datetime. ``items`` is either the
JSON array of the typed purchase table or text with comma separated categories.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, datetime, time, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.functions.convert import at, flag

# Product groups as they are named in the documents.
PRODUCT_GROUPS = {
    "milk": "Молочные продукты",
    "fruits": "Фрукты и ягоды",
    "veggies": "Овощи и зелень",
    "bakery": "Зерновые и хлебобулочные изделия",
    "meat": "Мясо, рыба, яйца и бобовые",
    "organic": "organic",
}

# What is read of a purchase; its id only with a product table.
PURCHASE_COLUMNS = (
    "purchase_id", "customer_id", "store_id", "store_city", "total_amount", "payment_method", "is_delivery", "items", "purchase_datetime",
)
RECENT_GROUPS = (("milk", 30), ("fruits", 30), ("fruits", 14), ("veggies", 14), ("meat", 7), ("meat", 90))
MEASURES = (
    "total_purchases", "amount", "amounts", "max_cart_value", "min_cart_value", "last_purchase_date", "first_purchase_date",
    "total_spent_7d", "cart_size", "carts", "delivery_purchases", "cash_purchases", "card_purchases", "weekend_purchases",
    "weekday_purchases", "night_purchases", "morning_purchases", "early_bird_purchases", "single_item_purchases",
    *(f"recent_{days}d_purchases" for days in (7, 14, 30, 90)), *(f"{group}_purchases" for group in PRODUCT_GROUPS),
    *(f"{group}_purchases_{days}d" for group, days in RECENT_GROUPS),
)


@dataclass(frozen=True)
class FeatureConfig:
    """Product groups and limits of the flags."""

    groups: dict[str, str] = field(default_factory=lambda: dict(PRODUCT_GROUPS))
    items_are_json: bool = True
    bounded: bool = False
    recurrent_over: int = 2
    new_customer_days: int = 30
    bulk_over: float = 1000
    low_cost_under: float = 200
    loyal_from: int = 3
    payment_share: float = 0.7
    day_kind_share: float = 0.6
    single_item_share: float = 0.5
    varied_from: int = 4
    family_from: float = 4
    high_spender_over: float = 2000
    fruit_lover_from: int = 3


@dataclass(frozen=True)
class RunTime:
    """Day of the partition and the moment that stands for "now"."""

    ds: date
    as_of: datetime

    @classmethod
    def of(cls, ds: str, as_of: datetime | None = None) -> RunTime:
        day = datetime.strptime(ds, "%Y%m%d").date()
        return cls(day, as_of or datetime.combine(day + timedelta(days=1), time()))

    @property
    def at_midnight(self) -> bool:
        """Whether now is the start of a day, so that ``within`` takes a day whole or not at all."""
        return self.as_of.tzinfo is None and self.as_of.time() == time()

    def bought_since(self, days: int, bought_at: str = "purchase_datetime") -> Column:
        """Purchase day within ``days`` before the partition day, as a bound on the time itself."""
        start = datetime.combine(self.ds - timedelta(days=days), time())
        return F.col(bought_at) >= at(start)

    def within(self, days: int, bought_at: str = "purchase_datetime") -> Column:
        """Purchase time within ``days`` before now."""
        start = self.as_of - timedelta(days=days)
        return F.col(bought_at) >= at(start)


def with_cart(purchases: DataFrame, config: FeatureConfig) -> DataFrame:
    """Add ``cart``, the categories in the purchase, and ``products``, one element per item; NULL without items."""
    if config.items_are_json:
        items = F.from_json(F.lower(F.col("items")), "array<struct<category:string,product_id:string>>")
        # The one-element explode keeps later steps from parsing the text again.
        parsed = purchases.withColumn("parsed_", F.explode(F.array(items)))
        return parsed.withColumns({"cart": F.col("parsed_")["category"], "products": F.col("parsed_")["product_id"]}).drop("parsed_")
    return purchases.withColumns({"cart": F.split("items", ","), "products": F.lit(None).cast("array<string>")})


def _group_test(config: FeatureConfig, group: str) -> Column:
    wanted = config.groups[group].lower()
    if config.items_are_json and group != "organic":
        return F.array_contains("cart", wanted)
    return F.lower(F.col("items")).contains(wanted)


def _facts(purchases: DataFrame, run: RunTime, config: FeatureConfig) -> DataFrame:
    """What the measures look at, worked out once per purchase."""
    bought_at = F.col("purchase_datetime")
    groups = {f"has_{g}": _group_test(config, g) for g in PRODUCT_GROUPS}
    carried = [c for c in ("purchase_id",) if c in purchases.columns]
    return purchases.select(
        "customer_id", "store_city", "store_id", "cart", "products", "payment_method", bought_at, *carried,
        F.col("total_amount").alias("amount"),
        (F.col("is_delivery").cast("int") == 1).alias("delivered"),
        F.size("cart").alias("cart_size"),
        F.hour(bought_at).alias("hour"),
        *[run.within(d).alias(f"in_{d}d") for d in (7, 14, 30, 90)],
        *[test.alias(name) for name, test in groups.items()],
    )


def _counted(run: RunTime) -> dict[str, Column]:
    """Conditions over ``_facts`` whose matching purchases are counted per customer; without those of ``_by_day``."""
    fact = F.col
    counted = {
        "delivery_purchases": fact("delivered"),
        "cash_purchases": fact("payment_method") == "cash",
        "card_purchases": fact("payment_method") == "card",
        "night_purchases": fact("hour") >= 20,
        "morning_purchases": fact("hour") < 10,
        "early_bird_purchases": fact("hour").between(12, 15),
        "single_item_purchases": fact("cart_size") == 1,
    }
    for group in PRODUCT_GROUPS:
        counted[f"{group}_purchases"] = fact(f"has_{group}")
    if not run.at_midnight:
        for group, days in RECENT_GROUPS:
            counted[f"{group}_purchases_{days}d"] = fact(f"has_{group}") & fact(f"in_{days}d")
    return counted


def _by_day(run: RunTime) -> dict[str, Column]:
    """Counts that take all purchases of a day or none, from the finished row of the day: they need no aggregate of their own."""
    day = "first_purchase_date"
    weekend = F.dayofweek(day).isin(1, 7)
    tests = {"weekend_purchases": (weekend, "total_purchases"), "weekday_purchases": (~weekend, "total_purchases")}
    for days in (7, 14, 30, 90):
        tests[f"recent_{days}d_purchases"] = (run.bought_since(days, day), "total_purchases")
    if run.at_midnight:
        for group, days in RECENT_GROUPS:
            tests[f"{group}_purchases_{days}d"] = (run.within(days, day), f"{group}_purchases")
    return {name: F.when(test, F.col(count)).otherwise(0) for name, (test, count) in tests.items()}


def customer_cube(
    purchases: DataFrame,
    ds: str,
    as_of: datetime | None = None,
    config: FeatureConfig | None = None,
    products: DataFrame | None = None,
) -> DataFrame:
    """Everything the metrics need, from one reading of the purchases: (customer_id, kind, value) and the measures.

    A customer has a row of kind ``day`` for each day with purchases, which carries that day's counts, sums and bounds, and a row
    without measures for each distinct ``city``, ``store`` and ``category``. With ``products`` there is one of kind
    ``organic`` for each purchase whose cart holds a product with ``is_organic``; then carts are JSON and purchases have ids.
    Rows of several cubes of one run can be put together and aggregated again, distinct values stay exact.

    Rows of a customer with very many purchases are combined before they are shuffled and then lie by value.
    """
    config = config or FeatureConfig()
    run = RunTime.of(ds, as_of)
    known = purchases.where(F.col("customer_id").isNotNull())
    if config.bounded:
        known = known.where(F.col("purchase_datetime") <= at(run.as_of))
    counted, by_day = _counted(run), _by_day(run)
    facts = _facts(with_cart(known, config), run, config).withColumns(counted)

    def row(kind: str, value: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), value.cast("string").alias("value"))

    rows = F.concat(
        F.array(row("day", F.to_date("purchase_datetime")), row("city", F.col("store_city")), row("store", F.col("store_id"))),
        F.coalesce(F.transform(F.array_distinct("cart"), lambda c: row("category", c)), F.array()),
    )
    if products is not None:
        facts = _with_organic(facts, products)
        rows = F.when(F.col("product").isNull(), rows).otherwise(F.array(row("organic", F.col("purchase_id"))))
    # The measures stay columns beside the rows, so those nobody asks for go before the rows are made.
    measures = ["amount", "purchase_datetime", "cart_size", "in_7d", *counted]
    tall = facts.select("customer_id", *measures, F.explode(rows).alias("row_")).select("customer_id", *measures, "row_.*")
    tall = tall.where((F.col("kind") == "day") | F.col("value").isNotNull())
    of_day = F.col("kind") == "day"

    def measure(name: str) -> Column:
        return F.when(of_day, F.col(name))

    recent = F.when(F.col("in_7d"), measure("amount"))
    cube = tall.groupBy("customer_id", "kind", "value").agg(
        F.count_if(of_day).alias("total_purchases"),
        F.sum(measure("amount")).alias("amount"), F.count(measure("amount")).alias("amounts"),
        F.max(measure("amount")).alias("max_cart_value"), F.min(measure("amount")).alias("min_cart_value"),
        F.max(measure("purchase_datetime")).alias("last_purchase_date"), F.min(measure("purchase_datetime")).alias("first_purchase_date"),
        *([] if run.at_midnight else [F.sum(recent).alias("total_spent_7d")]),
        F.sum(measure("cart_size")).alias("cart_size"), F.count(measure("cart_size")).alias("carts"),
        *[F.count_if(of_day & F.col(name)).alias(name) for name in counted],
    )
    if run.at_midnight:
        by_day["total_spent_7d"] = F.when(run.within(7, "first_purchase_date"), F.col("amount"))
    return cube.withColumns(by_day).select("customer_id", "kind", "value", *MEASURES)


def _with_organic(facts: DataFrame, products: DataFrame) -> DataFrame:
    """The purchases, without ``product``, and a row of ids for each organic product in their carts.

    Cart elements meet the products before a purchase becomes rows by day, city, store and category, so what is shuffled for that
    is each purchase once and its narrow cart elements. Purchases get keys that no product has, spread so that they are no
    frequent key.
    """
    organic = products.where("is_organic").select(F.col("product_id").alias("organic_")).distinct()
    none = F.array(F.lit(None).cast("string"))
    bought = F.coalesce(F.array_compact(F.array_distinct("products")), F.array())
    both = facts.withColumn("product", F.explode(F.concat(none, bought))).drop("products")
    ids = ["customer_id", "purchase_id", "product"]
    narrow = both.select(*ids, *[F.when(F.col("product").isNull(), F.col(c)).alias(c) for c in both.columns if c not in ids])
    spread_by = F.xxhash64("customer_id", "purchase_id", "store_id", "purchase_datetime")
    spread = F.concat(F.lit("\n"), F.pmod(spread_by, F.lit(100_000)).cast("string"))
    met = narrow.withColumn("key_", F.coalesce("product", spread)).join(organic, F.col("key_") == F.col("organic_"), "left")
    return met.where("product IS NULL OR organic_ IS NOT NULL").drop("key_", "organic_")


def merge_cubes(cube: DataFrame) -> DataFrame:
    """One row per customer, kind and value of cubes put together."""
    same = {"last_purchase_date": F.max, "first_purchase_date": F.min, "max_cart_value": F.max, "min_cart_value": F.min}
    keys = ["customer_id", "kind", "value"]
    return cube.groupBy(*keys).agg(*[same.get(c, F.sum)(c).alias(c) for c in cube.columns if c not in keys])


def metrics_of(cube: DataFrame, by_product: bool = False) -> DataFrame:
    """The metrics of each customer from a cube; ``by_product`` counts organic purchases by their products."""
    kinds = {"city": "unique_cities", "store": "unique_stores", "category": "unique_categories"}
    same = {"last_purchase_date": F.max, "first_purchase_date": F.min, "max_cart_value": F.max, "min_cart_value": F.min}
    means = {"avg_cart_value": ("amount", "amounts"), "avg_cart_size": ("cart_size", "carts")}
    used = {c for pair in means.values() for c in pair} | {"customer_id", "kind", "value"}
    sums = [same.get(c, F.sum)(c).alias(c) for c in cube.columns if c not in used]
    found = cube.groupBy("customer_id").agg(
        *sums,
        *[F.try_divide(F.sum(total).cast("double"), F.sum(number)).alias(name) for name, (total, number) in means.items()],
        F.count_if((F.col("kind") == "day") & F.col("value").isNotNull()).alias("unique_purchase_days"),
        *[F.count_if(F.col("kind") == kind).alias(name) for kind, name in kinds.items()],
        F.count_if(F.col("kind") == "organic").alias("by_product_"),
    )
    if by_product:
        found = found.withColumn("organic_purchases", F.col("by_product_"))
    found = found.drop("by_product_")
    return found.fillna(0, subset=[c for c in found.columns if c != "customer_id"])


def customer_metrics(
    purchases: DataFrame,
    ds: str,
    as_of: datetime | None = None,
    config: FeatureConfig | None = None,
    products: DataFrame | None = None,
) -> DataFrame:
    """One row per known customer: counts, sums and recency of the purchases.

    With ``products(product_id, is_organic)`` a purchase is organic when its cart holds such a product, otherwise
    when the text of its cart says so.
    """
    return metrics_of(customer_cube(purchases, ds, as_of, config, products), products is not None)


def _flags(run: RunTime, config: FeatureConfig) -> dict[str, Column]:
    metric = F.col
    total = metric("total_purchases")

    def any_of(name: str) -> Column:
        return metric(name) > 0

    def none_of(name: str) -> Column:
        return metric(name) == 0

    def share(name: str, limit: float) -> Column:
        return metric(name) >= total * F.lit(float(limit))

    age = F.datediff(at(run.as_of), metric("first_purchase_date"))
    return {
        "bought_milk_last_30d": any_of("milk_purchases_30d"),
        "bought_fruits_last_14d": any_of("fruits_purchases_14d"),
        "not_bought_veggies_14d": none_of("veggies_purchases_14d"),
        "recurrent_buyer": metric("recent_30d_purchases") > config.recurrent_over,
        "inactive_14_30": any_of("recent_30d_purchases") & none_of("recent_14d_purchases"),
        "new_customer": age <= config.new_customer_days,
        "delivery_user": any_of("delivery_purchases"),
        "organic_preference": any_of("organic_purchases"),
        "bulk_buyer": metric("avg_cart_value") > config.bulk_over,
        "low_cost_buyer": metric("avg_cart_value") < config.low_cost_under,
        "buys_bakery": any_of("bakery_purchases"),
        "loyal_customer": (total >= config.loyal_from) & any_of("card_purchases"),
        "multicity_buyer": metric("unique_cities") > 1,
        "bought_meat_last_week": any_of("meat_purchases_7d"),
        "night_shopper": any_of("night_purchases"),
        "morning_shopper": any_of("morning_purchases"),
        "prefers_cash": share("cash_purchases", config.payment_share),
        "prefers_card": share("card_purchases", config.payment_share),
        "weekend_shopper": share("weekend_purchases", config.day_kind_share),
        "weekday_shopper": share("weekday_purchases", config.day_kind_share),
        "single_item_buyer": share("single_item_purchases", config.single_item_share),
        "varied_shopper": metric("unique_categories") >= config.varied_from,
        "store_loyal": metric("unique_stores") == 1,
        "switching_store": metric("unique_stores") > 1,
        "family_shopper": metric("avg_cart_size") >= config.family_from,
        "early_bird": any_of("early_bird_purchases"),
        "no_purchases": total == 0,
        "recent_high_spender": metric("total_spent_7d") > config.high_spender_over,
        "fruit_lover": metric("fruits_purchases_30d") >= config.fruit_lover_from,
        "vegetarian_profile": none_of("meat_purchases_90d"),
    }


def customer_features(
    purchases: DataFrame,
    ds: str,
    as_of: datetime | None = None,
    config: FeatureConfig | None = None,
    products: DataFrame | None = None,
) -> DataFrame:
    """The 30 flags of each customer for the partition day ``ds``."""
    config = config or FeatureConfig()
    metrics = customer_metrics(purchases, ds, as_of, config, products)
    flags = _flags(RunTime.of(ds, as_of), config)
    return metrics.select(
        "customer_id",
        *[flag(test).alias(name) for name, test in flags.items()],
        F.lit(ds).alias("ds"),
    )
