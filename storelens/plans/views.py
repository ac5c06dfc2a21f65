"""Inputs of the registered queries, derived from the supplied tables.

Each view is SQL text. Where ``SPARK`` and ``DUCKDB`` do not override it, the same
text describes the input in both engines; what is computed from it differs.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "pages",
)

_PAYMENT = "CASE WHEN o.o_orderpriority IN ('1-URGENT','2-HIGH','3-MEDIUM') THEN 'card' ELSE 'cash' END"

# A cart is one document at the source, which bounds the list of its items.
_PURCHASES = """
SELECT o.o_orderkey AS purchase_id, o.o_custkey AS customer_id, i.store_id, n.n_name AS store_city,
  CAST(o.o_totalprice AS DECIMAL(12,2)) AS total_amount, {payment} AS payment_method,
  CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END AS is_delivery, i.items, {ts} AS purchase_datetime
FROM orders o
LEFT JOIN (SELECT l.l_orderkey, min(l.l_suppkey) AS store_id, {items} AS items
           FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey GROUP BY l.l_orderkey) i
  ON i.l_orderkey = o.o_orderkey
LEFT JOIN supplier s ON s.s_suppkey = i.store_id
LEFT JOIN nation n ON n.n_nationkey = s.s_nationkey
"""

_ADDRESS = """'"country":"Россия","city":"City ' || CAST({key} % 9 AS STRING) || '","street":"Main St","house":"' || CAST({key} % 30 AS STRING) || '","postal_code":"1' || CAST({key} % 1000 AS STRING) || '"'"""
_COORDINATES = """'"coordinates":{{"latitude":' || CAST({key} % 90 AS STRING) || '.5,"longitude":' || CAST({key} % 180 AS STRING) || '.25}}'"""


def _address(key: str) -> str:
    return _ADDRESS.format(key=key)


def _place(key: str) -> str:
    return f"{_address(key)} || ',' || {_COORDINATES.format(key=key)}"


_PURCHASE_JSON = f"""
CASE WHEN o_orderkey % 50 = 0 THEN '{{"purchase_id":'
     WHEN o_orderkey % 51 = 0 THEN ''
     WHEN o_orderkey % 53 = 0 THEN '{{"_id":"1"}} {{"_id":"2"}}'
     WHEN o_orderkey % 57 = 0 THEN '{{"_id":"1"}} x}}'
     WHEN o_orderkey % 59 = 0 THEN '{{"_id":"1"}},{{"_id":"2"}}'
     WHEN o_orderkey % 61 = 0 THEN '[1] [2]'
ELSE '{{"_id":"' || CAST(o_orderkey AS STRING)
  || '","purchase_id":"P-' || CAST(o_orderkey AS STRING)
  || '","customer":{{"customer_id":"C-' || CAST(o_custkey AS STRING)
  || '","first_name":"Анна","last_name":""}}'
  || ',"store":{{"store_id":"S-' || CAST(o_orderkey % 45 AS STRING)
  || '","store_name":"Store ' || CAST(o_orderkey % 45 AS STRING)
  || '","store_network":"NET","location":{{' || {_place('o_orderkey')} || '}}}}'
  || ',"items":[{{"product_id":"PR-' || CAST(o_orderkey % 20 AS STRING)
  || '","name":"Milk","category":"Молочные продукты","quantity":' || CAST(o_orderkey % 5 + 1 AS STRING) || '}}'
  || CASE WHEN o_orderkey % 4 >= 2 THEN ',{{"product_id":"PR-' || CAST((o_orderkey + 7) % 20 AS STRING)
     || '","name":"Apples","category":"Фрукты и ягоды","quantity":1}}' ELSE '' END
  || CASE WHEN o_orderkey % 4 = 3 THEN ',{{"product_id":"PR-' || CAST((o_orderkey + 10) % 20 AS STRING)
     || '","name":"Kefir","category":"Молочные продукты","quantity":2}}' ELSE '' END || ']'
  || ',"total_amount":' || CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS STRING)
  || ',"payment_method":"' || CASE WHEN o_orderkey % 2 = 0 THEN 'Card' ELSE 'Cash' END
  || '","is_delivery":' || CASE WHEN o_orderkey % 3 = 0 THEN 'true' ELSE 'false' END
  || CASE WHEN o_orderkey % 3 = 0 THEN ',"delivery_address":{{' || {_address('o_custkey')} || ',"apartment":"12"}}' ELSE '' END
  || ',"purchase_datetime":"' || CAST(CAST(o_orderdate AS DATE) AS STRING)
  || CASE WHEN o_orderkey % 11 = 0 THEN ' bad' ELSE 'T10:15:30' END || '"}}' END
"""

_CUSTOMER_JSON = f"""
CASE WHEN c_custkey % 50 = 1 THEN '[1,2' ELSE
  '{{"_id":"' || CAST(c_custkey AS STRING)
  || '","customer_id":"C-' || CAST(c_custkey AS STRING)
  || '","first_name":"' || c_name || '","last_name":"ИВАНОВ","email":"User.' || CAST(c_custkey AS STRING)
  || '@Example.COM","phone":"' || CASE WHEN c_custkey % 6 = 0 THEN '' ELSE '+7912' || CAST(1000000 + c_custkey AS STRING) END
  || '","birth_date":"' || CASE WHEN c_custkey % 8 = 0 THEN 'unknown' ELSE '1990-0' || CAST(c_custkey % 9 + 1 AS STRING) || '-15' END
  || '","gender":"' || CASE WHEN c_custkey % 2 = 0 THEN 'Male' ELSE 'Female' END
  || '","registration_date":"2024-0' || CAST(c_custkey % 9 + 1 AS STRING) || '-01T08:00:00"'
  || CASE WHEN c_custkey % 4 = 0 THEN '' ELSE ',"is_loyalty_member":true,"loyalty_card_number":"LOYAL-' || CAST(c_custkey AS STRING) || '"' END
  || ',"purchase_location":{{' || {_place('c_custkey')} || '}}'
  || ',"delivery_address":{{' || {_address('c_nationkey')} || ',"apartment":"7"}}'
  || ',"preferences":{{"preferred_language":"RU","preferred_payment_method":"card","receive_promotions":'
  || CASE WHEN c_custkey % 3 = 0 THEN 'true' ELSE 'false' END || '}}}}' END
"""

_PRODUCT_JSON = """
CASE WHEN p_partkey % 60 = 7 THEN 'not json' ELSE
  '{"_id":"' || CAST(p_partkey AS STRING)
  || '","id":"PR-' || CAST(p_partkey AS STRING) || '","name":"' || p_name || '","group":"' || p_type
  || '","description":"","kbju":{"calories":' || CAST(p_size AS STRING) || '.5,"protein":"' || CAST(p_size AS STRING)
  || '","fat":null,"carbohydrates":"many"},"price":' || CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS STRING)
  || ',"unit":"КГ","origin_country":"' || p_brand || '","expiry_days":'
  || CASE WHEN p_partkey % 10 = 0 THEN '-5' WHEN p_partkey % 10 = 1 THEN '70000' ELSE CAST(p_size AS STRING) END
  || ',"is_organic":' || CASE WHEN p_partkey % 2 = 0 THEN 'true' ELSE 'false' END
  || ',"barcode":"' || CAST(4600000 + p_partkey AS STRING)
  || '","manufacturer":{"name":"OOO ' || p_brand || '","country":"RU","website":"https://example.com/' || CAST(p_size AS STRING)
  || '","inn":"77' || CAST(p_partkey % 100 AS STRING) || '"}}' END
"""

_STORE_JSON = f"""
CASE WHEN s_suppkey % 25 = 3 THEN NULL ELSE
  '{{"_id":"' || CAST(s_suppkey AS STRING)
  || '","store_id":"ST-' || CAST(s_suppkey AS STRING) || '","store_name":"' || s_name
  || '","store_network":"Big Store","store_type_description":"Over 200 sq m","type":"offline","categories":["' || 'Milk' || '","Fruit ' || CAST(s_nationkey AS STRING)
  || '"],"manager":{{"name":"Пётр","phone":"+7 (495) 100-' || CAST(s_suppkey AS STRING) || '","email":"m' || CAST(s_suppkey AS STRING)
  || '@Example.com"}},"location":{{' || {_place('s_suppkey')}
  || '}},"opening_hours":{{"mon_fri":"09:00-21:00","sat":"10:00-20:00"}},"accepts_online_orders":true,"delivery_available":'
  || CASE WHEN s_suppkey % 2 = 0 THEN 'true' ELSE 'false' END
  || ',"last_inventory_date":"2025-0' || CAST(s_suppkey % 9 + 1 AS STRING) || '-28"}}' END
"""

_PHONE = """CASE c_custkey % 5
  WHEN 0 THEN '8 (912) ' || CAST(1000000 + c_custkey AS STRING)
  WHEN 1 THEN '+7 912 ' || CAST(1000000 + c_custkey AS STRING)
  WHEN 2 THEN '912' || CAST(1000000 + c_custkey AS STRING)
  WHEN 3 THEN '+49 (30) ' || CAST(c_custkey AS STRING)
  ELSE NULL END"""

# Every third trail holds a list within an item, every fifth price a blank behind its thousands, some stocks more than a number.
_ITEM_HTML = """'<html><body><ul class="breadcrumb"><li><a href="/">Home</a>'
  || CASE WHEN p_partkey % 3 = 0 THEN '<ul><li><a href="/s">Sub &gt; list</a></li><li>plain</li></ul>' ELSE '' END
  || '</li><li><a href="/t/' || p_type || '">' || p_type
  || '</a></li><li class="active">' || p_name || '</li></ul><h1> ' || p_name || ' &amp; co </h1><p class="price_color">£'
  || CASE WHEN p_partkey % 5 = 1 THEN '1 ' ELSE '' END
  || REPLACE(CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS STRING), '.', ',') || '</p><p class="instock availability"><i class="icon-ok"></i> '
  || CASE WHEN p_partkey % 4 = 0 THEN 'Out of stock' ELSE 'In stock (' || CAST(p_size AS STRING) || ' available'
     || CASE WHEN p_partkey % 7 = 2 THEN ' now)' ELSE ')' END END || ' </p></body></html>'"""

COMMON = {
    "v_sales": f"""
SELECT p.p_type AS category,
  CASE WHEN l.l_orderkey % 10 = 2 THEN NULL ELSE p.p_name END AS item,
  CASE WHEN l.l_orderkey % 10 = 1 THEN NULL ELSE CAST(p.p_retailprice AS DECIMAL(10,2)) END AS price_per_unit,
  CASE WHEN l.l_orderkey % 20 IN (3, 11) THEN NULL ELSE CAST(l.l_quantity AS INT) END AS quantity,
  CASE WHEN l.l_orderkey % 20 IN (3, 11) THEN NULL
       ELSE CAST(CAST(p.p_retailprice AS DECIMAL(10,2)) * CAST(l.l_quantity AS INT) AS DECIMAL(10,2)) END AS total_spent,
  {_PAYMENT} AS payment_method,
  CASE WHEN o.o_orderstatus = 'O' THEN 'Online' ELSE 'In-store' END AS location,
  CAST(o.o_orderdate AS DATE) AS transaction_date, o.o_custkey AS customer_id, l.l_orderkey AS transaction_id
FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey JOIN orders o ON o.o_orderkey = l.l_orderkey""",
    "v_events": """
SELECT event_id AS id, user_id, event_type, CAST(ts AS TIMESTAMP) AS event_time,
  CAST(round(value * 100) AS BIGINT) AS points_spent FROM events""",
    "v_registration": """
SELECT user_id, min(CAST(ts AS TIMESTAMP)) AS registration_date FROM events WHERE event_type = 'signup' GROUP BY user_id""",
    "v_users_old": """
SELECT c_custkey AS id, c_name AS name, CAST(c_nationkey AS STRING) AS email, c_mktsegment AS role FROM customer""",
    "v_users_new": """
SELECT c_custkey AS id, CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_name END AS name,
  CAST(CASE WHEN c_custkey % 17 = 0 THEN c_nationkey + 1 ELSE c_nationkey END AS STRING) AS email,
  CASE WHEN c_custkey % 7 = 0 THEN 'RETAIL' ELSE c_mktsegment END AS role
FROM customer WHERE c_custkey % 13 <> 0""",
    "v_logins": """
SELECT event_id AS id, user_id, event_type,
  CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(ts AS TIMESTAMP) END AS event_timestamp FROM events""",
    "v_sent": "SELECT event_id AS id FROM events WHERE event_id % 3 = 0",
    "v_phones": f"SELECT c_custkey, {_PHONE} AS phone FROM customer",
    "v_raw_purchases": f"""
SELECT {_PURCHASE_JSON} AS full_data FROM orders
UNION ALL SELECT {_PURCHASE_JSON} AS full_data FROM orders WHERE o_orderkey % 7 = 0""",
    "v_stored_purchases": f"SELECT {_PURCHASE_JSON} AS full_data FROM orders WHERE o_orderkey % 5 = 0",
    "v_raw_customers": f"SELECT {_CUSTOMER_JSON} AS full_data FROM customer",
    "v_raw_products": f"SELECT {_PRODUCT_JSON} AS full_data FROM part",
    "v_raw_stores": f"SELECT {_STORE_JSON} AS full_data FROM supplier",
    "v_sources_dup": """
SELECT o_orderkey, o_custkey FROM orders UNION ALL SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey % 4 = 0""",
    "v_site": """
SELECT page_id, 'http://shop.example/p/' || CAST(page_id AS STRING) AS url,
  '<a href="/p/' || CAST((3 * page_id + 1) % (SELECT count(*) FROM pages) AS STRING) || '">next</a><a href="../p/'
  || CAST((7 * page_id + 2) % (SELECT count(*) FROM pages) AS STRING) || '">more</a><a href="#top">top</a><a href="http://else.example/">out</a>' AS html
FROM pages""",
    # The given pages lie at the addresses they link to most often.
    "v_linked_site": """
SELECT 'http://shop.example' || l.link AS url, p.html, l.place FROM v_site_links l
  JOIN (SELECT html, row_number() OVER (ORDER BY page_id) - 1 AS place FROM pages) p ON p.place = l.place""",
    "v_item_pages": f"SELECT 'http://shop.example/item/' || CAST(p_partkey AS STRING) AS url, {_ITEM_HTML} AS html, p_partkey, p_name, p_type, p_retailprice, p_size FROM part",
    "v_folder": """
SELECT c_custkey AS id, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_name END AS member,
  CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS segment FROM customer""",
}

_JSON_ITEM = """'{"category":"' || split_part(p.p_type, ' ', 1) || '","product_id":"' || CAST(p.p_partkey AS STRING) || '"}'"""

SPARK = {
    "v_site_links": r"""
SELECT link, row_number() OVER (ORDER BY count(*) DESC, link) - 1 AS place
FROM (SELECT explode(regexp_extract_all(html, '<a\\s+href="(/[^"/]*)"', 1)) AS link FROM pages) GROUP BY link""",
    "v_purchases_json": _PURCHASES.format(
        payment=_PAYMENT,
        items=f"'[' || array_join(array_sort(collect_list({_JSON_ITEM})), ',') || ']'",
        ts="timestampadd(HOUR, CAST((o.o_orderkey * 7) % 24 AS INT), timestampadd(DAY, -CAST(o.o_orderkey % 120 AS INT), TIMESTAMP'2001-08-01 00:00:00'))",
    ),
    "v_purchases": _PURCHASES.format(
        payment=_PAYMENT,
        items="array_join(array_sort(collect_list(p.p_type)), ',')",
        ts="timestampadd(HOUR, CAST((o.o_orderkey * 7) % 24 AS INT), timestampadd(DAY, -CAST(o.o_orderkey % 120 AS INT), TIMESTAMP'2001-08-01 00:00:00'))",
    ),
}

DUCKDB = {
    "v_site_links": r"""
SELECT link, row_number() OVER (ORDER BY count(*) DESC, link) - 1 AS place
FROM (SELECT unnest(regexp_extract_all(html, '<a\s+href="(/[^"/]*)"', 1)) AS link FROM pages) GROUP BY link""",
    "v_purchases_json": _PURCHASES.format(
        payment=_PAYMENT,
        items=f"'[' || array_to_string(list_sort(list({_JSON_ITEM})), ',') || ']'",
        ts="TIMESTAMP '2001-08-01' - to_days(CAST(o.o_orderkey % 120 AS INT)) + to_hours(CAST((o.o_orderkey * 7) % 24 AS INT))",
    ),
    "v_purchases": _PURCHASES.format(
        payment=_PAYMENT,
        items="array_to_string(list_sort(list(p.p_type)), ',')",
        ts="TIMESTAMP '2001-08-01' - to_days(CAST(o.o_orderkey % 120 AS INT)) + to_hours(CAST((o.o_orderkey * 7) % 24 AS INT))",
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Spark DataFrame of a derived input."""
    texts = {**COMMON, **SPARK}
    frames: dict[str, DataFrame] = {}
    for inner in re.findall(r"\bv_\w+", texts[name]):
        frames.setdefault(inner, view(spark, sf_dir, inner))
    for base in TABLES:
        if re.search(rf"\b{base}\b", texts[name]):
            frames[base] = table(spark, sf_dir, base)
    # Frames are parameters of the text: no name is registered in the session.
    named = re.sub(r"\b(FROM|JOIN)\s+(\w+)", lambda m: f"{m[1]} {{{m[2]}}}" if m[2] in frames else m[0], texts[name].replace("{", "{{").replace("}", "}}"))
    return spark.sql(named, **frames)


def duckdb_with(*names: str) -> str:
    """``WITH`` clause that defines the named inputs for DuckDB."""
    texts = {**COMMON, **DUCKDB}
    return "WITH " + ",\n".join(f"{n} AS ({texts[n]})" for n in names)
