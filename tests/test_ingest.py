"""JSON files to typed tables for several collections."""

import hashlib
import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens.plans import ingest
from storelens.sources import messages, tables
from storelens.sources.specs import SPECS
from storelens.streaming import store

STORE = {"_id": "s1", "store_id": "S-1", "manager": {"name": "Пётр", "phone": "8 (912) 345-67-89", "email": "Boss@Shop.RU"}, "categories": ["A"]}
PRODUCT = {"_id": "p1", "id": "PR-1", "name": "Milk", "price": 2.5, "expiry_days": 10}


def test_files_to_typed_tables(spark, tmp_path):
    root = str(tmp_path)
    inputs = {
        "stores": ([STORE, {**STORE, "_id": "s2"}], "_id string, store_id string, manager struct<name:string,phone:string,email:string>, categories array<string>"),
        "products": ([PRODUCT], "_id string, id string, name string, price double, expiry_days int"),
    }
    mapping = {}
    for name, (docs, ddl) in inputs.items():
        folder = tmp_path / "in" / name
        folder.mkdir(parents=True)
        (folder / "all.json").write_text(json.dumps(docs, ensure_ascii=False), encoding="utf-8")
        (folder / "bad.json").write_text("{", encoding="utf-8")
        mapping[name] = {"schema": T.StructType.fromDDL(ddl), "channel": {"format": "json", "path": f"{root}/topic/{name}"}}

    def step(name, schema, channel):
        loaded = ingest.load_documents(spark, f"{root}/in/{name}", f"{root}/store/{name}", schema)
        collection = spark.read.schema(schema).parquet(f"{root}/store/{name}")
        sent = ingest.publish_documents(collection, channel)
        for _ in range(2):
            ingest.stream_collection(spark, name, channel, f"{root}/dwh").awaitTermination()
        return loaded, sent

    assert tables.run_collections(mapping, step) == {"stores": (2, 2), "products": (1, 1)}
    stores = store.read_store(spark, f"{root}/dwh/stores/typed", SPECS["stores"].schema).collect()
    assert len(stores) == 1
    assert stores[0]["manager_phone"] == hashlib.md5(b"+79123456789").hexdigest()
    assert stores[0]["manager_email"] == hashlib.md5(b"boss@shop.ru").hexdigest()
    assert stores[0]["manager_name"] == "пётр"
    products = store.read_store(spark, f"{root}/dwh/products/typed", SPECS["products"].schema).collect()
    assert [(p["product_id"], p["price"], p["expiry_days"]) for p in products] == [("pr-1", 2.5, 10)]


def test_publish_takes_a_condition(spark, tmp_path):
    collection = spark.createDataFrame([("1", 5), ("2", 6)], "_id string, n int")
    channel = {"format": "json", "path": f"{tmp_path}/topic"}
    assert ingest.publish_documents(collection, channel, F.col("n") > 5) == 1
    assert [r["key"] for r in messages.read_messages(spark, channel).collect()] == ["2"]


def test_running_trigger_on_a_new_root(spark, tmp_path):
    (tmp_path / "topic").mkdir()
    channel = {"format": "json", "path": str(tmp_path / "topic")}
    query = ingest.stream_collection(spark, "purchases", channel, str(tmp_path / "dwh"), {"processingTime": "1 second"})
    try:
        assert query.isActive
        query.processAllAvailable()
        assert query.exception() is None
    finally:
        for running in spark.streams.active:
            running.stop()
