"""Typed tables built from JSON documents."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

_TYPES = {
    "lower": T.StringType(),
    "text": T.StringType(),
    "json": T.StringType(),
    "double": T.DoubleType(),
    "uint16": T.IntegerType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "bool": T.BooleanType(),
    "strings": T.ArrayType(T.StringType()),
}


@dataclass(frozen=True)
class FieldSpec:
    name: str
    path: str
    kind: str

    @property
    def dtype(self) -> T.DataType:
        return _TYPES[self.kind]


@dataclass(frozen=True)
class TableSpec:
    """Fields of one typed table and the columns its content hash leaves out."""

    collection: str
    fields: tuple[FieldSpec, ...]
    unhashed: frozenset[str] = frozenset()

    @property
    def hashed(self) -> list[str]:
        return [f.name for f in self.fields if f.name not in self.unhashed]

    @property
    def schema(self) -> T.StructType:
        typed = [T.StructField(f.name, f.dtype) for f in self.fields]
        return T.StructType([*typed, T.StructField("row_hash", T.StringType())])


def _table(collection: str, text: str, unhashed: tuple[str, ...] = ()) -> TableSpec:
    rows = [line.split() for line in text.strip().splitlines()]
    return TableSpec(
        collection,
        tuple(FieldSpec(name, path, kind) for name, path, kind in rows),
        frozenset(unhashed),
    )


# Column, document path and kind of each field.
PRODUCTS = _table("products", """
    product_id            id                    lower
    name                  name                  lower
    group_name            group                 lower
    description           description           lower
    calories              kbju.calories         double
    protein               kbju.protein          double
    fat                   kbju.fat              double
    carbohydrates         kbju.carbohydrates    double
    price                 price                 double
    unit                  unit                  lower
    origin_country        origin_country        lower
    expiry_days           expiry_days           uint16
    is_organic            is_organic            bool
    barcode               barcode               lower
    manufacturer_name     manufacturer.name     lower
    manufacturer_country  manufacturer.country  lower
    manufacturer_website  manufacturer.website  lower
    manufacturer_inn      manufacturer.inn      lower
""")

CUSTOMERS = _table("customers", """
    customer_id               customer_id                              lower
    first_name                first_name                               lower
    last_name                 last_name                                lower
    email                     email                                    text
    phone                     phone                                    text
    birth_date                birth_date                               date
    gender                    gender                                   lower
    registration_date         registration_date                        timestamp
    is_loyalty_member         is_loyalty_member                        bool
    loyalty_card_number       loyalty_card_number                      lower
    purchase_country          purchase_location.country                lower
    purchase_city             purchase_location.city                   lower
    purchase_street           purchase_location.street                 lower
    purchase_house            purchase_location.house                  lower
    purchase_postal_code      purchase_location.postal_code            lower
    purchase_latitude         purchase_location.coordinates.latitude   double
    purchase_longitude        purchase_location.coordinates.longitude  double
    delivery_country          delivery_address.country                 lower
    delivery_city             delivery_address.city                    lower
    delivery_street           delivery_address.street                  lower
    delivery_house            delivery_address.house                   lower
    delivery_apartment        delivery_address.apartment               lower
    delivery_postal_code      delivery_address.postal_code             lower
    preferred_language        preferences.preferred_language           lower
    preferred_payment_method  preferences.preferred_payment_method     lower
    receive_promotions        preferences.receive_promotions           bool
""")

PURCHASES = _table("purchases", """
    purchase_id           purchase_id                           lower
    customer_id           customer.customer_id                  lower
    customer_first_name   customer.first_name                   lower
    customer_last_name    customer.last_name                    lower
    store_id              store.store_id                        lower
    store_name            store.store_name                      lower
    store_network         store.store_network                   lower
    store_country         store.location.country                lower
    store_city            store.location.city                   lower
    store_street          store.location.street                 lower
    store_house           store.location.house                  lower
    store_postal_code     store.location.postal_code            lower
    latitude              store.location.coordinates.latitude   double
    longitude             store.location.coordinates.longitude  double
    items                 items                                 json
    total_amount          total_amount                          double
    payment_method        payment_method                        lower
    is_delivery           is_delivery                           bool
    delivery_country      delivery_address.country              lower
    delivery_city         delivery_address.city                 lower
    delivery_street       delivery_address.street               lower
    delivery_house        delivery_address.house                lower
    delivery_apartment    delivery_address.apartment            lower
    delivery_postal_code  delivery_address.postal_code          lower
    purchase_datetime     purchase_datetime                     timestamp
""")

# The document id changes on every reload, so it is left out of the hash.
STORES = _table("stores", """
    id                      _id                             lower
    store_id                store_id                        lower
    store_name              store_name                      lower
    store_network           store_network                   lower
    store_type_description  store_type_description          lower
    type                    type                            lower
    categories              categories                      strings
    manager_name            manager.name                    lower
    manager_phone           manager.phone                   lower
    manager_email           manager.email                   lower
    country                 location.country                lower
    city                    location.city                   lower
    street                  location.street                 lower
    house                   location.house                  lower
    postal_code             location.postal_code            lower
    latitude                location.coordinates.latitude   double
    longitude               location.coordinates.longitude  double
    opening_mon_fri         opening_hours.mon_fri           lower
    opening_sat             opening_hours.sat               lower
    opening_sun             opening_hours.sun               lower
    accepts_online_orders   accepts_online_orders           bool
    delivery_available      delivery_available              bool
    warehouse_connected     warehouse_connected             bool
    last_inventory_date     last_inventory_date             date
""", unhashed=("id",))

SPECS = {s.collection: s for s in (PRODUCTS, CUSTOMERS, PURCHASES, STORES)}

SALES_CSV_SCHEMA = T.StructType([
    T.StructField("Transaction ID", T.StringType()),
    T.StructField("Customer ID", T.StringType()),
    T.StructField("Category", T.StringType()),
    T.StructField("Item", T.StringType()),
    T.StructField("Price Per Unit", T.DoubleType()),
    T.StructField("Quantity", T.DoubleType()),
    T.StructField("Total Spent", T.DoubleType()),
    T.StructField("Payment Method", T.StringType()),
    T.StructField("Location", T.StringType()),
    T.StructField("Transaction Date", T.StringType()),
    T.StructField("Discount Applied", T.StringType()),
])

LOGIN_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("event_timestamp", T.StringType()),
])

RAW_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("full_data", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
])
