"""Explicit schemas and cast lists of every table; nothing is inferred at run time."""

from __future__ import annotations

from pyspark.sql import types as T

from cdcmart.functions.casts import NUMERIC, RATE

METADATA = "datastream_metadata"

# Landing columns with the type each is meant to have, in file order.
LANDING = {
    "orders": [
        ("id", "string"),
        ("store_id", "bigint"),
        ("customer_id", "bigint"),
        ("currency_code", "string"),
        ("total_price", NUMERIC),
        ("discount", NUMERIC),
        ("net_amount", NUMERIC),
        ("channel", "string"),
        ("status", "string"),
        ("created_at", "timestamp"),
        ("updated_at", "timestamp"),
    ],
    "order_items": [
        ("id", "string"),
        ("order_id", "string"),
        ("product_id", "bigint"),
        ("quantity", "bigint"),
        ("unit_price", NUMERIC),
        ("net_amount", NUMERIC),
        ("default_code", "string"),
        ("is_recommended", "boolean"),
        ("created_at", "timestamp"),
        ("updated_at", "timestamp"),
    ],
    "stores": [
        ("id", "bigint"),
        ("name", "string"),
        ("country_code", "string"),
        ("currency_code", "string"),
        ("timezone", "string"),
        ("is_franchise", "boolean"),
        ("is_dev", "boolean"),
        ("is_excluded_from_dw", "boolean"),
        ("opening_date", "date"),
        ("created_at", "timestamp"),
        ("updated_at", "timestamp"),
    ],
    "currency_exchange_rates": [
        ("currency_code", "string"),
        ("exchange_date", "date"),
        ("rate_to_usd", RATE),
    ],
}
# Tables fed by change events carry the moment the source recorded the change in a nested column.
CDC_TABLES = ("orders", "order_items", "stores")

# Landing column, mart column, type.
ORDERS_SPEC = [
    ("id", "order_id", "string"),
    ("store_id", "store_id", "bigint"),
    ("customer_id", "customer_id", "bigint"),
    ("currency_code", "currency_code", "string"),
    ("total_price", "total_price_local", NUMERIC),
    ("discount", "discount_local", NUMERIC),
    ("net_amount", "net_amount_local", NUMERIC),
    ("channel", "channel", "string"),
    ("status", "status", "string"),
    ("created_at", "created_at", "timestamp"),
    ("updated_at", "updated_at", "timestamp"),
]
ITEMS_SPEC = [
    ("id", "order_item_id", "string"),
    ("order_id", "order_id", "string"),
    ("product_id", "product_id", "bigint"),
    ("quantity", "quantity", "bigint"),
    ("unit_price", "unit_price_local", NUMERIC),
    ("net_amount", "net_amount_local", NUMERIC),
    ("default_code", "default_code", "string"),
    ("is_recommended", "is_recommended", "boolean"),
    ("created_at", "created_at", "timestamp"),
    ("updated_at", "updated_at", "timestamp"),
]
STORES_SPEC = [
    ("id", "store_id", "bigint"),
    ("name", "store_name", "string"),
    ("country_code", "country_code", "string"),
    ("currency_code", "currency_code", "string"),
    ("timezone", "timezone", "string"),
    ("is_franchise", "is_franchise", "boolean"),
    ("opening_date", "opening_date", "date"),
    ("created_at", "created_at", "timestamp"),
    ("updated_at", "updated_at", "timestamp"),
]

# Column order of the mart tables.
ORDERS_CLEAN = [
    "order_id",
    "store_id",
    "customer_id",
    "channel",
    "status",
    "created_at",
    "updated_at",
    "currency_code",
    "total_price_local",
    "discount_local",
    "net_amount_local",
    "total_price_usd",
    "discount_usd",
    "net_amount_usd",
]
DIM_STORES = [
    "store_id",
    "store_name",
    "country_code",
    "currency_code",
    "timezone",
    "is_franchise",
    "opening_date",
    "region",
    "store_age_days",
    "store_maturity",
    "created_at",
    "updated_at",
]
FCT_ORDERS = [
    ("order_id", "string"),
    ("store_id", "bigint"),
    ("customer_id", "bigint"),
    ("channel", "string"),
    ("status", "string"),
    ("currency_code", "string"),
    ("total_price_local", NUMERIC),
    ("discount_local", NUMERIC),
    ("net_amount_local", NUMERIC),
    ("total_price_usd", NUMERIC),
    ("discount_usd", NUMERIC),
    ("net_amount_usd", NUMERIC),
    ("item_count", "bigint"),
    ("total_quantity", "bigint"),
    ("recommended_item_count", "bigint"),
    ("created_at", "timestamp"),
    ("updated_at", "timestamp"),
]


_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
    NUMERIC: T.DecimalType(38, 9),
    RATE: T.DecimalType(38, 18),
}


def struct(columns: list[tuple[str, str]]) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in columns])


def landing_schema(table: str) -> T.StructType:
    """Typed landing schema, with the nested metadata column of the CDC tables."""
    schema = struct(LANDING[table])
    if table in CDC_TABLES:
        nested = T.StructType([T.StructField("source_timestamp", T.TimestampType())])
        schema = schema.add(METADATA, nested)
    return schema


def csv_columns(table: str) -> list[str]:
    names = [name for name, _ in LANDING[table]]
    return [*names, f"{METADATA}.source_timestamp"] if table in CDC_TABLES else names


ITEMS_CLEAN_SCHEMA = struct([(name, kind) for _, name, kind in ITEMS_SPEC])
FCT_ORDERS_SCHEMA = struct(FCT_ORDERS)
