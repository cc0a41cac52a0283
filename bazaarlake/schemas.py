"""Declared schemas of the five tables.

The raw form reads every column as text: nothing is lost to type inference
(a phone number keeps its leading zero) and one bad cell cannot change the
type of a column.  ``functions.typing`` turns the raw form into the clean one.
"""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT_COLUMN = "_corrupt_record"

_MONEY = T.DecimalType(18, 2)
_STAMPS = [("created_at", T.TimestampNTZType()), ("updated_at", T.TimestampNTZType())]

_COLUMNS = {
    "categories": [("category_id", T.IntegerType()), ("category_name", T.StringType())],
    "products": [
        ("product_id", T.IntegerType()),
        ("category_id", T.IntegerType()),
        ("product_name", T.StringType()),
        ("default_price", _MONEY),
    ],
    "customers": [
        ("customer_id", T.LongType()),
        ("first_name", T.StringType()),
        ("last_name", T.StringType()),
        ("email", T.StringType()),
        ("phone", T.StringType()),
        ("city", T.StringType()),
        ("signup_date", T.DateType()),
        *_STAMPS,
    ],
    "orders": [
        ("order_id", T.LongType()),
        ("customer_id", T.LongType()),
        ("order_date", T.DateType()),
        ("payment_method", T.StringType()),
        ("order_status", T.StringType()),
        *_STAMPS,
    ],
    "order_items": [
        ("order_item_id", T.LongType()),
        ("order_id", T.LongType()),
        ("product_id", T.IntegerType()),
        ("product_name", T.StringType()),
        ("quantity", T.IntegerType()),
        ("unit_price", _MONEY),
        ("discount", T.IntegerType()),
        ("final_price", _MONEY),
        *_STAMPS,
    ],
}

TABLES = list(_COLUMNS)
PRIMARY_KEY = {
    "categories": "category_id",
    "products": "product_id",
    "customers": "customer_id",
    "orders": "order_id",
    "order_items": "order_item_id",
}
WATERMARKED = ["customers", "orders", "order_items"]

CLEAN = {
    table: T.StructType([T.StructField(name, kind) for name, kind in columns])
    for table, columns in _COLUMNS.items()
}


def all_text(schema: T.StructType) -> T.StructType:
    """The same columns as text, plus a place for lines that do not split well."""
    fields = [T.StructField(f.name, T.StringType()) for f in schema.fields]
    return T.StructType([*fields, T.StructField(CORRUPT_COLUMN, T.StringType())])


RAW = {table: all_text(schema) for table, schema in CLEAN.items()}
