import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

from bazaarlake import schemas  # noqa: E402
from bazaarlake.session import local_session  # noqa: E402
from bazaarlake.tables import RetailTables  # noqa: E402

AS_OF = dt.date(2025, 4, 15)


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, partitions=8, app="tests")
    yield session
    session.stop()


@pytest.fixture()
def conf(spark):
    """Set session settings for one test."""
    before = {}

    def change(**settings):
        for name, value in settings.items():
            key = name.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


CATEGORIES = [(1, "Electronics"), (2, "Clothing")]
PRODUCTS = [(1, 1, "Smartphone", "65000"), (2, 1, "Laptop", "30000"), (3, 2, "T-Shirt", "700")]
CUSTOMERS = [(1, "Asha", "Rao", "Pune"), (2, "Ravi", "Nair", "Kochi"), (3, "Meera", "Das", "Delhi")]
ORDERS = [
    (1, 1, "2025-01-10", "UPI", "completed"),
    (2, 2, "2025-01-20", "Card", "completed"),
    (3, 1, "2025-02-05", "Cash", "pending"),
    (4, 2, "2025-04-25", "UPI", "completed"),
    (5, 3, "2025-02-11", "UPI", "completed"),
]
ITEMS = [
    (1, 1, 1, 1, "61750.00"),
    (2, 1, 3, 2, "630.00"),
    (3, 2, 2, 3, "28500.00"),
    (4, 2, 9999, 1, "700.00"),
    (5, 3, 1, 2, "65000.00"),
    (6, 4, 3, 4, "700.00"),
    (7, 5, 3, -2, "0.00"),
    (8, 5, 2, 1, "30000.00"),
]


def typed(spark, table, rows, columns):
    """A frame with the declared types of ``table``; columns not given are left out."""
    kinds = {f.name: f.dataType for f in schemas.CLEAN[table].fields}
    text = spark.createDataFrame(
        [tuple(None if v is None else str(v) for v in row) for row in rows],
        ", ".join(f"{c} string" for c in columns))
    return text.select(*[text[c].cast(kinds[c]).alias(c) for c in columns])


ITEM_COLUMNS = ["order_item_id", "order_id", "product_id", "quantity", "final_price"]
ORDER_COLUMNS = ["order_id", "customer_id", "order_date", "payment_method", "order_status"]


def hand_made(spark, items=ITEMS, orders=ORDERS, products=PRODUCTS, customers=CUSTOMERS):
    return RetailTables(
        categories=typed(spark, "categories", CATEGORIES, ["category_id", "category_name"]),
        products=typed(spark, "products", products, ["product_id", "category_id", "product_name", "default_price"]),
        customers=typed(spark, "customers", customers, ["customer_id", "first_name", "last_name", "city"]),
        orders=typed(spark, "orders", orders, ORDER_COLUMNS),
        order_items=typed(spark, "order_items", items, ITEM_COLUMNS),
    )


@pytest.fixture(scope="session")
def raw_tables(spark):
    return hand_made(spark)


@pytest.fixture(scope="session")
def clean_tables(raw_tables):
    from bazaarlake.operators import quality

    orders = quality.clean_orders(raw_tables.orders, AS_OF)
    items = quality.clean_items(raw_tables.order_items, raw_tables.products, orders)
    return raw_tables.having(orders=orders, order_items=items)


def rows_of(df):
    """Rows as tuples, decimals as text so that scale shows."""
    from decimal import Decimal

    return [tuple(str(v) if isinstance(v, Decimal) else v for v in row) for row in df.collect()]
