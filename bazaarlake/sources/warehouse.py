"""The order warehouse tables seen as the retail star schema, with seeded defects.

Which lines are defective follows from their keys, so the same lines are bad in
every run: of 100 lines one has an unknown product, one a negative quantity, and one
puts its whole order into the future.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from bazaarlake import schemas
from bazaarlake.functions import scalars
from bazaarlake.operators import defects
from bazaarlake.tables import RetailTables

AS_OF = dt.date(2001, 12, 31)
# 9999 is a real part key on large inputs.
UNKNOWN_PRODUCT = 999_999_999
ITEM_KEY = ("order_id", "line_no")
# Line numbers are below this, so an item id made of order and line gives both back.
LINES_PER_ORDER = 8

BAD_PRODUCT, BAD_QUANTITY, BAD_DATE = 0, 1, 2


# Declared, so that no job has to look into the files before a plan can be made.
_COLUMNS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(_COLUMNS[table]).parquet(f"{sf_dir}/{table}.parquet")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    picked = F.expr("(l_orderkey * 31 + l_linenumber * 17 + l_partkey * 7 + l_suppkey * 3) % 100")
    return read(spark, sf_dir, "lineitem").withColumn("defect", picked)


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct part types, numbered in order: only the distinct ones meet in the window."""
    names = read(spark, sf_dir, "part").where(F.col("p_type").isNotNull()).select(F.col("p_type").alias("category_name")).distinct()
    return names.select(F.row_number().over(Window.orderBy("category_name")).alias("category_id"), "category_name")


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts with their category number."""
    part = read(spark, sf_dir, "part")
    return part.join(categories(spark, sf_dir), F.col("p_type") == F.col("category_name")).select(
        F.col("p_partkey").alias("product_id"),
        "category_id",
        F.col("p_name").alias("product_name"),
        F.col("p_retailprice").cast(scalars.MONEY).alias("default_price"),
    )


def product_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select(F.col("p_partkey").alias("product_id"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("city"))
    return read(spark, sf_dir, "customer").join(nation, "c_nationkey").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("first_name"),
        F.col("c_mktsegment").alias("last_name"),
        "city",
    )


def sound_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders before any defect."""
    payment = F.expr("CASE o_orderkey % 3 WHEN 0 THEN 'UPI' WHEN 1 THEN 'Cash' ELSE 'Card' END")
    step = F.col("o_orderkey") % 20
    status = (
        F.when(step < 14, "completed").when(step < 17, "pending")
        .when(step < 19, "cancelled").otherwise("returned")
    )
    return read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        payment.alias("payment_method"),
        status.alias("order_status"),
        F.col("o_orderdate").alias("created_at"),
    )


def postdated_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir).where(F.col("defect") == BAD_DATE).select(F.col("l_orderkey").alias("order_id"))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return defects.postdate_orders(sound_orders(spark, sf_dir), postdated_ids(spark, sf_dir), AS_OF)


def _as_item(lines: DataFrame, *priced) -> DataFrame:
    return lines.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        *priced,
        F.col("l_shipdate").alias("created_at"),
        "defect",
    )


def sound_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Priced items before any defect, with the column ``defect`` that picks them."""
    price = F.col("p_retailprice").cast(scalars.MONEY)
    discount = F.round(F.col("l_discount") * 100).cast("int")
    part = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_retailprice")
    return _as_item(
        _lines(spark, sf_dir).join(part, "l_partkey"),
        F.col("p_name").alias("product_name"),
        price.alias("unit_price"),
        discount.alias("discount"),
        scalars.discounted(price, discount).alias("final_price"),
    )


def with_item_defects(items: DataFrame) -> DataFrame:
    broken = defects.break_product(items, F.col("defect") == BAD_PRODUCT, UNKNOWN_PRODUCT)
    size = F.lit(1) + F.col("line_no") % 5
    return defects.negate_quantity(broken, F.col("defect") == BAD_QUANTITY, size).drop("defect")


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_item_defects(sound_items(spark, sf_dir))


def unpriced_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Defective items without price and name, for work that needs neither: part is not joined."""
    items = _as_item(
        _lines(spark, sf_dir),
        F.lit("").alias("product_name"),
        F.lit(Decimal("0.00")).cast(scalars.MONEY).alias("final_price"),
    )
    return with_item_defects(items).drop("product_name", "final_price")


def landable_tables(spark: SparkSession, sf_dir: str) -> RetailTables:
    """The raw tables with all columns of the retail schema; what the warehouse lacks follows from a key."""
    tables = raw_tables(spark, sf_dir)
    opened = F.lit(dt.date(1995, 1, 1))
    stamped = lambda df: df.withColumn("updated_at", F.col("created_at"))
    full = tables.having(
        customers=stamped(tables.customers.select(
            "*", F.concat(F.col("customer_id").cast("string"), F.lit("@example.com")).alias("email"),
            F.lpad(F.col("customer_id").cast("string"), 10, "0").alias("phone"),
            opened.alias("signup_date"), opened.cast("timestamp_ntz").alias("created_at"))),
        orders=stamped(tables.orders),
        order_items=stamped(tables.order_items.withColumn("order_item_id", F.col("order_id") * LINES_PER_ORDER + F.col("line_no"))),
    )
    return RetailTables(**{name: df.select(*schemas.CLEAN[name].names) for name, df in full.items()})


def raw_tables(spark: SparkSession, sf_dir: str) -> RetailTables:
    return RetailTables(
        categories=categories(spark, sf_dir),
        products=products(spark, sf_dir),
        customers=customers(spark, sf_dir),
        orders=orders(spark, sf_dir),
        order_items=order_items(spark, sf_dir),
    )


