"""The five business questions, on clean tables.

Distinct orders are counted on rows that are already one per order and group, so no
query needs Spark's distinct aggregation over item lines; where lines are not joined to
orders, they are summed per product before anything else.  Tables that hold several runs are
scoped to the published one first, since equal ids of two runs would multiply in every join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from bazaarlake import fixed_values as fixed
from bazaarlake.functions import scalars
from bazaarlake.operators.pruning import maybe_among
from bazaarlake.operators.ranking import rank_within, top_k
from bazaarlake.operators.totals import REVENUE, UNITS, share_of_all, totals_by, totals_per_order
from bazaarlake.tables import RetailTables

_LINE = ["order_id", "quantity", "final_price"]


def completed(orders: DataFrame, *columns: str) -> DataFrame:
    return orders.where(F.col("order_status") == fixed.COMPLETED).select(*columns)


def _money(total, name: str):
    return F.round(F.sum(total), 2).alias(name)


def completed_order_totals(tables: RetailTables, *order_columns: str) -> DataFrame:
    """Item totals of every completed order, with columns of the order."""
    keys = ["order_id", *order_columns]
    return totals_per_order(tables.order_items.select(*_LINE), completed(tables.orders, *keys), keys)


def revenue_by_category(tables: RetailTables, filter_bits: int | None = None) -> DataFrame:
    """Orders, units and revenue per category, completed orders only, best first.

    With ``filter_bits`` most lines of other orders are left out before lines and orders are shuffled.
    """
    tables = tables.asked()
    lines = tables.order_items.select("product_id", *_LINE)
    if filter_bits:
        lines = maybe_among(lines, "order_id", completed(tables.orders, "order_id"), filter_bits)
    placed = lines.join(tables.products.select("product_id", "category_id"), "product_id")
    per_order = totals_per_order(
        placed.select("category_id", *_LINE),
        completed(tables.orders, "order_id"),
        ["category_name", "order_id"],
        names=(tables.categories, "category_id"),
    )
    return (
        per_order.groupBy("category_name")
        .agg(
            F.count("order_id").alias("total_orders"),
            F.sum(UNITS).alias("total_units_sold"),
            _money(REVENUE, "total_revenue_inr"),
        )
        .orderBy(F.col("total_revenue_inr").desc())
    )


def spend_by_customer(tables: RetailTables) -> DataFrame:
    """Orders and spend of every customer with a completed order."""
    tables = tables.asked()
    spend = completed_order_totals(tables, "customer_id").groupBy("customer_id").agg(
        F.count("order_id").alias("orders"), F.sum(REVENUE).alias(REVENUE)
    )
    person = ["customer_id", "first_name", "last_name", "city"]
    # Grouped once more because a customer may be listed twice; both sides are hashed by
    # customer_id, so this does not shuffle.
    return (
        spend.join(tables.customers.select(*person), "customer_id")
        .groupBy(*person)
        .agg(F.max("orders").alias("total_orders"), _money(REVENUE, "total_spend_inr"))
        .select(
            "customer_id",
            scalars.full_name(F.col("first_name"), F.col("last_name")).alias("customer_name"),
            "city", "total_orders", "total_spend_inr",
        )
    )


def top_customers(tables: RetailTables, k: int = 10) -> DataFrame:
    """The k customers with the highest spend; equal spend goes by customer_id."""
    return top_k(spend_by_customer(tables), k, F.col("total_spend_inr").desc(), F.col("customer_id"))


def monthly_trend(tables: RetailTables) -> DataFrame:
    """Orders, different customers and revenue per month, completed orders only."""
    tables = tables.asked()
    month = scalars.order_month(F.col("order_date"))
    per_order = completed_order_totals(tables, "order_date", "customer_id").select(
        month.alias("order_month"), "order_id", "customer_id", REVENUE
    )
    # One row per order, then one per customer and month: no distinct aggregation is left.
    per_customer = per_order.groupBy("order_month", "customer_id").agg(
        F.count("order_id").alias("orders"), F.sum(REVENUE).alias(REVENUE))
    return (
        per_customer.groupBy("order_month")
        .agg(
            F.sum("orders").alias("total_orders"),
            F.count("customer_id").alias("unique_customers"),
            _money(REVENUE, "monthly_revenue_inr"),
        )
        .orderBy("order_month")
    )


def payment_split(tables: RetailTables) -> DataFrame:
    """Orders, their share in percent, and revenue per payment method, completed orders only."""
    tables = tables.asked()
    per_method = completed_order_totals(tables, "payment_method").groupBy("payment_method").agg(
        F.count("order_id").alias("total_orders"), _money(REVENUE, "total_revenue_inr")
    )
    return (
        share_of_all(per_method, "total_orders", "pct_of_orders")
        .select("payment_method", "total_orders", "pct_of_orders", "total_revenue_inr")
        .orderBy(F.col("total_orders").desc())
    )


def product_sales(tables: RetailTables) -> DataFrame:
    """Units and revenue per product name within its category, any order status.

    Lines are collapsed per product id before the product table is joined.
    """
    per_product = totals_by(tables.order_items, "product_id")
    return (
        per_product.join(tables.products.select("product_id", "product_name", "category_id"), "product_id")
        .join(tables.categories, "category_id")
        .groupBy("product_name", "category_name", "category_id")
        .agg(F.sum(UNITS).alias("total_units_sold"), _money(REVENUE, "total_revenue_inr"))
    )


def top_product_per_category(tables: RetailTables) -> DataFrame:
    """The product with most units in each category; ties are all kept."""
    tables = tables.asked()
    ranked = rank_within(product_sales(tables), "category_id", "total_units_sold", "rank_in_category")
    return (
        ranked.where("rank_in_category = 1")
        .select("product_name", "category_name", "total_units_sold", "total_revenue_inr", "rank_in_category")
        .orderBy(F.col("total_revenue_inr").desc())
    )


QUESTIONS = {
    "revenue_by_category": revenue_by_category,
    "top_customers": top_customers,
    "monthly_trend": monthly_trend,
    "payment_split": payment_split,
    "top_product_per_category": top_product_per_category,
}
