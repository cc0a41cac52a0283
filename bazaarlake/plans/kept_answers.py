"""The five answers over all published runs, kept up to date run by run.

Each run leaves small partial aggregates beside the clean tables: per category, customer, month, payment method and
product, and bitmaps of the customers of each month.  An answer merges the partials of all runs; a run that is
published again replaces its own, which takes back what it said before.  So a changed run is the only one that
is read.  Orders of two runs are different orders; a customer is the same one by customer_id.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from bazaarlake.functions import scalars
from bazaarlake.operators import distinct
from bazaarlake.operators.ranking import rank_within, top_k
from bazaarlake.operators.totals import REVENUE, UNITS, share_of_all, totals_by, totals_per_order
from bazaarlake.plans.analytics import completed, completed_order_totals
from bazaarlake.sinks import commits
from bazaarlake.sinks.files import drop_stage, side_by_side
from bazaarlake.tables import RetailTables

_PERSON = ["customer_id", "first_name", "last_name", "city"]


def order_totals(tables: RetailTables) -> DataFrame:
    """The completed orders of one run with their revenue: what four of the partials start from."""
    return completed_order_totals(tables, "order_date", "customer_id", "payment_method").select(
        "order_id", "customer_id", "payment_method", scalars.order_month(F.col("order_date")).alias("order_month"), REVENUE)


def partials(tables: RetailTables, orders: DataFrame | None = None) -> dict[str, DataFrame]:
    """What one run adds to each answer; `tables` hold that run alone, `orders` its ``order_totals`` if they are written."""
    orders = order_totals(tables) if orders is None else orders
    counted, money = F.count("order_id").alias("orders"), F.sum(REVENUE).alias(REVENUE)
    lines = tables.order_items.select("order_id", "product_id", "quantity", "final_price").join(tables.products.select("product_id", "category_id"), "product_id")
    in_category = totals_per_order(lines, completed(tables.orders, "order_id"), ["category_name", "order_id"], names=(tables.categories, "category_id"))
    people = tables.customers.select(*_PERSON).distinct()
    products = tables.products.select("product_id", "product_name", "category_id").join(tables.categories, "category_id")
    return {
        "categories": in_category.groupBy("category_name").agg(counted, F.sum(UNITS).alias(UNITS), money),
        "customers": orders.groupBy("customer_id").agg(counted, money).join(people, "customer_id"),
        "months": orders.groupBy("order_month").agg(counted, money),
        "month_customers": distinct.bitmaps(orders, ["order_month"], "customer_id"),
        "methods": orders.groupBy("payment_method").agg(counted, money),
        "products": totals_by(tables.order_items, "product_id").join(products, "product_id")
        .groupBy("category_id", "category_name", "product_name").agg(F.sum(UNITS).alias(UNITS), money),
    }


@dataclass
class KeptAnswers:
    """Partials of every run below a root, published run by run by commit files."""

    spark: SparkSession
    root: str

    def refresh(self, run_date: dt.date, tables: RetailTables) -> None:
        """Take up a run, in place of what it said before."""
        seen = commits.snapshot(self.spark, self.root).number
        mark = uuid.uuid4().hex
        version, stage = f"{commits.VERSIONS}/{mark}", f"{self.root}/_stage/{mark}"
        done = False
        try:
            # Written once: items and orders meet for it once, not for each partial.
            order_totals(tables).write.parquet(stage)
            parts = partials(tables, self.spark.read.parquet(stage))
            folders = {name: f"{version}/{name}" for name in parts}
            side_by_side(*[partial(df.write.parquet, f"{self.root}/{folders[name]}") for name, df in parts.items()])
            commits.commit(self.spark, self.root, commits.RUN, run_date.isoformat(), folders, seen)
            done = True
        finally:
            drop_stage(self.spark, stage)
            if not done:
                drop_stage(self.spark, f"{self.root}/{version}")

    def _part(self, name: str) -> DataFrame:
        runs = commits.snapshot(self.spark, self.root).runs
        if not runs:
            raise KeyError(f"no run is kept below {self.root}")
        return self.spark.read.parquet(*[f"{self.root}/{folders[name]}" for folders in runs.values()])

    def revenue_by_category(self) -> DataFrame:
        return self._part("categories").groupBy("category_name").agg(
            F.sum("orders").alias("total_orders"), F.sum(UNITS).alias("total_units_sold"), F.round(F.sum(REVENUE), 2).alias("total_revenue_inr"),
        ).orderBy(F.desc("total_revenue_inr"))

    def top_customers(self, k: int = 10) -> DataFrame:
        spend = self._part("customers").groupBy(*_PERSON).agg(F.sum("orders").alias("total_orders"), F.round(F.sum(REVENUE), 2).alias("total_spend_inr"))
        return top_k(spend, k, F.col("total_spend_inr").desc(), F.col("customer_id")).select(
            "customer_id", scalars.full_name(F.col("first_name"), F.col("last_name")).alias("customer_name"), "city", "total_orders", "total_spend_inr")

    def monthly_trend(self) -> DataFrame:
        months = self._part("months").groupBy("order_month").agg(F.sum("orders").alias("total_orders"), F.round(F.sum(REVENUE), 2).alias("monthly_revenue_inr"))
        buyers = distinct.counts(self._part("month_customers"), ["order_month"], unique_customers="customer_id")
        return months.join(buyers, "order_month", "left").select(
            "order_month", "total_orders", F.coalesce("unique_customers", F.lit(0)).alias("unique_customers"), "monthly_revenue_inr").orderBy("order_month")

    def payment_split(self) -> DataFrame:
        methods = self._part("methods").groupBy("payment_method").agg(F.sum("orders").alias("total_orders"), F.round(F.sum(REVENUE), 2).alias("total_revenue_inr"))
        return share_of_all(methods, "total_orders", "pct_of_orders").select(
            "payment_method", "total_orders", "pct_of_orders", "total_revenue_inr").orderBy(F.desc("total_orders"))

    def top_product_per_category(self) -> DataFrame:
        sold = self._part("products").groupBy("category_id", "category_name", "product_name").agg(
            F.sum(UNITS).alias("total_units_sold"), F.round(F.sum(REVENUE), 2).alias("total_revenue_inr"))
        return rank_within(sold, "category_id", "total_units_sold", "rank_in_category").where("rank_in_category = 1").select(
            "product_name", "category_name", "total_units_sold", "total_revenue_inr", "rank_in_category").orderBy(F.desc("total_revenue_inr"))
