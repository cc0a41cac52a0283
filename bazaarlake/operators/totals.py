"""Aggregations shared by the queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from bazaarlake.functions import scalars

UNITS = "units"
REVENUE = "revenue"


def line_money(items: DataFrame, *keys: str) -> DataFrame:
    """Keys, units and revenue of every item line."""
    return items.select(
        *keys,
        F.col("quantity").alias(UNITS),
        scalars.revenue(F.col("final_price"), F.col("quantity")).alias(REVENUE),
    )


def _line_sums() -> list[Column]:
    """Sums over item lines; the product is formed here, so that shuffles carry the short columns."""
    line = scalars.revenue(F.col("final_price"), F.col("quantity"))
    return [F.sum("quantity").alias(UNITS), F.sum(line).alias(REVENUE)]


def totals_by(items: DataFrame, *keys: str) -> DataFrame:
    """Units and revenue per key; summed in every map task before the shuffle."""
    return items.groupBy(*keys).agg(*_line_sums())


def totals_per_order(
    lines: DataFrame,
    orders: DataFrame,
    keys: Sequence[str],
    names: tuple[DataFrame, str] | None = None,
) -> DataFrame:
    """Units and revenue of the lines of ``orders``, grouped by ``keys``, which include order_id.

    Lines and orders meet hashed by order_id, so the grouping needs no further shuffle; adaptive
    execution splits an order that holds a large share of all lines, and sums its parts before
    they meet.  ``names`` is a small look-up (table, key) to apply to the lines after they have
    met the orders, so that its text is not shuffled.
    """
    met = lines.join(orders, "order_id")
    if names is not None:
        met = met.join(names[0], names[1])
    return met.groupBy(*keys).agg(*_line_sums())


def share_of_all(df: DataFrame, measure: str, name: str) -> DataFrame:
    """Percentage of the column total.  ``df`` must already be aggregated to few rows."""
    whole = Window.partitionBy()
    share = F.col(measure) * F.lit(100).cast("decimal(10,0)") / F.sum(measure).over(whole)
    return df.withColumn(name, F.round(share, 2))


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
