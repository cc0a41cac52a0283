"""Putting known defects into made tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from bazaarlake import fixed_values as fixed
from bazaarlake.functions.scalars import as_day


def break_product(items: DataFrame, where: Column, product_id: int = fixed.INVALID_PRODUCT_ID) -> DataFrame:
    """Point the picked items at a product that does not exist; the price stays."""
    return items.withColumns({
        "product_id": F.when(where, F.lit(product_id)).otherwise(F.col("product_id")).cast(
            items.schema["product_id"].dataType),
        "product_name": F.when(where, F.lit(fixed.INVALID_PRODUCT_NAME)).otherwise(F.col("product_name")),
    })


def negate_quantity(items: DataFrame, where: Column, size: Column) -> DataFrame:
    """Give the picked items a quantity of -size and a price of nothing."""
    return items.withColumns({
        "quantity": F.when(where, -size).otherwise(F.col("quantity")).cast("int"),
        "final_price": F.when(where, F.lit(0)).otherwise(F.col("final_price")).cast("decimal(18,2)"),
    })


def postdate_orders(orders: DataFrame, order_ids: DataFrame, as_of: dt.date,
                    days: int = fixed.FUTURE_DAYS) -> DataFrame:
    """Move every order named in ``order_ids`` to ``as_of`` + days; created_at is not moved."""
    named = order_ids.select("order_id").distinct().withColumn("_postdated", F.lit(True))
    return (
        orders.join(named, "order_id", "left")
        .withColumn("order_date", F.when(F.col("_postdated"), F.date_add(as_day(as_of), days))
                    .otherwise(F.col("order_date")))
        .select(*orders.columns)
    )
