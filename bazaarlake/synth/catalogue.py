"""The static tables: categories, products, discounts, from nested literals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from bazaarlake import fixed_values as fixed
from bazaarlake.functions.draws import constants
from bazaarlake.functions.scalars import MONEY

CATEGORY_COUNT = len(fixed.CATEGORIES)
PER_CATEGORY = len(fixed.PRODUCT_NAMES[fixed.CATEGORIES[0][1]])
PRODUCT_COUNT = CATEGORY_COUNT * PER_CATEGORY

UNIFORM_WEIGHTS = [1] * PRODUCT_COUNT
POPULAR_WEIGHTS = [
    fixed.POPULAR_WEIGHT if position % PER_CATEGORY < fixed.POPULAR_POSITIONS else 1
    for position in range(PRODUCT_COUNT)
]


def categories(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(fixed.CATEGORIES, "category_id int, category_name string")


def _per_category(lists: dict[str, list]) -> Column:
    """A map literal: category name -> list."""
    pairs = []
    for name, values in lists.items():
        pairs += [F.lit(name), constants(values)]
    return F.create_map(*pairs)


def discount_list(category_name: Column) -> Column:
    return F.element_at(_per_category(fixed.DISCOUNT_PERCENTS), category_name)


def products(spark: SparkSession) -> DataFrame:
    """Each category's list flattened with its position; ids run through in category order."""
    listed = categories(spark).select(
        "category_id",
        F.posexplode(F.arrays_zip(
            F.element_at(_per_category(fixed.PRODUCT_NAMES), F.col("category_name")).alias("name"),
            F.element_at(_per_category(fixed.PRODUCT_PRICES), F.col("category_name")).alias("price"),
        )).alias("position", "entry"),
    )
    return listed.select(
        ((F.col("category_id") - 1) * PER_CATEGORY + F.col("position") + 1).alias("product_id"),
        "category_id",
        F.col("entry.name").alias("product_name"),
        F.col("entry.price").cast(MONEY).alias("default_price"),
    )


def product_facts(spark: SparkSession) -> DataFrame:
    """What an item copies from its product: name, price and the discounts it may get (49 rows)."""
    return products(spark).join(categories(spark), "category_id").select(
        "product_id", "product_name", "default_price",
        discount_list(F.col("category_name")).alias("discounts"),
    )
