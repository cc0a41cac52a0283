"""Finding, removing and setting aside bad rows; table checks."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from bazaarlake.functions.scalars import as_day
from bazaarlake.functions.typing import MALFORMED
from bazaarlake.operators.joins import with_known_key
from bazaarlake.operators.pruning import among_words, key_words, maybe_among

REASONS = "reasons"
IS_CLEAN = "is_clean"
INVALID_FK = "invalid_fk"
NEGATIVE_QTY = "negative_qty"
FUTURE_DATE = "future_date"
REMOVED_ORDER = "removed_order"
ITEM_REASONS = [MALFORMED, INVALID_FK, NEGATIVE_QTY, REMOVED_ORDER]


# One rule each ------------------------------------------------------------

def with_valid_product(items: DataFrame, products: DataFrame) -> DataFrame:
    """Items whose product exists; by key look-up, not by a known bad value."""
    return with_known_key(items, products, "product_id", "_known").where("_known").select(*items.columns)


def with_unknown_product(items: DataFrame, products: DataFrame) -> DataFrame:
    return with_known_key(items, products, "product_id", "_known").where("not _known").select(*items.columns)


def with_positive_quantity(items: DataFrame) -> DataFrame:
    return items.where(F.col("quantity") > 0)


def not_in_future(orders: DataFrame, as_of: dt.date) -> DataFrame:
    return orders.where(F.col("order_date") <= as_day(as_of))


def with_kept_order(items: DataFrame, kept_orders: DataFrame, filter_bits: int | None = None) -> DataFrame:
    """Items whose order is kept: a removed order takes its items along.

    With ``filter_bits`` a filter of the kept orders, of that size, takes most other items out before the shuffle.
    """
    if filter_bits:
        items = maybe_among(items, "order_id", kept_orders, filter_bits)
    return items.join(kept_orders.select("order_id"), "order_id", "left_semi").select(*items.columns)


def with_key_among(items: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Items whose key is among written keys: by their exact set, without a shuffle of items, while it keeps its bound.

    Counts the set, so for a job; a query that only makes a plan takes the joins.
    """
    words = key_words(keys, key)
    if words is None:
        return items.join(keys.select(key), key, "left_semi").select(*items.columns)
    return among_words(items, key, words, "_among").where("_among").select(*items.columns)


# The clean tables alone ---------------------------------------------------

def well_formed(df: DataFrame) -> DataFrame:
    return df.where(~F.col(MALFORMED)).drop(MALFORMED) if MALFORMED in df.columns else df


def clean_orders(orders: DataFrame, as_of: dt.date) -> DataFrame:
    return not_in_future(well_formed(orders), as_of)


def clean_lines(items: DataFrame, products: DataFrame) -> DataFrame:
    """The rules that need no order.  Enough for any query that joins clean orders itself."""
    return with_valid_product(with_positive_quantity(well_formed(items)), products)


def clean_items(items: DataFrame, products: DataFrame, kept_orders: DataFrame) -> DataFrame:
    return with_kept_order(clean_lines(items, products), kept_orders)


# Clean and quarantine in one pass -----------------------------------------

def reasons_of(*tests: tuple[str, Column]) -> Column:
    """The names of the tests that are true.  array_remove is generated code; array_compact is interpreted row by row."""
    return F.array_remove(F.array(*[F.when(test, F.lit(name)).otherwise(F.lit("")) for name, test in tests]), "")


def _with_reasons(df: DataFrame, tests: Sequence[tuple[str, Column]]) -> DataFrame:
    return df.withColumn(REASONS, reasons_of(*tests)).withColumn(IS_CLEAN, F.size(REASONS) == 0)


def _malformed(df: DataFrame, *needed: str) -> Column:
    marked = F.col(MALFORMED) if MALFORMED in df.columns else F.lit(False)
    for name in needed:
        marked = marked | F.col(name).isNull()
    return marked


def judge_orders(orders: DataFrame, as_of: dt.date) -> DataFrame:
    """Every order with its reasons for removal; none when clean."""
    tests = [
        (MALFORMED, _malformed(orders, "order_date")),
        (FUTURE_DATE, F.col("order_date") > as_day(as_of)),
    ]
    return _with_reasons(orders, tests).drop(MALFORMED)


def judge_items(
    items: DataFrame,
    products: DataFrame,
    judged_orders: DataFrame,
    product_words: DataFrame | None = None,
    kept_order_words: DataFrame | None = None,
) -> DataFrame:
    """Every item with its reasons for removal; an item is clean iff ``clean_items`` keeps it.

    Where the keys of the products or of the kept orders are given as exact sets (``pruning.key_words``), items are looked up in
    these and not shuffled; the verdicts are the same.
    """
    if product_words is None:
        looked_up = with_known_key(items, products, "product_id", "_known")
    else:
        looked_up = among_words(items, "product_id", product_words, "_known")
    if kept_order_words is None:
        verdicts = judged_orders.groupBy("order_id").agg(F.bool_or(IS_CLEAN).alias("_order_kept"))
        joined = looked_up.join(verdicts, "order_id", "left")
    else:
        joined = among_words(looked_up, "order_id", kept_order_words, "_order_kept")
    tests = [
        (MALFORMED, _malformed(items, "quantity")),
        (INVALID_FK, ~F.col("_known")),
        (NEGATIVE_QTY, F.col("quantity") <= 0),
        (REMOVED_ORDER, ~F.coalesce(F.col("_order_kept"), F.lit(False))),
    ]
    columns = [c for c in items.columns if c != MALFORMED]
    return _with_reasons(joined, tests).select(*columns, REASONS, IS_CLEAN)


def quarantined(judged: DataFrame) -> DataFrame:
    return judged.where(~F.col(IS_CLEAN)).drop(IS_CLEAN)


def kept(judged: DataFrame) -> DataFrame:
    return judged.where(IS_CLEAN).drop(IS_CLEAN, REASONS)


def summary(judged: DataFrame, reasons: Sequence[str], rows: str, bad: str) -> DataFrame:
    """measure, value: all rows, bad rows, and rows per reason that occurs, in one pass over the judged rows."""
    of_reason = [F.count_if(F.array_contains(REASONS, reason)) for reason in reasons]
    names = [rows, bad, *reasons]
    counts = [F.count(F.lit(1)), F.count_if(~F.col(IS_CLEAN)), *of_reason]
    cells = ", ".join(f"'{name}', c{i}" for i, name in enumerate(names))
    counted = judged.agg(*[count.alias(f"c{i}") for i, count in enumerate(counts)])
    return counted.selectExpr(f"stack({len(names)}, {cells}) AS (measure, value)").where(
        F.col("measure").isin(rows, bad) | (F.col("value") > 0))


def reason_counts(judged: DataFrame) -> DataFrame:
    """Rows per reason; a row with two reasons counts under both."""
    return (
        judged.select(F.explode(REASONS).alias("reason"))
        .groupBy("reason").agg(F.count(F.lit(1)).alias("bad_rows"))
    )


# Table checks ---------------------------------------------------------------

def _check(df: DataFrame, tests: Sequence[tuple[int, str, Column]]) -> DataFrame:
    """Count the bad rows of all checks on one table in one pass, one output row per check."""
    counted = df.agg(*[bad.cast("bigint").alias(f"c{number}") for number, _, bad in tests])
    cells = ", ".join(f"{number}, '{message}', c{number}" for number, message, _ in tests)
    return counted.selectExpr(f"stack({len(tests)}, {cells}) AS (number, check_name, bad_rows)")


def _off_by(expected: int) -> Column:
    return F.abs(F.count(F.lit(1)) - F.lit(expected))


def _is_empty() -> Column:
    return F.when(F.count(F.lit(1)) > 0, 0).otherwise(1)


def _repeats(*keys: str) -> Column:
    # count_distinct leaves out nulls, so a null key counts as a repeat: it identifies nothing.
    return F.count(F.lit(1)) - F.count_distinct(*keys)


def check_report(
    tables,
    categories: int = 7,
    products: int = 49,
    contact: str = "email",
    item_key: Sequence[str] = ("order_item_id",),
) -> DataFrame:
    """Eleven checks on the five tables: check_name, passed, bad_rows.

    All sizes come first, then unique keys, then missing and negative values.
    """
    parts = [
        _check(tables.categories, [(1, f"categories has exactly {categories} rows", _off_by(categories))]),
        _check(tables.products, [(2, f"products has exactly {products} rows", _off_by(products))]),
        _check(tables.customers, [
            (3, "customers is not empty", _is_empty()),
            (6, "customer ids are unique", _repeats("customer_id")),
            (9, f"customers have {contact}", F.count_if(F.col(contact).isNull())),
        ]),
        _check(tables.orders, [
            (4, "orders is not empty", _is_empty()),
            (7, "order ids are unique", _repeats("order_id")),
            (10, "orders have a customer", F.count_if(F.col("customer_id").isNull())),
        ]),
        _check(tables.order_items, [
            (5, "order items is not empty", _is_empty()),
            (8, "order item ids are unique", _repeats(*item_key)),
            (11, "unit prices are not negative", F.count_if(F.col("unit_price") < 0)),
        ]),
    ]
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report.orderBy("number").select("check_name", (F.col("bad_rows") == 0).alias("passed"), "bad_rows")


class CheckFailed(ValueError):
    pass


def require_checks(report: DataFrame) -> None:
    """Raise on the first failed check, in the order of the report (eleven rows)."""
    for row in report.collect():
        if not row["passed"]:
            raise CheckFailed(f"check failed: {row['check_name']} ({row['bad_rows']} bad rows)")
