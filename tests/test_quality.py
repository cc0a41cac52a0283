"""Cleaning rules, quarantine, checks."""

import pytest
from conftest import AS_OF, ITEMS, ORDERS, hand_made, rows_of

from bazaarlake.operators import quality
from pyspark.sql import functions as F


def ids(df, key="order_item_id"):
    return sorted(r[key] for r in df.select(key).collect())


def test_single_rules(raw_tables):
    items, products, orders = raw_tables.order_items, raw_tables.products, raw_tables.orders
    assert ids(quality.with_valid_product(items, products)) == [1, 2, 3, 5, 6, 7, 8]
    assert ids(quality.with_unknown_product(items, products)) == [4]
    assert ids(quality.with_positive_quantity(items)) == [1, 2, 3, 4, 5, 6, 8]
    assert ids(quality.not_in_future(orders, AS_OF), "order_id") == [1, 2, 3, 5]
    assert ids(quality.with_kept_order(items, quality.not_in_future(orders, AS_OF))) == [1, 2, 3, 4, 5, 7, 8]


def test_clean_items(clean_tables):
    assert ids(clean_tables.order_items) == [1, 2, 3, 5, 8]


def test_cleaning_twice_changes_nothing(clean_tables):
    orders = quality.clean_orders(clean_tables.orders, AS_OF)
    again = quality.clean_items(clean_tables.order_items, clean_tables.products, orders)
    assert rows_of(again.orderBy("order_item_id")) == rows_of(clean_tables.order_items.orderBy("order_item_id"))


def test_verdicts_and_plain_rules_agree_and_nothing_is_lost(spark):
    items = [*ITEMS, (9, 99, 1, 1, "1.00"), (10, 1, None, 1, "1.00"), (11, 1, 1, None, "1.00"), (12, 4, 9999, 0, "1.00")]
    orders = [*ORDERS, (6, 1, None, "UPI", "completed")]
    tables = hand_made(spark, items=items, orders=orders)
    judged_orders = quality.judge_orders(tables.orders, AS_OF)
    judged = quality.judge_items(tables.order_items, tables.products, judged_orders)
    kept_orders = quality.clean_orders(tables.orders, AS_OF)
    assert ids(quality.kept(judged_orders), "order_id") == ids(kept_orders, "order_id")
    assert ids(quality.kept(judged)) == ids(quality.clean_items(tables.order_items, tables.products, kept_orders))
    assert quality.kept(judged).count() + quality.quarantined(judged).count() == len(items)
    reasons = {r["order_item_id"]: r["reasons"] for r in quality.quarantined(judged).collect()}
    assert reasons == {
        4: ["invalid_fk"], 6: ["removed_order"], 7: ["negative_qty"], 9: ["removed_order"], 10: ["invalid_fk"],
        11: ["malformed"], 12: ["invalid_fk", "negative_qty", "removed_order"]}


def test_large_product_table_takes_the_other_way(raw_tables, conf):
    """With broadcasting off, unknown keys are found first; the answer is the same."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    items, products = raw_tables.order_items, raw_tables.products
    assert ids(quality.with_valid_product(items, products)) == [1, 2, 3, 5, 6, 7, 8]
    assert ids(quality.with_unknown_product(items, products)) == [4]


def test_null_product_is_unknown_on_both_ways(spark, conf):
    tables = hand_made(spark, items=[*ITEMS, (9, 1, None, 1, "1.00")])
    assert 9 in ids(quality.with_unknown_product(tables.order_items, tables.products))
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    assert 9 in ids(quality.with_unknown_product(tables.order_items, tables.products))


def report_of(tables, **expected):
    extra = tables.having(
        customers=tables.customers.withColumn("email", F.col("first_name")),
        order_items=tables.order_items.withColumn("unit_price", F.col("final_price")))
    return quality.check_report(extra, **expected)


def test_checks_pass_on_sound_tables(raw_tables):
    report = report_of(raw_tables, categories=2, products=3)
    assert report.count() == 11
    quality.require_checks(report)


def test_first_failed_check_is_raised(spark, raw_tables):
    with pytest.raises(quality.CheckFailed, match="categories has exactly 7 rows"):
        quality.require_checks(report_of(raw_tables))
    doubled = hand_made(spark, orders=[*ORDERS, ORDERS[0]])
    with pytest.raises(quality.CheckFailed, match="order ids are unique"):
        quality.require_checks(report_of(doubled, categories=2, products=3))
    empty = raw_tables.having(orders=raw_tables.orders.where("false"))
    with pytest.raises(quality.CheckFailed, match="orders is not empty"):
        quality.require_checks(report_of(empty, categories=2, products=3))
    negative = hand_made(spark, items=[*ITEMS, (9, 1, 1, 1, "-1.00")])
    with pytest.raises(quality.CheckFailed, match="unit prices are not negative"):
        quality.require_checks(report_of(negative, categories=2, products=3))
