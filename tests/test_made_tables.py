"""Draws and the made tables."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from bazaarlake import fixed_values as fixed
from bazaarlake.functions import draws
from bazaarlake.operators.picks import NOTHING, cutoff_of
from bazaarlake.operators.quality import check_report, require_checks
from bazaarlake.synth import catalogue
from bazaarlake.synth.generate import Sizes, maker

AS_OF = dt.date(2025, 4, 15)


@pytest.fixture(scope="module")
def small(spark):
    return maker(spark, 3000, AS_OF, seed=5)


def frame(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_catalogue(spark):
    products = catalogue.products(spark).orderBy("product_id").collect()
    assert [p["product_id"] for p in products] == list(range(1, 50))
    assert (products[0]["product_name"], int(products[0]["default_price"])) == ("Smartphone", 65000)
    assert (products[48]["product_name"], int(products[48]["default_price"]), products[48]["category_id"]) == ("Tea", 30, 7)
    assert len({p["product_name"] for p in products}) == 49


@pytest.mark.parametrize("target,customers,orders", [(100_000, 14_285, 50_000), (750, 200, 375), (100, 200, 300)])
def test_sizes(target, customers, orders):
    assert (Sizes.of(target).customers, Sizes.of(target).orders) == (customers, orders)


def test_weighted_draw_keeps_its_weights(spark):
    drawn = spark.range(50_000).select(
        draws.weighted(draws.draw(1, "w", F.col("id")), fixed.STATUS_WEIGHTS).alias("s"))
    n = {r["s"]: r["count"] for r in drawn.groupBy("s").count().collect()}
    for status, weight in fixed.STATUS_WEIGHTS:
        assert abs(n[status] / 50_000 - weight / 100) < 0.01


def _drawn_baskets(spark, weights, count=4000):
    ids = spark.range(count).select("id", F.lit(5).alias("n"))
    hs = draws.draws(1, "b", 5, F.col("id"))
    return [r["p"] for r in draws.with_distinct_picks(ids, "p", hs, F.col("n"), weights).collect()]


def test_baskets_are_distinct_and_uniform(spark):
    baskets = _drawn_baskets(spark, catalogue.UNIFORM_WEIGHTS)
    assert all(len(set(b)) == 5 and min(b) >= 0 and max(b) < 49 for b in baskets)
    per_product = Counter(p for b in baskets for p in b)
    expected = 4000 * 5 / 49
    assert all(abs(n - expected) < expected * 0.3 for n in per_product.values())


def test_weighted_baskets_prefer_popular_products(spark):
    baskets = _drawn_baskets(spark, catalogue.POPULAR_WEIGHTS)
    assert all(len(set(b)) == 5 for b in baskets)
    first = Counter(b[0] % 7 < 2 for b in baskets)
    assert abs(first[True] / 4000 - 70 / 105) < 0.03


def test_same_seed_same_tables_for_any_partitioning(spark, small, conf):
    before = [frame(df) for _, df in small.tables().items()]
    conf(spark__sql__shuffle__partitions="3")
    again = maker(spark, 3000, AS_OF, seed=5)
    assert [frame(df) for _, df in again.tables().items()] == before
    other = maker(spark, 3000, AS_OF, seed=6)
    assert frame(other.orders()) != frame(small.orders())


def test_made_tables_follow_the_rules(small):
    tables = small.sound_tables()
    require_checks(check_report(tables))
    assert tables.order_items.count() == 3000
    orders = tables.orders.join(tables.customers.select("customer_id", "signup_date"), "customer_id")
    assert orders.count() == tables.orders.count()
    assert orders.where((F.col("order_date") < F.col("signup_date")) | (F.col("order_date") > F.lit(AS_OF))).count() == 0
    items = tables.order_items
    wrong = items.where("final_price <> round(unit_price * (100 - discount) / 100, 2) OR quantity NOT BETWEEN 1 AND 5")
    assert wrong.count() == 0
    assert items.agg(F.min("order_item_id"), F.max("order_item_id"), F.count_distinct("order_item_id")).first() == (1, 3000, 3000)
    assert items.groupBy("order_id").agg((F.count(F.lit(1)) - F.count_distinct("product_id")).alias("d")).where("d > 0").count() == 0
    same_day = items.join(tables.orders.select("order_id", "order_date"), "order_id").where(
        "cast(created_at AS date) <> order_date OR hour(created_at) NOT BETWEEN 8 AND 22")
    assert same_day.count() == 0


def test_defects_are_injected_in_exact_number(small):
    sound, dirty = small.sound_tables(), small.tables()
    kinds = Counter(r["k"] for r in sound.order_items.select(small.defect_kind().alias("k")).collect())
    assert sum(n for k, n in kinds.items() if k) == 90
    assert dirty.order_items.where("product_id = 9999 AND product_name = 'INVALID_PRODUCT'").count() == kinds["invalid_fk"]
    assert dirty.order_items.where("quantity BETWEEN -5 AND -1 AND final_price = 0").count() == kinds["negative_qty"]
    late = dirty.orders.where(F.col("order_date") == F.lit(AS_OF + dt.timedelta(days=10)))
    assert 0 < late.count() <= kinds["future_date"]
    assert late.where("cast(created_at AS date) > DATE '2025-04-15'").count() == 0


def test_cutoff_picks_exactly(spark):
    """Also when many rows share one draw."""
    ids = spark.range(1000).withColumnRenamed("id", "k")
    for draw in (draws.draw(1, "p", F.col("k")), F.col("k") % 3, F.lit(9).cast("bigint")):
        for wanted in (1, 30, 500, 1000):
            cutoff = cutoff_of(ids, draw, "k", wanted)
            picked = ids.where(cutoff.picks(draw, F.col("k")))
            expected = ids.select("k", draw.alias("d")).orderBy("d", "k").limit(wanted)
            assert sorted(r["k"] for r in picked.collect()) == sorted(r["k"] for r in expected.collect())
    assert cutoff_of(ids, F.lit(1), "k", 0) == NOTHING
    assert ids.where(NOTHING.picks(F.lit(0), F.col("k"))).count() == 0
