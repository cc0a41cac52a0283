"""Hot keys and null keys, through the same code as every query."""

import pytest
from conftest import hand_made, rows_of
from pyspark.sql import functions as F

from bazaarlake.operators import prefix, pruning, quality
from bazaarlake.operators.prefix import running_total, running_total_before
from bazaarlake.operators.ranking import full_rank_within, rank_within
from bazaarlake.plans import analytics, sql_questions
from bazaarlake.session import DEFAULTS
from bazaarlake.sources.catalog import as_views


def counted(df):
    return {tuple(r)[:-1]: r["n"] for r in df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n")).collect()}


@pytest.fixture(scope="module")
def skewed(spark):
    """Order 1, product 3 and customer 1 hold a third of their tables; some keys are null."""
    n = range(3000)
    items = [(i, None if i % 97 == 0 else 1 if i % 3 == 0 else i % 400, None if i % 89 == 0 else 3 if i % 3 < 2 else 1 + i % 3,
              1 + i % 5, f"{i % 97}.25") for i in n]
    orders = [(i, None if i % 41 == 0 else 1 if i % 3 == 0 else i % 50, f"2025-0{1 + i % 3}-11", ["UPI", "Card"][i % 2],
               "pending" if i % 7 == 0 else "completed") for i in range(400)]
    customers = [(i, f"F{i}", "L", "C") for i in range(50)]
    return hand_made(spark, items=items, orders=orders, customers=customers)


@pytest.mark.parametrize("name", list(analytics.QUESTIONS))
@pytest.mark.parametrize("broadcast", ["10m", "-1"])
def test_questions_with_hot_and_null_keys_equal_the_sql_text(spark, skewed, conf, name, broadcast):
    conf(spark__sql__autoBroadcastJoinThreshold=broadcast)
    as_views(skewed)
    plain = rows_of(spark.sql(sql_questions.QUESTIONS[name]))
    assert rows_of(analytics.QUESTIONS[name](skewed)) == plain and plain


def test_a_hot_order_is_split_at_run_time(spark, conf):
    """The session's settings make the join split a key that is most of its side."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__shuffle__partitions="16",
         spark__sql__adaptive__advisoryPartitionSizeInBytes="64k", spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="64k",
         spark__sql__adaptive__skewJoin__skewedPartitionFactor="2", **{k.replace(".", "__"): v for k, v in DEFAULTS.items()})
    lines = spark.range(0, 200_000, 1, 8).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).alias("order_id"), "id")
    joined = lines.join(spark.range(5000).withColumnRenamed("id", "order_id"), "order_id").groupBy("order_id").count()
    joined.collect()
    assert "skewed" in joined._jdf.queryExecution().executedPlan().toString() or "skew=true" in joined._jdf.queryExecution().executedPlan().toString()


def test_null_keys_are_unknown_products_and_orders_without_verdict(skewed):
    judged = quality.judge_items(skewed.order_items, skewed.products, quality.judge_orders(skewed.orders, __import__("datetime").date(2026, 1, 1)))
    for row in judged.where("product_id is null").collect():
        assert "invalid_fk" in row["reasons"]
    for row in judged.where("order_id is null").collect():
        assert "removed_order" in row["reasons"]
    assert judged.count() == skewed.order_items.count()


def test_running_total_equals_plain_window(spark):
    df = spark.range(1, 5001).select(F.col("id").alias("k"), (F.col("id") % 5 + 1).alias("n"))
    total = {r["k"]: r["before"] for r in running_total_before(df, "n", "k", 1, 5000, "before", 8).collect()}
    expected, so_far = {}, 0
    for k in range(1, 5001):
        expected[k] = so_far
        so_far += k % 5 + 1
    assert total == expected


@pytest.mark.parametrize("kind", ["bigint", "double", "decimal(18,2)"])
def test_full_rank_equals_window_rank(spark, kind):
    """Uneven groups, ties, one measure that holds half of a group, null groups and measures, both signs."""
    df = spark.range(6000).select(
        "id", F.when(F.col("id") % 11 == 0, None).when(F.col("id") < 5000, 1).otherwise(F.col("id") % 3).cast("int").alias("g"),
        F.when(F.col("id") % 13 == 0, None).when(F.col("id") % 2 == 0, 50).otherwise((F.col("id") * 7919) % 997 - 300).cast(kind).alias("m"))
    got = full_rank_within(df, "g", "m", "r")
    assert got.columns == ["id", "g", "m", "r"]
    assert counted(got) == counted(rank_within(df, "g", "m", "r"))


@pytest.fixture(scope="module")
def sparse(spark):
    """Ids from -5 to 10^12: a few far apart, a dense clump in the middle, one of them the largest."""
    wide = spark.range(4000).select((F.col("id") * 250_062_515 - 5).alias("k"))
    clump = spark.range(6000).select((F.col("id") + 499_000_000_007).alias("k"))
    ids = wide.unionByName(clump).unionByName(spark.range(1).select(F.lit(10**12).alias("k"))).distinct()
    return ids.withColumn("n", (F.col("k") % 7 + 1).cast("int")).cache()


def test_running_total_of_sparse_ids(sparse):
    rows = sorted((r["k"], r["n"]) for r in sparse.collect())
    expected, so_far = {}, 0
    for k, n in rows:
        expected[k] = so_far
        so_far += n
    assert {r["k"]: r["before"] for r in running_total(sparse, "n", "k", "before", 8, rows_per_bucket=100).collect()} == expected


@pytest.mark.parametrize("buckets", [2, 10, 97])
def test_no_bucket_is_over_twice_the_mean(sparse, buckets):
    borders = prefix.even_borders(sparse, "k", buckets)
    sizes = [r["count"] for r in sparse.groupBy(prefix.bucket_of(F.col("k"), borders).alias("b")).count().collect()]
    assert len(sizes) == buckets and max(sizes) <= 2 * sparse.count() / buckets


def test_buckets_are_those_of_a_plain_search(spark):
    import bisect
    borders = [-3, 0, 5, 6, 10**12]
    ids = [-(1 << 62), -4, -3, -1, 0, 4, 5, 6, 7, 10**12 - 1, 10**12, (1 << 62)]
    df = spark.createDataFrame([(i,) for i in ids], "k long")
    for n in range(len(borders) + 1):
        got = {r["k"]: r["b"] for r in df.select("k", prefix.bucket_of(F.col("k"), borders[:n]).alias("b")).collect()}
        assert got == {i: bisect.bisect_right(borders[:n], i) for i in ids}


def test_running_total_of_odd_ids(spark):
    """Repeated ids share their total, rows without an id have none and count in none, null values add nothing."""
    df = spark.createDataFrame([(3, 10, "a"), (3, 5, "b"), (None, 99, "c"), (7, None, "d"), (9, 1, "e"), (-2, 4, "f")], "k long, n int, _x string")
    got = {r["_x"]: r["t"] for r in running_total(df, "n", "k", "t", 4, rows_per_bucket=1).collect()}
    assert got == {"f": 0, "a": 4, "b": 4, "d": 19, "e": 19, "c": None}
    assert running_total(df.limit(0), "n", "k", "t").collect() == []


def test_filter_takes_other_rows_out_and_loses_none(spark):
    facts = spark.range(60_000).select((F.col("id") % 20_000).alias("order_id"), "id")
    keys = spark.range(0, 20_000, 10).select(F.col("id").alias("order_id"))
    bits = pruning.bits_for(keys.count(), 0.05)
    passed = pruning.maybe_among(facts, "order_id", keys, bits)
    exact = facts.join(keys, "order_id", "left_semi")
    assert exact.join(passed, "id", "left_anti").count() == 0
    others = passed.count() - exact.count()
    assert exact.count() == 6_000 and others <= 0.05 * 54_000 * 1.2


def test_a_filter_that_lets_half_pass_changes_no_result(spark):
    items = spark.range(30_000).select((F.col("id") % 10_000).alias("order_id"), "id").unionByName(
        spark.createDataFrame([(None, -1)], "order_id long, id long"))
    orders = spark.range(0, 10_000, 3).select(F.col("id").alias("order_id")).unionByName(spark.createDataFrame([(None,)], "order_id long"))
    half = round(orders.count() / 0.693 / 64) * 64
    passed = pruning.maybe_among(items, "order_id", orders, half, hashes=1).where("order_id % 3 != 0").count()
    assert 0.45 * 20_000 < passed < 0.55 * 20_000
    assert sorted(rows_of(quality.with_kept_order(items, orders, half))) == sorted(rows_of(quality.with_kept_order(items, orders)))


def test_the_filter_stands_before_the_shuffle_and_answers_stay(spark, skewed, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    pruned = analytics.revenue_by_category(skewed, 1 << 12)
    assert rows_of(pruned) == rows_of(analytics.revenue_by_category(skewed))
    plan = pruned._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 2 and plan.index("SortMergeJoin") < plan.index("LeftSemi")


def test_filter_size_has_a_bound(spark):
    assert pruning.bits_for(0) >= 64 and pruning.bits_for(10**9) is None
    assert pruning.bits_for(10**6) <= pruning.MOST_BITS
    for bits in (0, 100, 2 * pruning.MOST_BITS):
        with pytest.raises(ValueError):
            pruning.key_filter(spark.range(1), "id", bits)
