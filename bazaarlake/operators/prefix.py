"""Running totals over a whole table without a one-task window."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

MIN_WIDTH = 1_000
#: The most buckets of `running_total`: bounds the sketch, the borders in the plan and the table of sums.
MOST_BUCKETS = 1 << 12


def _totals(bucketed: DataFrame, value: str, order_id: str, name: str, partitions: int) -> DataFrame:
    """Add the sum over smaller ids to a frame with ``_bucket``, whose buckets follow one another in id order."""
    in_order = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        bucketed.groupBy("_bucket").agg(F.sum(value).alias("_bucket_sum"))
        .select("_bucket", F.coalesce(F.sum("_bucket_sum").over(in_order), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy("_bucket").orderBy(order_id).rangeBetween(Window.unboundedPreceding, -1)
    return (
        bucketed.repartition(partitions, "_bucket").join(F.broadcast(offsets), "_bucket")
        .withColumn(name, F.col("_offset") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .drop("_bucket", "_offset")
    )


def running_total_before(
    df: DataFrame, value: str, order_id: str, lowest: int, highest: int, name: str, partitions: int
) -> DataFrame:
    """Add ``name``: the sum of ``value`` over all rows with a smaller ``order_id``.

    ``order_id`` must be unique integers that fill [lowest, highest] densely (``running_total`` takes
    any).  The range is cut into as many equal buckets as a bucket has ids (the square root of the
    range), so that neither the table of their sums nor a bucket grows as the table does;
    a window inside each bucket does the rest in parallel.  The
    result keeps the given number of partitions: its rows are narrow here, so merging
    by size would leave too few tasks for what is computed from them.
    """
    width = max(MIN_WIDTH, math.isqrt(highest - lowest + 1))
    bucketed = df.withColumn("_bucket", F.expr(f"({order_id} - {lowest}) div {width}"))
    return _totals(bucketed, value, order_id, name, partitions)


def even_borders(df: DataFrame, order_id: str, buckets: int) -> list[int]:
    """Ids at which the buckets after the first begin, from one mergeable quantile sketch of the ids.

    The sketch places each border within a quarter of a bucket, so that no bucket of different ids is larger
    than one and a half times the mean, however the ids lie.
    """
    if buckets < 2:
        return []
    shares = [i / buckets for i in range(1, buckets)]
    found = df.agg(F.percentile_approx(order_id, shares, 4 * buckets).alias("at")).first()["at"]
    return sorted(set(found or []))


def bucket_of(order_id: Column, borders: list[int]) -> Column:
    """How many borders are at or below the id: a binary search in one constant array.  Null ids are in bucket 0."""
    if not borders:
        return F.lit(0)
    table = F.split(F.lit(",".join(map(str, borders))), ",").cast("array<bigint>")
    steps = F.array(*(F.lit(1 << bit) for bit in reversed(range(len(borders).bit_length()))))

    def step(found: Column, more: Column) -> Column:
        return F.when(F.get(table, found + more - 1) <= order_id, found + more).otherwise(found)

    return F.aggregate(steps, F.lit(0), step)


def running_total(
    df: DataFrame, value: str, order_id: str, name: str, partitions: int | None = None, rows_per_bucket: int = MIN_WIDTH
) -> DataFrame:
    """Add ``name``: the sum of ``value`` over all rows with a smaller ``order_id``, for any integer ids.

    Ids may be sparse, clumped and negative: buckets hold nearly equal numbers of rows, not of possible ids.  There are as many
    buckets as a bucket has rows (the square root of the table), at least ``rows_per_bucket`` rows in each, up to
    MOST_BUCKETS.  Rows of one id have the same total, and are in one bucket; a row without an id has the total null and
    counts in none; an empty table gives none.  The frame is read three times: write it first if it is dear to make.
    """
    rows = df.count()
    buckets = min(MOST_BUCKETS, rows // max(rows_per_bucket, math.isqrt(rows), 1))
    known = F.col(order_id).isNotNull()
    counted = df.withColumn("_value", F.when(known, F.col(value))).withColumn(
        "_bucket", bucket_of(F.col(order_id), even_borders(df, order_id, buckets)))
    wanted = partitions or df.sparkSession.sparkContext.defaultParallelism
    return _totals(counted, "_value", order_id, name, wanted).withColumn(name, F.when(known, F.col(name))).drop("_value")
