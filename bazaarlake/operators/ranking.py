"""Top-k and rank inside groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(k)


def rank_within(df: DataFrame, group: str, measure: str, name: str) -> DataFrame:
    """Rank by ``measure`` from high to low; equal measures share a rank.

    A filter ``name = 1`` above it makes Spark drop lower ranks before the shuffle.
    """
    order = Window.partitionBy(group).orderBy(F.col(measure).desc())
    return df.withColumn(name, F.rank().over(order))


# Slices of a measure per doubling of its value: a group's rows spread over thousands of tasks.
SLICES_PER_DOUBLING = 64


def _slice(measure: Column) -> Column:
    """A number that grows with the measure and depends on nothing else; null for null."""
    size = F.log2(F.abs(measure.cast("double")) + 1) * SLICES_PER_DOUBLING
    return F.floor(F.signum(measure.cast("double")) * size)


def full_rank_within(df: DataFrame, group: str, measure: str, name: str) -> DataFrame:
    """The same ranks for every row, with no large group held by one task.

    A rank is one plus the number of rows with a larger measure; null is the smallest.  Equal
    measures of a group are counted first.  Each group is cut into slices of its measure on a
    logarithmic scale; the counts per slice give the offset of a slice, and a window inside
    each slice does the rest.
    """
    counted = df.groupBy(group, measure).agg(F.count(F.lit(1)).alias("_n")).withColumn("_slice", _slice(F.col(measure)))
    higher = F.col("_slice").desc_nulls_last()
    above = Window.partitionBy(group).orderBy(higher).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counted.groupBy(group, "_slice").agg(F.sum("_n").alias("_total")).select(
        F.col(group).alias("_group"), F.col("_slice").alias("_of"),
        F.coalesce(F.sum("_total").over(above), F.lit(0)).alias("_offset"))
    inside = (
        Window.partitionBy(group, "_slice").orderBy(F.col(measure).desc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    ranks = counted.withColumn("_before", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(
        offsets, F.col(group).eqNullSafe(F.col("_group")) & F.col("_slice").eqNullSafe(F.col("_of"))
    ).select(
        F.col(group).alias("_group"), F.col(measure).alias("_measure"),
        (F.col("_offset") + F.col("_before") + 1).cast("int").alias(name),
    )
    same = df[group].eqNullSafe(ranks["_group"]) & df[measure].eqNullSafe(ranks["_measure"])
    return df.join(ranks, same).select(*[df[c] for c in df.columns], name)
