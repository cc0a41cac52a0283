"""Exact distinct counts from bitmaps that can be kept and merged.

A number is a bit: its bucket says which bitmap of 4 KiB, its position which bit.  Bitmaps of parts (a run, a month)
are merged by OR, so a count over many parts needs no second look at the rows, and the same stored bitmaps
give counts per part, per group of parts and in all.  One bitmap serves 32,768 neighbouring numbers: ids
that are dense take about a bit each, ids scattered over 64 bits up to a bitmap each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def bitmaps(df: DataFrame, keys: list[str], *ids: str) -> DataFrame:
    """Columns keys, counted (the name of the id), bucket, bits; nulls count nowhere.  Built in every map task first."""
    each = F.explode(F.array(*[F.struct(F.lit(name).alias("counted"), F.col(name).cast("long").alias("id")) for name in ids]))
    rows = df.select(*keys, each.alias("x")).select(*keys, "x.counted", "x.id").where("id IS NOT NULL")
    return rows.groupBy(*keys, "counted", F.bitmap_bucket_number("id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits"))


def merged(parts: DataFrame, keys: list[str]) -> DataFrame:
    """The bitmaps of coarser keys."""
    return parts.groupBy(*keys, "counted", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def counts(parts: DataFrame, keys: list[str], **names: str) -> DataFrame:
    """Distinct counts per key: a column for each name, of the id given for it."""
    of = [F.coalesce(F.sum(F.when(F.col("counted") == counted, F.bitmap_count("bits"))), F.lit(0)).alias(name) for name, counted in names.items()]
    return merged(parts, keys).groupBy(*keys).agg(*of)
