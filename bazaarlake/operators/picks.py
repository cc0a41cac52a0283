"""Exact-count random pick without sorting the table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from bazaarlake.functions.draws import DRAW_BITS

_HALF = 1 << (DRAW_BITS // 2)


@dataclass(frozen=True)
class Cutoff:
    """Rows up to (draw, key) in that order are picked."""

    draw: int
    key: int

    def picks(self, draw: Column, key: Column) -> Column:
        return (draw < F.lit(self.draw)) | ((draw == F.lit(self.draw)) & (key <= F.lit(self.key)))


NOTHING = Cutoff(-1, -1)


def _locate(counts: DataFrame, wanted: int) -> tuple[int, int]:
    """Cell of the histogram (at most 65536 rows) where the running count reaches ``wanted``."""
    upto = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    row = (
        counts.withColumn("upto", F.sum("n").over(upto))
        .where(F.col("upto") >= wanted)
        .orderBy("cell")
        .first()
    )
    return row["cell"], row["upto"] - row["n"]


def cutoff_of(df: DataFrame, draw: Column, key: str, wanted: int) -> Cutoff:
    """The cutoff that picks the ``wanted`` rows with the smallest (draw, key).

    ``key`` must be unique and ``wanted`` at most the row count.  Two histograms of
    16 bits each pin down the draw; only the rows that share this very 32-bit value
    are ordered by key.
    """
    if wanted <= 0:
        return NOTHING
    drawn = df.select(F.col(key), draw.alias("_draw"))
    high, low = F.expr(f"_draw div {_HALF}"), F.col("_draw") % _HALF

    def histogram(rows: DataFrame, cell: Column) -> DataFrame:
        return rows.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n"))

    high_cell, before = _locate(histogram(drawn, high), wanted)
    in_cell = drawn.where(high == high_cell)
    low_cell, before_low = _locate(histogram(in_cell, low), wanted - before)
    at = high_cell * _HALF + low_cell
    left = wanted - before - before_low
    last = drawn.where(F.col("_draw") == at).orderBy(key).limit(left).agg(F.max(key).alias("k")).first()["k"]
    return Cutoff(at, last)
