"""Contiguous shards of nearly equal bytes, from prefix sums over partition totals.

Rows are dealt into ranges of the id; each range reports its bytes and rows; the running sum of
those totals gives every range its global start; a running sum inside the range gives every row
its own.  The axis of all bytes is cut at equal targets, and a row belongs to the shard in which
its middle byte lies.  So shards are contiguous in id order, and no shard's size is further from
the target than the largest row.

Defined cases: a null text has no bytes (size is the overhead alone, crc 0); null ids come first;
rows with equal ids, and rows repeated whole, follow each other in scan order and each gets its own
slot; an empty table gives no rows; a very long text is one row, which makes its shard longer than the
others by less than its size.  Columns besides id and text are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaarlake.session import checkpointed

OVERHEAD_BYTES = 8


def shard_contiguous(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text",
                     overhead: int = OVERHEAD_BYTES) -> DataFrame:
    """Columns id_col, size, text_crc32, shard (0 to shards-1), slot (gapless from 0 in each shard)."""
    body = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    sized = docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(body) + F.lit(overhead)).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.monotonically_increasing_id().alias("scanned"),  # equal ids must not fill one range
    )
    # Ranges come from a sample; they are written once so that every later reader sees the same ones.
    ranged = checkpointed(sized.repartitionByRange("id", "scanned").withColumn("part", F.spark_partition_id()))

    # One row per range: as many as there are partitions, whatever the number of documents.
    totals = ranged.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        "part",
        F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(Window.partitionBy()).alias("all_bytes"),
    )
    inside = Window.partitionBy("part").orderBy("id", "scanned")
    placed = (
        ranged.withColumn("bytes_in_part", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("rows_in_part", F.row_number().over(inside))
        .join(F.broadcast(starts), "part")
        .withColumn("end_byte", F.col("bytes_before") + F.col("bytes_in_part"))
        .withColumn("row", F.col("rows_before") + F.col("rows_in_part") - 1)
        .withColumn("shard", F.least(
            F.lit(shards - 1), F.expr(f"((2 * end_byte - size) * {shards}) div (2 * all_bytes)")).cast("int"))
    )
    firsts = placed.groupBy("shard").agg(F.min("row").alias("first_row"))  # one row per shard
    return placed.join(F.broadcast(firsts), "shard").select(
        F.col("id").alias(id_col), "size", "text_crc32", "shard", (F.col("row") - F.col("first_row")).alias("slot"))
