"""What several operators share: reading tables, free column names, written intermediates, folds."""

from __future__ import annotations

import math
import os

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bazaarlake.session import input_bytes, run_folder


ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def importable(spark: SparkSession) -> None:
    """Python workers of this machine find this package where the driver found it, as if it were installed."""
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if ROOT not in paths.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, paths) if x)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that the frame does not have yet (Spark compares names without case)."""
    taken = {c.lower() for c in df.columns}
    name = wanted
    while name.lower() in taken:
        name += "_"
    return name


#: Arrow batches between the JVM and Python: what Spark has by itself, and what a session gets that still has it.
BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "1000"),
    "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "4194304b"),
}


def small_batches(spark: SparkSession) -> None:
    """Batches of whole texts take a few MB: 10,000 texts are tens of MB in the JVM, beside its heap, and again in Python."""
    for key, (untouched, small) in BATCHES.items():
        if spark.conf.get(key) == untouched:
            spark.conf.set(key, small)


#: A small table is written in at most a file for so many bytes that its plan reads, or so many files a core.
BYTES_PER_FILE, FILES_PER_CORE = 2 << 20, 4


def in_few_files(df: DataFrame) -> DataFrame:
    """The frame in fewer partitions, if its plan reads less than 2 MB for each partition of a shuffle.

    Hadoop starts processes for each file that it makes in a folder of the file system (chmod), and each of them holds, for a
    moment, the memory of the executor.  Partitions that are merged are computed one after the other, as before.
    """
    spark = df.sparkSession
    most = max(FILES_PER_CORE * spark.sparkContext.defaultParallelism, math.ceil(input_bytes(df) / BYTES_PER_FILE))
    return df.coalesce(most) if most < parts(spark) else df


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The frame as Parquet in the shared folder, so that what built it is not run again."""
    spark = df.sparkSession
    folder = run_folder(spark, purpose)
    in_few_files(df).write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo folds; null where the id is null."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % F.lit(folds)


def smallest_hashes(df: DataFrame, id_col: str, wanted: int, group_col: str, sizes: dict) -> DataFrame:
    """Of each group the `wanted` rows of the smallest hashes of their id; sizes: rows of each group.

    Rows beyond twice the share that is wanted are left out before the window, so that one task never gets much more
    than 2 * wanted rows of a group, however many tasks and rows there are.
    """
    space = 1 << 40
    hashed = F.pmod(F.xxhash64(id_col), F.lit(space))
    limit = F.lit(0)
    for value, size in sizes.items():
        limit = F.when(F.col(group_col) == F.lit(value), F.lit(min(space, 2 * wanted * space // max(size, 1)))).otherwise(limit)
    name, place = free_name(df, "__hash"), free_name(df, "__place")
    order = Window.partitionBy(group_col).orderBy(name, id_col)
    return (df.withColumn(name, hashed).where(F.col(name) < limit).withColumn(place, F.row_number().over(order))
            .where(F.col(place) <= wanted).drop(name, place))


#: Bits of a filter: its table has at most BITS / 64 rows of two numbers, 2 MB, whatever it is made from.
FILTER_BITS = 1 << 23


def bit_filter(hashes: DataFrame, hash_col: str) -> DataFrame:
    """A bit for each hash that occurs, modulo FILTER_BITS: columns word, bits."""
    place = F.pmod(F.col(hash_col), F.lit(FILTER_BITS))
    return hashes.select(F.shiftright(place, 6).alias("word"), (place % 64).cast("int").alias("bit")).groupBy("word").agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))).alias("bits"))


def maybe_in(df: DataFrame, hash_col: str, bits: DataFrame) -> DataFrame:
    """The rows whose hash may be among those of the filter; none that is is lost.  An exact join should follow.

    The filter is sent to all tasks: its size has a bound.
    """
    place = F.pmod(F.col(hash_col), F.lit(FILTER_BITS))
    named = bits.select(F.col("word").alias("__word"), F.col("bits").alias("__bits"))
    there = F.call_function("shiftrightunsigned", F.col("__bits"), (place % 64).cast("int")).bitwiseAND(F.lit(1)) == 1
    return df.join(F.broadcast(named), (F.shiftright(place, 6) == F.col("__word")) & there, "left_semi")


def groups_for(rows: int, rows_per_group: int) -> int:
    return max(1, math.ceil(rows / rows_per_group))
