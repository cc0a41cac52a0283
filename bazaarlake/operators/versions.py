"""Several runs in one folder: scope, latest version, increments."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window, functions as F


def one_run(df: DataFrame, run_date: dt.date, column: str = "run_date") -> DataFrame:
    """Rows of one run; a partition filter, so other runs are not read."""
    return df.where(F.col(column) == F.lit(run_date).cast("date"))


def latest_run(df: DataFrame, column: str = "run_date") -> DataFrame:
    """Rows of the newest run.  The inner maximum reads partition values or one column."""
    newest = df.agg(F.max(column).alias("d")).first()["d"]
    return df.where(F.col(column) == F.lit(newest))


def latest_per_key(df: DataFrame, key: str | list[str], newest_first: list[str]) -> DataFrame:
    """One row per key, the newest.

    ``row_number() = 1`` lets Spark keep one row per key in every map task before the
    shuffle, so a key with very many versions does not gather in one task.
    """
    keys = [key] if isinstance(key, str) else key
    order = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in newest_first])
    return df.withColumn("_version", F.row_number().over(order)).where("_version = 1").drop("_version")


def newer_than(df: DataFrame, loaded: DataFrame, key: str, stamp: str = "created_at") -> DataFrame:
    """Rows created after the newest loaded one, and those of the same instant not loaded yet."""
    mark = loaded.agg(F.max(stamp).alias("m")).first()["m"]
    if mark is None:
        return df
    at_mark = F.lit(mark).cast(df.schema[stamp].dataType)
    later = df.where(F.col(stamp) > at_mark)
    same_instant = df.where(F.col(stamp) == at_mark)
    done = loaded.where(F.col(stamp) == at_mark).select(key)
    return later.unionByName(same_instant.join(done, key, "left_anti").select(*df.columns))
