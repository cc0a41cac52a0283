"""Writing: CSV runs, Parquet runs, result files, and publishing a staged run."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from bazaarlake import schemas
from bazaarlake.functions.scalars import stamp_text
from bazaarlake.sources.files import hadoop_path
from bazaarlake.sources.raw_csv import CSV_FORM, RUN_DATE
from bazaarlake.tables import RetailTables


def _as_csv_text(df: DataFrame) -> DataFrame:
    """Timestamps in the raw zone's text form."""
    return df.select(*[
        stamp_text(F.col(f.name)).alias(f.name)
        if isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType)) else F.col(f.name)
        for f in df.schema.fields
    ])


def write_dated_csv(df: DataFrame, root: str, table: str, run_date: dt.date) -> str:
    """``<root>/<table>/<table>_YYYYMMDD.csv``: a folder of part files, replaced as a whole."""
    path = f"{root}/{table}/{table}_{run_date:%Y%m%d}.csv"
    _as_csv_text(df).write.mode("overwrite").options(**CSV_FORM).csv(path)
    return path


#: Text that is written once and read once or twice: the fastest level takes most of its size away.  A compressed file is
#: read by one task, so its lines have a bound (about 16 MB): the tasks of a cleaning are many and alike, however few wrote it.
PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": "500000"}


def land_csv(df: DataFrame, root: str, table: str, run_date: dt.date) -> str:
    """One run into ``<root>/<table>/run_date=…``, compressed: a rerun replaces it, other runs stay."""
    path = f"{root}/{table}"
    (
        _as_csv_text(df).withColumn(RUN_DATE, F.lit(run_date).cast("date"))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .options(**CSV_FORM, **PACKED).partitionBy(RUN_DATE).csv(path)
    )
    return path


def write_parquet(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").parquet(path)
    return path


def write_result(df: DataFrame, path: str) -> str:
    """A query result as CSV; part files are in the order of the result."""
    df.write.mode("overwrite").options(**CSV_FORM).csv(path)
    return path


#: Independent writes that run at the same time: a few, so that small jobs do not wait for one another.
WRITERS = 4


def side_by_side(*writes: Callable[[], object]) -> list:
    """Run independent jobs at the same time; the results in order.  The first failure is raised after all have ended."""
    with ThreadPoolExecutor(WRITERS) as pool:
        return [job.result() for job in [pool.submit(write) for write in writes]]


def land_all(root: str, *runs: tuple[dt.date, RetailTables]) -> None:
    """Land all tables of one run or several: tables side by side, the runs of one table one after the other.

    The largest table comes first, so that the others fill the cores that its last tasks leave.
    """
    def land(name: str) -> None:
        for day, tables in runs:
            land_csv(getattr(tables, name), root, name, day)

    side_by_side(*[partial(land, name) for name in reversed(schemas.TABLES)])


def publish_all(spark: SparkSession, moves: list[tuple[str, str]]) -> None:
    """Move finished stage folders to their places, all or none.

    Each old folder is set aside next to its place, under a name that readers skip.  If any step
    fails, whether it raises or says no, what was moved goes back and every old folder returns.
    """
    fs = hadoop_path(spark, moves[0][1])[0]
    mark, undo = uuid.uuid4().hex, []

    def move(source, target) -> None:
        if not fs.rename(source, target):
            raise OSError(f"cannot move {source} to {target}")

    try:
        for stage, target in moves:
            stage_path, target_path = hadoop_path(spark, stage)[1], hadoop_path(spark, target)[1]
            parent = target_path.getParent()
            fs.mkdirs(parent)
            aside = hadoop_path(spark, f"{parent}/.{target_path.getName()}.{mark}")[1]
            if fs.exists(target_path):
                move(target_path, aside)
                undo.append((aside, target_path))
            move(stage_path, target_path)
            undo.append((target_path, stage_path))
    except BaseException:
        lost = []
        for source, target in reversed(undo):
            try:
                move(source, target)
            except Exception as error:  # go on: the other folders can still return
                lost.append(f"{source} is not back at {target}: {error}")
        if lost:
            raise OSError("; ".join(lost))
        raise
    for source, target in undo:
        if source.getName().startswith("."):
            fs.delete(source, True)


def publish(spark: SparkSession, stage: str, target: str) -> None:
    """Move one finished stage folder to its place, replacing what is there."""
    publish_all(spark, [(stage, target)])


def drop_stage(spark: SparkSession, stage: str) -> None:
    """Remove one run's stage folder, and nothing else."""
    fs, path = hadoop_path(spark, stage)
    fs.delete(path, True)
