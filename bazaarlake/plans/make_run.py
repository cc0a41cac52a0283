"""Make one run of raw tables and land it."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from bazaarlake import schemas
from bazaarlake.operators.quality import check_report, require_checks
from bazaarlake.plans.clean_zone import run_folder_name
from bazaarlake.session import prepare, size_shuffles
from bazaarlake.sinks.files import drop_stage, land_csv, publish
from bazaarlake.sources.raw_csv import scan_run
from bazaarlake.synth.generate import Maker
from bazaarlake.tables import RetailTables

# A made item in a shuffle, roughly.
ITEM_BYTES = 128


def row_counts(tables: RetailTables, names: list[str] = schemas.TABLES) -> DataFrame:
    """table_name, row_count: one row per table."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items() if name in names
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def make_run(spark: SparkSession, maker: Maker, raw_root: str, run_date: dt.date) -> dict[str, int]:
    """Write the five tables to a stage, check what was written, publish; returns row counts."""
    prepare(spark)
    size_shuffles(spark, maker.sizes.target_items * ITEM_BYTES)
    stage = f"{raw_root}/_stage/{uuid.uuid4().hex}"
    try:
        for name, df in maker.tables().items():
            land_csv(df, stage, name, run_date)
        staged = scan_run(spark, stage, run_date)
        require_checks(check_report(staged))
        counts = {row["table_name"]: row["row_count"] for row in row_counts(staged).collect()}
        run = run_folder_name(run_date)
        for name in schemas.TABLES:
            publish(spark, f"{stage}/{name}/{run}", f"{raw_root}/{name}/{run}")
    finally:
        drop_stage(spark, stage)
    return counts
