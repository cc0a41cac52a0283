"""Raw run -> judged once -> clean tables and quarantine, published together.

Two ways to publish: by renames into the folders `processed_<table>/run_date=...`, or (`by_commit`) by a
commit file alone, the data staying where they were written, for stores on which a rename is a copy.  Either
way a commit file says which run is the current one.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from bazaarlake import schemas
from bazaarlake.functions.typing import MALFORMED
from bazaarlake.operators import pruning, quality
from bazaarlake.session import prepare, size_shuffles
from bazaarlake.sinks import commits
from bazaarlake.sinks.files import drop_stage, publish_all, side_by_side
from bazaarlake.sources.catalog import clean_name
from bazaarlake.sources.files import exists
from bazaarlake.sources.raw_csv import RUN_DATE, scan_run, text_bytes
from bazaarlake.tables import RetailTables

QUARANTINE = "quarantine"
VERDICTS = ["true", "false"]
#: Row groups are what a scan can be split at: small ones keep the rows of a task few, however large the files are.
CLEAN_FORM = {"compression": "zstd", "parquet.block.size": str(16 * 1024 * 1024)}
_DIMENSIONS = ["categories", "products", "customers"]
_ORDER_REASONS = [MALFORMED, quality.FUTURE_DATE]


@dataclass(frozen=True)
class CleanJob:
    """Parameters of one cleaning run."""

    raw_root: str
    clean_root: str
    run_date: dt.date
    as_of: dt.date
    #: Publish by a commit file alone, without renames.
    by_commit: bool = False
    #: Numbers of categories and products: all checks must pass on the clean tables before they are published.
    expected: tuple[int, int] | None = None


class RunRefused(ValueError):
    """A run that must not replace what is published."""


def run_folder_name(run_date: dt.date) -> str:
    return f"{RUN_DATE}={run_date:%Y-%m-%d}"


def _write_judged(judged: DataFrame, path: str, reasons: list[str]) -> dict[str, int]:
    """Write clean and bad rows in one pass, split by folder, counting on the way."""
    seen, spark = Observation(), judged.sparkSession
    counts = [F.count(F.lit(1)).alias("rows"), F.count_if(quality.IS_CLEAN).alias("clean_rows")] + [
        F.count_if(F.array_contains(quality.REASONS, reason)).alias(reason) for reason in reasons
    ]
    judged.observe(seen, *counts).write.mode("overwrite").options(**CLEAN_FORM).partitionBy(quality.IS_CLEAN).parquet(path)
    for verdict in VERDICTS:
        folder = f"{path}/{quality.IS_CLEAN}={verdict}"
        if not exists(spark, folder):  # no such rows: an earlier result must not stay
            spark.createDataFrame([], judged.drop(quality.IS_CLEAN).schema).write.parquet(folder)
    return {name: int(value) for name, value in seen.get.items()}


def _read_judged(spark: SparkSession, path: str) -> DataFrame:
    """The verdict comes back from the folder name as text."""
    return spark.read.parquet(path).withColumn(quality.IS_CLEAN, F.col(quality.IS_CLEAN).cast("boolean"))


def _judge_dimension(table: DataFrame) -> DataFrame:
    return table.withColumns({
        quality.REASONS: quality.reasons_of((MALFORMED, F.col(MALFORMED))),
        quality.IS_CLEAN: ~F.col(MALFORMED),
    }).drop(MALFORMED)


def clean_run(spark: SparkSession, job: CleanJob) -> dict[str, dict[str, int]]:
    """Clean one run; returns row counts and counts per reason for each table.

    Everything is staged first.  A failure drops this run's stage only; a published run
    is replaced at the end, all tables or none.  A run of which a table keeps no row is refused.
    """
    prepare(spark)
    raw = scan_run(spark, job.raw_root, job.run_date)
    size_shuffles(spark, max(text_bytes(df) for _, df in raw.items()))
    seen = commits.snapshot(spark, job.clean_root).number
    version = f"{commits.VERSIONS if job.by_commit else '_stage'}/{uuid.uuid4().hex}"
    stage = f"{job.clean_root}/{version}"
    report: dict[str, dict[str, int]] = {}
    published = False
    try:
        judged = {name: (_judge_dimension(getattr(raw, name).drop(RUN_DATE)), [MALFORMED]) for name in _DIMENSIONS}
        judged["orders"] = quality.judge_orders(raw.orders.drop(RUN_DATE), job.as_of), _ORDER_REASONS
        counts = side_by_side(*[partial(_write_judged, df, f"{stage}/{name}", reasons) for name, (df, reasons) in judged.items()])
        report |= dict(zip(judged, counts))
        # Items are judged against the written verdicts, so a lost executor does not
        # send them back to the raw text.
        verdicts = _read_judged(spark, f"{stage}/orders").select("order_id", quality.IS_CLEAN)
        products = quality.kept(_read_judged(spark, f"{stage}/products"))
        judged_items = quality.judge_items(
            raw.order_items.drop(RUN_DATE), products, verdicts,
            pruning.key_words(products, "product_id"), pruning.key_words(verdicts.where(quality.IS_CLEAN), "order_id"))
        report["order_items"] = _write_judged(judged_items, f"{stage}/order_items", quality.ITEM_REASONS)
        _require_sound(spark, job, stage, report)
        if job.by_commit:
            folders = {place: f"{version}/{name}/{quality.IS_CLEAN}={verdict}" for place, name, verdict in _parts()}
            commits.commit(spark, job.clean_root, commits.RUN, job.run_date.isoformat(), folders, seen)
        else:
            run = run_folder_name(job.run_date)
            folders = {place: f"{place}/{run}" for place, _, _ in _parts()}
            publish_all(spark, [(f"{stage}/{name}/{quality.IS_CLEAN}={verdict}", f"{job.clean_root}/{folders[place]}") for place, name, verdict in _parts()])
            commits.commit(spark, job.clean_root, commits.RUN, job.run_date.isoformat(), folders, seen, alone=False)
        published = True
    finally:
        if not (published and job.by_commit):
            drop_stage(spark, stage)
    return report


def _require_sound(spark: SparkSession, job: CleanJob, stage: str, report: dict[str, dict[str, int]]) -> None:
    """Refuse a staged run with an empty clean table, or, where numbers are expected, with a failed check."""
    empty = [name for name, counts in report.items() if not counts["clean_rows"]]
    if empty:
        raise RunRefused(f"run {job.run_date} keeps no row of {', '.join(empty)}")
    if job.expected is not None:
        staged = RetailTables(**{name: spark.read.parquet(f"{stage}/{name}/{quality.IS_CLEAN}=true") for name in schemas.TABLES})
        quality.require_checks(quality.check_report(staged, *job.expected))


def _parts() -> list[tuple[str, str, str]]:
    """Place, table and verdict of each published part."""
    return [part for name in schemas.TABLES for part in (
        (clean_name(name), name, "true"), (f"{QUARANTINE}/{name}", name, "false"))]


def read_published(spark: SparkSession, clean_root: str, place: str, run_date: dt.date | None = None) -> DataFrame:
    """One part (`processed_<table>` or `quarantine/<table>`) of a run as the commits name it; by default of the current run."""
    state = commits.snapshot(spark, clean_root)
    run = run_date or state.current
    if run not in state.runs:
        raise KeyError(f"run {run} is not published below {clean_root}")
    return spark.read.parquet(f"{clean_root}/{state.runs[run][place]}")
