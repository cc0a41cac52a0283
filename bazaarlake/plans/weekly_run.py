"""The whole chain: make, land, register, clean, register, ask.

    spark-submit bazaarlake/plans/weekly_run.py --root <folder> --target-items 100000 --as-of 2025-04-15
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession, functions as F

from bazaarlake import fixed_values as fixed
from bazaarlake.plans.analytics import QUESTIONS
from bazaarlake.plans.clean_zone import CleanJob, clean_run
from bazaarlake.plans.make_run import make_run
from bazaarlake.session import prepare
from bazaarlake.sinks.files import write_result
from bazaarlake.sources.catalog import clean_tables, register_clean, register_raw
from bazaarlake.synth.generate import maker
from bazaarlake.tables import RetailTables


def run_scope(tables: RetailTables, run_date: dt.date) -> RetailTables:
    """All five tables limited to one run, before any join can multiply rows."""
    return tables.of_run(run_date)


def ask(spark: SparkSession, database: str, run_date: dt.date, results_root: str) -> list[str]:
    """Answer every question on one run of the clean tables; returns the result folders."""
    tables = run_scope(clean_tables(spark, database), run_date)
    return [
        write_result(question(tables), f"{results_root}/{run_date:%Y-%m-%d}/{name}")
        for name, question in QUESTIONS.items()
    ]


def weekly_run(
    spark: SparkSession,
    root: str,
    run_date: dt.date,
    as_of: dt.date | None = None,
    target_items: int = fixed.DEFAULT_TARGET_ITEMS,
    seed: int = 1,
    raw_database: str = "retail_raw",
    clean_database: str = "retail_clean",
) -> dict:
    prepare(spark)
    as_of = as_of or run_date
    raw_root, clean_root = f"{root}/raw", f"{root}/clean"
    made = make_run(spark, maker(spark, target_items, as_of, seed), raw_root, run_date)
    register_raw(spark, raw_database, raw_root)
    report = clean_run(spark, CleanJob(raw_root, clean_root, run_date, as_of))
    register_clean(spark, clean_database, clean_root)
    answers = ask(spark, clean_database, run_date, f"{root}/results")
    return {"made": made, "cleaned": report, "answers": answers}


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--root", required=True)
    parser.add_argument("--as-of", type=dt.date.fromisoformat)
    parser.add_argument("--target-items", type=int, default=fixed.DEFAULT_TARGET_ITEMS)
    parser.add_argument("--seed", type=int, default=1)
    options = parser.parse_args()
    spark = SparkSession.builder.appName("retail weekly run").getOrCreate()
    today = options.as_of or spark.range(1).select(F.current_date()).first()[0]
    outcome = weekly_run(spark, options.root, today, today, options.target_items, options.seed)
    for part, value in outcome.items():
        print(part, value)


if __name__ == "__main__":
    main()
