"""Table names over folders, so that the questions can be asked in SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from bazaarlake import fixed_values as fixed
from bazaarlake import schemas
from bazaarlake.sinks import commits
from bazaarlake.sources.files import exists, hadoop_path
from bazaarlake.sources.raw_csv import CSV_FILES, RUN_DATE
from bazaarlake.tables import RetailTables

ALL_RUNS = "_all"
RAW_FILES = "_files"
CURRENT = "bazaarlake.current_run"
#: As `functions.scalars.run_date_of`, of the file that a row is read from.
RUN_DATE_OF_FILE = (
    r"coalesce(try_to_date(nullif(regexp_extract(_metadata.file_path, r'_(\d{8})\.csv', 1), ''), 'yyyyMMdd'), "
    r"try_to_date(regexp_extract(_metadata.file_path, r'run_date=(\d{4}-\d{2}-\d{2})', 1), 'yyyy-MM-dd'))"
)


def _columns(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def clean_name(table: str) -> str:
    return f"{fixed.CLEAN_TABLE_PREFIX}{table}"


def ensure_database(spark: SparkSession, database: str, folder: str | None = None) -> None:
    place = f" LOCATION '{folder}'" if folder else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{place}")


def _sync_partitions(spark: SparkSession, table: str, wanted: dict[dt.date, str]) -> None:
    """Give a table partitioned by run exactly these runs and folders."""
    spec = lambda run: f"({RUN_DATE} = '{run}')"
    there = {dt.date.fromisoformat(row[0].removeprefix(f"{RUN_DATE}=")) for row in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    for run in sorted(there - wanted.keys()):
        spark.sql(f"ALTER TABLE {table} DROP PARTITION {spec(run)}")
    for run in sorted(there & wanted.keys()):
        spark.sql(f"ALTER TABLE {table} PARTITION {spec(run)} SET LOCATION '{wanted[run]}'")
    new = sorted(wanted.keys() - there)
    if new:
        spark.sql(f"ALTER TABLE {table} ADD " + " ".join(f"PARTITION {spec(run)} LOCATION '{wanted[run]}'" for run in new))


def _create_view(spark: SparkSession, database: str, name: str, query: str, properties: dict[str, str] | None = None) -> None:
    """A view in place of whatever was registered under the name before; files are never touched."""
    if spark.catalog.tableExists(f"{database}.{name}") and spark.catalog.getTable(f"{database}.{name}").tableType != "VIEW":
        spark.sql(f"DROP TABLE `{database}`.`{name}`")
    given = ", ".join(f"'{key}' = '{value}'" for key, value in (properties or {}).items())
    spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{name}` {f'TBLPROPERTIES ({given})' if given else ''} AS {query}")


def register_raw(spark: SparkSession, database: str, root: str, tables: list[str] = schemas.TABLES) -> None:
    """Raw tables by declared text schema, one per folder, with the run date of each row's file.

    `<table>_files` is the folder as it is; `<table>` adds `run_date`, which is a function of the file's path alone, so a
    filter on it opens the files of that run only, whether a run is a dated folder, a dated file or both.  What is
    not dated has a null run date.  Call again after a landing.
    """
    ensure_database(spark, database)
    for table in tables:
        text_columns = T.StructType([f for f in schemas.RAW[table].fields if f.name != schemas.CORRUPT_COLUMN])
        files = f"{table}{RAW_FILES}"
        spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{files}`")
        spark.sql(
            f"CREATE TABLE `{database}`.`{files}` ({_columns(text_columns)}) USING csv "
            f"OPTIONS (header 'true', escape '\"', recursiveFileLookup 'true', pathGlobFilter '{CSV_FILES}') "
            f"LOCATION '{root}/{table}'"
        )
        spark.catalog.refreshTable(f"{database}.{files}")
        names = ", ".join(f"`{name}`" for name in text_columns.names)
        _create_view(spark, database, table, f"SELECT {names}, {RUN_DATE_OF_FILE} AS {RUN_DATE} FROM `{database}`.`{files}`")


def published_runs(spark: SparkSession, root: str) -> commits.Snapshot:
    """The commits' state; for a folder without commits, its dated folders, the newest as the current run."""
    state = commits.snapshot(spark, root)
    if not state.runs:
        for table in schemas.TABLES:
            if exists(spark, f"{root}/{clean_name(table)}"):
                for run in dated_folders(spark, f"{root}/{clean_name(table)}"):
                    state.runs.setdefault(run, {})[clean_name(table)] = f"{clean_name(table)}/{RUN_DATE}={run}"
        state.current = max(state.runs, default=None)
    return state


def dated_folders(spark: SparkSession, folder: str) -> list[dt.date]:
    """The runs of a table that was published as dated folders."""
    fs, path = hadoop_path(spark, folder)
    names = [status.getPath().getName() for status in fs.listStatus(path)]
    return [dt.date.fromisoformat(name.removeprefix(f"{RUN_DATE}=")) for name in names if name.startswith(f"{RUN_DATE}=")]


def register_clean(spark: SparkSession, database: str, root: str) -> None:
    """Clean tables by name: `processed_<table>` is the current run, `processed_<table>_all` holds every published run.

    Called after each publish or change of the current run: partitions follow the commits, so the catalog never lags
    behind them.
    """
    ensure_database(spark, database)
    state = published_runs(spark, root)
    for table in schemas.TABLES:
        name = clean_name(table)
        history = f"`{database}`.`{name}{ALL_RUNS}`"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {history} ({_columns(schemas.CLEAN[table])}, {RUN_DATE} date) "
            f"USING parquet PARTITIONED BY ({RUN_DATE}) LOCATION '{root}/{name}'"
        )
        _sync_partitions(spark, history, {run: f"{root}/{folders[name]}" for run, folders in state.runs.items() if name in folders})
        spark.catalog.refreshTable(f"{database}.{name}{ALL_RUNS}")
        current = f"DATE '{state.current}'" if state.current else "NULL"
        _create_view(spark, database, name, f"SELECT * FROM {history} WHERE {RUN_DATE} = {current}", {CURRENT: str(state.current or "")})


def clean_tables(spark: SparkSession, database: str) -> RetailTables:
    """The clean tables of every published run; questions are asked of the current one unless the caller scopes them."""
    first = f"`{database}`.`{clean_name(schemas.TABLES[0])}`"
    current = spark.sql(f"SHOW TBLPROPERTIES {first} ('{CURRENT}')").first()["value"]
    return RetailTables(
        **{t: spark.table(f"{database}.{clean_name(t)}{ALL_RUNS}") for t in schemas.TABLES},
        published=dt.date.fromisoformat(current) if current else None)


def as_views(tables: RetailTables) -> None:
    """The five clean tables as temporary views, for ``spark.sql``."""
    for table, df in tables.asked().items():
        df.createOrReplaceTempView(clean_name(table))


