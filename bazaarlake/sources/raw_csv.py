"""Raw zone: CSV with a header, one folder per table, any number of dated runs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from bazaarlake import schemas
from bazaarlake.functions.scalars import run_date_of
from bazaarlake.functions.typing import apply_types
from bazaarlake.session import input_bytes
from bazaarlake.sources.files import exists, hadoop_path, has_file
from bazaarlake.tables import RetailTables

RUN_DATE = "run_date"


class SourceMissing(RuntimeError):
    pass


def run_paths(spark: SparkSession, folder: str, run_date: dt.date) -> list[str]:
    """What holds one run of a table: its ``run_date=`` folder and its dated files or folders, whichever exist."""
    fs, root = hadoop_path(spark, folder)
    found = []
    for pattern in (f"{RUN_DATE}={run_date:%Y-%m-%d}", f"*_{run_date:%Y%m%d}*"):
        matches = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(root, pattern))
        found += [status.getPath().toString() for status in matches or []]
    return sorted(path for path in found if has_file(spark, path))


def require_source(
    spark: SparkSession, root: str | None, tables: list[str] = schemas.TABLES, run_date: dt.date | None = None
) -> None:
    """Fail early on no path, no folder, or a table without a CSV file (of the run, if one is named)."""
    if not root:
        raise SourceMissing("no raw folder given")
    if not exists(spark, root):
        raise SourceMissing(f"raw folder not found: {root}")
    for table in tables:
        folder = f"{root}/{table}"
        if run_date is None and not has_file(spark, folder):
            raise SourceMissing(f"no CSV file for {table} below {root}")
        if run_date is not None and not (exists(spark, folder) and run_paths(spark, folder, run_date)):
            raise SourceMissing(f"no CSV file for {table} of {run_date} below {root}")


# Quotes inside quoted cells are doubled, as CSV writers other than Spark's do by default.
CSV_FORM = {"header": "true", "quote": '"', "escape": '"'}
#: Raw files, as text or compressed: a landed run is.
CSV_FILES = "*.{csv,csv.gz}"
#: Bytes of text in a byte of a compressed raw file, roughly.
GZIP_SHARE = 6


def csv_options() -> dict[str, str]:
    return {
        **CSV_FORM,
        "recursiveFileLookup": "true",
        "pathGlobFilter": CSV_FILES,
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": schemas.CORRUPT_COLUMN,
        # Whether a line counts as malformed must not depend on the columns a query asks for.
        "columnPruning": "false",
    }


def scan_text(spark: SparkSession, folder: str, schema: T.StructType, run_date: dt.date | None = None) -> DataFrame:
    """All runs of one table as text, with the run date of each row's file.

    With ``run_date`` only what holds that run is opened: a dated folder, dated files, or both.
    A run that is not there is an error, not an empty table.
    """
    reader = spark.read.options(**csv_options()).schema(schema)
    if run_date is None:
        found = reader.load(folder, format="csv")
    else:
        paths = run_paths(spark, folder, run_date)
        if not paths:
            raise SourceMissing(f"no run of {run_date} in {folder}")
        found = reader.load(paths, format="csv")
    return found.select("*", run_date_of(F.col("_metadata.file_path")).alias(RUN_DATE))


def text_bytes(df: DataFrame) -> int:
    """Size of the raw text that is read, also where its files are compressed."""
    return input_bytes(df) * (GZIP_SHARE if any(name.endswith(".gz") for name in df.inputFiles()) else 1)


def scan_table(spark: SparkSession, root: str, table: str, run_date: dt.date | None = None) -> DataFrame:
    """One raw table, typed, with run_date and a mark on malformed rows."""
    text = scan_text(spark, f"{root}/{table}", schemas.RAW[table], run_date)
    return apply_types(text, schemas.CLEAN[table], keep=(RUN_DATE,))


def scan_run(spark: SparkSession, root: str, run_date: dt.date | None = None) -> RetailTables:
    require_source(spark, root, run_date=run_date)
    return RetailTables(**{t: scan_table(spark, root, t, run_date) for t in schemas.TABLES})


def inferred_schema(spark: SparkSession, folder: str) -> T.StructType:
    """What schema discovery would say; for a report only, the jobs use the declared one."""
    options = {k: v for k, v in csv_options().items() if k != "columnNameOfCorruptRecord"}
    return spark.read.options(**options, inferSchema="true").csv(folder).schema


def schema_report(spark: SparkSession, found: T.StructType, declared: T.StructType) -> DataFrame:
    """Column, position, found and declared type: one row per column."""
    by_name = {f.name: f.dataType.simpleString() for f in declared.fields}
    rows = [
        (position, f.name, f.dataType.simpleString(), by_name.get(f.name, ""))
        for position, f in enumerate(found.fields)
    ]
    return spark.createDataFrame(rows, "position int, column_name string, found_type string, declared_type string")


