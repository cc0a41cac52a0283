"""Batch increments by a ledger of files: every file's rows arrive once, whatever their dates.

Beside the target a ledger keeps, for each raw file that was loaded, its path, size, time of change, number of rows and
the first and last `created_at`.  A load lists the raw folder, takes the files that the ledger does not know, writes
their rows and their ledger entries, and publishes both by one commit file.  A file that was replaced or removed is
retracted: its rows are those whose file is no longer live.  So rows that arrive late, with a `created_at` below the
mark, are found, a run landed anew is there once, and mark and ledger survive a restart; a load that fails leaves
nothing behind, and of two loads at the same time one fails.

Only files not loaded before are opened.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from bazaarlake import schemas
from bazaarlake.functions.scalars import run_date_of
from bazaarlake.functions.typing import apply_types
from bazaarlake.sinks import commits
from bazaarlake.sinks.files import drop_stage
from bazaarlake.sources.files import exists
from bazaarlake.sources.raw_csv import CSV_FILES, RUN_DATE, csv_options

FILE, LOADED_BY = "source_file", "loaded_by"
#: Files of one commit; a load goes on until every file present is loaded.
FILES_PER_COMMIT = 10_000

_ENTRY = f"{FILE} string, size long, modified timestamp, {LOADED_BY} int, live boolean, rows long, first_created timestamp_ntz, last_created timestamp_ntz"


def _plain(path: Column) -> Column:
    """One spelling of a path: `file:/x` and `file:///x` are the same file."""
    return F.regexp_replace(path, r"^(\w+):/+(?=/)", "$1:")


def _file_of_row() -> Column:
    """The path of a row's file as a listing spells it: Spark hands it to rows as a URI."""
    uri = F.col("_metadata.file_path")
    return _plain(F.coalesce(F.try_url_decode(F.replace(uri, F.lit("+"), F.lit("%2B"))), uri))


class FileLedger:
    """The increments of one raw table in one target folder."""

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType, target: str, stamp: str = "created_at"):
        self.spark, self.folder, self.schema, self.target, self.stamp = spark, folder, schema, target, stamp

    def _folders(self, part: str) -> list[str]:
        loads = commits.snapshot(self.spark, self.target).loads
        return [f"{self.target}/{folders[part]}" for folders in loads.values()]

    def entries(self) -> DataFrame:
        """Every ledger entry of every load."""
        folders = self._folders("files")
        read = self.spark.read.schema(_ENTRY)
        return read.parquet(*folders) if folders else self.spark.createDataFrame([], _ENTRY)

    def live(self) -> DataFrame:
        """The files whose rows count: the last entry of each path, unless it says that the file is gone."""
        newest = Window.partitionBy(FILE).orderBy(F.desc(LOADED_BY))
        return self.entries().withColumn("_n", F.row_number().over(newest)).where("_n = 1 AND live").drop("_n")

    def mark(self):
        """The newest `created_at` that was loaded; None before the first load."""
        return self.live().agg(F.max("last_created")).first()[0]

    def rows(self) -> DataFrame:
        """The loaded rows: typed columns, the mark on malformed ones, run date, file, and the number of the load."""
        folders = self._folders("rows")
        if not folders:
            raise KeyError(f"nothing is loaded into {self.target}")
        return self.spark.read.parquet(*folders).join(self.live().select(FILE, LOADED_BY), [FILE, LOADED_BY], "left_semi")

    def _listing(self) -> DataFrame:
        """The files that are there; only the listing is read."""
        files = self.spark.read.format("binaryFile").option("pathGlobFilter", CSV_FILES).option("recursiveFileLookup", "true").load(self.folder)
        return files.select(_plain(F.col("path")).alias(FILE), F.col("length").alias("size"), F.col("modificationTime").alias("modified"))

    def load(self) -> list[dict]:
        """Load what is new and retract what is gone; a report for each commit: load, files, rows, late_rows, mark."""
        reports = []
        while report := self._load_some():
            reports.append(report)
        return reports

    def _load_some(self) -> dict | None:
        state = commits.snapshot(self.spark, self.target)
        number = len(state.loads) + 1
        listing, live = self._listing(), self.live()
        known = ["size", "modified"]
        new = listing.join(live.select(FILE, *known), [FILE, *known], "left_anti").orderBy("modified", FILE).limit(FILES_PER_COMMIT)
        paths = [row[FILE] for row in new.collect()]  # at most FILES_PER_COMMIT
        gone = live.join(listing, FILE, "left_anti").select(
            FILE, "size", "modified", F.lit(number).alias(LOADED_BY), F.lit(False).alias("live"), F.lit(0).cast("long").alias("rows"),
            F.lit(None).cast("timestamp_ntz").alias("first_created"), F.lit(None).cast("timestamp_ntz").alias("last_created"))
        lost = gone.count()
        if not paths and not lost:
            return None
        before = self.mark()
        version = f"{commits.VERSIONS}/{uuid.uuid4().hex}"
        stage, committed = f"{self.target}/{version}", False
        try:
            self._read(paths, number).write.parquet(f"{stage}/rows")
            written = self.spark.read.parquet(f"{stage}/rows")
            late = F.count_if(F.col(self.stamp) < F.lit(before).cast("timestamp_ntz")) if before else F.lit(0).cast("long")
            of_file = written.groupBy(FILE).agg(
                F.count(F.lit(1)).alias("rows"), F.min(self.stamp).alias("first_created"), F.max(self.stamp).alias("last_created"))
            listed = self.spark.createDataFrame([(p,) for p in paths], f"{FILE} string").join(listing, FILE)
            entries = listed.join(of_file, FILE, "left").select(
                FILE, "size", "modified", F.lit(number).alias(LOADED_BY), F.lit(True).alias("live"),
                F.coalesce("rows", F.lit(0).cast("long")).alias("rows"), "first_created", "last_created")
            entries.unionByName(gone).coalesce(1).write.parquet(f"{stage}/files")
            counted = written.agg(F.count(F.lit(1)).alias("rows"), late.alias("late")).first()
            commits.commit(self.spark, self.target, commits.LOAD, str(number), {"rows": f"{version}/rows", "files": f"{version}/files"}, state.number)
            committed = True
        finally:
            if not committed and exists(self.spark, stage):
                drop_stage(self.spark, stage)
        return {"load": number, "files": len(paths), "retracted": lost, "rows": counted["rows"], "late_rows": counted["late"], "mark": self.mark()}

    def _read(self, paths: list[str], number: int) -> DataFrame:
        options = {k: v for k, v in csv_options().items() if k != "recursiveFileLookup"}
        reader = self.spark.read.options(**options).schema(schemas.all_text(self.schema))
        text = reader.load(paths, format="csv") if paths else self.spark.createDataFrame([], schemas.all_text(self.schema)).withColumn(
            "_metadata", F.named_struct(F.lit("file_path"), F.lit("")))
        dated = text.select(
            *schemas.all_text(self.schema).names, run_date_of(F.col("_metadata.file_path")).alias(RUN_DATE),
            _file_of_row().alias(FILE), F.lit(number).alias(LOADED_BY))
        return apply_types(dated, self.schema, keep=(RUN_DATE, FILE, LOADED_BY))


def ledger_of(spark: SparkSession, raw_root: str, table: str, target_root: str) -> FileLedger:
    """The ledger of one of the tables that grow from run to run."""
    if table not in schemas.WATERMARKED:
        raise ValueError(f"{table} has no created_at and is replaced as a whole")
    return FileLedger(spark, f"{raw_root}/{table}", schemas.CLEAN[table], f"{target_root}/{table}")
