"""How the columns of a raw table change from run to run, found in one pass over all files.

For each file and column the scan counts the cells that are there and those that read as each type.  A type fits if it
reads every cell, so the counts of several files, or of all runs so far, add up to the type that fits them all:
whole numbers with fractions make a double, dates with timestamps a timestamp, anything else text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from bazaarlake.functions.scalars import run_date_of
from bazaarlake.sources.raw_csv import CSV_FILES, CSV_FORM, RUN_DATE

#: Types from narrow to wide; a column gets the first that reads all its cells.
TYPES = ["boolean", "int", "bigint", "double", "date", "timestamp", "string"]
#: Types that read everything the key reads.
WIDER = {"void": TYPES, "boolean": ["string"], "int": ["bigint", "double", "string"], "bigint": ["double", "string"],
         "double": ["string"], "date": ["timestamp", "string"], "timestamp": ["string"], "string": []}


def _reads(cell: Column, kind: str) -> Column:
    if kind == "string":
        return cell.isNotNull()
    if kind == "boolean":
        return F.lower(cell).isin("true", "false")
    form = {"int": r"^[+-]?\d+$", "bigint": r"^[+-]?\d+$", "double": r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$",
            "date": r"^\d{4}-\d{2}-\d{2}$", "timestamp": r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d+)?)?.*)?$"}[kind]
    return cell.rlike(form) & cell.try_cast(kind).isNotNull()


def _files(spark: SparkSession):
    return spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", CSV_FILES)


def _headers(spark: SparkSession, folder: str) -> DataFrame:
    """The first line of each file: only first blocks are looked at."""
    lines = _files(spark).text(folder).select(
        F.col("_metadata.file_path").alias("file"), "value", F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"))
    return lines.where("block = 0").groupBy("file").agg(F.min_by("value", "place").alias("header"))


def column_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Columns file, run_date, position, column_name, cells and a count for each of TYPES: a row per file and column."""
    headers = _headers(spark, folder)
    widest = headers.agg(F.max(F.size(F.split("header", ",")))).first()[0] or 1
    names = [f"c{i}" for i in range(widest)]
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    cells = _files(spark).options(**CSV_FORM).schema(schema).csv(folder).select("*", F.col("_metadata.file_path").alias("file"))
    counts = cells.groupBy("file").agg(*[
        F.struct(F.count(name).alias("cells"), *[F.count_if(_reads(F.col(name), kind)).alias(kind) for kind in TYPES]).alias(name)
        for name in names])
    titled = headers.select("file", F.from_csv("header", F.lit(schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "))).alias("h"))
    titles = titled.select("file", F.posexplode(F.array(*[F.col(f"h.{name}") for name in names])).alias("position", "column_name")).where("column_name IS NOT NULL")
    # A file without rows has columns, but no counts.
    found = counts.select("file", F.posexplode(F.array(*names)).alias("position", "n"))
    joined = titles.join(found, ["file", "position"], "left")
    return joined.select("file", run_date_of(F.col("file")).alias(RUN_DATE), "position", "column_name",
                         *[F.coalesce(f"n.{c}", F.lit(0)).alias(c) for c in ("cells", *TYPES)])


def _fitting(cells: Column, counts: dict[str, Column]) -> Column:
    kind = F.when(cells == 0, "void")
    for name, n in counts.items():
        kind = kind.when(n == cells, name)
    return kind


def run_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Columns run_date, column_name, position, cells, found_type, merged_type (of this and all earlier runs)."""
    per_run = column_counts(spark, folder).groupBy(RUN_DATE, "column_name").agg(
        F.min("position").alias("position"), *[F.sum(c).alias(c) for c in ("cells", *TYPES)])
    so_far = Window.partitionBy("column_name").orderBy(RUN_DATE)
    return per_run.select(
        RUN_DATE, "column_name", "position", "cells", _fitting(F.col("cells"), {k: F.col(k) for k in TYPES}).alias("found_type"),
        _fitting(F.sum("cells").over(so_far), {k: F.sum(k).over(so_far) for k in TYPES}).alias("merged_type"))


def changes(columns: DataFrame) -> DataFrame:
    """Columns run_date, column_name, change, before_type, found_type: what each run does to each column.

    change is first (no run before), added, lost, same, moved (only its place differs), widened, narrowed or changed.
    A row per run and column goes through one window: the runs are put side by side as maps.
    """
    entry = F.struct("column_name", F.struct("found_type", "position"))
    runs = columns.groupBy(RUN_DATE).agg(F.map_from_entries(F.collect_list(entry)).alias("now"))
    beside = runs.withColumn("before", F.lag("now").over(Window.orderBy(RUN_DATE)))
    names = F.array_distinct(F.concat(F.map_keys("now"), F.coalesce(F.map_keys("before"), F.array())))
    pairs = beside.select(RUN_DATE, "now", "before", F.explode(names).alias("column_name")).select(
        RUN_DATE, "column_name", F.col("before").isNull().alias("is_first"),
        F.element_at("before", F.col("column_name")).alias("b"), F.element_at("now", F.col("column_name")).alias("n"))
    wider = F.create_map(*[x for kind, kinds in WIDER.items() for x in (F.lit(kind), F.array(*[F.lit(k) for k in kinds]).cast("array<string>"))])
    was, now = F.col("b.found_type"), F.col("n.found_type")
    change = (
        F.when(F.col("is_first"), "first").when(F.col("b").isNull(), "added").when(F.col("n").isNull(), "lost")
        .when((was == now) & (F.col("b.position") == F.col("n.position")), "same").when(was == now, "moved")
        .when(F.array_contains(F.element_at(wider, was), now), "widened")
        .when(F.array_contains(F.element_at(wider, now), was), "narrowed").otherwise("changed"))
    return pairs.select(RUN_DATE, "column_name", change.alias("change"), was.alias("before_type"), now.alias("found_type"))
