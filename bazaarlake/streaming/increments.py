"""Incremental load of a raw folder: each run exactly once, however often it is landed.

The checkpoint remembers the files that were read, so a late file with old rows is
still loaded, which a high-water mark on created_at cannot do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from bazaarlake import schemas
from bazaarlake.functions.scalars import run_date_of
from bazaarlake.functions.typing import apply_types
from bazaarlake.sources.raw_csv import RUN_DATE, csv_options, scan_text

# Bounds one micro-batch; the trigger goes on until every file present is read.
FILES_PER_BATCH = 10_000


def typed_stream(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    text = (
        spark.readStream.options(**csv_options())
        .option("maxFilesPerTrigger", FILES_PER_BATCH)
        .schema(schemas.all_text(schema)).csv(folder)
    )
    dated = text.select("*", run_date_of(F.col("_metadata.file_path")).alias(RUN_DATE))
    return apply_types(dated, schema, keep=(RUN_DATE,))


def load_new_files(
    spark: SparkSession, folder: str, schema: T.StructType, target: str, checkpoint: str
) -> None:
    """Load every run that has files not seen before into ``target``, then return.

    The stream says which runs changed; each of those is read whole and replaces its partition.  So a
    run that was landed again, under new file names, is there once, and a batch that is repeated after a
    failure writes the same.
    """
    def replace_runs(batch: DataFrame, _: int) -> None:
        runs = [row[RUN_DATE] for row in batch.select(RUN_DATE).distinct().collect()]  # a row per run
        for run in runs:
            text = scan_text(spark, folder, schemas.all_text(schema), run)
            (
                apply_types(text, schema, keep=(RUN_DATE,))
                .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(RUN_DATE).parquet(target)
            )

    query = (
        typed_stream(spark, folder, schema)
        .writeStream.foreachBatch(replace_runs)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def load_new_rows(spark: SparkSession, raw_root: str, table: str, target_root: str) -> None:
    """``load_new_files`` for one of the tables that grow from run to run."""
    if table not in schemas.WATERMARKED:
        raise ValueError(f"{table} has no created_at and is replaced as a whole")
    load_new_files(
        spark, f"{raw_root}/{table}", schemas.CLEAN[table],
        f"{target_root}/{table}", f"{target_root}/_checkpoints/{table}",
    )
