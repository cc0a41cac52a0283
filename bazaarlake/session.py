"""Session settings and the shared folder.

Nothing here overrides what a cluster has set: every setting is applied only
where the session has none of its own.
"""

from __future__ import annotations

import math
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from bazaarlake.sources.files import hadoop_path

PARTITION_BYTES = 128 * 1024 * 1024

# Skewed joins are split even when that costs the next aggregate one more exchange;
# a shuffled join whose build partitions turn out small hashes instead of sorting; a
# partitioned write keeps its few files open instead of sorting; a task reads at most 16 MB, since a MB of packed
# Parquet is up to 100,000 rows and a partial aggregate of them holds a hundred times their bytes.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "32m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.maxConcurrentOutputFileWriters": "8",
    "spark.sql.files.maxPartitionBytes": "16m",
}

# Spark's own values: a session that still shows one of these was not tuned.
_BUILT_IN = {
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "false",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0b",
    "spark.sql.maxConcurrentOutputFileWriters": "0",
    "spark.sql.files.maxPartitionBytes": "134217728b",
}


def local_session(cores: int | str = "*", partitions: int = 8, app: str = "bazaarlake") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Give a foreign session the settings it does not have yet."""
    for key, untouched in _BUILT_IN.items():
        if spark.conf.get(key, untouched) == untouched:
            spark.conf.set(key, DEFAULTS[key])
    return spark


def input_bytes(df: DataFrame) -> int:
    """Size of everything the plan reads.

    Catalyst's estimate of a join is the product of its sides, which says little about
    how much work a plan is; the sum over its leaves does.
    """
    try:
        leaves = df._jdf.queryExecution().analyzed().collectLeaves()
        return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    except AttributeError:
        return 1 << 62


def shuffle_partitions(spark: SparkSession) -> int:
    """Partitions a shuffle starts with, before adaptive execution merges small ones."""
    return int(
        spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
        or spark.conf.get("spark.sql.shuffle.partitions")
    )


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise a small result in the shared folder; what built it is not run again."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def size_shuffles(spark: SparkSession, input_bytes: int, partition_bytes: int = PARTITION_BYTES) -> int:
    """Raise (never lower) the first partition count of shuffles to fit the input.

    Adaptive execution can only merge shuffle partitions, so the first count must
    be large enough that one partition of the largest shuffle fits in memory.  For a job
    to call once; readers of tables leave the session as it is.
    """
    current = shuffle_partitions(spark)
    wanted = math.ceil(input_bytes / partition_bytes)
    if wanted > current:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(wanted))
        return wanted
    return current


_own_folders: dict[str, tempfile.TemporaryDirectory] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    A local master without that setting gets one temporary folder for the application, removed
    when the program ends.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if re.match(r"local(\[|$)", spark.sparkContext.master):
        app = spark.sparkContext.applicationId
        if app not in _own_folders:
            _own_folders[app] = tempfile.TemporaryDirectory(prefix="bazaarlake-", ignore_cleanup_errors=True)
        return _own_folders[app].name
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


def run_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder of its own for the scratch data of one run, removed when the driver ends."""
    base = f"{shared_folder(spark)}/bazaarlake/{purpose}-{uuid.uuid4().hex}"
    fs, path = hadoop_path(spark, base)
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return f"{base}/data"
