"""Look at a folder on any Hadoop file system (local, HDFS, object store)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def hadoop_path(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = hadoop_path(spark, path)
    return fs.exists(jpath)


def has_file(spark: SparkSession, path: str, suffixes: tuple[str, ...] = (".csv", ".csv.gz")) -> bool:
    """Is there a file with one of these suffixes anywhere below?  Stops at the first."""
    fs, jpath = hadoop_path(spark, path)
    if not fs.exists(jpath):
        return False
    files = fs.listFiles(jpath, True)  # a file is its own listing
    while files.hasNext():
        status = files.next()
        if status.getPath().getName().endswith(suffixes) and status.getLen() > 0:
            return True
    return False
