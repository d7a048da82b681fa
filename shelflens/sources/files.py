"""Path probes through the storage layer Spark itself uses (local, HDFS, S3, ...)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return fs, jvm_path


def path_exists(spark: SparkSession, path: str) -> bool:
    """True or false; a storage error is raised, not read as "missing"."""
    fs, p = _path(spark, path)
    return fs.exists(p)


def glob_matches(spark: SparkSession, pattern: str) -> bool:
    fs, p = _path(spark, pattern)
    found = fs.globStatus(p)
    return found is not None and len(found) > 0


def remove_matches(spark: SparkSession, pattern: str) -> None:
    """Delete the folders that match, if any."""
    fs, p = _path(spark, pattern)
    for found in fs.globStatus(p) or []:
        fs.delete(found.getPath(), True)


def table_exists(spark: SparkSession, table: str) -> bool:
    """A catalogue table by name, or a dataset by path."""
    if "/" in table:
        return path_exists(spark, table)
    return spark.catalog.tableExists(table)
