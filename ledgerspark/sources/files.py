"""Folders of the file systems Spark reads: local, ``hdfs://`` or an object store."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    context = spark.sparkContext
    at = context._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(context._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    files, at = _located(spark, path)
    return files.exists(at)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder, none if it is not there."""
    files, at = _located(spark, path)
    return sorted(f.getPath().getName() for f in files.listStatus(at)) if files.exists(at) else []


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder with all it holds; one that is not there is no fault."""
    files, at = _located(spark, path)
    files.delete(at, True)
