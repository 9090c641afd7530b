"""Folders of any store that Spark writes, through Hadoop's own file system."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _files(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def subfolders(spark: SparkSession, folder: str) -> list[str]:
    """Names of the folders in `folder`; none if it isn't there."""
    files, path = _files(spark, folder)
    if not files.exists(path):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(path) if s.isDirectory())


def delete(spark: SparkSession, folder: str) -> None:
    files, path = _files(spark, folder)
    files.delete(path, True)
