"""Folder operations on whatever file system a path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def make_folder(spark: SparkSession, path: str) -> None:
    fs, target = _resolve(spark, path)
    fs.mkdirs(target)


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, target = _resolve(spark, path)
    fs.delete(target, True)


def list_names(spark: SparkSession, path: str) -> list[str]:
    fs, target = _resolve(spark, path)
    return [status.getPath().getName() for status in fs.listStatus(target)]


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Sorted names in a folder; none if there is no such folder."""
    fs, target = _resolve(spark, path)
    return sorted(list_names(spark, path)) if fs.exists(target) else []


def create_marker(spark: SparkSession, path: str) -> None:
    """An empty file that must not exist yet: it is there in whole or not at all."""
    fs, target = _resolve(spark, path)
    fs.create(target, False).close()


def size_of(spark: SparkSession, path: str) -> int:
    fs, target = _resolve(spark, path)
    return fs.getContentSummary(target).getLength()


def files_of(spark: SparkSession, path: str) -> int:
    fs, target = _resolve(spark, path)
    return fs.getContentSummary(target).getFileCount()
