"""Folders of tables in the file system that their path names, through Hadoop's public file system interface."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _at(spark, path)
    return files.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    files, place = _at(spark, path)
    files.delete(place, True)


def publish(spark: SparkSession, staged: str, final: str) -> None:
    """Give a finished folder its final name; a folder of that name is replaced."""
    files, source = _at(spark, staged)
    _, target = _at(spark, final)
    files.delete(target, True)
    if not files.rename(source, target):
        raise OSError(f"{staged} could not be renamed to {final}")
