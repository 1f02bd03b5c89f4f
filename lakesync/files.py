"""Files below a job's root, through the file system that Spark reads them with."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _at(spark, path)
    return system.exists(place)


def delete(spark: SparkSession, path: str) -> None:
    system, place = _at(spark, path)
    system.delete(place, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none if it is missing."""
    system, place = _at(spark, path)
    return sorted(f.getPath().getName() for f in system.listStatus(place)) if system.exists(place) else []
