"""Commit records: an empty file per number in a folder, written and listed through the
Hadoop file API, so they work on any storage Spark does and cost no job.

A table that is written in numbered parts counts a part once its number is committed;
what a broken run left without a record is never read.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _file(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _file(spark, path)
    return fs.exists(p)


def matches(spark: SparkSession, pattern: str) -> bool:
    """Whether any file matches a path pattern."""
    fs, p = _file(spark, pattern)
    return bool(fs.globStatus(p))


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, in order; none if it is not there."""
    fs, p = _file(spark, folder)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p))


def commit(spark: SparkSession, folder: str, number: int) -> None:
    fs, p = _file(spark, f"{folder}/{number:012d}")
    fs.create(p, True).close()


def committed(spark: SparkSession, folder: str) -> list[int]:
    return [int(n) for n in names(spark, folder) if n.isdigit()]


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _file(spark, path)
    fs.delete(p, True)
