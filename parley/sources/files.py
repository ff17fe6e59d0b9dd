"""Small helpers on the file system of the session (local, HDFS, object store)."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

_BATCH = re.compile(r"^\d{14}$")


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    file_system, hadoop_path = _file_system(spark, path)
    return file_system.exists(hadoop_path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder which the caller wrote, if it is there."""
    file_system, hadoop_path = _file_system(spark, path)
    file_system.delete(hadoop_path, True)


def glob_names(spark: SparkSession, pattern: str) -> list[str]:
    """Names of the entries which match a glob, sorted."""
    file_system, hadoop_path = _file_system(spark, pattern)
    found = file_system.globStatus(hadoop_path) or []
    return sorted(entry.getPath().getName() for entry in found)


def list_batches(spark: SparkSession, home: str) -> list[str]:
    """Batch ids (``yyyyMMddHHmmss``) under a data home, oldest first, of any year."""
    return [name for name in glob_names(spark, f"{home}/*") if _BATCH.match(name)]


def newest_batch(spark: SparkSession, home: str) -> str | None:
    batches = list_batches(spark, home)
    return batches[-1] if batches else None
