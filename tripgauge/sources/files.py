"""Removing directories that no table reads any more."""

from __future__ import annotations

from pyspark.sql import SparkSession


def delete_directory(spark: SparkSession, path: str) -> None:
    """Delete ``path`` on whatever file system it names."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)
