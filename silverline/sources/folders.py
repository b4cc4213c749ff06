"""Directory listings in any store Spark reads."""

from __future__ import annotations

from pyspark.sql import SparkSession


def list_folders(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern, sorted."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(s.getPath().toString() for s in found or [])
