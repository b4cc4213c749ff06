"""The folder every executor can reach, for stored intermediate results."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def _context_dir(spark: SparkSession) -> str | None:
    folder = spark.sparkContext._jsc.sc().getCheckpointDir()
    return None if folder.isEmpty() else folder.get()


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder. None is ever made up: a session without one fails."""
    folder = spark.conf.get(_SETTING, None) or _context_dir(spark)
    if not folder:
        raise ValueError(f"Set {_SETTING} to a folder all executors share")
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """Cut lineage through the shared folder, so a lost executor loses nothing."""
    spark = df.sparkSession
    if not _context_dir(spark):
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint()
