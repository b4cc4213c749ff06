"""The queries' own choice of a folder, for a local session that names none."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

from silverline.sources.shared import shared_dir


def use_local_folder(spark: SparkSession) -> None:
    """Give a local session without `spark.checkpoint.dir` a temporary one; others must set it."""
    try:
        shared_dir(spark)
    except ValueError:
        if not spark.sparkContext.master.startswith("local"):
            raise
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="silverline-"))
