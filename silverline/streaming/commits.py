"""The order of commits to a target, agreed between any number of streams.

A batch first writes its folder, then claims the target's next sequence number. A number is
claimed by creating its file, which a store does for one writer only; whoever comes second takes
the next. Readers see committed folders only. A batch that is run again keeps its number, so what
it writes stays as new as it was.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from silverline.sources.folders import list_folders

COMMIT = StructType().add("seq", "long").add("run", "string").add("batch", "long")


def _create(spark: SparkSession, path: str, content: str) -> bool:
    """Write a small file unless there is one; whether this call made it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if store.exists(place):
        return False
    try:
        out = store.create(place, False)
    except Exception as e:
        if store.exists(place):
            return False  # another stream was faster
        raise e
    out.write(bytearray(content.encode()))
    out.close()
    return True


def commits(spark: SparkSession, target: str) -> DataFrame:
    """(seq, run, batch): one row per committed batch."""
    if not list_folders(spark, f"{target}/_commits/*"):
        return spark.createDataFrame([], COMMIT)
    return spark.read.schema(COMMIT).json(f"{target}/_commits").filter("seq is not null")


def commit(spark: SparkSession, target: str, run: str, batch: int) -> int:
    """The sequence number of a batch: a new one, or the one that it has."""
    known = commits(spark, target).filter((F.col("run") == run) & (F.col("batch") == batch)).first()
    if known:
        return known["seq"]
    numbers = [int(p.rsplit("/", 1)[1]) for p in list_folders(spark, f"{target}/_commits/*")]
    seq = max(numbers, default=0) + 1
    while not _create(spark, f"{target}/_commits/{seq:015d}", json.dumps({"seq": seq, "run": run, "batch": batch})):
        seq += 1
    return seq
