"""Keyed dedupe with operator state, and event-time windows with late rows.

State lives in RocksDB, one store for each shuffle partition, and only its changes are written per
batch: the time of a batch follows the batch's keys and not what was ever seen. The number of
shuffle partitions of the first start is kept for good by the checkpoint; choose it for the size
that the state may reach.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from silverline.sources.folders import list_folders
from silverline.streaming.commits import commit, commits
from silverline.streaming.loads import per_batch

_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def keyed_state(spark: SparkSession):
    """Queries started inside keep their state in RocksDB; a started query keeps its setting."""
    before = {k: spark.conf.get(k, None) for k in _STORE}
    for k, v in _STORE.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _write(rows: DataFrame, target: str, run: str, number: int) -> None:
    rows.write.mode("overwrite").parquet(f"{target}/run={run}/batch={number}")
    commit(rows.sparkSession, target, run, number)


def batch_rows(spark: SparkSession, target: str, schema: StructType) -> DataFrame:
    """All committed rows of a target that is written batch by batch."""
    paths = [f"{target}/run={r['run']}/batch={r['batch']}" for r in commits(spark, target).collect()]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def stateful_unique(source: DataFrame, target: str, checkpoint: str, key: str,
                    order: list[str]) -> StreamingQuery:
    """Each key once: the first row by `order` of the first batch that has it.

    The state of a key is its smallest (batch time, order, row). Rows are merged before the shuffle,
    so a hot key costs a row per task. A batch gives out the keys whose smallest row is of its own
    time; a batch that runs again has the same time. Null keys are one key. A new checkpoint starts
    with empty state: it is another run, and repeats keys that an earlier one gave out.
    """
    names = source.columns
    # Nulls of `order` come last, as in keep_first: the flags compare before the values.
    row = F.struct("seen", *[F.col(f"old.{c}").isNull().alias(f"null_{i}") for i, c in enumerate(order)],
                   F.struct(*[F.col(f"old.{c}") for c in order]).alias("by"), "old")
    timed = source.select(F.struct(*names).alias("old"), F.current_timestamp().alias("seen"))
    first = timed.groupBy(F.col(f"old.{key}").alias("key")).agg(F.min(row).alias("first"))
    new = first.filter(F.col("first.seen") == F.current_timestamp()).select("first.old.*")
    with keyed_state(source.sparkSession):
        return per_batch(new, checkpoint, lambda rows, run, n: _write(rows, target, run, n), "update")


def windowed(source: DataFrame, target: str, checkpoint: str, time: str, delay: str, over: Column,
             keys: list[str], aggregates: list[Column]) -> StreamingQuery:
    """Aggregates by event-time window and key, each window once, when the watermark has passed it.

    `over` is `F.window(time, ...)` or `F.session_window(time, ...)`; results have window_start and
    window_end. Rows that come after their window was given out are dropped here; `late_rows` keeps
    them. Rows without an event time are in no window.
    """
    marked = source.filter(F.col(time).isNotNull()).withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)
    found = (marked.groupBy(over.alias("window"), *keys).agg(*aggregates)
             .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "*").drop("window"))
    with keyed_state(source.sparkSession):
        return per_batch(found, checkpoint, lambda rows, run, n: _write(rows, target, run, n))


def late_rows(source: DataFrame, target: str, checkpoint: str, time: str, delay: str,
              window_end: Column) -> StreamingQuery:
    """The rows whose window had ended by the watermark when they came, by the rule of `windowed`.

    The watermark of a batch is the latest event time of earlier batches less `delay`. Each batch
    stores its own latest time with its rows (one number), and reads those of the batches before.
    Run over the same source and drops as `windowed`, it finds what that left out.
    """
    def split(batch: DataFrame, run: str, number: int) -> None:
        spark = batch.sparkSession
        marks = list_folders(spark, f"{target}/_marks/batch=*/_SUCCESS")
        before = [int(p.split("/batch=")[1].split("/")[0]) for p in marks]
        high = None
        if any(n < number for n in before):
            last = max(n for n in before if n < number)
            high = spark.read.schema("high timestamp").parquet(f"{target}/_marks/batch={last}").first()["high"]
        mark = F.lit(high).cast("timestamp") - F.expr(f"interval {delay}")
        late = batch.filter(window_end <= mark) if high else batch.limit(0)
        _write(late, target, run, number)
        (batch.agg(F.greatest(F.max(time), F.lit(high).cast("timestamp")).alias("high")).coalesce(1)
         .write.mode("overwrite").parquet(f"{target}/_marks/batch={number}"))

    return per_batch(source, checkpoint, split)
