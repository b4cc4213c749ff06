"""Incremental loads: new files only, restart-safe, with keyed dedupe and upsert.

Keyed loads run per micro-batch as plain joins and aggregations, which merge hot keys on the map
side and keep no operator state; what is already known lives in the target table. (`state.py` has
the same dedupe with keyed state, whose time does not follow the target's size.)

A micro-batch owns the directory `run=<query id>/batch=N` and overwrites it, so a batch that is
run again after a failure writes the same rows once. The query id lives in the checkpoint: a
new checkpoint is a new run with directories of its own, and never touches those of another.
A batch becomes visible with its sequence number (`commits.py`): of two rows with one key the one
committed later is newer, whichever streams wrote them.

Keyed tables are cut by linear hashing: `buckets` folders, of which a batch reads and writes only
those of its own keys. `compact` folds all committed directories into the base, rewriting only the
buckets that they touch. Where the rows have outgrown the buckets it adds some, and an added
bucket takes its rows from one old bucket, so only those that are split are rewritten too. Files,
and the tasks that write them, so follow the rows. A base is published by one committed row set:
readers see the old directories or the base, never both.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from silverline.operators.joins import skip_done
from silverline.operators.keyed import keep_first, keep_last
from silverline.sources.folders import list_folders
from silverline.streaming.commits import commit, commits

BUCKETS = 16
ROWS_A_BUCKET = 1 << 20
#: A bucket is a folder of its own, so beyond FOLDERS of them each has at least LEAST_ROWS, whatever is asked.
FOLDERS, LEAST_ROWS = 256, 1 << 14
_PLACE = StructType().add("run", "string").add("batch", "long").add("seq", "long").add("bucket", "integer")
_BASE = (StructType().add("kind", "string").add("bucket", "integer").add("path", "string").add("run", "string")
         .add("batch", "long").add("seq", "long").add("buckets", "integer"))


def file_stream(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def incremental_append(source: DataFrame, sink: str, checkpoint: str) -> StreamingQuery:
    """Append what arrived since the last run, then stop."""
    return (source.writeStream.format("parquet").outputMode("append")
            .option("path", sink).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def _level(buckets: int) -> int:
    """The largest of BUCKETS, 2 BUCKETS, 4 BUCKETS ... up to the number of buckets."""
    size = BUCKETS
    while size * 2 <= buckets:
        size *= 2
    return size


def bucket_of(keys: list[str], buckets: int) -> Column:
    """Linear hashing: by twice the level, or by the level for buckets not added yet."""
    level, mark = _level(buckets), F.xxhash64(*keys)
    wide = F.pmod(mark, F.lit(2 * level))
    return F.when(wide < buckets, wide).otherwise(F.pmod(mark, F.lit(level))).cast("integer")


def buckets_for(rows: int, rows_a_bucket: int) -> int:
    """Buckets of about that many rows, as long as they are worth their folders."""
    return min(-(-rows // rows_a_bucket), max(FOLDERS, -(-rows // LEAST_ROWS)))


def split_buckets(buckets: int, more: int) -> set[int]:
    """The buckets whose rows may move when there are `more` of them."""
    found = set()
    for added in range(buckets, more):
        while added >= buckets:
            level = _level(added)
            added -= level
        found.add(added)
    return found


def run_of(spark: SparkSession, checkpoint: str) -> str:
    return spark.read.schema("id string").json(f"{checkpoint}/metadata").first()["id"]


def _published(spark: SparkSession, target: str) -> tuple[int, int, dict[int, str], dict[tuple[str, int], int]]:
    """The newest base: version, number of buckets, their folders, and the (run, batch) folded into it."""
    versions = [int(p.rsplit("=", 1)[1]) for p in list_folders(spark, f"{target}/_bases/version=*")
                if list_folders(spark, f"{p}/_SUCCESS")]
    if not versions:
        return 0, BUCKETS, {}, {}
    rows = spark.read.schema(_BASE).parquet(f"{target}/_bases/version={max(versions)}").collect()
    return (max(versions), max(r["buckets"] for r in rows), {r["bucket"]: r["path"] for r in rows if r["kind"] == "bucket"},
            {(r["run"], r["batch"]): r["seq"] for r in rows if r["kind"] == "folded"})


def write_batch(rows: DataFrame, target: str, run: str, number: int, keys: list[str]) -> None:
    """Write a batch's folder, then commit it. A batch folded into a base is written there already."""
    spark = rows.sparkSession
    _, buckets, _, folded = _published(spark, target)
    if (run, number) in folded:
        return
    (rows.withColumn("bucket", bucket_of(keys, buckets)).repartition("bucket")
     .write.mode("overwrite").partitionBy("bucket").parquet(f"{target}/run={run}/batch={number}"))
    commit(spark, target, run, number)


def _live(spark: SparkSession, target: str, folded: dict, skip: tuple[str, int] | None = None) -> dict:
    """Committed batches that no base holds: (run, batch) to sequence number."""
    rows = {(r["run"], r["batch"]): r["seq"] for r in commits(spark, target).collect()}
    return {k: seq for k, seq in rows.items() if k not in folded and k != skip}


def _live_rows(spark: SparkSession, target: str, schema: StructType, live: dict) -> DataFrame:
    full = StructType([*schema.fields, *_PLACE.fields])
    if not live:
        return spark.createDataFrame([], full)
    paths = [f"{target}/run={run}/batch={batch}" for run, batch in sorted(live)]
    paths = [p for p in paths if list_folders(spark, f"{p}/bucket=*")]  # an empty batch has none
    if not paths:
        return spark.createDataFrame([], full)
    # One row per batch since the last compaction, hence safe to broadcast.
    numbers = spark.createDataFrame([(r, b, s) for (r, b), s in live.items()], "run string, batch long, seq long")
    return (spark.read.schema(full).option("basePath", target).parquet(*paths).drop("seq")
            .join(F.broadcast(numbers), ["run", "batch"]).select(*full.names))


def _base_rows(spark: SparkSession, target: str, schema: StructType, folders: list[str]) -> DataFrame:
    full = StructType([*schema.fields, *_PLACE.fields])
    if not folders:
        return spark.createDataFrame([], full)
    return (spark.read.schema(full.add("base", "string")).option("basePath", f"{target}/_rows").parquet(*sorted(folders))
            .drop("base"))


def stored_rows(spark: SparkSession, target: str, schema: StructType,
                skip: tuple[str, int] | None = None) -> DataFrame:
    """All rows of a keyed target, with where they come from; `skip` leaves out one batch."""
    _, _, folders, folded = _published(spark, target)
    return (_live_rows(spark, target, schema, _live(spark, target, folded, skip))
            .union(_base_rows(spark, target, schema, list(folders.values()))))


def per_batch(source: DataFrame, checkpoint: str, action, mode: str = "append") -> StreamingQuery:
    """Run `action(batch, run, number)` for each micro-batch that is due, then stop."""
    def once(batch: DataFrame, number: int) -> None:
        action(batch, run_of(batch.sparkSession, checkpoint), number)

    return (source.writeStream.outputMode(mode).foreachBatch(once).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def stream_unique(source: DataFrame, target: str, checkpoint: str, key: str,
                  order: list[str]) -> StreamingQuery:
    """Each key once across all runs: the first row of the first batch that has it."""
    def append_new(batch: DataFrame, run: str, number: int) -> None:
        spark = batch.sparkSession
        rows = keep_first(batch, [key], order).persist()
        place = bucket_of([key], _published(spark, target)[1])
        touched = [r[0] for r in rows.select(place).distinct().collect()]  # at most the buckets
        known = stored_rows(spark, target, batch.select(key).schema, skip=(run, number))
        new = skip_done(rows, known.filter(F.col("bucket").isin(touched)), key)
        write_batch(new, target, run, number, [key])
        rows.unpersist()

    return per_batch(source, checkpoint, append_new)


def unique_rows(spark: SparkSession, target: str, schema: StructType) -> DataFrame:
    return stored_rows(spark, target, schema).select(*schema.names)


def stream_upsert(source: DataFrame, target: str, checkpoint: str, keys: list[str],
                  order: list[str]) -> StreamingQuery:
    """Keep-last per key. A batch writes only its own newest rows; `current_rows` merges."""
    def append_latest(batch: DataFrame, run: str, number: int) -> None:
        write_batch(keep_last(batch, keys, order), target, run, number, keys)

    return per_batch(source, checkpoint, append_latest)


def _newest(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """What was committed later is newer; inside a batch `order` decides."""
    return keep_last(rows, keys, ["seq", *order])


def current_rows(spark: SparkSession, target: str, schema: StructType, keys: list[str],
                 order: list[str]) -> DataFrame:
    """The upserted table."""
    return _newest(stored_rows(spark, target, schema), keys, order).select(*schema.names)


def compact(spark: SparkSession, target: str, schema: StructType, keys: list[str],
            order: list[str], rows_a_bucket: int = ROWS_A_BUCKET) -> int:
    """Fold everything committed so far into the base; no stream may be writing meanwhile.

    Returns the number of buckets, of about `rows_a_bucket` rows each (`buckets_for`). Rows keep their sequence number, so what arrives later compares
    with them as before. Folders that are not read any more stay until they are removed by hand.
    """
    version, buckets, folders, folded = _published(spark, target)
    live = _live(spark, target, folded)
    fresh = _live_rows(spark, target, schema, live)
    touched = {r[0]: r[1] for r in fresh.groupBy("bucket").count().collect()}  # one row a bucket
    count = sum(touched.values()) + _base_rows(spark, target, schema, list(folders.values())).count()
    more = max(buckets, buckets_for(count, rows_a_bucket))
    moved = set(touched) | split_buckets(buckets, more)
    held = _base_rows(spark, target, schema, [folders[b] for b in sorted(moved) if b in folders])
    base = uuid.uuid4().hex
    (_newest(fresh.union(held), keys, order).withColumn("bucket", bucket_of(keys, more)).repartition("bucket")
     .write.partitionBy("bucket").parquet(f"{target}/_rows/base={base}"))
    written = {int(p.rsplit("=", 1)[1]): p for p in list_folders(spark, f"{target}/_rows/base={base}/bucket=*")}
    kept = {b: p for b, p in folders.items() if b not in moved} | written
    rows = [("bucket", b, p, None, None, None, more) for b, p in sorted(kept.items())]
    rows += [("folded", None, None, *k, s, more) for k, s in sorted((folded | live).items())]
    (spark.createDataFrame(rows or [("empty", None, None, None, None, None, more)], _BASE)
     .coalesce(1).write.parquet(f"{target}/_bases/version={version + 1}"))
    return more
