from collections import Counter

import pytest
from pyspark.sql import functions as F

from silverline.sources.shared import fresh_path
from silverline.streaming import commits, loads, state

SCHEMA = "k long, v long"


def _drop(spark, path, low, high):
    """Rows low..high-1; a third of them share key 0."""
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50)
    spark.range(low, high).select(key.alias("k"), F.col("id").alias("v")).write.mode("append").parquet(path)


def _source(spark, path):
    return loads.file_stream(spark, path, spark.createDataFrame([], SCHEMA).schema)


def _schema(spark):
    return spark.createDataFrame([], SCHEMA).schema


def _unique(spark, source, target, log):
    loads.stream_unique(_source(spark, source), target, log, "k", ["v"]).awaitTermination()


def _upsert(spark, source, target, log):
    loads.stream_upsert(_source(spark, source), target, log, ["k"], ["v"]).awaitTermination()


def _paths(spark, *names):
    return [fresh_path(spark, n) for n in names]


def _keys(spark, path, low, high, shift):
    (spark.range(low, high).select(F.col("id").alias("k"), (F.col("id") + shift).alias("v"))
     .write.mode("append").parquet(path))


@pytest.mark.parametrize("compacted", [False, True])
def test_unique_and_upsert_over_two_runs(spark, compacted):
    source, unique, unique_log, target, target_log = _paths(spark, "d", "u", "ul", "t", "tl")
    schema = _schema(spark)
    for low, high in ((0, 300), (300, 900)):
        _drop(spark, source, low, high)
        _unique(spark, source, unique, unique_log)
        _upsert(spark, source, target, target_log)
        if compacted:
            loads.compact(spark, unique, schema, ["k"], ["v"])
            loads.compact(spark, target, schema, ["k"], ["v"])
    every = spark.read.schema(SCHEMA).parquet(source)
    first = every.groupBy("k").agg(F.min("v").alias("v"))
    last = every.groupBy("k").agg(F.max("v").alias("v"))
    got = loads.unique_rows(spark, unique, schema)
    assert got.exceptAll(first).count() == 0 and got.count() == first.count()
    now = loads.current_rows(spark, target, schema, ["k"], ["v"])
    assert now.exceptAll(last).count() == 0 and now.count() == last.count()


def test_append_takes_each_file_once(spark):
    source, sink, log = _paths(spark, "d", "s", "l")
    for low, high in ((0, 10), (10, 25)):
        _drop(spark, source, low, high)
        for _ in range(2):  # a second run without new files adds nothing
            loads.incremental_append(_source(spark, source), sink, log).awaitTermination()
    assert spark.read.schema(SCHEMA).parquet(sink).count() == 25


def test_second_source_with_a_new_checkpoint_keeps_the_first(spark):
    one, two, target, *logs = _paths(spark, "a", "b", "t", "l1", "l2")
    _keys(spark, one, 0, 20, 0)
    _keys(spark, two, 18, 25, 1000)
    schema = _schema(spark)
    for source, log in zip((one, two), logs):
        _upsert(spark, source, target, log)
    got = {r.k: r.v for r in loads.current_rows(spark, target, schema, ["k"], ["v"]).collect()}
    assert got == {k: k + (1000 if k >= 18 else 0) for k in range(25)}


def test_lost_checkpoint_repeats_no_key(spark):
    source, target, *logs = _paths(spark, "d", "t", "l1", "l2")
    _keys(spark, source, 0, 20, 0)
    for log in logs:
        _unique(spark, source, target, log)
    assert loads.unique_rows(spark, target, _schema(spark)).count() == 20


def test_batch_run_again_writes_the_same_rows(spark):
    source, target = _paths(spark, "d", "t")
    _drop(spark, source, 0, 100)
    rows = spark.read.schema(SCHEMA).parquet(source)
    for _ in range(2):
        loads.write_batch(rows, target, "r", 0, ["k"])
    assert loads.stored_rows(spark, target, rows.schema).count() == rows.count()
    assert loads.stored_rows(spark, target, rows.schema, skip=("r", 0)).count() == 0


def test_later_run_wins_after_compaction(spark):
    one, two, target, *logs = _paths(spark, "a", "b", "t", "l1", "l2")
    _keys(spark, one, 0, 5, 100)
    _keys(spark, two, 0, 5, 0)
    schema = _schema(spark)
    _upsert(spark, one, target, logs[0])
    loads.compact(spark, target, schema, ["k"], ["v"])
    _upsert(spark, two, target, logs[1])
    for _ in range(2):
        got = {r.k: r.v for r in loads.current_rows(spark, target, schema, ["k"], ["v"]).collect()}
        assert got == {k: k for k in range(5)}
        loads.compact(spark, target, schema, ["k"], ["v"])


def test_known_keys_are_read_from_touched_folders_only(spark):
    source, target, log = _paths(spark, "d", "t", "l")
    _keys(spark, source, 0, 500, 0)
    _unique(spark, source, target, log)
    known = loads.stored_rows(spark, target, _schema(spark))
    assert "bucket" in known.columns
    plan = known.filter(F.col("bucket").isin([3]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [(bucket" in plan, plan


# ---- Commit order and growing buckets ----

def _values(spark, target):
    return {r.k: r.v for r in loads.current_rows(spark, target, _schema(spark), ["k"], ["v"]).collect()}


@pytest.mark.parametrize("compacted", [False, True])
def test_the_later_commit_wins_between_alternating_streams(spark, compacted):
    one, two, target, *logs = _paths(spark, "a", "b", "t", "l1", "l2")
    for source, log, value in ((one, logs[0], 1), (two, logs[1], 100), (one, logs[0], 5), (two, logs[1], 7)):
        spark.createDataFrame([(1, value)], SCHEMA).write.mode("append").parquet(source)
        _upsert(spark, source, target, log)
        if compacted:
            loads.compact(spark, target, _schema(spark), ["k"], ["v"])
        assert _values(spark, target) == {1: value}


def test_a_batch_run_again_keeps_its_place(spark):
    target, = _paths(spark, "t")
    old, new = (spark.createDataFrame([(1, v)], SCHEMA) for v in (1, 2))
    for run, rows in (("a", old), ("b", new), ("a", old)):
        loads.write_batch(rows, target, run, 0, ["k"])
    assert _values(spark, target) == {1: 2}
    loads.compact(spark, target, _schema(spark), ["k"], ["v"])
    loads.write_batch(old, target, "a", 0, ["k"])  # again after it was folded
    assert _values(spark, target) == {1: 2}
    assert sorted(r.seq for r in commits.commits(spark, target).collect()) == [1, 2]


def test_a_number_is_claimed_once(spark):
    target, = _paths(spark, "t")
    assert [commits.commit(spark, target, "a", n) for n in (0, 1, 0)] == [1, 2, 1]
    assert commits._create(spark, f"{target}/_commits/{3:015d}", "") is True  # a stream that died while claiming
    assert commits._create(spark, f"{target}/_commits/{3:015d}", "") is False
    assert commits.commit(spark, target, "b", 0) == 4
    assert commits.commits(spark, target).count() == 3


def test_folders_without_a_commit_are_not_read(spark):
    target, = _paths(spark, "t")
    rows = spark.createDataFrame([(1, 1)], SCHEMA)
    loads.write_batch(rows, target, "a", 0, ["k"])
    (rows.withColumn("v", F.lit(9).cast("long")).withColumn("bucket", loads.bucket_of(["k"], 16))
     .write.partitionBy("bucket").parquet(f"{target}/run=a/batch=1"))
    assert _values(spark, target) == {1: 1}


def test_buckets_grow_one_by_one_and_only_split_ones_are_rewritten(spark):
    target, = _paths(spark, "t")
    schema = _schema(spark)
    every = spark.range(4000).select(F.col("id").alias("k"), F.col("id").alias("v"))
    loads.write_batch(every, target, "a", 0, ["k"])
    assert loads.compact(spark, target, schema, ["k"], ["v"], rows_a_bucket=200) == 20
    before = loads._published(spark, target)[2]
    assert len(before) == 20
    assert loads.compact(spark, target, schema, ["k"], ["v"], rows_a_bucket=190) == 22
    after = loads._published(spark, target)[2]
    assert {b for b in before if before[b] != after[b]} == {4, 5} and len(after) == 22
    assert loads.compact(spark, target, schema, ["k"], ["v"], rows_a_bucket=50) == 80
    assert _values(spark, target) == {k: k for k in range(4000)}
    few = spark.createDataFrame([(1, -1), (4001, -2)], SCHEMA)
    loads.write_batch(few, target, "b", 0, ["k"])
    middle = loads._published(spark, target)[2]
    loads.compact(spark, target, schema, ["k"], ["v"])
    last = loads._published(spark, target)[2]
    assert sum(middle[b] != last[b] for b in middle) == 2  # those of the two keys
    assert _values(spark, target) == {k: k for k in range(4000)} | {1: -1, 4001: -2}


def test_folders_do_not_follow_the_rows_of_small_buckets(spark):
    assert [loads.buckets_for(n, 8) for n in (0, 9, 2048, 90_000, 1 << 24)] == [0, 2, 256, 256, 1024]
    assert loads.buckets_for(1 << 30, loads.ROWS_A_BUCKET) == 1024
    target, = _paths(spark, "t")
    every = spark.range(4000).select(F.col("id").alias("k"), F.col("id").alias("v"))
    loads.write_batch(every, target, "a", 0, ["k"])
    assert loads.compact(spark, target, _schema(spark), ["k"], ["v"], rows_a_bucket=8) == 256
    assert _values(spark, target) == {k: k for k in range(4000)}


def test_linear_hashing_moves_rows_out_of_split_buckets_only(spark):
    keys = spark.range(5000).select(F.col("id").alias("k"))
    for n, more in ((16, 17), (16, 40), (20, 33), (31, 32), (32, 100)):
        rows = keys.select(loads.bucket_of(["k"], n).alias("a"), loads.bucket_of(["k"], more).alias("b")).collect()
        assert {r.a for r in rows} == set(range(n)) and {r.b for r in rows} == set(range(more))
        moved = {r.a for r in rows if r.a != r.b}
        assert moved == loads.split_buckets(n, more)


# ---- Keyed state ----

def _state_unique(spark, source, target, log):
    query = state.stateful_unique(_source(spark, source), target, log, "k", ["v"])
    query.awaitTermination()
    return query


def test_stateful_unique_over_restarts(spark):
    source, target, log = _paths(spark, "d", "t", "l")
    for low, high in ((0, 300), (300, 900), (900, 950)):
        _drop(spark, source, low, high)
        query = _state_unique(spark, source, target, log)
        _state_unique(spark, source, target, log)  # nothing new
    first = spark.read.schema(SCHEMA).parquet(source).groupBy("k").agg(F.min("v").alias("v"))
    got = state.batch_rows(spark, target, _schema(spark))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, first.collect()))
    stats = query.lastProgress["stateOperators"][0]
    assert stats["numRowsTotal"] == first.count() and any(k.startswith("rocksdb") for k in stats["customMetrics"])
    assert "RocksDB" not in (spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) or "")


def test_stateful_unique_shuffles_one_row_per_key_and_task(spark):
    source, target, log = _paths(spark, "d", "t", "l")
    spark.range(30_000).select(F.lit(0).cast("long").alias("k"), F.col("id").alias("v")).repartition(3).write.parquet(source)
    query = _state_unique(spark, source, target, log)
    plan = query._jsq.explainInternal(False) if hasattr(query._jsq, "explainInternal") else ""
    assert state.batch_rows(spark, target, _schema(spark)).collect() == [(0, 0)]
    assert query.lastProgress["stateOperators"][0]["numRowsUpdated"] == 1, plan


def test_stateful_unique_keeps_nulls_as_one_key(spark):
    source, target, log = _paths(spark, "d", "t", "l")
    for rows in ([(None, None), (None, 3), (1, None)], [(None, 1), (1, 1), (2, None)]):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        _state_unique(spark, source, target, log)
    got = state.batch_rows(spark, target, _schema(spark)).collect()
    assert Counter(map(tuple, got)) == Counter([(None, 3), (1, None), (2, None)])


# ---- Windows ----

EVENT = "ts timestamp, k long"


def _events(spark, path, minutes):
    spark.createDataFrame([(m, k) for m, k in minutes], "m long, k long").select(
        (F.timestamp_seconds(F.col("m") * 60)).alias("ts"), "k").coalesce(1).write.mode("append").parquet(path)


def _minute(column):
    return (F.unix_timestamp(column) / 60).cast("long")


@pytest.mark.parametrize("kind", ["tumbling", "session"])
def test_windows_and_late_rows(spark, kind):
    source, target, late, log, late_log = _paths(spark, "d", "w", "late", "l", "ll")
    schema = spark.createDataFrame([], EVENT).schema
    over = F.window("ts", "10 minutes") if kind == "tumbling" else F.session_window("ts", "10 minutes")
    end = F.window("ts", "10 minutes")["end"] if kind == "tumbling" else F.col("ts") + F.expr("interval 10 minutes")
    # 60 less 5 minutes is the watermark of the second drop: 3 and 12 are late, 52 is not.
    for drop in ([(1, 1), (2, 1), (11, 1), (25, 2), (60, 1)], [(3, 1), (12, 1), (52, 1), (61, 2), (200, 3)]):
        _events(spark, source, drop)
        stream = loads.file_stream(spark, source, schema)
        state.windowed(stream, target, log, "ts", "5 minutes", over, ["k"], [F.count(F.lit(1)).alias("n")]).awaitTermination()
        state.late_rows(loads.file_stream(spark, source, schema), late, late_log, "ts", "5 minutes", end).awaitTermination()
    out = "window_start timestamp, window_end timestamp, k long, n long"
    rows = state.batch_rows(spark, target, spark.createDataFrame([], out).schema)
    got = {tuple(r) for r in rows.select(_minute("window_start"), _minute("window_end"), "k", "n").collect()}
    want = {"tumbling": {(0, 10, 1, 2), (10, 20, 1, 1), (20, 30, 2, 1), (50, 60, 1, 1), (60, 70, 1, 1), (60, 70, 2, 1)},
            "session": {(1, 21, 1, 3), (25, 35, 2, 1), (52, 70, 1, 2), (61, 71, 2, 1)}}[kind]
    assert got == want
    missed = state.batch_rows(spark, late, schema).select(_minute("ts")).collect()
    assert sorted(r[0] for r in missed) == [3, 12]
