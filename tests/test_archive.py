"""Page archives: splits at any byte, half-written records, damage, growing files, lost attempts."""

import os
from collections import Counter

import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from silverline.sources import archive as ar
from silverline.streaming import loads

KIND = "page_id long, url string, html string"


def append(path, rows, mark=None):
    with open(path, "ab") as sink:
        own = ar.Archive(sink, mark)
        for i, text in rows:
            own.add({"page_id": i, "url": f"https://e.com/{i}", "html": text})
    return own.mark


def read(spark, folder, **options):
    ar.register(spark)
    return spark.read.format(ar.FORMAT).options(**options).load(str(folder))


@given(st.lists(st.binary(max_size=300), max_size=12), st.integers(1, 400), st.integers(0, 200))
@settings(max_examples=60, deadline=None)
def test_every_record_lies_in_one_stretch(tmp_path_factory, bodies, split, torn):
    path = str(tmp_path_factory.mktemp("a") / f"x{ar.SUFFIX}")
    rows = [(i, b.hex()) for i, b in enumerate(bodies)]
    mark = append(path, rows)
    size = os.path.getsize(path)
    append(path, [(99, "cut")], mark)
    os.truncate(path, min(os.path.getsize(path) - 1, size + torn))
    files, name = ar.place(path)
    with files.open_input_file(name) as source:
        end = ar.whole_end(source, mark, os.path.getsize(path))
    assert end == size
    found = [p for at in range(ar.HEAD, end, split)
             for p in ar.payloads(files, ar.Stretch(name, at, min(at + split, end)))]
    got = [r for b in ar.record_batches(iter(found), pa.schema([("page_id", pa.int64()), ("html", pa.string())]))
           for r in b.to_pylist()]
    assert got == [{"page_id": i, "html": t} for i, t in rows]


def test_round_trip_in_splits(spark, tmp_path):
    long = "<p>" + "".join(f"word{i} " for i in range(200_000)) + "é\x00\U0001F600</p>"
    rows = [(1, "u", long), (2, None, ""), (None, "", None), (2, None, ""), (4, "ü\n\"", "\\u0041")]
    df = spark.createDataFrame(rows * 3, KIND).repartition(1)
    ar.register(spark)
    df.write.format(ar.FORMAT).mode("append").save(str(tmp_path / "a"))
    assert [n for n in os.listdir(tmp_path / "a") if not n.endswith(ar.SUFFIX)] == []
    back = read(spark, tmp_path / "a", split_bytes=100_000)
    assert back.rdd.getNumPartitions() > 3
    assert Counter(map(tuple, back.collect())) == Counter(rows * 3)


def test_columns_modes_and_empty_tables(spark, tmp_path):
    path = str(tmp_path / "a")
    assert read(spark, path).count() == 0
    df = spark.createDataFrame([(1, True, 0.5)], "page_id long, ok boolean, share double")
    ar.register(spark)
    df.limit(0).write.format(ar.FORMAT).mode("append").save(path)
    assert read(spark, path).count() == 0
    for mode, n in (("append", 1), ("append", 2), ("overwrite", 1)):
        df.write.format(ar.FORMAT).mode(mode).save(path)
        assert read(spark, path).count() == n
    got = spark.read.format(ar.FORMAT).schema("share double, missing string, ok boolean").load(path)
    assert [tuple(r) for r in got.collect()] == [(0.5, None, True)]


def test_damage_is_named(spark, tmp_path):
    path = tmp_path / f"x{ar.SUFFIX}"
    append(path, [(i, "text " * 50) for i in range(5)])
    raw = bytearray(path.read_bytes())
    raw[ar.HEAD + ar.FRAME + 5] ^= 1
    path.write_bytes(raw)
    with pytest.raises(PySparkException, match=f"record at byte {ar.HEAD} is damaged"):
        read(spark, tmp_path).collect()
    path.write_bytes(b"something else entirely, and long enough")
    with pytest.raises(PySparkException, match="not a page archive"):
        read(spark, tmp_path).collect()


def test_failed_write_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "a")
    ar.register(spark)
    bad = spark.range(100).select(F.when(F.col("id") < 90, F.col("id")).otherwise(F.raise_error(F.lit("lost"))).alias("page_id"))
    with pytest.raises(PySparkException):
        bad.write.format(ar.FORMAT).mode("append").save(path)
    assert read(spark, path).count() == 0


def test_stream_follows_a_growing_file(spark, tmp_path):
    folder, target, log = tmp_path / "a", str(tmp_path / "out"), str(tmp_path / "log")
    folder.mkdir()
    path = folder / f"x{ar.SUFFIX}"
    ar.register(spark)

    def run():
        source = spark.readStream.format(ar.FORMAT).option("split_bytes", 200).load(str(folder))
        loads.incremental_append(source, target, log).awaitTermination()
        return sorted(r.page_id for r in spark.read.schema(KIND).parquet(target).collect())

    mark = append(path, [(i, "first " * i) for i in range(6)])
    assert run() == list(range(6))
    append(path, [(6, "half")], mark)
    whole = path.read_bytes()
    os.truncate(path, len(whole) - 3)
    append(folder / f"y{ar.SUFFIX}", [(10, "other file")])
    assert run() == [*range(6), 10]
    path.write_bytes(whole)
    append(path, [(7, "after")], mark)
    assert run() == [*range(8), 10]
    assert run() == [*range(8), 10]
