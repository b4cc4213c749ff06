"""Mergeable summaries, filtered resume, keyword automata and roll-ups against plain definitions."""

import random
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from silverline.functions import text as t
from silverline.operators import aggregates as ag, joins, keywords, resume, sketches as sk
from silverline.queries import ORACLES, QUERIES, summaries

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))
import check  # noqa: E402
from given import DATA  # noqa: E402


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_the_automaton_takes_one_text_at_a_time(spark):
    texts = spark.createDataFrame([("ab c",), ("x",), (None,), ("",)], "v string")
    found = keywords.tag_texts(texts, "v", {"one": ["b"], "two": ["c"]}, "tags")
    assert "ArrowEvalPython" in found._jdf.queryExecution().executedPlan().toString()
    assert not hasattr(keywords, "pd")  # no worker loads pandas or holds a batch as Python texts
    assert [r.tags for r in found.collect()] == ["one|two", None, None, None]


# ---- Distinct keys ----

def test_merged_sketches_are_close_to_exact_counts(spark):
    rows = spark.range(300_000).select((F.col("id") % 7).alias("batch"), F.when(F.col("id") % 50 != 0, F.col("id") % 90_001).alias("k"))
    sketches = sk.key_sketches(rows, ["batch"], "k").cache()
    merged = sk.merge_key_sketches(sketches, []).select("n_rows", "n_null", sk.n_keys("keys").alias("n")).first()
    exact = ag.distinct_keys(rows, ["k"]).first().n_k
    assert (merged.n_rows, merged.n_null) == (300_000, 6_000)
    assert abs(merged.n - exact) <= 4 * exact / 2 ** (sk.SIZE / 2)


def test_keys_not_seen_before(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (1, "b"), (2, "b"), (2, "c"), (2, None), (3, None)], "g int, k string")
    s = sk.key_sketches(df, ["g"], "k")
    one = s.filter("g = 1").select(F.col("keys").alias("earlier"))
    got = {r.g: (r.n_rows, r.n_null, r.n, r.fresh) for r in s.join(one).select(
        "g", "n_rows", "n_null", sk.n_keys("keys").alias("n"), sk.n_new_keys(F.col("keys"), F.col("earlier")).alias("fresh")).collect()}
    assert got == {1: (3, 0, 2, 0), 2: (3, 1, 2, 1), 3: (1, 1, 0, 0)}
    assert sk.key_sketches(df.limit(0), ["g"], "k").count() == 0


def test_slices_count_more_keys_than_a_sketch_holds(spark):
    rows = spark.range(90_000).select((F.col("id") % 6).alias("batch"), F.when(F.col("id") % 50 != 0, F.col("id") % 40_009).alias("k"))
    slices = sk.exact_slices(rows, [], 10)
    sliced = sk.merge_key_sketches(sk.key_sketches(rows, ["batch"], "k", 10, slices), ["slice"], 10)
    got = sliced.agg(F.sum("n_rows"), F.sum("n_null"), F.sum(sk.n_keys("keys"))).first()
    assert tuple(got) == (90_000, 1_800, ag.distinct_keys(rows, ["k"]).first().n_k)
    assert sk.exact_slices(rows.limit(0), [], 10) == 1


@pytest.mark.parametrize("name", ["distinct_keys_merged", "new_keys_by_year"])
def test_queries_over_keys_are_exact_beyond_one_sketch(spark, tmp_path, monkeypatch, name):
    con = check.connect(DATA)
    con.execute(f"COPY (SELECT o.* REPLACE (o_custkey * 100 + i AS o_custkey) FROM orders o, range(100) r(i)) "
                f"TO '{tmp_path}/orders.parquet'")
    con.execute(f"CREATE OR REPLACE VIEW orders AS SELECT * FROM '{tmp_path}/orders.parquet'")
    monkeypatch.setattr(summaries, "SIZE", 10)
    note, ok = check.compare(spark, con, name, QUERIES[name], ORACLES[name], str(tmp_path))
    assert ok, note


# ---- Profiles ----

def test_merged_profile_keeps_ranks(spark):
    rng = random.Random(5)
    values = [rng.gauss(0, 10) for _ in range(60_000)]
    rows = [(i % 9, v if i % 10 else None, float("nan") if i % 3 else 1.0) for i, v in enumerate(values)]
    months = sk.column_profile(spark.createDataFrame(rows, "b int, x double, y double"), ["b"], ["x", "y"])
    got = {r.column: r for r in sk.with_quantiles(sk.merge_profiles(months, []), {"p10": .1, "median": .5, "p99": .99}).collect()}
    known = sorted(v for i, v in enumerate(values) if i % 10)
    assert (got["x"].n_rows, got["x"].n_null, got["x"].least, got["x"].greatest) == (60_000, 6_000, known[0], known[-1])
    for name, share in {"p10": .1, "median": .5, "p99": .99}.items():
        rank = sum(v <= got["x"][name] for v in known) / len(known)
        assert abs(rank - share) < 4 * 2.3 / sk.K ** .9
    assert (got["y"].n_null, got["y"].median) == (40_000, 1.0)


def test_drift_of_batches(spark):
    df = spark.createDataFrame(
        [("a", float(i), None) for i in range(1000)] + [("b", float(i + 500) if i % 2 else None, None) for i in range(1000)],
        "g string, x double, z double")
    p = sk.column_profile(df, ["g"], ["x", "z"])
    a, b = (p.filter(F.col("g") == g).drop("g") for g in "ab")
    got = {r.column: (r.null_change, r.distance) for r in sk.drift(a, b, []).collect()}
    assert got["x"] == (.5, pytest.approx(.5, abs=.03)) and got["z"] == (0, None)
    assert {r.column: r.distance for r in sk.drift(a, a, []).collect()} == {"x": 0, "z": None}
    assert [r.distance for r in sk.drift(a, b.limit(0), []).collect()] == [None, None]


# ---- Resume ----

TODO = "name string, k long, _block int"


@pytest.mark.parametrize("fn", [joins.skip_done, resume.skip_done_filtered])
def test_skip_done_keeps_columns_in_place(spark, fn):
    todo = spark.createDataFrame([("a", 1, 0), ("a", 1, 0), ("b", 2, 0), ("c", None, 0), ("c", None, 0)], TODO)
    done = spark.createDataFrame([(2,), (2,), (None,), (9,)], "k long")
    want = [("a", 1, 0), ("a", 1, 0), ("c", None, 0), ("c", None, 0)]
    got = fn(todo, done, "k")
    assert got.columns == todo.columns and _rows(got) == sorted(want, key=repr)
    assert _rows(fn(todo, done.limit(0), "k")) == _rows(todo) and fn(todo.limit(0), done, "k").count() == 0


def _nodes(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_suspects_are_shuffled(spark):
    todo = spark.range(200_000).select(F.concat(F.lit("k"), "id").alias("k"), F.lit("x").alias("v"))
    done = spark.range(0, 2_000_000, 100).select(F.concat(F.lit("k"), "id").alias("k"))
    suspects, fresh = resume.split_suspects(todo, done, "k", done.count() // resume.KEYS_A_BLOCK + 1)
    assert 2_000 <= suspects.count() <= 2_000 + 0.02 * 200_000  # done ones, and a few false alarms
    assert suspects.join(done, "k", "left_semi").count() == 2_000 and fresh.join(done, "k", "left_semi").count() == 0
    plan = _nodes(fresh)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert resume.skip_done_filtered(todo, done, "k").count() == 198_000


def test_too_many_keys_or_other_types_take_the_plain_join(spark):
    todo, done = spark.range(100).toDF("k"), spark.range(50).toDF("k")
    for got in (resume.skip_done_filtered(todo, done, "k", max_blocks=1),
                resume.skip_done_filtered(todo, done.select(F.col("k").cast("int")), "k")):
        assert got.count() == 50 and "bit_or" not in _nodes(got)


# ---- Keywords ----

def test_automaton_gives_the_tags_of_the_plain_rule(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcé ") for _ in range(rng.randint(1, 4)))
    rules = {f"r{i}": [word() for _ in range(3)] for i in range(12)} | {"same": ["ab", "ab"], "twin": ["ab"]}
    texts = [None, "", "AB", "xyz", *("".join(rng.choice("ABCabcé x") for _ in range(rng.randint(0, 30))) for _ in range(200))]
    df = spark.createDataFrame([(x,) for x in texts], "s string")
    got = keywords.tag_texts(df, "s", rules, "tags").withColumn("want", t.keyword_tags("s", rules))
    assert [r for r in got.collect() if r.tags != r.want] == []


def test_ten_thousand_words_and_the_limit(spark):
    rules = {f"r{i:05d}": [f"word{i:05d}"] for i in range(10_000)}
    df = spark.createDataFrame([("x word00007 word09999y",), ("word1",)], "s string")
    assert [r.tags for r in keywords.tag_texts(df, "s", rules, "tags").collect()] == ["r00007|r09999", None]
    assert [r.tags for r in keywords.tag_texts(df, "s", {"all": [""]}, "tags").collect()] == ["all", "all"]
    assert [r.tags for r in keywords.tag_texts(df, "s", {}, "tags").collect()] == [None, None]
    with pytest.raises(ValueError):
        keywords.tag_texts(df, "s", {"long": ["x" * (keywords.MAX_CHARS + 1)]}, "tags")


# ---- Roll-up ----

def test_rollup_tells_null_keys_from_totals(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", None, 7), (None, None, None), (None, 2, 1)], "p string, q int, v int")
    got = _rows(ag.rollup_audit(df, ["p", "q"], {"v": F.col("v")}))
    assert got == sorted([("a", 1, 0, 1, 5), ("a", None, 0, 1, 7), (None, None, 0, 1, None), (None, 2, 0, 1, 1),
                          ("a", None, 1, 2, 12), (None, None, 1, 2, 1), (None, None, 3, 4, 13)], key=repr)
    assert _rows(ag.rollup_audit(df.limit(0), ["p", "q"], {"v": F.col("v")})) == []
