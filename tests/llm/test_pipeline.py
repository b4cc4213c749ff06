import sys
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path[:0] = [str(Path(__file__).resolve().parents[2] / x) for x in ("", "tools")]
import __spark_entry__ as entry  # noqa: E402
import check  # noqa: E402
import corpus_pipeline  # noqa: E402
from silverline.llm import mixing, packing, toxicity  # noqa: E402
from silverline.llm.queries import ORACLES, QUERIES  # noqa: E402
from test_line_dedup import brute as brute_lines  # noqa: E402
from test_jaccard import brute as brute_near  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, name):
    note, ok = check.compare(spark, check.connect(DATA), name, QUERIES[name], ORACLES[name], DATA)
    assert ok, note


def test_all_are_registered():
    names = entry.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13
    assert "pipeline" in names


def test_each_stage_against_plain_python(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, outs = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, outs[-1], DATA)
        outs.append(spark.createDataFrame(out.collect(), out.schema))
    given, clean, lined, single, mixed, packed = ([tuple(r) for r in o.collect()] for o in outs)
    assert all(o.columns == columns for o in outs[:-1])

    rows = toxicity.training_rows(docs, spark.read.parquet(f"{DATA}/labels.parquet"),
                                  ~corpus_pipeline.held_out(F.col("doc_id")))
    scores = toxicity.fit(rows).scores([r[1] for r in given])
    assert Counter(clean) == Counter(r for r, s in zip(given, scores) if s < toxicity.THRESHOLD)

    want = {i: t for i, t, _, _ in brute_lines([r[:2] for r in clean])}
    assert sorted(lined) == sorted((r[0], want[r[0]], r[2], r[3], len(want[r[0]])) for r in clean)

    firsts = {i for i, _ in brute_near([r[:2] for r in lined])[0]}
    assert sorted(single) == sorted(r for r in lined if r[0] in firsts)

    taken = {r.doc_id: r.taken / r.size for r in mixing.mix(outs[3]).taken().collect() if r.size}
    copies = Counter(mixed)
    assert copies.keys() <= set(single)
    assert all(abs(copies[r] - taken.get(r[0], 0)) < 1 for r in single)

    words = Counter()
    for r in packed:
        words[r[0]] += r[3]
    sizes = Counter()
    for r in mixed:
        sizes[r[0]] += len(r[1].encode().split())
    assert words == +sizes
    assert all(r[3] <= r[5] and r[5] in packing.LENGTHS for r in packed)


CLASHES = ["score", "rest", "whole", "kept_text", "n_lines", "n_dropped", "row", "doc", "size", "start", "slot", "sid",
           "block", "_id", "_source", "_copies", "_copy", "_words", "_size", "_row", "target", "root", "rank", "text_", "a.b"]


@pytest.mark.parametrize("empty", [False, True])
def test_stages_with_clashing_names_null_ids_and_empty_tables(spark, tmp_path, empty):
    rows = [(1, "the first line of a text\nshared line of many", "a"), (2, "shared line of many\nand one more line", "b"),
            (None, "a document without an id " * 9, "a"), (None, None, None), (5, "", "b"),
            (6, "a document without an id " * 9, None), (6, "same id and another text " * 3, "a")]
    full = [(*r, *[f"{c}{n}" for c in CLASHES]) for n, r in enumerate(rows)]
    names = ", ".join(f"`{c}` string" for c in CLASHES)
    docs = spark.createDataFrame([] if empty else full, f"doc_id long, text string, source string, {names}")
    spark.createDataFrame([(1, 0)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, out, str(tmp_path))
        out = spark.createDataFrame(out.collect(), out.schema)
        if name == "packing":
            break
        assert out.columns == docs.columns, name
        left = {tuple(r[3:]) for r in out.collect()}
        assert left <= {r[3:] for r in full} and bool(left) != empty, name
        assert name not in ("toxicity", "line_dedup") or out.count() == docs.count()
