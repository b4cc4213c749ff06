from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest_llm import prose
from silverline.llm import substrings


def brute(texts, window):
    words = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    kept = []
    for w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        kept.append(b" ".join(x for i, x in enumerate(w) if i not in gone).decode())
    return kept


def check(docs, rows, window):
    got = substrings.dedup_substrings(docs(rows), window=window).collect()
    want = sorted(zip([i for i, _ in rows], brute([t for _, t in rows], window)), key=repr)
    assert sorted([(r.doc_id, r.kept_text) for r in got], key=repr) == want
    counts = Counter((r.doc_id, r.n_words) for r in got)
    assert counts == Counter((i, len((t or "").encode().split())) for i, t in rows)


@pytest.mark.parametrize("window", [7, 35])
def test_planted_passages(docs, window):
    rng = np.random.default_rng(window)
    shared = prose(rng, 60)
    rows = [(i, prose(rng, int(rng.integers(0, 200)))) for i in range(20)]
    rows += [(20 + i, f"{prose(rng, 30)} {shared} {prose(rng, 40)}") for i in range(15)]
    words = shared.split()
    rows += [(50 + i, " ".join(words[i:i + window + i % 3 - 1])) for i in range(12)]
    rows += [(70, " ".join(["in"] * 90)), (71, " ".join(["in", "on"] * 60)), (72, " ".join(["in"] * 36))]
    rows += [(80, rows[3][1]), (81, rows[3][1] + " end")]
    check(docs, rows, window)


def test_cases(docs):
    rng = np.random.default_rng(3)
    text = prose(rng, 50)
    check(docs, [(1, None), (2, ""), (3, " \n\t "), (4, text), (4, text), (4, prose(rng, 60)),
                 (None, text + " x"), (None, "a b"), (5, "é ü " * 80), (6, "a b")], 35)
    assert substrings.dedup_substrings(docs([])).collect() == []


def test_long_texts_are_read_in_stretches(docs):
    rng = np.random.default_rng(5)
    shared, giant = prose(rng, 100), "z" * (substrings.BLOCK + 9)
    rows = [(i, f"{prose(rng, substrings.STRETCH - 40 - i)} {shared} {giant} {prose(rng, 9000)}")
            for i in range(2)]
    ids = {}
    for _, t in rows:
        own = substrings.Reader().words(t.encode()).tolist()
        assert len(own) == len(t.split())
        assert all(ids.setdefault(w, i) == i for w, i in zip(t.split(), own))
    assert len(set(ids.values())) == len(ids)
    check(docs, rows, 35)


def test_support_decides_a_symbol():
    """A symbol whose support lies in a stretch is found wherever the stretch stands."""
    rng = np.random.default_rng(1)
    part = rng.integers(1, 50, 60).astype(np.uint64)
    places = []
    for n in (3, 8):
        whole = np.concatenate([[substrings.END], rng.integers(1, 50, n).astype(np.uint64), part,
                                rng.integers(1, 50, n).astype(np.uint64), [substrings.END]])
        places.append({(k, int(s), int(a) - n - 1) for k, (sym, low, high) in
                       enumerate(substrings.parse(whole)) for s, a, b in zip(sym, low, high)
                       if a >= n + 1 and b <= n + 1 + 60})
    assert places[0] == places[1] and max(k for k, _, _ in places[0]) == len(substrings.ROUNDS)


def test_rows_with_null_ids_are_told_apart(spark, docs):
    """Two texts with one 24-bit hash, by which rows were once told apart, and one id."""
    rng = np.random.default_rng(8)
    passage = prose(rng, 40)
    texts = spark.range(20000).select(F.concat(F.lit("own"), "id", F.lit(" "), F.lit(passage)).alias("text"))
    pair = (texts.groupBy(F.pmod(F.xxhash64("text", F.lit(True)), F.lit(1 << 24)).alias("tag"))
            .agg(F.collect_list("text").alias("texts")).filter("size(texts) > 1").first())
    one, two = pair.texts[:2]
    check(docs, [(None, one), (None, two), (None, "short")], 35)
    spare = (spark.range(20000).select(F.concat(F.lit("w"), "id").alias("text"))
             .union(spark.range(20000).select(F.concat(F.lit("q"), "id", F.lit(" "), F.lit(passage))))
             .groupBy(F.pmod(F.xxhash64("text", F.lit(True)), F.lit(1 << 24)).alias("tag"))
             .agg(F.min("text").alias("long"), F.max("text").alias("short"))
             .filter("long like 'q%' and short like 'w%'").first())
    check(docs, [(None, spare.long), (None, spare.short), (1, passage)], 35)


def test_windows_wider_than_a_byte(docs):
    rng = np.random.default_rng(6)
    shared = prose(rng, 900)
    check(docs, [(i, f"{prose(rng, 50)} {shared} {prose(rng, 50)}") for i in range(3)], 400)
