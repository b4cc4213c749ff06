import numpy as np
import pytest
from pyspark.sql import functions as F

from silverline.llm import neighbours


def brute(rows, k):
    rows = {i: np.array(v, float) for i, v in rows if i is not None and v is not None and None not in v
            and np.isfinite(v).all() and any(v)}
    kind = max({len(v) for v in rows.values()}, key=lambda n: (sum(len(v) == n for v in rows.values()), -n))
    rows = {i: v for i, v in rows.items() if len(v) == kind}
    out = []
    for q in sorted(rows):
        if q % 20 == 0:
            near = sorted((-float(np.dot(rows[q], v)), i) for i, v in rows.items() if i != q)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(near)]
    return out


def run(spark, rows, k=5):
    df = spark.createDataFrame([(i, v, "x") for i, v in rows],
                               "vec_id long, embedding array<float>, cell string")
    got = neighbours.nearest(df, F.col("vec_id") % 20 == 0, k=k).orderBy("query_id", "rank").collect()
    return [(r.query_id, r["rank"], r.vec_id, r.score) for r in got]


def test_cases_and_ties(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 4)]) for i in range(1, 90)]
    rows += [(100 + i, [1.0, 1.0, 0.0, 0.0]) for i in range(60)]
    rows += [(200, None), (220, [0.0] * 4), (240, [1.0, None, 0.0, 0.0]), (260, [float("nan"), 1.0, 0.0, 0.0]),
             (280, [float("inf"), 1.0, 0.0, 0.0]), (300, [1.0, 2.0]), (None, [1.0] * 4), (320, [])]
    rows += [rows[19], rows[19]]
    got, want = run(spark, rows), brute(rows, 5)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want], atol=1e-12, rtol=0)


@pytest.mark.parametrize("rows", [[], [(20, [1.0, 0.0])], [(20, [1.0, 0.0]), (1, [0.5, 1.0])]])
def test_few_rows(spark, rows):
    assert [g[:3] for g in run(spark, rows)] == ([(20, 1, 1)] if len(rows) == 2 else [])


def test_recall_on_the_given_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in df.collect()]
    want = {(q, i) for q, _, i, _ in brute(rows, 20)}
    found = neighbours.nearest(df, F.col("vec_id") % 20 == 0)
    got = {(r.query_id, r.vec_id) for r in found.collect()}
    assert len(got) == len(want) and len(got & want) / len(want) >= 0.9


def test_chi_square():
    assert abs(float(neighbours.chance_within(np.array([15.5073]), 8)[0]) - 0.95) < 1e-5
    assert abs(float(neighbours.chance_within(np.array([36.4150]), 24)[0]) - 0.95) < 1e-5
    assert abs(neighbours.reach(8, 0.95) - 15.5073) < 1e-3


def test_projected_distances_follow_the_distribution():
    rng = np.random.default_rng(3)
    x, q = rng.standard_normal((100, 12)), rng.standard_normal((1, 12))
    top = float((x ** 2).sum(axis=1).max())
    within = []
    for seed in range(600):
        space = neighbours.Space.make(12, top, seed=seed)
        far = ((space.candidates(x) - space.queries(q)) ** 2).sum(axis=1)
        within.append(np.mean(far <= neighbours.reach() * space.squared(q, (x @ q.T)[:, 0])))
    assert abs(np.mean(within) - neighbours.SURE) < 0.02


def test_search_verifies_what_the_test_does_not_rule_out():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((60, 64))[rng.integers(0, 60, 6000)] + 0.25 * rng.standard_normal((6000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    q, k = x[::40], 20
    true = np.argsort(-(q @ x.T), axis=1, kind="stable")[:, :k]
    rows, scores, verified = neighbours.search(
        neighbours.Space.make(64, 1 + 1e-9), x, np.arange(len(x)), q, np.full(len(q), -np.inf), k)
    found = [len(set(r) & set(t)) for r, t in zip(rows, true)]
    assert sum(found) / true.size >= 0.95 and verified < len(q) * len(x) / 2
    assert np.allclose(scores, np.einsum("qd,qkd->qk", q, x[rows]), atol=1e-12)
    assert (np.diff(scores, axis=1) <= 0).all()


def test_blocks_hold_queries_of_near_cells(spark):
    queries = spark.range(4000).select(
        F.col("id").alias("query"), F.array(F.lit(1.0)).alias("vec"), F.lit(0.0).alias("least"),
        F.when(F.col("id") < 1500, 3).otherwise(F.col("id") % 50).cast("long").alias("home"))
    rows = neighbours.blocked(queries, 100).collect()
    held, homes = {}, {}
    for r in rows:
        held[r.block] = held.get(r.block, 0) + 1
        homes.setdefault(r.block, set()).add(r.home)
    assert len(rows) == 4000 and max(held.values()) < 200 and len(held) == 40
    assert all(max(h) - min(h) <= 3 for h in homes.values())


def test_many_blocks_give_the_same_answers(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(i, [float(v) for v in rng.integers(-2, 3, 4)]) for i in range(1, 400)]
    one = run(spark, rows)
    monkeypatch.setattr(neighbours, "QUERIES_A_BLOCK", 3)
    assert run(spark, rows) == one
