from collections import Counter, defaultdict

import numpy as np

from conftest_llm import prose
from silverline.llm import mixing


def brute_targets(sizes):
    names = sorted([s for s in sizes if s is not None]) + [None] * (None in sizes)
    weight = {s: n % 3 + 1 for n, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = sum(weight[s] for s in names if s not in capped)
        level = (total - sum(3 * sizes[s] for s in capped)) / rest if rest else 0
        more = {s for s in names if s not in capped and weight[s] * level > 3 * sizes[s]}
        if not more:
            return {s: 3.0 * sizes[s] if s in capped else weight[s] * level for s in names}
        capped |= more


def test_targets_and_taken(docs):
    rng = np.random.default_rng(0)
    names = ["b"] * 120 + ["a"] * 20 + [None] * 15 + ["é"] * 3 + ["Z"] * 2 + ["c"]
    rows = [(i, prose(rng, int(rng.integers(0, 400)))) for i in range(len(names))]
    rows[3], rows[4], rows[5] = (3, None), (4, ""), (5, " \n")
    rows += [(7, "again and again"), (7, "again and again"), (None, "no id here")]
    names += ["a", "a", "b"]
    df = docs(rows, source=names)
    got = mixing.mix(df).taken().collect()
    sizes = Counter()
    for (_, t), s in zip(rows, names):
        sizes[s] += len((t or "").split())
    want = brute_targets(sizes)
    assert len(got) == len(rows)
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    for s, t in taken.items():
        assert abs(t - want[s]) <= max(4 * mixing.BLOCK, 0.03 * want[s]), (s, t, want[s])
    again = mixing.mix(df.repartition(5)).taken().collect()
    key = lambda r: (str(r.doc_id), str(r.source), r.size, r.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_the_mix_is_even_everywhere(docs):
    rng = np.random.default_rng(1)
    df = docs([(i, prose(rng, 800)) for i in range(60)], source=["a", "b", "c"] * 20)
    plan = mixing.mix(df)
    slots = plan.slots.orderBy("slot").collect()
    for start in range(0, len(slots) - 96, 96):
        share = Counter(r.sid for r in slots[start:start + 96])
        assert all(abs(share[s] - 16 * s) <= 5 for s in (1, 2, 3)), share
    for (sid, epoch), ranks in _by(slots).items():
        assert len(ranks) == len(set(ranks))
    words = sum(r.words for r in plan.filled().collect())
    assert abs(words - 60 * 800) < 0.02 * 60 * 800


def _by(slots):
    out = defaultdict(list)
    for r in slots:
        out[r.sid, r.epoch].append(r.block)
    return out


def test_empty_and_wordless(docs):
    assert mixing.mix(docs([])).taken().collect() == []
    got = mixing.mix(docs([(1, None), (2, "")])).taken().collect()
    assert [(r.size, r.target, r.taken) for r in got] == [(0, 0.0, 0)] * 2


def test_mixed_documents(docs):
    rng = np.random.default_rng(2)
    df = docs([(i, prose(rng, 300)) for i in range(40)] + [(None, prose(rng, 300)), (5, None)],
              source=["a"] * 30 + ["b"] * 10 + [None, "b"])
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    copies = Counter(r.doc_id for r in out.collect())
    taken = {r.doc_id: r.taken / r.size for r in mixing.mix(df).taken().filter("size > 0").collect()}
    assert all(abs(copies[i] - t) < 1 and copies[i] <= 3 for i, t in taken.items())


def test_mixed_documents_lie_in_the_order_of_the_schedule(docs):
    rng = np.random.default_rng(3)
    n = 1200
    names = ["a", "b", "c"] * (n // 3)
    df = docs([(i, prose(rng, int(rng.integers(20, 60)))) for i in range(n)], source=names)
    df = df.select("*", *[df["lang"].alias(c) for c in ("row", "slot", "_row", "_size", "sid", "block", "start")])
    rows = mixing.mixed_documents(df).collect()  # partitions in their order
    assert len(rows) > n - 50 and all(r["slot"] == r["lang"] for r in rows)
    for start in range(0, len(rows) - 200, 200):
        words = Counter()
        for r in rows[start:start + 200]:
            words[r["source"]] += len(r["text"].split())
        total = sum(words.values())
        assert all(abs(words[s] / total - w / 6) < 0.08 for s, w in (("a", 1), ("b", 2), ("c", 3))), (start, words)
    again = [r.doc_id for r in mixing.mixed_documents(df).collect()]
    assert again == [r.doc_id for r in rows]
