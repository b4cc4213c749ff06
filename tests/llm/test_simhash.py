import numpy as np
import xxhash

from conftest_llm import prose
from silverline.llm import simhash
from silverline.llm.components import connected_components


def brute_print(text):
    words = (text or "").encode().lower().split()
    parts = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    prints = [brute_print(t) for _, t in rows]
    label = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(len(rows)):
                if (prints[i] ^ prints[j]).bit_count() <= 2 and label[j] < label[i]:
                    label[i], changed = label[j], True
    first = {}
    for (i, _), k in zip(rows, label):
        if i is not None:
            first[k] = min(first.get(k, i), i)
    return [(i, p, first.get(k)) for (i, _), p, k in zip(rows, prints, label)]


def test_against_brute_force(docs):
    rng = np.random.default_rng(2)
    base = [prose(rng, 300) for _ in range(6)]
    rows = [(i, prose(rng, int(rng.integers(0, 80)))) for i in range(30)]
    for n in range(40):
        words = base[n % 6].split()
        words[int(rng.integers(0, len(words)))] = "changed"
        rows.append((100 + n, " ".join(words)))
    rows += [(200, None), (201, ""), (202, " \n"), (203, "One"), (204, "one"), (205, "a B"), (205, "a b"),
             (None, "one"), (None, base[0]), (None, "alone here now"), (206, "x " * 5000)]
    got = simhash.near_duplicates(docs(rows))
    found = sorted([(r.doc_id, r.fp % (1 << 64), r.component_id) for r in got.collect()], key=repr)
    assert found == sorted(brute_components(rows), key=repr)
    assert simhash.near_duplicates(docs([])).collect() == []


def test_every_pair_within_the_radius_meets():
    masks = simhash.covering_masks(2)
    assert len(masks) == 7
    assert all(any(not m & (1 << i | 1 << j) for m in masks) for i in range(64) for j in range(64))


def test_large_buckets_find_the_same_pairs():
    rng = np.random.default_rng(4)
    mask = simhash.covering_masks(2)[3]
    free = ~mask & (1 << 64) - 1
    bits = [i for i in range(64) if free >> i & 1]
    fps = np.unique(np.array([sum(1 << bits[b] for b in rng.choice(9, rng.integers(0, 6), False))
                              for _ in range(300)], np.uint64))
    small = {tuple(sorted((int(fps[a]), int(fps[b])))) for x, y in simhash._pairs(fps, free, 2)
             for a, b in zip(x, y)}
    simhash.PAIRWISE, old = 1, simhash.PAIRWISE
    try:
        large = {tuple(sorted((int(fps[a]), int(fps[b])))) for x, y in simhash._pairs(fps, free, 2)
                 for a, b in zip(x, y)}
    finally:
        simhash.PAIRWISE = old
    assert small == large and small


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 240)] + [(9, 9), (3, 7)]
    got = {r.node: r.component for r in
           connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(101, 161)} | {i: 3 for i in [7, *range(200, 240)]}


def test_one_of_each(docs):
    rows = [(3, "a b c d"), (1, "a b c d"), (1, "a b c d"), (2, "q r s"), (None, "zz"), (None, "zz")]
    kept = simhash.one_of_each(docs(rows))
    assert kept.columns == docs(rows).columns
    assert sorted([(r.doc_id, r.text) for r in kept.collect()], key=repr) == sorted(
        [(1, "a b c d"), (2, "q r s"), (None, "zz"), (None, "zz")], key=repr)
