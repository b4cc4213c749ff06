import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from conftest_llm import prose
from silverline.llm import divergence

LETTERS = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows, least=30, top=50):
    """The audit by its definition, from (text, lang, source)."""
    groups, held = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        found = LETTERS.findall((text or "").translate(LOWER))
        groups[lang or "", source or ""].update(found)
        held[lang or ""].update(set(found))
    out = []
    for lang, docs in held.items():
        kept = sorted(t for t, n in docs.items() if n >= least)
        own = {s: c for (k, s), c in groups.items() if k == lang}

        def shares(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10 ** 9 * (counts[t] + 5) // (total + 5 * len(kept)) for t in kept}

        whole = shares(sum(own.values(), Counter()))
        each = {s: shares(c) for s, c in own.items()}
        for s, p in each.items():
            pairs = [(sum(abs(p[t] - q[t]) for t in kept), o) for o, q in each.items() if o != s]
            terms = [(p[t] - whole[t], t) for t in kept if own[s][t] and p[t] > whole[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
                out += [(lang, s, part, item, v, i) for i, (v, item) in enumerate(found, 1)]
    return sorted(out)


def audited(docs, rows, **kind):
    df = docs([(i, t) for i, (t, _, _) in enumerate(rows)], [x[1] for x in rows], [x[2] for x in rows])
    return sorted(tuple(r) for r in divergence.audit(df, **kind).collect())


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    words = [f"{a}{b}" for a in ("ab", "ä", "straße", "abcdefgh", "abcdefghi", "x" * 16, "x" * 17, "y" * 70)
             for b in ("", "a", "é", "zz")]
    found = []
    for n in range(240):
        own = rng.choice(words, int(rng.integers(0, 40)), p=rng.dirichlet(np.ones(len(words))))
        found.append((" ".join(own) + rng.choice(["", " Ab1ab_AB", "\x00ab"]), rng.choice(["en", "de"]),
                      rng.choice(["web", "news", "Ünits", "web2"], p=[.6, .2, .1, .1])))
    found += [(None, "en", "nulls"), ("", "fr", "only"), ("ab ab", None, "web"), ("ab", None, None),
              ("z" * 5000, "en", None)]
    return found + found[:20]


def test_against_the_definition(docs, rows):
    want = brute(rows)
    assert {r[2] for r in want} == {"pair", "term"} and len({r[0] for r in want}) == 3
    assert audited(docs, rows) == want


def test_small_slices_blocks_and_tiles(docs, rows, monkeypatch):
    monkeypatch.setattr(divergence, "SLICE_BYTES", 300)
    monkeypatch.setattr(divergence, "CELLS", 16)
    monkeypatch.setattr(divergence, "TILE", 2)
    assert audited(docs, rows, least_docs=3, top=2) == brute(rows, 3, 2)


def test_empty_table(docs):
    assert divergence.audit(docs([])).collect() == []


def test_terms_of_every_length_are_counted():
    rng = np.random.default_rng(4)
    words = [bytes(rng.integers(97, 99, n, np.uint8)) for n in rng.integers(1, 22, 3000)]
    texts = [b" ".join(words[i:i + 300]) for i in range(0, 3000, 300)]
    groups = rng.integers(0, 3, len(texts))
    got = {}
    for terms, own, n, docs in divergence.term_counts(texts, groups):
        for t, g, a, b in zip(terms, own.tolist(), n.tolist(), docs.tolist()):
            assert (t, g) not in got
            got[t, g] = a, b
    n, held = Counter(), Counter()
    for text, g in zip(texts, groups.tolist()):
        n.update((w, g) for w in text.split())
        held.update((w, g) for w in set(text.split()))
    assert got == {k: (n[k], held[k]) for k in n}


def test_shares_of_large_counts_are_exact(spark):
    from pyspark.sql import functions as F
    n, total, kept = 8 * 10 ** 12 + 7, 9 * 10 ** 13 + 1, 10 ** 7
    row = spark.range(1).select(F.lit(n).alias("n"), F.lit(total).alias("total"), F.lit(kept).alias("kept"))
    got = row.select(divergence._share("n", "total")).first()[0]
    assert got == 1 + 10 ** 9 * (n + 5) // (total + 5 * kept)


def test_common_prose(docs):
    rng = np.random.default_rng(5)
    rows = [(prose(rng, 30), "en", f"s{i % 5}") for i in range(150)]
    assert audited(docs, rows) == brute(rows)
