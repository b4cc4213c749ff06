import hashlib
import math
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from conftest_llm import prose
from silverline.llm import resampling

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def features(text, longest):
    words = WORDS.findall((text or "").translate(LOWER))
    return words, [" ".join(words[i:i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def brute(rows, target, longest, buckets, least, share, seed):
    """(doc_id, n_words, n_features, weight, score, rank) by the definition."""
    of = lambda f: zlib.crc32(f.encode()) % buckets
    found = [(i, *features(t, longest)) for i, t in rows]
    s = Counter(of(f) for _, _, own in found for f in own)
    t = Counter(of(f) for x in target for f in features(x, longest)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log(
        float(t[b] + 1) * (big_s + buckets) / (float(s[b] + 1) * (big_t + buckets))))
    out = []
    for i, words, own in found:
        weight = math.floor(Fraction(sum(gain(of(f)) for f in own), len(own))) if own else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000.0 * math.log(-math.log((h + 0.5) / 4294967296.0)))
        out.append([i, len(words), len(own), weight, weight + noise, None])
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for n, r in enumerate(able[:share[0] * len(able) // share[1]], 1):
        r[5] = n
    return out


@pytest.mark.parametrize("longest, buckets, share", [(1, 10_000, (10, 100)), (3, 97, (1, 2)), (2, 100_003, (1, 1))])
def test_against_the_definition(spark, docs, longest, buckets, share):
    rng = np.random.default_rng(longest)
    rows = [(i, prose(rng, int(rng.integers(0, 70)))) for i in range(90)]
    rows += [(200, None), (201, ""), (202, "Été 12 ÄB-cd_x" * 30), (203, "w" * 3000 + " end"), (204, "\x00\x7f!")]
    target = [prose(rng, 40).replace("the", "été") for _ in range(5)] + [None, ""]
    df = spark.createDataFrame([(t,) for t in target], "text string")
    got = resampling.resample(docs(rows), df, longest=longest, buckets=buckets, share=share)
    want = brute(rows, target, longest, buckets, 20, share, "2024")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want))
    assert any(r[5] for r in want)


def test_crcs_of_all_runs():
    rng = np.random.default_rng(1)
    words = [bytes(rng.integers(97, 123, int(n), np.uint8)) for n in rng.integers(1, 90, 60)]
    want = [zlib.crc32(b" ".join(words[i:i + n])) for n in range(1, 8) for i in range(len(words) - n + 1)]
    assert resampling.feature_crcs(words, 7).tolist() == want
    assert resampling.feature_crcs([b"one"], 3).tolist() == [zlib.crc32(b"one")]
    assert resampling.feature_crcs([], 3).tolist() == []


def test_shift_is_that_of_combined_crcs():
    for size in (0, 1, 7, 8, 300, 70_000, 5_000_001):
        a, b = b"first part", bytes(size)
        crc = resampling.shift(np.array([zlib.crc32(a)], np.uint32), np.array([size]))[0]
        assert int(crc) ^ zlib.crc32(b) == zlib.crc32(a + b)


def test_null_ids_repeated_rows_and_empty_tables(spark, docs):
    rng = np.random.default_rng(7)
    text = prose(rng, 30)
    rows = [(None, text), (None, text), (5, text), (5, text), (6, prose(rng, 30)), (7, "few words")]
    empty = spark.createDataFrame([], "text string")
    got = resampling.resample(docs(rows), empty, share=(1, 1)).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == [1, 2, 3, 4, 5]
    want = brute(rows, [], 1, 10_000, 20, (1, 1), "2024")
    assert Counter((r[0], *r[3:5]) for r in got) == Counter((r[0], *r[3:5]) for r in want)
    assert resampling.resample(docs([]), empty).collect() == []


def test_ties_go_to_the_smaller_id(spark, docs, monkeypatch):
    from pyspark.sql import functions as F
    monkeypatch.setattr(resampling, "_noise", lambda doc_id, seed: F.lit(0).cast("long"))
    text = " ".join(["same"] * 25)
    got = resampling.resample(docs([(i, text) for i in (9, 3, 5, None, 1)]),
                              spark.createDataFrame([("same",)], "text string"), share=(4, 5)).collect()
    assert {r.doc_id: r["rank"] for r in got} == {1: 1, 3: 2, 5: 3, 9: 4, None: None}
