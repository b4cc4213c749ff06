import math
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from silverline.llm import langid
from silverline.llm.common import held_out


def test_held_out_rows_are_recognised(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(docs, ~held_out(F.col("doc_id")))
    pred = {r.doc_id: r for r in langid.identify(docs, model).collect()}
    rows = [r for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    right = [pred[r.doc_id].lang_pred == r.lang for r in rows]
    assert sum(right) / len(right) > 0.98
    assert all(0 <= r.score <= 1 for r in pred.values())
    far = model.predict("zzqx jjkw qqqq xxzz wvwv")
    assert far[2] and far[0] in model.lang


def test_cases(docs):
    en, de = "the cat and the dog were in the house ", "der hund und die katze sind im haus "
    rows = [(i, (en if i % 2 else de) * 5) for i in range(20)]
    cases = [(50, None), (51, ""), (52, "123 ... !"), (53, "ŋ"), (54, en * 40000), (55, "x"), (55, "x"), (None, de)]
    df = docs(rows + cases, lang=["en" if i % 2 else "de" for i in range(20)] + [None] * len(cases))
    model = langid.fit(df, F.lit(True))
    got = langid.identify(df, model).collect()
    assert len(got) == 28
    pred = {r.doc_id: r.lang_pred for r in got}
    assert [pred[i] for i in (50, 51, 52, 54, None)] == ["und", "und", "und", "en", "de"]
    assert pred[53] in ("en", "de") and pred[0] == "de" and pred[1] == "en"
    none = langid.fit(docs([]), F.lit(True))
    assert [r.lang_pred for r in langid.identify(docs([(1, "text")]), none).collect()] == ["und"]
    assert langid.identify(docs([]), model).collect() == []


def test_blocks_count_every_gram_once(monkeypatch):
    text = "".join(chr(97 + i * i % 26) if i % 7 else " " for i in range(1000))
    whole = langid.gram_counts(text)
    monkeypatch.setattr(langid, "BLOCK", 64)
    assert np.array_equal(whole, langid.gram_counts(text)) and whole.sum() == 1000 + 999 + 998


def plain_fit(rows, per_language, k):
    """TF-IDF vectors and spherical k-means as loops over dictionaries, from (id, text, lang)."""
    def grams(text):
        return {g: n for g, n in enumerate(langid.gram_counts(text)) if n}

    bags = [(i, grams(t), x) for i, t, x in rows]
    held = Counter(g for _, b, _ in bags for g in b)
    idf = {g: math.log((1 + len(bags)) / (1 + n)) + 0.1 for g, n in held.items()}
    unit = lambda v: {g: x / (sum(y * y for y in v.values()) ** 0.5 or 1) for g, x in v.items()}
    dot = lambda a, b: sum(x * b.get(g, 0) for g, x in a.items())
    out = {}
    for lang in {x for *_, x in bags}:
        own = sorted((langid.hash_order(i), n) for n, (i, _, x) in enumerate(bags) if x == lang)
        points = [unit({g: n ** 0.5 * idf[g] for g, n in bags[n][1].items()}) for _, n in own]
        centres = [points[int(j)] for j in np.linspace(0, len(points) - 1, min(k, len(points)))]
        for _ in range(8):
            best = [max(range(len(centres)), key=lambda c: (dot(p, centres[c]), -c)) for p in points]
            sums = []
            for c in sorted(set(best)):
                total = Counter()
                for p, b in zip(points, best):
                    if b == c:
                        total.update(p)
                sums.append(unit(total))
            centres = sums
        out[lang] = centres
    return idf, out


def test_against_a_plain_version(docs):
    rng = np.random.default_rng(8)
    parts = {"en": "the and house with river of", "de": "der und haus mit fluss von", "fr": "le et maison avec eau de"}
    rows = [(i, " ".join(rng.choice(parts[x].split(), 12)) + f" {'qzx'[i % 3] * 3}", x)
            for i, x in enumerate(rng.choice(list(parts), 60))]
    model = langid.fit(docs([r[:2] for r in rows], lang=[r[2] for r in rows]), F.lit(True), centroids=2)
    idf, want = plain_fit(rows, 400, 2)
    assert all(abs(model.idf[g] - v) < 1e-9 for g, v in idf.items())
    for lang, centres in want.items():
        got = [r for r, x in zip(model.rows, model.lang) if x == lang]
        dense = [np.array([c.get(g, 0) for g in range(langid.DIM)]) for c in centres]
        assert len(got) == len(dense) and all(min(np.abs(g - d).max() for g in got) < 1e-4 for d in dense)
    for _, text, _ in rows[:20]:
        assert model.predict(text)[0] == max(sorted(want), key=lambda x: max(
            float(np.dot(model.vector(text), [c.get(g, 0) for g in range(langid.DIM)])) for c in want[x]))


def test_languages_of_long_texts_only_and_many_languages(docs):
    long = "кот собака дом река лес " * 2000
    rows = [(i, "the cat and the dog " * 5) for i in range(10)] + [(100 + i, long) for i in range(3)]
    model = langid.fit(docs(rows, lang=["en"] * 10 + ["ru"] * 3), F.lit(True))
    assert model.predict("кот и собака")[0] == "ru"
    rows = [(i, f"word{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]} " * 20) for i in range(400)]
    many = langid.fit(docs(rows, lang=[f"l{i % 200}" for i in range(400)]), F.lit(True))
    assert len(set(many.lang)) == 200
