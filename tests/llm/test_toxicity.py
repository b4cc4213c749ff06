import zlib

import numpy as np
from pyspark.sql import functions as F

from conftest_llm import prose
from silverline.llm import toxicity
from silverline.llm.common import held_out

BAD = ["grumbolt", "snazzel", "vipkrat", "dolmung"]


def sample(n, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        words = prose(rng, 80).split()
        if i % 3 == 0:
            for _ in range(3):
                words.insert(int(rng.integers(0, 80)), BAD[int(rng.integers(0, 4))])
        rows.append((" ".join(words), int(i % 3 == 0)))
    return rows


def test_subsequence_kernel_is_the_definition():
    def direct(word):
        out = {}
        for i in range(len(word)):
            for j in range(i + 1, len(word)):
                for k in range(j + 1, len(word)):
                    key = word[i] + word[j] + word[k]
                    out[key] = out.get(key, 0) + toxicity.DECAY ** (k - i + 1)
        return out

    marks, found = ["^idiot$", "^clown$"], ["^idxiot$", "^clon$", "^banana$", "^clown$"]
    got, _, _ = toxicity._features(found, marks)
    norm = lambda n: sum(toxicity.DECAY ** (2 * (k - i + 1)) * (k - i - 1)
                         for i in range(n) for k in range(i + 2, n)) ** 0.5
    for row, a in zip(got, found):
        for value, b in zip(row, marks):
            x, y = direct(a), direct(b)
            assert abs(value - sum(x[t] * y[t] for t in x.keys() & y.keys()) / norm(len(a)) / norm(len(b))) < 1e-5


def test_plain_and_disguised_words():
    scorer = toxicity.fit(sample(300))
    fresh = sample(90, seed=5)
    right = [(s >= toxicity.THRESHOLD) == bool(y) for s, (_, y) in zip(scorer.scores([t for t, _ in fresh]), fresh)]
    assert sum(right) == len(right)
    rng = np.random.default_rng(9)
    hidden = [f"{prose(rng, 20)} {w} {prose(rng, 20)} {w} {prose(rng, 5)}" for w in
              ("grum.bolt", "g r u m b o l t", "GRUMBOLT!!", "grumxbolt", "vip-krat", "snaazzel", "$$dolmung$$")]
    scores = scorer.scores(hidden)
    assert all(s >= toxicity.THRESHOLD for s in scores), scores
    clean = scorer.scores([prose(rng, 5000), "", None, "a " * 900, "q" * 50000, "!?. --"])
    assert all(s < toxicity.THRESHOLD for s in clean), clean


def test_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    scorer = toxicity.fit(toxicity.training_rows(docs, labels, ~held_out(F.col("doc_id"))))
    known = labels.join(docs, "doc_id").select("doc_id", "text", "toxic").collect()
    rows = [r for r in known if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    pred = [s >= toxicity.THRESHOLD for s in scorer.scores([r.text for r in rows])]
    caught = [p for p, r in zip(pred, rows) if r.toxic]
    clean = [p for p, r in zip(pred, rows) if not r.toxic]
    assert sum(caught) / len(caught) > 0.8 and sum(clean) / len(clean) < 0.04


def test_cases(spark, docs):
    rows = [(i, t) for i, (t, _) in enumerate(sample(60))]
    rows += [(70, None), (71, ""), (72, "x" * 100000), (73, "grumbolt grumbolt"), (73, "grumbolt grumbolt"), (None, "y")]
    labels = [(i, y, "x") for i, (_, y) in enumerate(sample(60))] + [(0, 0, "x"), (999, 1, "x"), (None, 1, "x"),
                                                                   (70, 1, "x"), (71, None, "x"), (72, 7, "x")]
    given = spark.createDataFrame(labels, "doc_id long, toxic int, text string")
    df = docs(rows)
    train = toxicity.training_rows(df, given, F.lit(True))
    assert len(train) == 60
    scorer = toxicity.fit(train)
    got = toxicity.score_texts(df, scorer, keep=["rest", "source", "text"])
    assert got.columns == ["doc_id", "score", "rest", "source", "text"]
    out = [(r.doc_id, r.score >= 0.3) for r in got.collect()]
    assert len(out) == len(rows) and dict(out)[73] and not any(dict(out)[i] for i in (70, 71, 72, None))
    assert toxicity.score_texts(docs([]), scorer).collect() == []
    one_class = toxicity.fit([("text here", 0)])
    assert one_class.scores(["text", None]) == [0.0, 0.0]
    assert toxicity.fit([]).scores(["text"]) == [0.0]


def test_sample_is_drawn_from_labels_with_a_text(spark, docs):
    from pyspark.sql import functions as F
    labels = spark.range(200_000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"))
    rows = [(i * 40, f"text number {i}") for i in range(4000)] + [(i * 40 + 1, f"bad number {i}") for i in range(4000)]
    rows += [(i * 40 + 3, " \n") for i in range(50)] + [(i * 40 + 5, None) for i in range(50)]
    train = toxicity.training_rows(docs(rows), labels, F.lit(True))
    assert [sum(y == v for _, y in train) for v in (0, 1)] == [700, 700]


def test_long_texts_are_learned_from_all_over(spark, docs):
    rows = [(i, "word " * 30_000 + "ending") for i in range(3)]
    labels = spark.createDataFrame([(i, 0) for i in range(3)], "doc_id long, toxic int")
    train = toxicity.training_rows(docs(rows), labels, F.lit(True))
    assert len(train) == 3 and all(len(t) <= 20_010 and t.endswith("ending") for t, _ in train)


def test_every_piece_of_a_word_is_learned():
    rng = np.random.default_rng(4)
    rows = [(f"{prose(rng, 30)} {'dampfschiffkapitaen' + 'grumbolt' if i % 2 else ''}", i % 2) for i in range(200)]
    rows += [(f"{prose(rng, 30)} dampfschiffkapitaensmuetze", 0) for _ in range(60)]
    scorer = toxicity.fit(rows)
    assert scorer.scores(["a grumbolt here"])[0] >= toxicity.THRESHOLD
    assert scorer.scores(["the dampfschiffkapitaen"])[0] < toxicity.THRESHOLD
