import re

import numpy as np

from conftest_llm import prose
from silverline.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    seen, places = {}, []
    for i in range(len(words) - 7):
        seen.setdefault(tuple(words[i:i + 8]), []).append(i)
    for at in seen.values():
        places += at if len(at) > 1 else []
    covered = {i + j for i in places for j in range(8)}
    lines, earlier, dup = text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in earlier
            earlier.add(line)
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), failed)


def test_base_counts(docs):
    rng = np.random.default_rng(0)
    part = prose(rng, 20)
    texts = [None, "", " \n\t", "one", "é ü\x0bb\x0cd", "\n".join(["a b"] * 5 + ["a b ", "", " "]), "in " * 300,
             f"{part} {prose(rng, 30)} {part} {prose(rng, 30)}", "a b c d e f g h " * 2, "a b c d e f g h a b c d e f g",
             "| x | y #$%&*<> " * 9, "w" * 60000, prose(rng, 5000), "a\n\na\nb\na", "x y z", "$" * 50 + "\\ ^ ]"]
    texts += [prose(rng, int(rng.integers(1, 60))) for _ in range(20)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, "one"), (None, "one")]
    got = quality.judge(docs(rows)).collect()
    found = sorted([(str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words,
                     r.base_failed) for r in got])
    assert found == sorted((str(i), *brute(t)) for i, t in rows)
    assert not any(r.kept and r.base_failed for r in got)
    assert quality.judge(docs([])).collect() == []


def test_rates_match_plain_arithmetic(docs):
    rng = np.random.default_rng(1)
    rows = [(i, prose(rng, 200) + ".") for i in range(60)]
    rows += [(100 + i, " | ".join(prose(rng, 120).split())) for i in range(15)]
    voted = quality.votes(quality.features(docs(rows)))
    rates, good = quality.estimate(voted, rounds=3)
    names = list(quality.rules())
    table = [[r[f"vote_{n}"] for n in names] for r in voted.collect()]
    want, share = {y: {n: quality.START[y] for n in names} for y in quality.START}, quality.START_GOOD
    for _ in range(3):
        p = []
        for v in table:
            a, b = share, 1 - share
            for n, x in zip(names, v):
                a, b = a * want["good"][n][x + 1], b * want["bad"][n][x + 1]
            p.append(a / (a + b))
        part = {"good": p, "bad": [1 - x for x in p]}
        share, held = (sum(p) + 1) / (len(p) + 2), quality.PRIOR * len(p)
        want = {y: {n: tuple((sum(w for w, v in zip(part[y], table) if v[j] == x - 1) + held * quality.START[y][x])
                             / (sum(part[y]) + held) for x in range(3)) for j, n in enumerate(names)} for y in part}
    assert abs(good - share) < 1e-9
    assert all(np.allclose(rates[y][n], want[y][n]) for y in want for n in names)


def test_junk_goes_and_prose_stays(spark):
    folder = "/root/testdata/sf0.01"
    judged = quality.judge(spark.read.parquet(f"{folder}/documents.parquet")).alias("j")
    labels = spark.read.parquet(f"{folder}/labels.parquet").withColumnRenamed("quality", "label")
    rows = judged.join(labels, "doc_id").filter("not base_failed").collect()
    clean, junk = ([r.kept for r in rows if r.label == v] for v in (1, 0))
    assert sum(clean) / len(clean) > 0.98 and sum(junk) / len(junk) < 0.2
