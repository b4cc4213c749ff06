import re

import numpy as np
import pytest

from conftest_llm import prose
from silverline.llm import secrets

RULES = [("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                               re.I | re.A), lambda m: len(m[2]) >= 6),
         ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
         ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24)]


def base(text):
    """The base spans by their definition."""
    found = [(m.start(), k, m.end()) for k, (_, rule, ok) in enumerate(RULES) for m in rule.finditer(text or "") if ok(m)]
    return [f"{RULES[k][0]}:{a}:{b}" for a, k, b in sorted(found)]


def random(rng, symbols, n):
    return "".join(rng.choice(list(symbols), n))


HEX, UPPER = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"


@pytest.fixture(scope="module")
def corpus():
    """Texts with credentials in known formats, and plain long tokens."""
    rng = np.random.default_rng(2)
    texts = []
    for i in range(300):
        texts.append(" ".join([
            prose(rng, 8), f'token = "{random(rng, HEX, 18)}"', f"AKIA{random(rng, UPPER, 16)}.",
            random(rng, HEX, 40), random(rng, "0123456789", 16), "".join(prose(rng, 6).split()).strip("0123456789"),
            random(rng, "etaoinshr", 20).upper() if i % 3 == 0 else "x"]))
    return texts


@pytest.fixture(scope="module")
def learned(spark, corpus):
    df = spark.createDataFrame([(t,) for t in corpus], "text string")
    return secrets.fit(secrets.labelled_values(df))


def spans(df, formats):
    return {r.doc_id: r for r in secrets.scan(df, formats).collect()}


def test_base_spans_against_their_definition(docs, corpus, learned):
    odd = ["Password='short' passwd:longer1 TOKEN  =  \"abc-def/==\" api_key=ABCDEF apikey : x.y.z-1",
           "é" * 7 + "secret=é secret=ſecret1 toKen=abcdefg token=abcdefgé" + "a" * 24 + "日本" + "b" * 23 + " " + "c" * 90,
           "AKIAAKIA" + "Z" * 12 + "a AKIA0 xAKIA" + "9" * 40 + "akia", "tokentoken=token=password=abcdef", None, "",
           "secret" + " " * 500 + "= " * 50, "g" * 10_000 + "f" * 30 + "g" + "0" * 24 + " password=" + "q" * 5000]
    got = spans(docs(list(enumerate(corpus + odd))), learned)
    for i, text in enumerate(corpus + odd):
        want = base(text)
        assert got[i].base.split(",") == (want or [""]), text
        assert [got[i].n_assign, got[i].n_access, got[i].n_hex] == [sum(s.startswith(k[0]) for s in want) for k in RULES]
        assert [s for s in got[i].spans.split(",") if not s.startswith("format")] == (want or ([] if got[i].spans else [""]))


def test_values_lie_inside_their_spans(docs, learned):
    got = spans(docs([(1, "é token = \"0123456789abcdef01\" end")]), learned)[1]
    assert (got.spans, got["values"]) == ("assign:2:29", "assign:11:29")


def test_unlabelled_credentials_of_a_learned_format_are_added(docs, corpus, learned):
    rng = np.random.default_rng(9)
    rows, want = [], {}
    for i in range(60):
        value = random(rng, HEX, 18) if i % 2 else random(rng, UPPER, 18)
        rows.append((i, f"Über {prose(rng, 5)} {value}. {prose(rng, 5)}"))
        at = rows[-1][1].index(value)
        want[i] = f"format:{at}:{at + 18}"
    got = spans(docs(rows), learned)
    assert sum(got[i].spans == want[i] for i in want) >= 57


def test_plain_tokens_are_left_alone(docs, learned):
    rng = np.random.default_rng(10)
    rows = [(i, " ".join([random(rng, "0123456789", 16), "".join(prose(rng, 6).split()).strip("0123456789"),
                          random(rng, "etaoinshr", 20).upper()])) for i in range(100)]
    got = spans(docs(rows), learned)
    assert sum(r.n_format for r in got.values()) <= 2 and not any(r.base for r in got.values())


def walk(values, to, ends):
    """Plain counts of how often each state of an automaton is passed, left by a symbol and ended in."""
    passed, left, ended = {}, {}, {}
    for v in values:
        at = 0
        passed[at] = passed.get(at, 0) + 1
        for c in v:
            left[at, c] = left.get((at, c), 0) + 1
            at = to[at][c]
            passed[at] = passed.get(at, 0) + 1
        ended[at] = ended.get(at, 0) + 1
    return passed, left, ended


def test_merged_states_count_what_passes_them():
    rng = np.random.default_rng(5)
    values = ["AK" + random(rng, "xyz", int(rng.integers(1, 9))) + "!" for _ in range(400)]
    got = secrets.infer(values)
    passed, left, ended = walk(values, got.to, got.ends)
    assert dict(enumerate(got.passed)) == passed
    assert {(s, c): n for s, own in enumerate(got.leaves) for c, n in own.items()} == left
    assert {s: n for s, n in enumerate(got.ends) if n} == ended
    assert len(got.ends) < 8  # a loop stands for the repeated part
    assert secrets.infer(values[::-1]) == got


def test_merging_by_the_published_rule():
    """Ends at half and at nine tenths differ with many examples and agree with few."""
    many = ["a"] * 500 + ["ab"] * 500 + [""] * 9000
    few = ["a"] * 2 + ["ab"] * 2 + [""] * 36
    assert len(secrets.infer(many).ends) == 3 and len(secrets.infer(few).ends) == 1
    assert secrets.differ(500, 1000, 9000, 10_000) and not secrets.differ(1, 2, 9, 10)
    assert secrets.compatible(secrets.prefix_tree(["x", "xx"] * 3), 1, 2) is True


def test_rates_of_a_format_sum_to_one():
    found = secrets.Format(secrets.infer(["ab", "abab", "ababab"] * 20))
    for bits in found.bits:
        assert abs(sum(2 ** b for b in bits.values()) - 1) < 1e-9


def test_too_few_examples_add_nothing(spark, docs):
    df = docs([(1, "token=abcdef " + "z" * 30), (None, None)])
    formats = secrets.fit(secrets.labelled_values(df))
    got = secrets.scan(df, formats).collect()
    assert {(r.doc_id, r.spans) for r in got} == {(1, "assign:0:12"), (None, "")}
    empty = docs([])
    assert secrets.scan(empty, secrets.fit(secrets.labelled_values(empty))).collect() == []
