import numpy as np

from silverline.llm import line_dedup

ALL = " \t\n\x0b\x0c\r"


def brute(rows):
    key = lambda x: x.strip(ALL).translate({c: c + 32 for c in range(65, 91)})
    last = 1 << 63
    holders = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 10:
                holders.setdefault(key(line), set()).add(last if i is None else i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < 2
                or min(holders[key(x)]) == (last if i is None else i)]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def got(df):
    return sorted([(r.doc_id, r.kept_text, r.n_lines, r.n_dropped) for r in df.collect()], key=repr)


ROWS = [(5, "Hello there, you\nshort\nanother line here"), (2, " hello THERE, you \t\nown line of two\nown line of two"),
        (9, "hello there, you\r\n\nshort\nÄÖÜ äöü ß"), (7, "äöü äöü ß\nÄÖÜ äöü ß"), (1, None), (3, ""), (3, "\n\n"),
        (None, "another line here\nonly null"), (None, "only null one\nonly null one"),
        (4, "123456789\n1234567890"), (6, "123456789\n1234567890"), (6, "1234567890"), (8, "x " * 9 + "\n" + "y" * 70000)]


def test_against_brute_force(docs):
    rng = np.random.default_rng(1)
    lines = [f"line number {i} of the pool" for i in range(40)]
    rows = ROWS + [(100 + n, "\n".join(lines[j] if j < 40 else f"own {n} {j} text" for j in rng.integers(0, 80, 12)))
                   for n in range(60)]
    df = docs(rows)
    kept = line_dedup.dedup_lines(df, keep=["rest", "key", "source"])
    assert kept.columns == ["doc_id", "kept_text", "n_lines", "n_dropped", "rest", "key", "source"]
    assert got(kept) == brute(rows)
    assert got(line_dedup.dedup_lines(docs([]))) == []


def test_several_passes_give_the_same(docs):
    rows = ROWS + [(100 + n, "\n".join(f"line {n % 7 * k} is here" for k in range(5))) for n in range(20)]
    digests = docs(rows).select("doc_id", "text").mapInArrow(
        line_dedup._digests(10), "doc long, h long, g long").filter("doc is not null")
    one = line_dedup.repeated_keys(digests)
    many = line_dedup.repeated_keys(digests, 2 << line_dedup.CHUNK_BITS - 3, digests.count() // 6)
    assert sorted(one.collect()) == sorted(many.collect()) and one.count()


def test_dropped_lines_are_listed_by_row(docs, monkeypatch):
    """No list of dropped lines holds more than one row's, however many rows share an id."""
    lines = [f"line number {i} of the pool" for i in range(60)]
    rows = [(1, "\n".join(lines))] + [(i, "\n".join(lines[3 * n:3 * n + 3])) for n in range(20) for i in (None, 7)]
    inner, found = line_dedup.repeated_keys, []
    monkeypatch.setattr(line_dedup, "repeated_keys", lambda *a: found.append(inner(*a)) or found[-1])
    assert got(line_dedup.dedup_lines(docs(rows))) == brute(rows)
    assert max(r["count"] for r in found[0].groupBy("row").count().collect()) == 3
