from hypothesis import given, strategies as st

from silverline.llm import chat

pieces = st.lists(st.sampled_from(["\\", "###", "</turn>", "#", "\n", ":", "h", "e", "a", "é", "🙂", "### Assistant:\n"]))
texts = pieces.map("".join)


@given(st.lists(st.tuples(texts, texts)))
def test_round_trip(turns):
    formatted, spans = chat.format_turns(turns)
    assert chat.read_back(formatted) == turns
    assert chat.loss_text(formatted, spans) == "".join(t for r, t in turns if r == chat.LEARNED)


def trees(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows],
                                 "tree long, node long, parent long, score double, role string, text string, above string")


def brute(rows, branches):
    out = {}
    by = {}
    for r in rows:
        by.setdefault(r[0], {})[r[1]] = r
    for tree, nodes in by.items():
        parents = {r[2] for r in nodes.values()}
        found = []
        for n in nodes:
            if n in parents:
                continue
            path, at = [], n
            while at in nodes and len(path) <= len(nodes):
                path.append(nodes[at])
                at = nodes[at][2]
            if len(path) <= len(nodes):
                mean = sum(p[3] or 0.0 for p in path) / len(path)
                found.append((-mean, n, [(p[4], p[5]) for p in path[::-1]]))
        for rank, (_, _, turns) in enumerate(sorted(found)[:branches], 1):
            out[tree, rank] = chat.format_turns(turns)[0]
    return out


def test_branches(spark):
    rows = [(1, 1, None, 1.0, "user", "root"), (1, 2, 1, 0.5, "assistant", "a"), (1, 3, 1, 0.9, "assistant", "b"),
            (1, 4, 2, 5.0, "user", "c"), (1, 5, 4, 0.1, "assistant", None), (1, 6, 3, 0.9, "user", ""),
            (2, 1, 9, None, None, "dangling"), (2, 2, 1, 1.0, "user", "tie"), (2, 3, 1, 1.0, "user", "tie"),
            (3, 1, 2, 1.0, "user", "circle"), (3, 2, 1, 1.0, "user", "circle"), (3, 3, 2, 1.0, "user", "below")]
    rows += [(4, n, n - 1 if n else None, 1.0, "assistant" if n % 2 else "user", f"t{n}") for n in range(70)]
    for branches in (1, 2):
        got = {(r.tree, r["rank"]): r.formatted for r in chat.format_trees(trees(spark, rows), branches).collect()}
        assert got == brute(rows, branches)
    assert chat.format_trees(trees(spark, [])).collect() == []


def test_repeated_rows_and_null_ids(spark):
    rows = [(1, 1, None, 1.0, "user", "root"), (1, 2, 1, 0.5, "assistant", "a"), (1, 3, 1, 0.4, "assistant", "b")]
    want = brute(rows, 2)
    other = [(1, None, 1, 9.0, "user", "no id"), (None, 2, 1, 9.0, "user", "no tree"),
             (1, 3, 1, 0.7, "assistant", "c"), (1, 3, 1, 0.4, "user", "b")]
    got = chat.format_trees(trees(spark, rows * 50 + other), 2).collect()
    assert {(r.tree, r["rank"]): r.formatted for r in got} == want and len(got) == len(want)


def test_conversations(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", None), (None, 0, "user", "n"), (2, None, None, "q"),
            (2, 0, "b", "tie"), (2, 0, "a", "tie"), (2, 0, "a", "tie"), (3, 5, "assistant", "x" * 100000)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, node string")
    got = {r.tree: r.formatted for r in chat.format_trees(chat.conversation_messages(df)).collect()}
    turns = {1: [("user", "a"), ("assistant", "")], chat.NO_TREE: [("user", "n")],
             2: [("", "q"), ("a", "tie"), ("a", "tie"), ("b", "tie")], 3: [("assistant", "x" * 100000)]}
    assert {k: chat.read_back(v) for k, v in got.items()} == turns
    assert chat.read_back_digests(chat.format_trees(chat.conversation_messages(df.limit(0)))).collect() == []
