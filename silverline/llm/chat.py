"""Chat formatting of reply trees.

Messages name their parent. Root-to-leaf paths are enumerated by iterative self-joins that
double their reach: in round k every message learns its ancestor 2^k steps up and the score
gathered on the way, so a chain of n replies takes log2(n) rounds. Leaves, which stand for
branches, are ranked by the mean score of their path, the best `branches` of a tree are chosen,
and only their paths are listed: a leaf's path doubles in each round by joining the same
ancestor tables. The rounds join ids and scores only; texts join once, when the paths are known.

Each path becomes one conversation. Template, for each turn:

    ### <role>:
    <text></turn>

A backslash, `###` and `</turn>` inside texts and roles (in roles also `:` and line feeds) are
escaped with a backslash, so the template's own marks occur nowhere else and `read_back` restores every
turn exactly. The loss mask is a list of spans of code points: the (escaped) assistant texts.

Cases: null texts and roles are empty; a parent that does not exist makes a root; messages on or
below a circle of parents have no root and are left out, as are those without a tree or an id;
rows that share tree and id are one message, with the smallest parent and its smallest score, the
smallest role and its smallest text (null first); equal scores rank by message id; an empty table
gives an empty result. Texts may be long, but a conversation is one row of the result, so it
has to fit into one.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from silverline.llm.common import batches
from silverline.sources.shared import durable

LEARNED = "assistant"
NO_TREE = -(1 << 63)

_OUT = {"\\": "\\\\", "###": "\\h", "</turn>": "\\e"}
_OUT_ROLE = _OUT | {":": "\\c", "\n": "\\n"}
_BACK = {v[1:]: k for k, v in _OUT_ROLE.items()}
_TEXT = re.compile("|".join(map(re.escape, _OUT)))
_ROLE = re.compile("|".join(map(re.escape, _OUT_ROLE)))
_ESCAPED = re.compile(r"\\(.)")
_TURN = re.compile(r"### ([^:]*):\n(.*?)</turn>\n", re.S)


def escape(text: str) -> str:
    return _TEXT.sub(lambda m: _OUT[m[0]], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: _BACK[m[1]], text)


def format_turns(turns: list[tuple[str | None, str | None]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the spans under the loss mask."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head = f"### {_ROLE.sub(lambda m: _OUT_ROLE[m[0]], role or '')}:\n"
        body = escape(text or "")
        if role == LEARNED:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, "</turn>\n"]
        at += len(head) + len(body) + len("</turn>\n")
    return "".join(parts), spans


def read_back(formatted: str) -> list[tuple[str, str]]:
    return [(unescape(r), unescape(t)) for r, t in _TURN.findall(formatted)]


def loss_text(formatted: str, spans: list) -> str:
    return "".join(unescape(formatted[a:b]) for a, b in spans)


def ancestors(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The tables of each round, and the totals of whole paths.

    Round k has (tree, node, up, total, steps) of the messages that have an ancestor 2^k above,
    `up`; total and steps count what lies below it. Messages whose path ends earlier leave the
    rounds, and are in the second table with their totals.
    """
    real = nodes.select("tree", F.col("node").alias("up"), F.lit(True).alias("_real"))
    rows = durable(
        nodes.select("tree", "node", F.col("parent").alias("up"), F.col("score").alias("total"))
        .join(real, ["tree", "up"], "left")
        .select("tree", "node", F.when(F.col("_real"), F.col("up")).alias("up"), "total",
                F.lit(1).cast("long").alias("steps")))
    done, levels = rows.filter("up is null"), [rows.filter("up is not null")]
    bound = max(1, nodes.count())
    while 1 << len(levels) - 1 <= bound and not levels[-1].isEmpty():
        above = levels[-1].union(done).select(
            "tree", F.col("node").alias("up"), F.col("up").alias("_up"),
            F.col("total").alias("_total"), F.col("steps").alias("_steps"))
        rows = durable(levels[-1].join(above, ["tree", "up"]).select(
            "tree", "node", F.col("_up").alias("up"), (F.col("total") + F.col("_total")).alias("total"),
            (F.col("steps") + F.col("_steps")).alias("steps")))
        done = done.union(rows.filter("up is null"))
        levels.append(rows.filter("up is not null"))
    return levels, done


def paths(nodes: DataFrame, branches: int = 1) -> DataFrame:
    """(tree, leaf, rank, node, above): the messages of each tree's best branches."""
    levels, whole = ancestors(nodes)
    parents = nodes.select("tree", F.col("parent").alias("node")).distinct()
    best = Window.partitionBy("tree").orderBy(F.col("mean").desc_nulls_last(), "node")
    chosen = (whole.join(parents, ["tree", "node"], "left_anti")
              .withColumn("mean", F.col("total") / F.col("steps"))
              .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= branches))
    found = durable(chosen.select("tree", F.col("node").alias("leaf"), "rank", "node",
                                  F.lit(0).cast("long").alias("above")))
    for k, level in enumerate(levels[:-1]):
        step = level.select("tree", "node", "up")
        found = durable(found.union(
            found.join(step, ["tree", "node"])
            .select("tree", "leaf", "rank", F.col("up").alias("node"), F.col("above") + (1 << k))))
    return found


def _formatted(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches(rows, 256):
        out = [format_turns([(t["role"], t["text"]) for t in turns])
               for turns in batch.column(2).to_pylist()]
        spans = [[{"start": a, "end": b} for a, b in s] for _, s in out]
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([t for t, _ in out], pa.string()),
             pa.array(spans, kind)], ["tree", "rank", "formatted", "loss_spans"])


def format_trees(messages: DataFrame, branches: int = 1) -> DataFrame:
    """(tree, rank, formatted, loss_spans) from (tree, node, parent, score, role, text).

    Repeated rows are reduced by partial aggregation, ids and texts apart, before anything joins.
    """
    def once(*columns) -> DataFrame:
        own = messages.filter("tree is not null and node is not null").groupBy("tree", "node")
        return own.agg(F.min(F.struct(*columns)).alias("_one")).select("tree", "node", "_one.*")

    nodes = durable(once("parent", F.coalesce("score", F.lit(0.0)).alias("score")))
    texts = once("role", "text")
    turns = F.sort_array(F.collect_list(F.struct((-F.col("above")).alias("at"), "role", "text")))
    whole = (paths(nodes, branches).join(texts, ["tree", "node"])
             .groupBy("tree", "rank", "leaf").agg(turns.alias("turns"))
             .select("tree", "rank", "turns"))
    return whole.mapInArrow(
        _formatted, "tree long, rank int, formatted string, "
                    "loss_spans array<struct<start: bigint, end: bigint>>")


def conversation_messages(conversations: DataFrame) -> DataFrame:
    """A table of conversations as reply trees: each row answers the one before it.

    Rows go by turn (null first); equal turns by role and text. A null conversation is one of
    its own, as tree NO_TREE.
    """
    order = Window.partitionBy("tree").orderBy("turn", "role", "text")
    return (conversations.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(NO_TREE)).alias("tree"), "turn", "role", "text")
        .withColumn("node", F.row_number().over(order).cast("long"))
        .select("tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
                F.lit(1.0).alias("score"), "role", "text"))


def _digests(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches(rows, 256):
        found = []
        for formatted, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            turns = read_back(formatted)
            whole = "".join(f"{r}\n{t}\n" for r, t in turns)
            loss = loss_text(formatted, [(s["start"], s["end"]) for s in spans])
            found.append((len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss),
                          hashlib.sha256(loss.encode()).hexdigest(), len(formatted)))
        columns = list(zip(*found)) if found else [()] * 5
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *map(pa.array, columns, kinds)],
            ["tree", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])


def read_back_digests(formatted: DataFrame) -> DataFrame:
    """What can be read from formatted conversations again, as counts and digests."""
    return formatted.select("tree", "formatted", "loss_spans").mapInArrow(
        _digests, "tree long, n_turns long, turns_sha256 string, loss_chars long, "
                  "loss_sha256 string, formatted_chars long")
