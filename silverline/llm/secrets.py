"""Secret scans: fixed base patterns, and formats learned from what they find.

Base spans are the matches of three patterns: `assign` (a keyword, = or :, a value of 6 characters
or more), `access` (AKIA and capitals or digits, 20 characters) and `hex` (24 characters).

What the base finds is a labelled sample of credentials, and every other candidate a sample of what
is none, labelled `number` if it has digits only and else `other`. A candidate is a maximal run of `ALPHABET` characters, at least `LEAST` long, without dots
at its ends. For each label a probabilistic automaton is inferred from its distinct values:

1. Their prefix tree counts how often each state is passed, left by each symbol, and ended in.
2. States are merged in breadth-first order: a state joins the first settled state whose rates of
   ending and of each symbol differ by no more than the Hoeffding bound, and whose successors agree
   in turn. Merging folds the successors, so loops appear where the tree repeats itself.
3. Rates are smoothed by the label's own symbol rates, and those by an even spread; a symbol that
   a state never saw leads to the settled state that follows it most often.

A candidate's score is its log-likelihood under the best credential automaton less that under the
best automaton of plain candidates, in bits a symbol, ending included. It is a span of kind `format`
if it has more than `MARGIN` bits, more than all but a thousandth of the plain training values, and
more than halfway from those to what all but a hundredth of the training credentials (of `LEAST`
symbols) reach. Candidates that touch a base span are left to the base. The `other` automaton also learns its values in capitals,
as ordinary words do not become credentials when a heading writes them so.

Sampling is the only bound: `PER_LABEL` distinct values a label, those with the smallest hashes, of
a longer value a window of `WINDOW` symbols from a place chosen by its hash. Each label is fitted in
one task; the automata (bounded by PER_LABEL * WINDOW states) are broadcast. All texts are scanned
whole for labels and again for spans; only the few runs of `LEAST` symbols are looked at in Python.

Cases: null and empty texts have no spans; a label with fewer than `FEWEST` values has no automaton,
and without one of plain values or of any credential nothing is added; equal starts go by kind, then
end; repeated rows repeat their result, and repeated values are learned once; texts and candidates
may have any length; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import json
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import log, log2, sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from silverline.llm.common import batches, raw_texts, sample_by_hash, stored

KINDS = ["assign", "access", "hex", "format"]
OTHER, NUMBER = "other", "number"
LEAST = 16
PER_LABEL, WINDOW, FEWEST = 1000, 128, 20
ALPHA = 0.3
MARGIN = 1.0
SMOOTH = 1.0
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"

_ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.IGNORECASE)  # on bytes, so A-Z and a-z only
_KEYWORDS = [b"password", b"passwd", b"secret", b"token", b"api"]
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HEX = re.compile(rb"[0-9a-f]{24,}")
_SYMBOL = np.isin(np.arange(256), list(ALPHABET.encode()))
_END = ""

Span = tuple[int, int, int]


def long_runs(texts: list[bytes]) -> list[list[tuple[int, int]]]:
    """For each text, where its runs of at least LEAST symbols lie, in bytes."""
    found: list = [[] for _ in texts]
    if not texts:
        return found
    whole = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
    edges = np.nonzero(np.diff(_SYMBOL[whole], prepend=False))[0].reshape(-1, 2)
    edges = edges[edges[:, 1] - edges[:, 0] >= LEAST]
    firsts = np.cumsum([0] + [len(t) + 1 for t in texts])
    owner = np.searchsorted(firsts, edges[:, 0], "right") - 1
    for i, a, b in zip(owner.tolist(), (edges[:, 0] - firsts[owner]).tolist(), (edges[:, 1] - firsts[owner]).tolist()):
        found[i].append((a, b))
    return found


def base_spans(text: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, where the value starts) of the base, in bytes; `runs` are its long runs."""
    found = []
    low = text.lower()
    if any(k in low for k in _KEYWORDS):
        found += [(m.start(), 0, m.end(), m.start(2)) for m in _ASSIGN.finditer(text) if m.end() - m.start(2) >= 6]
    for a, b in runs:  # both patterns hold symbols only, and are longer than LEAST
        if b - a >= 20 and text.find(b"AKIA", a, b) >= 0:
            found += [(m.start(), 1, m.end(), m.start()) for m in _ACCESS.finditer(text, a, b) if m.end() - m.start() >= 20]
        if b - a >= 24:
            found += [(m.start(), 2, m.end(), m.start()) for m in _HEX.finditer(text, a, b)]
    return sorted(found)


def candidates(text: bytes, runs: list[tuple[int, int]], base: list) -> list[tuple[int, int]]:
    """Runs without dots at their ends that are long enough and touch no base span."""
    found, taken = [], [(s[0], s[2]) for s in base]
    ahead = 0
    reach = 0
    for a, b in runs:
        own = text[a:b]
        a, b = a + len(own) - len(own.lstrip(b".")), b - (len(own) - len(own.rstrip(b".")))
        while ahead < len(taken) and taken[ahead][0] < b:
            reach = max(reach, taken[ahead][1])
            ahead += 1
        if b - a >= LEAST and reach <= a:
            found.append((a, b))
    return found


def _labelled(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, value): the base's values and the candidates beside them, each once a batch."""
    for batch in batches(rows, 512):
        texts = [t or b"" for t in raw_texts(batch.column(0))]
        seen = set()
        for text, runs in zip(texts, long_runs(texts)):
            base = base_spans(text, runs)
            seen.update((KINDS[kind], text[value:end]) for _, kind, end, value in base)
            rest = [text[a:b] for a, b in candidates(text, runs, base)]
            seen.update((NUMBER if v.isdigit() else OTHER, v) for v in rest)
        pairs = sorted(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in pairs], pa.string()), pa.array([_window(v) for _, v in pairs], pa.string())],
            ["label", "value"])


def _window(value: bytes) -> str:
    """The value, or WINDOW symbols of it from a place chosen by its hash."""
    at = xxhash.xxh64_intdigest(value) % (len(value) - WINDOW + 1) if len(value) > WINDOW else 0
    return value[at:at + WINDOW].decode()


@dataclass
class Automaton:
    """States with counts: how often passed, ended in, and left by each symbol, and to where."""
    ends: list[int] = field(default_factory=list)
    passed: list[int] = field(default_factory=list)
    leaves: list[dict[str, int]] = field(default_factory=list)
    to: list[dict[str, int]] = field(default_factory=list)

    def state(self) -> int:
        self.ends.append(0)
        self.passed.append(0)
        self.leaves.append({})
        self.to.append({})
        return len(self.ends) - 1


def prefix_tree(values: list[str]) -> Automaton:
    """State 0 is the empty prefix."""
    tree = Automaton()
    tree.state()
    for value in values:
        at = 0
        tree.passed[0] += 1
        for c in value:
            nxt = tree.to[at].get(c)
            if nxt is None:
                nxt = tree.to[at][c] = tree.state()
            tree.leaves[at][c] = tree.leaves[at].get(c, 0) + 1
            at = nxt
            tree.passed[at] += 1
        tree.ends[at] += 1
    return tree


def differ(f: int, n: int, g: int, m: int, alpha: float = ALPHA) -> bool:
    """Whether two rates f / n and g / m differ by more than chance allows (Hoeffding)."""
    return abs(f / n - g / m) > sqrt(0.5 * log(2 / alpha)) * (1 / sqrt(n) + 1 / sqrt(m))


def compatible(tree: Automaton, a: int, b: int, alpha: float = ALPHA) -> bool:
    """Whether two states and, in turn, their common successors have equal rates."""
    todo, seen = [(a, b)], {(a, b)}
    while todo:
        a, b = todo.pop()
        n, m = tree.passed[a], tree.passed[b]
        if differ(tree.ends[a], n, tree.ends[b], m, alpha):
            return False
        one, two = tree.leaves[a], tree.leaves[b]
        for c in one.keys() | two.keys():
            if differ(one.get(c, 0), n, two.get(c, 0), m, alpha):
                return False
        for c in tree.to[a].keys() & tree.to[b].keys():
            pair = tree.to[a][c], tree.to[b][c]
            if pair[0] != pair[1] and pair not in seen:
                seen.add(pair)
                todo.append(pair)
    return True


def _fold(tree: Automaton, into: int, state: int) -> None:
    """Add a subtree's counts to a settled state and what follows it."""
    todo = [(into, state)]
    while todo:
        into, state = todo.pop()
        tree.ends[into] += tree.ends[state]
        tree.passed[into] += tree.passed[state]
        for c, n in tree.leaves[state].items():
            tree.leaves[into][c] = tree.leaves[into].get(c, 0) + n
            if c in tree.to[into]:
                todo.append((tree.to[into][c], tree.to[state][c]))
            else:
                tree.to[into][c] = tree.to[state][c]


def infer(values: list[str], alpha: float = ALPHA) -> Automaton:
    """Merge the statistically compatible states of the values' prefix tree."""
    tree = prefix_tree(sorted(values))
    settled, order = {0}, [0]
    while True:
        fringe = next(((s, c) for s in order for c in sorted(tree.to[s]) if tree.to[s][c] not in settled), None)
        if fringe is None:
            return _only(tree, order)
        parent, c = fringe
        state = tree.to[parent][c]
        own = next((s for s in order if compatible(tree, s, state, alpha)), None)
        if own is None:
            settled.add(state)
            order.append(state)
        else:
            tree.to[parent][c] = own
            _fold(tree, own, state)


def _only(tree: Automaton, order: list[int]) -> Automaton:
    """The settled states alone, numbered anew."""
    number = {s: i for i, s in enumerate(order)}
    return Automaton([tree.ends[s] for s in order], [tree.passed[s] for s in order],
                     [tree.leaves[s] for s in order], [{c: number[t] for c, t in tree.to[s].items()} for s in order])


class Format:
    """An automaton with smoothed log rates: bits of each symbol and the end, and moves, by state."""

    def __init__(self, learned: Automaton):
        symbols = [*ALPHABET, _END]
        total = {c: sum(own.get(c, 0) for own in learned.leaves) for c in ALPHABET} | {_END: sum(learned.ends)}
        every = sum(total.values())
        usual = {c: (total[c] + 1) / (every + len(symbols)) for c in symbols}
        follow: dict[str, dict[int, int]] = {c: {} for c in ALPHABET}
        for own, to in zip(learned.leaves, learned.to):
            for c, n in own.items():
                follow[c][to[c]] = follow[c].get(to[c], 0) + n
        likely = {c: max(sorted(f), key=f.get, default=0) for c, f in follow.items()}
        self.bits, self.to = [], []
        for end, n, own, to in zip(learned.ends, learned.passed, learned.leaves, learned.to):
            counts = own | {_END: end}
            self.bits.append({c: log2((counts.get(c, 0) + SMOOTH * usual[c]) / (n + SMOOTH)) for c in symbols})
            self.to.append(likely | to)

    def score(self, value: str) -> float:
        """The log-likelihood of a whole value."""
        at, bits, to, sum_ = 0, self.bits, self.to, 0.0
        for c in value:
            sum_ += bits[at][c]
            at = to[at][c]
        return sum_ + bits[at][_END]


@dataclass
class Formats:
    """The credential formats against the one of other candidates."""
    credentials: list[Format]
    others: list[Format]
    least: float = MARGIN

    def score(self, value: str) -> float:
        """Bits a symbol by which the best credential format is likelier."""
        if not self.credentials or not self.others:
            return float("-inf")
        best, plain = (max(f.score(value) for f in own) for own in (self.credentials, self.others))
        return (best - plain) / (len(value) + 1)


def _fit_label(group: pd.DataFrame) -> pd.DataFrame:
    values = group["value"].tolist()
    if group["label"].iloc[0] == OTHER:
        values += sorted({v.upper() for v in values} - set(values))
    learned = infer(values)
    return pd.DataFrame({"label": group["label"].iloc[:1], "automaton": [json.dumps(vars(learned))]})


def labelled_values(docs: DataFrame, text: str = "text") -> DataFrame:
    """(label, value): the base's values and other candidates, each once, at most PER_LABEL a label; stored."""
    found = docs.select(F.col(text).alias("text")).mapInArrow(_labelled, "label string, value string")
    return stored(sample_by_hash(found.distinct(), "label", "value", PER_LABEL), "labelled")


def fit(values: DataFrame) -> Formats:
    """Infer an automaton for each label, one task each, and set the least score."""
    enough = values.groupBy("label").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= FEWEST).drop("n")
    rows = (values.join(enough, "label", "left_semi").groupBy("label")
            .applyInPandas(_fit_label, "label string, automaton string").collect())
    learned = {r["label"]: Format(Automaton(**json.loads(r["automaton"]))) for r in rows}
    formats = Formats(*[[learned[k] for k in own if k in learned] for own in (KINDS, (OTHER, NUMBER))])
    plain = F.col("label").isin(OTHER, NUMBER)
    known = values.filter(plain | (F.length("value") >= LEAST))
    scores = [[formats.score(r["value"]) for r in known.filter(own).collect()] for own in (plain, ~plain)]
    if all(scores):  # PER_LABEL values a label at most
        low, high = np.quantile(scores[0], 0.999), np.quantile(scores[1], 0.01)
        formats.least = float(max(MARGIN, low, (low + high) / 2))
    return formats


def _places(text: bytes, spans: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Byte places as code points."""
    if text.isascii():
        return spans
    wanted = sorted({x for s in spans for x in (s[0], s[2], s[3])})
    at, count, place = 0, 0, {}
    for x in wanted:
        count += len(text[at:x].decode())
        at = place[x] = x
        place[x] = count
    return [(place[a], kind, place[b], place[v]) for a, kind, b, v in spans]


def _joined(spans: list) -> str:
    return ",".join(f"{KINDS[kind]}:{a}:{b}" for a, kind, b, _ in spans)


def spans_of(texts: list[bytes], formats: Formats) -> Iterator[list[tuple[int, int, int, int]]]:
    """(start, kind, end, start of the value) of each text, sorted, in code points."""
    for text, runs in zip(texts, long_runs(texts)):
        base = base_spans(text, runs)
        added = [(a, 3, b, a) for a, b in candidates(text, runs, base)
                 if formats.score(text[a:b].decode()) > formats.least]
        yield _places(text, sorted(base + added))


def scan(docs: DataFrame, formats: Formats, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_format, base, spans, values), one row per row."""
    shared = docs.sparkSession.sparkContext.broadcast(formats)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches(rows, 512):
            found = list(spans_of([t or b"" for t in raw_texts(batch.column(1))], own))
            counts = [pa.array([sum(s[1] == k for s in spans) for spans in found], pa.int64()) for k in range(4)]
            text = [pa.array(x, pa.string()) for x in (
                [_joined([s for s in spans if s[1] < 3]) for spans in found], [_joined(spans) for spans in found],
                [_joined([(v, kind, b, v) for _, kind, b, v in spans]) for spans in found])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *counts, *text],
                ["doc_id", "n_assign", "n_access", "n_hex", "n_format", "base", "spans", "values"])

    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return source.mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, n_format long, "
                                  "base string, spans string, values string")
