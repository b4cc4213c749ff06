"""Toxicity by a gapped subsequence string kernel, Nystroem landmarks and a linear SVM.

Two words are alike if they share many subsequences of three characters, each weighted by
`DECAY` to the length it spans, so a word with characters slipped in or left out stays close
to the plain one. A few hundred landmark words span the feature space (Nystroem) and a linear
support vector machine is trained there. Labels are per document and not per sentence, so its
examples are documents as bags of words, of which a toxic one holds a toxic word somewhere. The
kernel is over single words (and letters spelt out): an insult made of several ordinary words is
beyond it. The machine is trained on the words that look most toxic so far (at first by how much
oftener toxic documents hold them) against the words of clean documents, then picks those words
anew, and meets the clean words that it took for toxic.

The trained machine is a sum over landmarks of kernels, and the kernel is a product of sparse
subsequence counts, so it folds into one weight per subsequence. A word then costs the same
whatever the number of landmarks; words are scored in arrays, and once per task as a rule.

A document is as toxic as its two most toxic words: the first counts fully, the second a
quarter, squashed with an offset and slope fitted on the training documents. Long words are read
in overlapping pieces, single letters in a row also as one word, and nothing is cut off.
Punctuation at a word's ends does not count; inside a word it is read both with and without.

Fitting uses at most `per_class` labelled documents of each class, picked by the hash of their ids
among those that have a text, and of a text longer than `max_chars` stretches from all over it: a
bounded sample, fitted on the driver.

Cases: null and empty texts get the score of no words; a null label is never learned; labels
without a document that has words do nothing, and repeated ones count once, a toxic one winning;
of documents sharing a labelled id the smallest text is learned; equal scores share a rank; with one class
or none, every score is 0; repeated rows repeat their result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from silverline.llm.common import SPACES, batches, sample_by_hash, text_windows

PIECE, STEP = 14, 7
LETTERS = 128
DECAY = 0.5
LANDMARKS = 320
PER_CLASS, MAX_CHARS = 700, 20_000
THRESHOLD = 0.3
CACHE = 1 << 19
NONE = -2.0

_CUT = re.compile(f"[{SPACES}]+")
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_INNER = re.compile(r"[\W_]+")
_SPELT = re.compile(rf"(?<![^{SPACES}])(?:[^\W_][{SPACES}]+){{2,}}[^\W_](?![^{SPACES}])")


def _triples(n: int) -> tuple[np.ndarray, ...]:
    """Places of all subsequences of three among n characters, and their scaled weights."""
    i, j, k = np.nonzero(np.ones((n, n, n), bool))
    keep = (i < j) & (j < k)
    i, j, k = i[keep], j[keep], k[keep]
    weight = DECAY ** (k - i + 1.0)
    return i, j, k, (weight / np.linalg.norm(weight)).astype(np.float32)


_BY_LENGTH = {n: _triples(n) for n in range(3, PIECE + 3)}


def pieces(word: str) -> list[str]:
    """The readings of a word: as it stands and without inner punctuation, in short pieces."""
    bare = word.lower()
    forms = [bare]
    if not bare.isalnum():
        bare = _EDGE.sub("", bare)
        forms = [bare] if bare.isalnum() else [bare, _INNER.sub("", bare)]
    found = []
    for form in forms:
        if not form:
            continue
        form = f"^{form}$"
        if len(form) <= PIECE + 2:
            found.append(form)
        else:
            found += [form[i:i + PIECE + 2] for i in range(0, len(form) - STEP, STEP)]
    return [x for x in found if len(x) > 2]


def subsequences(group: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """For pieces of one length: ids of their subsequences (a row each), and the weights."""
    n = len(group[0])
    codes = np.frombuffer("".join(group).encode("utf-32-le", "replace"), np.uint32)
    plain = (codes >= 97) & (codes <= 122)
    codes = np.where(plain, codes - 97, 26 + codes % (LETTERS - 26)).astype(np.int32)
    codes = codes.reshape(len(group), n)
    i, j, k, weight = _BY_LENGTH[n]
    return (codes[:, i] * LETTERS + codes[:, j]) * LETTERS + codes[:, k], weight


def _by_length(found: list[str], block: int = 4096) -> Iterator[tuple[list[int], list[str]]]:
    groups = defaultdict(list)
    for at, piece in enumerate(found):
        groups[len(piece)].append(at)
    for own in groups.values():
        for start in range(0, len(own), block):
            part = own[start:start + block]
            yield part, [found[i] for i in part]


def margins(found: list[str], weights: np.ndarray) -> np.ndarray:
    """What the folded machine says of each piece, without its offset."""
    out = np.zeros(len(found))
    for at, group in _by_length(found):
        ids, weight = subsequences(group)
        out[at] = weights[ids] @ weight
    return out


@dataclass
class Scorer:
    """A weight per subsequence and the offsets; caches the scores of words it has met."""
    weights: np.ndarray
    offset: float
    slope: float = 0.0
    middle: float = 0.0
    known: dict[str, float] = field(default_factory=dict, repr=False)

    def learn(self, words: set[str]) -> None:
        """Score words not met before, all at once."""
        if len(self.known) > CACHE:
            self.known.clear()
        new = [w for w in words if w not in self.known]
        found, owner = [], []
        for at, word in enumerate(new):
            own = pieces(word)
            found += own
            owner += [at] * len(own)
        best = np.full(len(new), NONE)
        np.maximum.at(best, np.array(owner, int), margins(found, self.weights) + self.offset)
        self.known.update(zip(new, best.tolist()))

    def value(self, counts: Counter) -> float:
        """The most toxic word's margin and a quarter of the next one's; a repeat counts as next."""
        known, first, second = self.known, NONE, NONE
        for word, n in counts.items():
            own = known[word]
            if own > second:
                if own > first:
                    first, second = own, (own if n > 1 else first)
                else:
                    second = own
        return first + second / 4

    def score(self, value: float) -> float:
        z = self.slope * (value - self.middle) + np.log(THRESHOLD / (1 - THRESHOLD))
        return float(1 / (1 + np.exp(-np.clip(z, -60, 60)))) if self.slope else 0.0

    def scores(self, texts: Iterable[str | None]) -> list[float]:
        bags = [Counter(words(t)) for t in texts]
        self.learn(set().union(*bags))
        return [self.score(self.value(b)) for b in bags]


def words(text: str | None) -> list[str]:
    """All words of a text, and single letters in a row once more as one word."""
    if not text:
        return []
    found = [w for w in _CUT.split(text) if w]
    return found + [_CUT.sub("", m) for m in _SPELT.findall(text)]


def _features(found: list[str], marks: list[str]):
    """Kernels of pieces with the landmarks, by way of the landmarks' own subsequences."""
    known = np.unique(np.concatenate([subsequences([m])[0].ravel() for m in marks]))
    table = np.zeros((len(known) + 1, len(marks)), np.float32)
    for c, mark in enumerate(marks):
        ids, weight = subsequences([mark])
        np.add.at(table[:, c], np.searchsorted(known, ids[0]), weight)
    out = np.zeros((len(found), len(marks)), np.float32)
    for at, group in _by_length(found, 256):
        ids, weight = subsequences(group)
        place = np.minimum(np.searchsorted(known, ids), len(known) - 1)
        place = np.where(known[place] == ids, place, len(known))
        for row, i in enumerate(at):
            out[i] = weight @ table[place[row]]
    return out, known, table[:-1]


def _train(x: np.ndarray, y: np.ndarray, share: np.ndarray, cost: float = 20.0,
           rounds: int = 200) -> tuple[np.ndarray, float]:
    """Linear SVM with squared hinge loss by accelerated gradient descent."""
    x1 = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    rate = 1 / (1e-2 + 2 * cost * np.linalg.norm((x1 * share[:, None]).T @ x1, 2))
    w = z = np.zeros(x1.shape[1])
    for t in range(rounds):
        slack = np.maximum(0, 1 - y * (x1 @ z))
        grad = 1e-2 * z - 2 * cost * x1.T @ (share * y * slack)
        last, w = w, z - rate * grad
        z = w + t / (t + 3) * (w - last)
    return w[:-1], float(w[-1])


def _witnesses(bags: list[list[str]], value: dict[str, float]) -> Counter:
    """The two words of each toxic document that look most toxic, of those that have a value."""
    found = Counter()
    for bag in bags:
        found.update(sorted(set(bag) & value.keys(), key=lambda w: (-value[w], w))[:2])
    return found


def fit(rows: list[tuple[str, int]], landmarks: int = LANDMARKS, rounds: int = 4) -> Scorer:
    """Fit from (text, toxic) pairs in a fixed order."""
    raw = [(Counter(words(t)), y) for t, y in rows]
    bags = {v: [own for own in ([p for w in set(ws) for p in pieces(w)]
                                for ws, y in raw if y == v) if own] for v in (0, 1)}
    if not bags[0] or not bags[1]:
        return Scorer(np.zeros(LETTERS ** 3, np.float32), 0.0)
    a, b = (Counter(w for bag in bags[v] for w in set(bag)) for v in (1, 0))
    # A word that clean documents hold nearly as often cannot be what makes one toxic.
    value = {w: np.log((a[w] + 0.1) / len(bags[1])) - np.log((b[w] + 1.0) / len(bags[0]))
             for w in a if a[w] / len(bags[1]) > 5 * b[w] / len(bags[0])}
    clean = sorted(b, key=lambda w: (-b[w], w))
    toxic = _witnesses(bags[1], value)
    telling = [w for w, _ in sorted(toxic.items(), key=lambda x: (-x[1], x[0]))]
    negatives = set(clean[:2000]) | set(clean[::max(1, len(clean) // 3000)])
    for step in range(rounds):
        marks = telling[:landmarks // 2]
        hard = sorted(negatives) if not step else mined
        marks = marks + hard[::max(1, len(hard) // (landmarks - len(marks)))]
        marks = list(dict.fromkeys(marks))[:landmarks]
        positives = sorted(toxic)
        rest = sorted(negatives - toxic.keys())
        x, known, table = _features(positives + rest, marks)
        among, _, _ = _features(marks, marks)
        size, vector = np.linalg.eigh((among + among.T) / 2)
        keep = size > 1e-4
        root = vector[:, keep] / np.sqrt(size[keep])
        y = np.where(np.arange(len(x)) < len(positives), 1.0, -1.0)
        counts = np.array([toxic[w] for w in positives] + [1 + b[w] for w in rest], float)
        share = np.where(y > 0, 0.5 * counts / counts[y > 0].sum(),
                         0.5 * counts / max(1, counts[y < 0].sum()))
        w, offset = _train((x @ root).astype(np.float64), y, share)
        weights = np.zeros(LETTERS ** 3, np.float32)
        weights[known] = table @ (root @ w)
        scorer = Scorer(weights, offset)
        held = sorted(value)
        value = dict(zip(held, margins(held, weights) + offset))
        found = _witnesses(bags[1], value)
        toxic = Counter({w: n for w, n in found.items() if value[w] > 0}) or toxic
        telling = [w for w, _ in sorted(toxic.items(), key=lambda x: (-x[1], x[0]))]
        own = sorted(set(b) - toxic.keys())
        far = margins(own, weights)
        mined = [own[i] for i in np.argsort(-far, kind="stable")[:1500]]
        negatives |= set(mined)
    return _calibrated(scorer, raw)


def _calibrated(scorer: Scorer, raw: list[tuple[Counter, int]]) -> Scorer:
    """Puts the threshold where fewest training documents err, clean ones counting double."""
    scorer.learn(set().union(*[c for c, _ in raw]))
    values = np.array([scorer.value(c) for c, _ in raw])
    labels = np.array([y for _, y in raw])
    order = np.argsort(values)
    values, labels = values[order], labels[order]
    wrong = np.cumsum(labels == 1) + 2 * ((labels == 0).sum() - np.cumsum(labels == 0))
    best = np.nonzero(wrong == wrong.min())[0]
    low = values[best[0]]
    high = values[min(best[-1] + 1, len(values) - 1)]
    scorer.middle, scorer.slope = float(low + (high - low) / 3), 3.0
    scorer.known = {}
    return scorer


def training_rows(docs: DataFrame, labels: DataFrame, usable: Column,
                  per_class: int = PER_CLASS, max_chars: int = MAX_CHARS) -> list[tuple[str, int]]:
    """At most `per_class` (text, toxic) pairs of each class, of labelled ids that have a text."""
    texts = docs.filter(F.trim("text", F.lit(SPACES)) != "").select("doc_id", "text")
    known = (labels.filter(usable & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
             .join(texts.select("doc_id"), "doc_id", "left_semi"))
    # At most `per_class` ids of each of two classes, hence safe to broadcast and to collect.
    picked = sample_by_hash(known, "toxic", "doc_id", per_class)
    rows = (texts.join(F.broadcast(picked), "doc_id").withColumn("text", text_windows("text", max_chars))
            .groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).collect())
    return [(r["text"], r["toxic"]) for r in sorted(rows, key=lambda r: r["doc_id"])]


def score_texts(docs: DataFrame, scorer: Scorer, text: str = "text", doc_id: str = "doc_id",
                keep: list[str] | None = None) -> DataFrame:
    """(doc_id, score) and the columns named in `keep`, one row per row."""
    shared = docs.sparkSession.sparkContext.broadcast(scorer)
    rest = F.struct(*[F.col(c) for c in keep]) if keep else F.lit(None).cast("int")
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"),
                         rest.alias("rest"))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches(rows, 256):
            found = own.scores(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.float64()), batch.column(2)],
                ["doc_id", "score", "rest"])

    found = source.mapInArrow(run, StructType().add("doc_id", "long").add("score", "double").add(source.schema["rest"]))
    return found.select("doc_id", "score", *[F.col(f"rest.`{c}`").alias(c) for c in keep or []
                                             if c not in ("doc_id", "score")])
