"""Language identification by the nearest of several centroids per language.

A text is its counts of hashed letter 1- to 3-grams (lower case, every other character a
space), damped by a square root, weighted by inverse document frequency and scaled to length
one. Each language is described by a few centroids, found by clustering its training texts by
cosine, so that one language may have several kinds of text. A text gets the language of the
centroid with the highest cosine; `score` is that cosine. Where it lies further away than
nearly all training texts of that centroid, `rejected` is true: the language is still the
nearest one, but not to be relied on.

Document frequencies are counted over all training texts, whole. Centroids come from at most
`per_language` training documents of each language, picked by the hash of their ids, and of a text
longer than `max_chars` from stretches all over it: a bounded sample, clustered in one task per
language. Only frequencies and centroids reach the driver. Every document is then scored whole, in
blocks, with memory for one block.

Cases: a null text, or one without a letter, is `und` with score 0 and not rejected; a null
`lang` is never learned; without any training document everything is `und`; repeated rows
repeat their result; of documents sharing an id and a language the smallest text is clustered;
between equally near centroids the language that sorts first wins; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from silverline.llm.common import batches, sample_by_hash, text_windows

DIM = 1 << 13
BLOCK = 1 << 18
PER_LANGUAGE, MAX_CHARS, CENTROIDS = 400, 20_000, 4
UNKNOWN = "und"

_FACTORS = np.array([2654435761, 2246822519, 3266489917], np.uint32)


def _letters(codes: np.ndarray) -> np.ndarray:
    """Code points with every ASCII non-letter as a space."""
    plain = (codes >= 97) & (codes <= 122)
    return np.where(plain | (codes > 127), codes, np.uint32(32))


def gram_counts(text: str) -> np.ndarray:
    """Hashed counts of the 1-, 2- and 3-grams of a whole text."""
    counts, low = np.zeros(DIM), text.lower()
    for start in range(0, len(low), BLOCK):
        part = low[max(0, start - 2):start + BLOCK]
        codes = _letters(np.frombuffer(part.encode("utf-32-le", "replace"), np.uint32))
        skip = 2 if start else 0
        key = codes * _FACTORS[0]
        counts += np.bincount(key[skip:] >> np.uint32(19), minlength=DIM)
        for n in (1, 2):
            key = (key[:-1] + np.uint32(n)) * _FACTORS[n] ^ codes[n:] * _FACTORS[0]
            counts += np.bincount(key[max(0, skip - n):] * _FACTORS[1] >> np.uint32(19),
                                  minlength=DIM)
    return counts


def _scaled(rows: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(rows, axis=-1, keepdims=True)
    return rows / np.where(size == 0, 1, size)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


@dataclass
class Centroids:
    """Unit centroids (one row each), their language, the cosine below which they reject."""
    idf: np.ndarray
    rows: np.ndarray
    lang: list[str]
    least: np.ndarray

    def vector(self, text: str) -> np.ndarray:
        return _scaled(np.sqrt(gram_counts(text)) * self.idf)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        if not self.lang or not has_letter(text):
            return UNKNOWN, 0.0, False
        near = self.rows @ self.vector(text)
        best = int(np.argmax(near))
        return (self.lang[best], float(np.clip(near[best], 0, 1)),
                bool(near[best] < self.least[best]))


def _clusters(points: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means, started from points spread over the sample."""
    centres = points[np.linspace(0, len(points) - 1, min(k, len(points))).astype(int)]
    for _ in range(rounds):
        own = np.argmax(points @ centres.T, axis=1)
        used = [c for c in range(len(centres)) if (own == c).any()]
        centres = _scaled(np.stack([points[own == c].sum(axis=0) for c in used]))
    return centres


def damped(texts: list[str], idf: np.ndarray) -> np.ndarray:
    """Unit vectors of texts, a row each."""
    points = np.stack([np.sqrt(gram_counts(t)) for t in texts]) * idf
    return (points / np.maximum(np.linalg.norm(points, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def inverse_frequencies(held: np.ndarray, count: int) -> np.ndarray:
    """From how many of `count` texts hold each gram."""
    return np.log((1 + count) / (1 + held)) + 0.1


def centroids_of(texts: list[str], idf: np.ndarray, centroids: int = CENTROIDS) -> tuple[np.ndarray, list[float]]:
    """The centroids of one language's texts, and the cosine that nearly all of their texts reach."""
    points = damped(texts, idf)
    found = _clusters(points, centroids)
    near = points @ found.T
    nearest = np.argmax(near, axis=1)
    own = [near[nearest == c, c] for c in range(len(found))]
    return found, [float(np.quantile(x, 0.005)) if len(x) else 0.0 for x in own]


def _nothing() -> Centroids:
    return Centroids(np.ones(DIM), np.zeros((0, DIM)), [], np.zeros(0))


def fit(docs: DataFrame, usable: Column, per_language: int = PER_LANGUAGE, max_chars: int = MAX_CHARS,
        centroids: int = CENTROIDS) -> Centroids:
    """Fit to the usable rows of (doc_id, text, lang); only the centroids reach the driver."""
    pool = docs.filter(usable & F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (F.length("text") > 0))
    held = pool.select("text").mapInArrow(_held, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    counts = {r["gram"]: r["n"] for r in held}  # DIM rows and one at most
    if not counts.get(DIM):
        return _nothing()
    idf = inverse_frequencies(np.array([counts.get(g, 0) for g in range(DIM)]), counts[DIM])
    shared = docs.sparkSession.sparkContext.broadcast(idf)

    def clustered(group: pd.DataFrame) -> pd.DataFrame:
        rows = [(hash_order(i), t) for i, t in zip(group["doc_id"], group["text"]) if has_letter(t)]
        if not rows:
            return pd.DataFrame({"lang": [], "centre": [], "least": []})
        found, least = centroids_of([t for _, t in sorted(rows)], shared.value, centroids)
        return pd.DataFrame({"lang": group["lang"].iloc[0], "centre": [c.astype(np.float32).tobytes() for c in found],
                             "least": least})

    picked = (sample_by_hash(pool.select("doc_id", "lang").distinct(), "lang", "doc_id", per_language)
              .select("doc_id", "lang"))
    # A language's group is `per_language` texts of `max_chars`; its result is a few centroids.
    rows = (pool.join(picked, ["doc_id", "lang"]).select("doc_id", "lang", text_windows("text", max_chars).alias("text"))
            .groupBy("doc_id", "lang").agg(F.min("text").alias("text"))
            .groupBy("lang").applyInPandas(clustered, "lang string, centre binary, least double").collect())
    if not rows:
        return _nothing()
    rows.sort(key=lambda r: (r["lang"], r["centre"]))
    return Centroids(idf, np.stack([np.frombuffer(r["centre"], np.float32) for r in rows]), [r["lang"] for r in rows],
                     np.array([r["least"] for r in rows]))


def _held(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, n): how many of a task's texts hold each gram; gram DIM counts the texts."""
    held = np.zeros(DIM + 1, np.int64)
    for batch in batches(rows, 1024):
        for text in batch.column(0):
            own = text.as_py()
            if has_letter(own):
                held[:DIM] += gram_counts(own) > 0
                held[DIM] += 1
    at = np.nonzero(held)[0]
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(held[at])], ["gram", "n"])


def hash_order(doc_id: int) -> int:
    return doc_id * 0x9E3779B97F4A7C15 % (1 << 64)


def identify(docs: DataFrame, model: Centroids, text: str = "text",
             doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, lang_pred, score, rejected), one row per row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches(rows, 1024):
            found = [own.predict(t.as_py()) for t in batch.column(1)]
            lang, score, rejected = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                 pa.array(rejected, pa.bool_())], ["doc_id", "lang_pred", "score", "rejected"])

    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return source.mapInArrow(run, "doc_id long, lang_pred string, score double, rejected boolean")
