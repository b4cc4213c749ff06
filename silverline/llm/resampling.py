"""Importance resampling towards a target distribution over hashed word n-grams.

Words are maximal runs of digits, letters and characters beyond ASCII, A-Z in lower case. A text's
features are its runs of 1 to `longest` words, and a feature's bucket is the CRC-32 of its words
joined by one space, modulo `buckets`.

1. A text is normalised to its words joined by one space and scanned once, storing the running
   CRC at the end of every word. With A the text before an n-gram and B the n-gram,
   crc(AB) = shift(crc(A), |B|) xor crc(B), where the shift multiplies by x^(8|B|) over GF(2); so
   any n-gram's CRC is two stored prefixes and a shift, whatever its length. Shifts are table
   look-ups over whole arrays, one table for each bit of the length.
2. A text's buckets are stored with its id (2 or 4 bytes a feature), so it is read once. Each task
   sums its texts into one array of `buckets` counts; Spark adds up those arrays.
3. A bucket's gain is floor(1000 * ln of its smoothed share in the target over that in the
   documents). Every text's weight is the floored mean gain of its features, and its score adds
   Gumbel noise from a hash of seed and id, so the highest scores are a sample without replacement.
4. Scores are ranked by ranges: each range is numbered on its own and starts where the one before
   ended; nothing is sorted in one task.

The gains are `buckets` numbers, a parameter, and are broadcast. Nothing else leaves the executors.

Cases: null and empty texts have no features and weight 0; documents with fewer than `least_words`
words are never drawn; a null id is hashed as an empty one and loses ties; rows that share an id
get the same noise, and each is scored and drawn by itself (of equal ones any order); an empty
target gives every bucket the gain that t = T = 0 gives; texts may have any length, one text's
buckets lie in one cell; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from silverline.llm.common import batches, raw_texts, stored
from silverline.operators.keyed import running_total

BUCKETS, LONGEST = 10_000, 1
LEAST_WORDS, SHARE, SEED = 20, (10, 100), "2024"
_POLYNOMIAL = np.uint32(0xEDB88320)

_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
               for c in range(256))


def _step_bytes(crc: np.ndarray) -> np.ndarray:
    """The register after eight more zero bits."""
    for _ in range(8):
        crc = crc >> np.uint32(1) ^ (crc & np.uint32(1)) * _POLYNOMIAL
    return crc


def _shifted(crc: np.ndarray, table: np.ndarray) -> np.ndarray:
    """A linear map of the register, given what it does to each of its four bytes."""
    out = table[0][crc & np.uint32(255)]
    for k in (1, 2, 3):
        out = out ^ table[k][crc >> np.uint32(8 * k) & np.uint32(255)]
    return out


def _shift_tables() -> list[np.ndarray]:
    """For each bit of a length: the shift by 2^bit bytes."""
    own = np.arange(256, dtype=np.uint32)
    tables = [np.array([_step_bytes(own << np.uint32(8 * k)) for k in range(4)])]
    for _ in range(31):
        tables.append(_shifted(tables[-1], tables[-1]))
    return tables


_TABLES = _shift_tables()


def shift(crc: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Each CRC times x^(8 * size): what it adds to the CRC of a string followed by `size` bytes."""
    bit = 0
    while len(sizes) and int(sizes.max()) >> bit:
        at = np.nonzero(sizes >> bit & 1)[0]
        crc = crc.copy() if not bit else crc
        crc[at] = _shifted(crc[at], _TABLES[bit])
        bit += 1
    return crc


def normalised(text: bytes | None) -> list[bytes]:
    """The words of a text."""
    return (text or b"").translate(_WORDS).split()


def prefixes(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The running CRC before and after each word of the joined text, and where each starts and ends."""
    space, crc32 = b" ", zlib.crc32
    after = np.fromiter(accumulate(words[1:], lambda crc, w: crc32(w, crc32(space, crc)), initial=crc32(words[0])),
                        np.uint32, len(words))
    spaced = ~after
    spaced = ~(_TABLES[0][0][(spaced ^ np.uint32(32)) & np.uint32(255)] ^ spaced >> np.uint32(8))
    before = np.concatenate([np.zeros(1, np.uint32), spaced[:-1]])
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    return before, after, ends - sizes, ends


def feature_crcs(words: list[bytes], longest: int) -> np.ndarray:
    """The CRC-32 of every run of 1 to `longest` words."""
    if not words:
        return np.zeros(0, np.uint32)
    before, after, starts, ends = prefixes(words)
    found = []
    for n in range(1, min(longest, len(words)) + 1):
        last = len(words) - n + 1
        found.append(after[n - 1:] ^ shift(before[:last].copy(), ends[n - 1:] - starts[:last]))
    return np.concatenate(found)


def _hashed(longest: int, buckets: int):
    """(rest, n_words, n_features, features): buckets of each text, packed."""
    kind = np.uint16 if buckets <= 1 << 16 else np.uint32

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows, 512):
            words = [normalised(t) for t in raw_texts(batch.column(1))]
            found = [(feature_crcs(w, longest) % np.uint32(buckets)).astype(kind) for w in words]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(w) for w in words], pa.int64()),
                 pa.array([len(f) for f in found], pa.int64()),
                 pa.array([f.tobytes() for f in found], pa.binary())],
                ["doc_id", "n_words", "n_features", "features"])
    return run, kind


def _summed(kind, buckets: int):
    """(bucket, n): a task's features by bucket."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in rows:
            for own in batch.column(0).to_pylist():
                total += np.bincount(np.frombuffer(own, kind), minlength=buckets)
        at = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])
    return run


def _weighed(gains, kind):
    """(doc_id, n_words, n_features, weight): floored mean gains."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = gains.value
        for batch in rows:
            sums = np.array([int(own[np.frombuffer(f, kind)].sum()) for f in batch.column(3).to_pylist()], np.int64)
            n = batch.column(2).to_numpy()
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sums // np.maximum(n, 1))],
                                             ["doc_id", "n_words", "n_features", "weight"])
    return run


def hashed_features(docs: DataFrame, text: str, doc_id: str, longest: int, buckets: int) -> DataFrame:
    """(doc_id, n_words, n_features, features), one row per row, stored."""
    run, _ = _hashed(longest, buckets)
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return stored(source.mapInArrow(run, "doc_id long, n_words long, n_features long, features binary"), "features")


def bucket_counts(features: DataFrame, buckets: int) -> np.ndarray:
    """How many features each bucket holds: `buckets` numbers."""
    _, kind = _hashed(1, buckets)
    rows = (features.select("features").mapInArrow(_summed(kind, buckets), "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")).collect())
    counts = np.zeros(buckets, np.int64)
    for row in rows:
        counts[row["bucket"]] = row["n"]
    return counts


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln((t + 1)(S + B) / ((s + 1)(T + B)))) for each of B buckets."""
    size, s, t = float(len(source)), source.astype(float), target.astype(float)
    ratio = (t + 1) * (s.sum() + size) / ((s + 1) * (t.sum() + size))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def _noise(doc_id: Column, seed: str) -> Column:
    """floor(-1000 * ln(-ln(u))) for a u in (0, 1) by hash of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    u = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(u)))


def resample(docs: DataFrame, target: DataFrame, text: str = "text", doc_id: str = "doc_id",
             longest: int = LONGEST, buckets: int = BUCKETS, least_words: int = LEAST_WORDS,
             share: tuple[int, int] = SHARE, seed: str = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank): a null rank means not drawn."""
    features = hashed_features(docs, text, doc_id, longest, buckets)
    wanted = hashed_features(target.withColumn("doc_id", F.lit(0)), text, "doc_id", longest, buckets)
    gains = bucket_gains(bucket_counts(features, buckets), bucket_counts(wanted, buckets))
    _, kind = _hashed(longest, buckets)
    shared = docs.sparkSession.sparkContext.broadcast(gains)
    scored = (features.mapInArrow(_weighed(shared, kind), "doc_id long, n_words long, n_features long, weight long")
              .withColumn("score", F.col("weight") + _noise(F.col("doc_id"), seed)))
    scored = stored(scored.withColumn("row", F.monotonically_increasing_id()), "scores")
    able = scored.filter(F.col("n_words") >= least_words)
    top, of = share
    drawn = able.count() * top // of
    best = F.struct(-F.col("score"), F.col("doc_id").isNull(), "doc_id", "row")
    ranked = running_total(able.withColumn("best", best).withColumn("one", F.lit(1).cast("long")), "best", "one", "at")
    rank = F.when(F.col("at") <= drawn, F.col("at"))
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    return (ranked.select(*columns, rank.alias("rank"))
            .union(scored.filter(F.col("n_words") < least_words).select(*columns, F.lit(None).cast("long"))))
