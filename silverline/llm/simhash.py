"""SimHash near-duplicates found with covering locality-sensitive hashing.

A document's fingerprint has a bit set where over half of its shingle hashes have it set.
Documents whose fingerprints differ in at most `radius` bits are linked, and a document's
component is what it reaches over links.

Every bit position belongs to one of the 2^(r+1) - 1 non-zero vectors of r+1 bits, and there
is a table for each such vector v, keyed by the fingerprint's bits whose vector has an odd
product with v. At most r positions span at most r dimensions, so some v is orthogonal to
all of them: its table ignores every differing bit and the pair meets there. No pair
within the radius is ever missed, whatever the data.

Only distinct fingerprints enter the tables, so copies of a text cost one row. A bucket yields
a spanning forest of its links: never more edges than members. Empty documents have
fingerprint zero and take part like any other. Rows with a null id get a fingerprint and link
others too, but cannot name a component: one that has only such rows is null. Rows repeated with one id get one result each. A text of any length gives all its shingles,
counted in one task. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from silverline.llm.common import batches, raw_texts, word_ends
from silverline.llm.components import connected_components
from silverline.sources.shared import durable

BITS = 64
PAIRWISE = 512  # buckets up to this size are compared directly, larger ones by bit flips

_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
_LANES = np.arange(8, dtype=np.int64) * 256


def shingle_hashes(text: bytes | None, size: int) -> np.ndarray:
    """XXH64 (seed 42) of each run of `size` words as eight big-endian bytes per row."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros((0, 8), np.uint8)
    joined, digest = b" ".join(words), xxhash.xxh64_digest
    if len(words) <= size:
        found = [digest(joined, 42)]
    else:
        starts, ends = word_ends(words)
        cuts = zip(starts[:len(words) - size + 1].tolist(), ends[size - 1:].tolist())
        found = [digest(joined[a:b], 42) for a, b in cuts]
    return np.frombuffer(b"".join(found), np.uint8).reshape(-1, 8)


def fingerprint(text: bytes | None, size: int = 3) -> int:
    """Unsigned fingerprint of one text."""
    hashes = shingle_hashes(text, size)
    if not len(hashes):
        return 0
    counts = np.zeros((8, 256), np.int64)
    for start in range(0, len(hashes), 1 << 16):
        part = hashes[start:start + (1 << 16)] + _LANES
        counts += np.bincount(part.ravel(), minlength=2048).reshape(8, 256)
    ones = (counts @ _BYTE_BITS) * 2 > len(hashes)
    return int.from_bytes(np.packbits(ones.ravel()).tobytes(), "big")


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
                 shingle: int = 3) -> DataFrame:
    """(doc_id, fp): each row's fingerprint as a signed long."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows, 1024):
            fps = np.array([fingerprint(t, shingle) for t in raw_texts(batch.column(1))],
                           np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], ["doc_id", "fp"])

    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return source.mapInArrow(run, "doc_id long, fp long")


def covering_masks(radius: int) -> list[int]:
    """One mask per non-zero vector of radius + 1 bits, over the fingerprint's bits."""
    vectors = (1 << radius + 1) - 1
    return [sum(1 << i for i in range(BITS) if (i % vectors + 1 & v).bit_count() % 2)
            for v in range(1, vectors + 1)]


def _flips(free: int, radius: int) -> np.ndarray:
    """All ways to flip 1 to `radius` of the bits a table ignores."""
    bits = [1 << i for i in range(BITS) if free >> i & 1]
    ways, last = [], [(0, -1)]
    for _ in range(radius):
        last = [(p | b, j) for p, i in last for j, b in enumerate(bits) if j > i]
        ways += [p for p, _ in last]
    return np.array(ways, np.uint64)


def _pairs(fps: np.ndarray, free: int, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of distinct fingerprints of one bucket within the radius, in blocks."""
    if len(fps) <= PAIRWISE:
        near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= radius
        yield np.nonzero(np.triu(near, 1))
        return
    order = np.argsort(fps)
    ranked = fps[order]
    for flip in _flips(free, radius):
        other = ranked ^ flip
        at = np.minimum(np.searchsorted(ranked, other), len(ranked) - 1)
        hit = np.nonzero((ranked[at] == other) & (ranked < other))[0]
        yield order[hit], order[at[hit]]


def _forest(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> list[tuple[int, int]]:
    """Edges that connect what the pairs connect, at most n - 1 of them."""
    parent, kept = list(range(n)), []

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    for left, right in pairs:
        for a, b in zip(left.tolist(), right.tolist()):
            x, y = root(a), root(b)
            if x != y:
                parent[y] = x
                kept.append((a, b))
    return kept


def _bucket_links(masks: list[int], radius: int):
    """Links inside each bucket, from rows (table, key, fp) sorted by table and key."""
    def links(table: int, fps: np.ndarray) -> Iterator[tuple[int, int]]:
        free = ~masks[table] & (1 << BITS) - 1
        for a, b in _forest(len(fps), _pairs(fps.view(np.uint64), free, radius)):
            yield fps[a], fps[b]

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush(part: np.ndarray) -> Iterator[pa.RecordBatch]:
            if not len(part):
                return
            changed = np.any(part[1:, :2] != part[:-1, :2], axis=1)
            edges = np.concatenate([[0], np.nonzero(changed)[0] + 1, [len(part)]])
            found = [pair for i in np.nonzero(np.diff(edges) > 1)[0]
                     for g in [part[edges[i]:edges[i + 1]]]
                     for pair in links(int(g[0, 0]), np.ascontiguousarray(g[:, 2]))]
            if found:
                a, b = np.array(found, np.int64).T
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in rows:
            if not batch.num_rows:
                continue
            part = np.ascontiguousarray(np.stack([c.to_numpy() for c in batch.columns], axis=1)
                                        .astype(np.int64))
            first, last = part[0, :2], part[-1, :2]
            if held and not np.array_equal(held[-1][-1, :2], first):
                yield from flush(np.concatenate(held))
                held = []
            tail = np.nonzero(np.any(part[:, :2] != last, axis=1))[0]
            cut = tail[-1] + 1 if len(tail) else 0
            if cut:
                yield from flush(np.concatenate([*held, part[:cut]]))
                held = []
            held.append(part[cut:])
        if held:
            yield from flush(np.concatenate(held))

    return run


def links(prints: DataFrame, radius: int = 2) -> DataFrame:
    """(a, b): links between distinct fingerprints within the radius.

    They connect exactly the fingerprints that chains of links connect; links that close a
    circle inside a bucket are left out.
    """
    masks = covering_masks(radius)
    distinct = prints.select("fp").distinct()
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    tables = F.array(*[F.struct(F.lit(i).cast("long").alias("table"),
                                F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("key"))
                       for i, m in enumerate(signed)])
    buckets = (distinct.select(F.explode(tables).alias("t"), "fp")
               .select("t.table", "t.key", "fp")
               .repartition("table", "key").sortWithinPartitions("table", "key"))
    return buckets.mapInArrow(_bucket_links(masks, radius), "a long, b long")


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
                    shingle: int = 3, radius: int = 2) -> DataFrame:
    """(doc_id, fp, component_id): one row per input row; see the module for the cases."""
    prints = durable(fingerprints(docs, text, doc_id, shingle))
    components = connected_components(durable(links(prints, radius)))
    reps = prints.groupBy("fp").agg(F.min("doc_id").alias("rep"))
    rooted = durable(reps.join(components, reps["fp"] == components["node"], "left")
                     .select("fp", F.coalesce("component", "fp").alias("root"), "rep"))
    named = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    return (prints.join(durable(rooted.join(durable(named), "root").select("fp", "component_id")), "fp")
            .select("doc_id", "fp", "component_id"))


def one_of_each(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 3,
                radius: int = 2) -> DataFrame:
    """The rows of `docs` whose id names their component: the smallest document of each group.

    Of rows sharing such an id one stays, the one with the smallest text hash. Rows with a null
    id cannot stand for a group and all stay.
    """
    found = near_duplicates(docs, text, doc_id, shingle, radius).filter("doc_id = component_id")
    keep = found.groupBy(F.col("doc_id").alias("_id")).agg(F.count(F.lit(1)).alias("_n"))
    met = docs.join(durable(keep), F.col(doc_id) == F.col("_id"))
    first = Window.partitionBy("_id").orderBy(F.xxhash64(text), F.xxhash64(*docs.columns))
    several = (met.filter("_n > 1").withColumn("_turn", F.row_number().over(first))
               .filter("_turn = 1"))
    return (met.filter("_n = 1").select(*docs.columns).union(several.select(*docs.columns))
            .union(docs.filter(F.col(doc_id).isNull())))
