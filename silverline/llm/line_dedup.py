"""Line deduplication with two Bloom filters.

A line's key is the line without white space at its ends and with A-Z in lower case. A key of
at least `min_chars` code points that two documents hold stays only in the smallest of them.

1. Rows are numbered and stored; the distinct keys of each become 128-bit digests with the row's
   number and document, stored once (32 bytes a line).
2. The filters are cut into chunks by the digest's leading bits. A batch sends each chunk the
   keys it holds, once per batch however many of its documents hold them. The chunk marks them
   in its once-seen filter, and in its twice-seen filter if they were marked there before.
3. The twice-seen filter is broadcast. Keys that it does not hold are certainly unique and go
   no further; only suspects shuffle, to be counted exactly and to find their first document.
4. Rows meet their dropped keys by number and are written without them.

The filter grows with the lines, 16 bits each, so it is bounded: a pass covers at most
`max_filter_bytes` of it and beyond that there are further passes, each over its own range of
digests. Every digest is read in one pass only. Most common key: a batch sends it once, its
suspects are counted with partial aggregation, and the join to them is one that adaptive
execution may split.

Cases: null and empty texts are one empty line; a document that repeats a key keeps all its
copies if it is the first; rows sharing an id are one document (each is rewritten); a null id
counts as one document after all others; a text of any length is read whole, its lines and the
keys it loses in one task; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from silverline.llm.common import batches, numbered, raw_texts
from silverline.sources.shared import durable

CHUNK_BITS = 20
LINES_A_CHUNK = 1 << CHUNK_BITS - 4
MAX_FILTER_BYTES = 256 << 20
NO_ID = (1 << 63) - 1

_WHITE = b" \t\n\x0b\x0c\r"


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """The key of a line, or nothing if it is too short to count."""
    key = line.strip(_WHITE).lower()
    if len(key) < min_chars or len(key) < 4 * min_chars and len(key.decode()) < min_chars:
        return None
    return key


def _digests(min_chars: int):
    """(doc, h, g): the distinct keys of each document as two halves of a 128-bit digest.

    From (doc, text), or with the number of each row from (doc, text, row).
    """
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows, 1024):
            sizes, found = [], []
            for text in raw_texts(batch.column(1)):
                keys = {line_key(x, min_chars) for x in (text or b"").split(b"\n")} - {None}
                found += [xxhash.xxh3_128_digest(k) for k in keys]
                sizes.append(len(keys))
            pair = np.frombuffer(b"".join(found), np.int64).reshape(-1, 2)
            at = pa.array(np.repeat(np.arange(len(sizes)), sizes))
            rest = [c.take(at) for c in (batch.column(0), *batch.columns[2:])]
            yield pa.RecordBatch.from_arrays(
                [rest[0], pa.array(pair[:, 0]), pa.array(pair[:, 1]), *rest[1:]],
                ["doc", "h", "g", "row"][:len(rest) + 2])
    return run


def _places(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of a key inside its chunk."""
    mask = np.uint64((1 << CHUNK_BITS) - 1)
    return hashes & mask, hashes >> np.uint64(CHUNK_BITS) & mask


def _chunk_of(hashes: np.ndarray, chunk_bits: int) -> np.ndarray:
    if not chunk_bits:
        return np.zeros(len(hashes), np.int64)
    return (hashes >> np.uint64(64 - chunk_bits)).astype(np.int64)


def _sightings(chunk_bits: int):
    """(chunk, keys, again): a batch's distinct keys by chunk, and which it saw twice."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            if not batch.num_rows:
                continue
            hashes = batch.column(1).to_numpy().view(np.uint64)
            keys, counts = np.unique(hashes, return_counts=True)
            chunks = _chunk_of(keys, chunk_bits)
            edges = np.concatenate([[0], np.nonzero(np.diff(chunks))[0] + 1, [len(keys)]])
            cut = list(zip(edges[:-1], edges[1:]))
            yield pa.RecordBatch.from_arrays([
                pa.array(chunks[edges[:-1]]),
                pa.array([keys[a:b].tobytes() for a, b in cut], pa.binary()),
                pa.array([(counts[a:b] > 1).tobytes() for a, b in cut], pa.binary())],
                ["chunk", "keys", "again"])
    return run


def _twice(group: pd.DataFrame) -> pd.DataFrame:
    """The twice-seen filter of one chunk."""
    once, twice = np.zeros((2, 1 << CHUNK_BITS), bool)
    for keys, again in zip(group["keys"], group["again"]):
        first, second = _places(np.frombuffer(keys, np.uint64))
        seen = once[first] & once[second] | np.frombuffer(again, bool)
        twice[first[seen]] = twice[second[seen]] = True
        once[first] = once[second] = True
    return pd.DataFrame({"chunk": group["chunk"].iloc[:1],
                         "bits": [np.packbits(twice).tobytes()]})


def _suspects(filters, chunk_bits: int):
    """The digests whose key the twice-seen filter may hold."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = filters.value
        for batch in rows:
            hashes = batch.column(1).to_numpy().view(np.uint64)
            base = _chunk_of(hashes, chunk_bits) << CHUNK_BITS
            keep = np.ones(len(hashes), bool)
            for place in _places(hashes):
                at = base + place.astype(np.int64)
                keep &= (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)
            yield batch.filter(pa.array(keep))
    return run


def _filter_bits(sightings: DataFrame, chunks: int) -> np.ndarray:
    """All chunks of the twice-seen filter: `chunks` times 2^CHUNK_BITS bits, no more."""
    rows = sightings.groupBy("chunk").applyInPandas(_twice, "chunk long, bits binary")
    whole = np.zeros((chunks, (1 << CHUNK_BITS) // 8), np.uint8)
    for row in rows.toLocalIterator():
        whole[row["chunk"]] = np.frombuffer(row["bits"], np.uint8)
    return whole.ravel()


def repeated_keys(digests: DataFrame, max_filter_bytes: int = MAX_FILTER_BYTES,
                  lines_a_chunk: int = LINES_A_CHUNK) -> DataFrame:
    """The rows of (doc, h, g) or (doc, h, g, row) whose digest a smaller document holds too."""
    spark = digests.sparkSession
    chunks_a_pass = max(1, 1 << int(math.log2(max(1, max_filter_bytes >> CHUNK_BITS - 3))))
    needed = max(1, digests.count() / lines_a_chunk)
    chunks = 1 << math.ceil(math.log2(needed))
    passes = max(1, chunks // chunks_a_pass)
    chunk_bits, pass_bits = int(math.log2(min(chunks, chunks_a_pass))), int(math.log2(passes))
    suspects = None
    for i in range(passes):
        own = digests
        if passes > 1:  # a pass is a range of the second half; chunks go by the first
            own = digests.filter(F.shiftrightunsigned("g", 64 - pass_bits) == i)
        seen = own.mapInArrow(_sightings(chunk_bits), "chunk long, keys binary, again binary")
        bits = _filter_bits(seen, 1 << chunk_bits)
        found = own.mapInArrow(_suspects(spark.sparkContext.broadcast(bits), chunk_bits),
                               ", ".join(f"{c} long" for c in digests.columns))
        suspects = found if suspects is None else suspects.union(found)
    firsts = (suspects.groupBy("h", "g").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
              .filter("first < last").drop("last"))
    firsts = durable(firsts)  # so that the join is one that adaptive execution may split
    return suspects.join(firsts, ["h", "g"]).filter("doc > first").select(*digests.columns)


def _without(min_chars: int):
    """Each text without its dropped lines."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows, 1024):
            kept, lines, dropped = [], [], []
            for text, drop in zip(raw_texts(batch.column(1)), batch.column(2).to_pylist()):
                rest = own = (text or b"").split(b"\n")
                if drop:
                    gone = {np.array([d["h"], d["g"]]).tobytes() for d in drop}
                    rest = [x for x in own if (k := line_key(x, min_chars)) is None
                            or xxhash.xxh3_128_digest(k) not in gone]
                kept.append(b"\n".join(rest))
                lines.append(len(own))
                dropped.append(len(own) - len(rest))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(kept, pa.binary()).cast(pa.string()),
                 pa.array(lines, pa.int64()), pa.array(dropped, pa.int64()), batch.column(3)],
                ["doc_id", "kept_text", "n_lines", "n_dropped", "rest"])
    return run


def dedup_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_chars: int = 10,
                max_filter_bytes: int = MAX_FILTER_BYTES, keep: list[str] | None = None) -> DataFrame:
    """(doc_id, kept_text, n_lines, n_dropped) and the columns named in `keep`, one row per row."""
    rest = F.struct(*[F.col(c) for c in keep]) if keep else F.lit(None).cast("int")
    whole = numbered(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"),
                                 rest.alias("rest")))
    source = whole.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), "text", "row")
    digests = durable(source.mapInArrow(_digests(min_chars), "doc long, h long, g long, row long"))
    drops = (repeated_keys(digests, max_filter_bytes)
             .groupBy("row").agg(F.collect_list(F.struct("h", "g")).alias("drops")))
    met = whole.join(drops, "row", "left")
    kind = (StructType().add("doc_id", "long").add("kept_text", "string").add("n_lines", "long")
            .add("n_dropped", "long").add(met.schema["rest"]))
    out = met.select("doc_id", "text", "drops", "rest").mapInArrow(_without(min_chars), kind)
    return out.select("doc_id", "kept_text", "n_lines", "n_dropped",
                      *[F.col(f"rest.`{c}`").alias(c) for c in keep or []])
