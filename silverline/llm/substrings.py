"""Substring deduplication by recompression.

A window of `WINDOW` words that also starts anywhere else, in the same document or another, is
a repeat; every word that a repeat covers is removed.

Recompression shortens a text in rounds: a run round names maximal runs of one symbol, a pair round
splits all symbols into left and right ones by a bit of their hash and names every left symbol
followed by a right one. A name is a hash of what it stands for, so all tasks give the same
name to the same symbols without exchanging anything, and a round is a few array operations.
What a symbol looks like depends only on the few words around it. That stretch, its support, is
carried along. Equal words therefore have equal symbols inside, namely all whose support
lies within.

1. Each window is known by its anchor: of the highest-level symbols whose support it contains,
   the one with the smallest name. Equal windows have equal anchors at the same offset.
   Neighbouring windows mostly share one, and are one row: the anchor's key (its support), a
   digest of all words that they cover, and where they start.
2. Keys are counted. One that occurs once proves its windows unique: they go no further. If all
   rows of a key agree in their digest, all their windows are repeats.
3. Where rows of a key differ, one row of each digest is compared window by window: documents
   meet these rows, and digests of single windows are counted.
4. Documents meet their repeats by row number and are written without them.

Digests of words have 128 bits (keys 64, which only ever costs a comparison). Sums run over
partial aggregates, and the joins back to rows are ones that adaptive execution may split, so
a passage that a third of all documents share is spread like any other. Long documents are
read in stretches that overlap by a window, so memory does not follow their length.

Rows are numbered and stored once; the number is a row's place everywhere.

Cases: null texts have no words; shorter texts than a window keep all; rows sharing an id are
separate documents (each a place where a window may start); a null id likewise; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from silverline.llm.common import batches, numbered, raw_texts
from silverline.sources.shared import fresh_path

WINDOW = 35
ROUNDS = ("run", "pair", "pair", "pair", "pair", "pair")
STRETCH = 1 << 15
BLOCK = 1 << 17
END = np.uint64(0)

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD))
_BASES = (0x9E3779B97F4A7C15 | 5, 0xD6E8FEB86659FD93 | 5)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(32)) * _C
    x = (x ^ x >> np.uint64(29)) * _A
    return x ^ x >> np.uint64(32)


class Powers:
    """Powers of the two digest bases and of their inverses modulo 2^64."""

    def __init__(self, size: int):
        self.up, self.down = [], []
        for base in _BASES:
            for out, factor in ((self.up, base), (self.down, pow(base, -1, 1 << 64))):
                steps = np.full(size, factor, np.uint64)
                steps[0] = 1
                out.append(np.multiply.accumulate(steps))


class Digests:
    """Digests of any stretch of a row of symbols."""

    def __init__(self, symbols: np.ndarray, powers: Powers):
        n = len(symbols)
        self.powers = powers
        self.sums = [np.concatenate([[END], np.cumsum(symbols * up[:n])]) for up in powers.up]

    def __call__(self, start: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
        sums = self.sums[which]
        return mixed((sums[end] - sums[start]) * self.powers.down[which][start]
                     + (end - start).astype(np.uint64))


def _run_round(sym, low, high):
    starts = np.concatenate([[True], sym[1:] != sym[:-1]])
    first = np.nonzero(starts)[0]
    last = np.append(first[1:], len(sym)) - 1
    size = last - first + 1
    name = np.where(size > 1, mixed(sym[first] * _A + size.astype(np.uint64) * _B) | np.uint64(1),
                    sym[first])
    return (np.where(sym[first] == END, END, name),
            low[np.maximum(first - 1, 0)], high[np.minimum(last + 1, len(sym) - 1)])


def _pair_round(sym, low, high, salt: int):
    bit = (mixed(sym ^ np.uint64(salt * 0x632BE59BD9B4E019 % (1 << 64))) & np.uint64(1)).astype(bool)
    left, right = bit & (sym != END), ~bit & (sym != END)
    pair = np.zeros(len(sym), bool)
    pair[:-1] = left[:-1] & right[1:]
    follows = np.concatenate([[False], pair[:-1]])
    at = np.nonzero(~follows)[0]
    after, before = np.minimum(at + 1, len(sym) - 1), np.maximum(at - 1, 0)
    joint = pair[at]
    name = np.where(joint, mixed(sym[at] * _A + mixed(sym[after] + np.uint64(salt))) | np.uint64(1),
                    sym[at])
    return (name, np.where(right[at], low[before], low[at]),
            np.where(left[at], high[after], high[at]))


def parse(words: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Level by level the symbols of a row of words, and the start and end of their support.

    END separates texts, and comes first and last; it is never part of a name.
    """
    place = np.arange(len(words))
    levels = [(words, place, place + 1)]
    for number, kind in enumerate(ROUNDS):
        sym, low, high = levels[-1]
        levels.append(_run_round(sym, low, high) if kind == "run"
                      else _pair_round(sym, low, high, number + 1))
    return levels


def anchors(words: np.ndarray, wanted: np.ndarray, window: int):
    """The levels, and the level and index of the anchor of each wanted window start."""
    levels = parse(words)
    level = np.full(len(wanted), -1)
    index = np.zeros(len(wanted), np.int64)
    for number in range(len(levels) - 1, -1, -1):
        open_ = np.nonzero(level < 0)[0]
        if not len(open_):
            break
        sym, low, high = levels[number]
        # Symbols whose support starts at or after s, and ends by s + window.
        starts = np.concatenate([[0], np.cumsum(np.bincount(low, minlength=len(words) + 1))[:-1]])
        ends = np.cumsum(np.bincount(high, minlength=len(words) + 1))
        first, last = starts[wanted[open_]], ends[wanted[open_] + window]
        some = last > first
        open_, first, last = open_[some], first[some], last[some]
        if not len(open_):
            continue
        rank = mixed(sym + _B)
        tables, step = [np.arange(len(sym))], 1
        while 2 * step <= int((last - first).max()):
            old = tables[-1]
            one, two = old[:-step], old[step:]
            tables.append(np.concatenate([np.where(rank[two] < rank[one], two, one), old[-step:]]))
            step *= 2
        power = np.frexp((last - first).astype(np.float64))[1] - 1
        best = np.empty(len(open_), np.int64)
        for p in range(len(tables)):
            own = power == p
            one, two = tables[p][first[own]], tables[p][last[own] - (1 << p)]
            best[own] = np.where(rank[two] < rank[one], two, one)
        level[open_], index[open_] = number, best
    return levels, level, index


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


class Reader:
    """Turns text into word ids with array operations; holds the powers that digests need."""

    def __init__(self):
        self.powers = Powers(max(BLOCK + 2, 2 * STRETCH))

    def _ids(self, raw: bytes) -> np.ndarray:
        if len(raw) > BLOCK:  # one word without end
            return np.array([xxhash.xxh3_64_intdigest(w) | 1 for w in raw.split()], np.uint64)
        codes = np.frombuffer(raw, np.uint8)
        solid = np.concatenate([[False], ~_SPACE[codes], [False]])
        edges = np.nonzero(solid[1:] != solid[:-1])[0]
        start, end = edges[::2], edges[1::2]
        sums = np.concatenate([[END], np.cumsum((codes + np.uint64(1)) * self.powers.up[1][:len(codes)])])
        return mixed((sums[end] - sums[start]) * self.powers.down[1][start]
                     ^ (end - start).astype(np.uint64) * _B) | np.uint64(1)

    def words(self, text: bytes | None) -> np.ndarray:
        """An id for each word of a text, never END."""
        text = text or b""
        if len(text) <= BLOCK:
            return self._ids(text)
        found, at = [], 0
        while at < len(text):
            cut = at + BLOCK
            if cut < len(text):
                back = max(text.rfind(c, at, cut) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
                if back < 0:
                    ahead = [text.find(c, cut) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c")]
                    back = min((x for x in ahead if x >= 0), default=len(text) - 1)
                cut = back + 1
            found.append(self._ids(text[at:cut]))
            at = cut
        return np.concatenate(found)


def _stretches(texts: list[np.ndarray], window: int) -> Iterator[list[tuple[int, int, np.ndarray]]]:
    """Groups of (text, first word, words) of about STRETCH words; each window lies in one."""
    group, size = [], 0
    for number, words in enumerate(texts):
        for at in range(0, max(0, len(words) - window + 1), STRETCH):
            part = words[at:at + STRETCH + window - 1]
            if size + len(part) > STRETCH and group:
                yield group
                group, size = [], 0
            group.append((number, at, part))
            size += len(part) + 1
    if group:
        yield group


def _anchor_rows(window: int):
    """(row, key, digest, start, count): a row for each run of windows with one anchor."""
    names = ["row", "key", "digest", "start", "count"]

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader()
        for batch in batches(rows, 512):
            numbers = batch.column(0).to_numpy()
            texts = [reader.words(t) for t in raw_texts(batch.column(1))]
            for group in _stretches(texts, window):
                sizes = np.array([len(p) for _, _, p in group])
                words = np.concatenate([x for _, _, p in group for x in ([END], p)] + [[END]])
                begins = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]]) + 1
                counts = np.maximum(0, sizes - window + 1)
                part = np.repeat(np.arange(len(group)), counts)
                inner = np.arange(len(part)) - np.repeat(np.cumsum(counts) - counts, counts)
                wanted = begins[part] + inner
                levels, level, index = anchors(words, wanted, window)
                new = np.concatenate([[True], (level[1:] != level[:-1]) | (index[1:] != index[:-1])
                                      | (part[1:] != part[:-1])])
                first = np.nonzero(new)[0]
                last = np.append(first[1:], len(wanted)) - 1
                low, high = np.empty(len(first), np.int64), np.empty(len(first), np.int64)
                for number, (_, lows, highs) in enumerate(levels):
                    own = level[first] == number
                    low[own], high[own] = lows[index[first[own]]], highs[index[first[own]]]
                digests = Digests(words, reader.powers)
                owner = np.array([n for n, _, _ in group])[part[first]]
                offset = np.array([at for _, at, _ in group])[part[first]]
                yield pa.RecordBatch.from_arrays([
                    pa.array(numbers[owner]),
                    pa.array(digests(low, high).view(np.int64)),
                    pa.array(digests(wanted[first], wanted[last] + window, 1).view(np.int64)),
                    pa.array((offset + inner[first]).astype(np.int32)),
                    pa.array((last - first + 1).astype(np.int32))], names)
    return run


def _window_rows(window: int):
    """(h, g, row, start, lone): single windows of the chosen rows, with their digests."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader()
        for batch in batches(rows, 256):
            for row, text, chosen in zip(batch.column(0).to_pylist(), raw_texts(batch.column(1)),
                                         batch.column(2).to_pylist()):
                words = reader.words(text)
                start = np.array([c["start"] for c in chosen])
                count = np.array([c["count"] for c in chosen])
                lone = np.repeat(np.array([c["lone"] for c in chosen]), count)
                at = np.repeat(start, count) + np.arange(count.sum()) - np.repeat(
                    np.cumsum(count) - count, count)
                both = []
                for which in (0, 1):
                    total = np.zeros(len(at), np.uint64)
                    for j in range(window):
                        total += words[at + j] * reader.powers.up[which][j]
                    both.append(mixed(total).view(np.int64))
                yield pa.RecordBatch.from_arrays([
                    pa.array(both[0]), pa.array(both[1]),
                    pa.array(np.full(len(at), row)), pa.array(at.astype(np.int32)), pa.array(lone)],
                    ["h", "g", "row", "start", "lone"])
    return run


def _stored(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder once, by columns, and read again."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def repeats(texts: DataFrame, window: int = WINDOW) -> DataFrame:
    """(row, start, count): window starts whose words also start elsewhere.

    From stored (row, text), where each row has a number of its own.
    """
    place = ["row", "start", "count"]
    rows = _stored(texts.mapInArrow(
        _anchor_rows(window), "row long, key long, digest long, start int, count int"), "anchors")
    keys = (rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("digest").alias("low"),
                                    F.max("digest").alias("high")).filter("n > 1")
            .select("key", (F.col("low") == F.col("high")).alias("same")))
    packed = rows.select("key", "digest", "row", F.expr(
        "shiftleft(cast(start as bigint), 32) | count").alias("at"))
    shared = packed.join(_stored(keys, "keys"), "key").select(
        "key", "digest", "row", "same", F.expr("cast(shiftrightunsigned(at, 32) as int)").alias("start"),
        F.expr("cast(at & 4294967295 as int)").alias("count"))
    shared = _stored(shared, "shared")
    mixed_rows = shared.filter("not same")
    digests = _stored(mixed_rows.groupBy("key", "digest").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct(*place)).alias("one")), "digests")
    whole = (mixed_rows.join(digests.filter("n > 1").select("key", "digest"), ["key", "digest"])
             .select(*place).union(shared.filter("same").select(*place)))
    chosen = (digests.select("one.*", (F.col("n") == 1).alias("lone"))
              .groupBy("row").agg(F.collect_list(F.struct("start", "count", "lone")).alias("chosen")))
    windows = texts.join(chosen, "row").select("row", "text", "chosen").mapInArrow(
        _window_rows(window), "h long, g long, row long, start int, lone boolean")
    windows = _stored(windows, "windows")
    twice = (windows.groupBy("h", "g").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
             .select("h", "g"))
    single = (windows.filter("lone").join(_stored(twice, "twice"), ["h", "g"])
              .select("row", "start", F.lit(1).alias("count")))
    return whole.union(single)


def _without(window: int):
    """Each text without the words that repeats cover."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows, 512):
            kept, n_words, n_removed = [], [], []
            for text, gone in zip(raw_texts(batch.column(1)), batch.column(2).to_pylist()):
                words = (text or b"").split()
                n_words.append(len(words))
                if gone:
                    cover = np.zeros(len(words) + 1, np.int64)
                    start = np.array([g["start"] for g in gone])
                    np.add.at(cover, start, 1)
                    np.add.at(cover, start + [g["count"] + window - 1 for g in gone], -1)
                    words = [words[i] for i in np.nonzero(np.cumsum(cover[:-1]) == 0)[0]]
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(kept, pa.binary()).cast(pa.string()),
                 pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())],
                ["doc_id", "kept_text", "n_words", "n_removed"])
    return run


def dedup_substrings(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
                     window: int = WINDOW) -> DataFrame:
    """(doc_id, kept_text, n_words, n_removed), one row per row; kept words joined by one space."""
    texts = numbered(docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")))
    found = (repeats(texts.select("row", "text"), window)
             .groupBy("row").agg(F.collect_list(F.struct("start", "count")).alias("gone")))
    met = texts.join(found, "row", "left")
    return met.select("doc_id", "text", "gone").mapInArrow(
        _without(window), "doc_id long, kept_text string, n_words long, n_removed long")
