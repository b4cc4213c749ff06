"""Source divergence audit: how far the term frequencies of sources of one language lie apart.

A term is a maximal run of letters (A-Z in lower case, a-z, everything beyond ASCII). A language
keeps the terms that at least `least_docs` of its documents hold. Each (lang, source) group and
each whole language gives a kept term the smoothed share
p = 1 + floor(SCALE * (count + ADDED) / (N + ADDED * V)), all in whole numbers.

1. Terms are counted by slices of texts, sorted by group, in numpy. A term of at most 8 bytes is
   one big-endian word, of at most 16 bytes two; a bucket of terms with equally many 16-bit digits
   is sorted by radix, digit by digit, and its runs are counted. The sorts are stable and the
   texts in group order, so a run of one term falls into runs of groups and documents. Longer
   terms are sorted as bytes, in a bucket for each length.
2. Spark sums the slices' counts by (lang, source, term), keeps the terms with enough documents,
   and works out every share. `term` rows are a ranking whose map side keeps `top` rows a group.
3. `pair` rows need every two sources of a language, never a row for two sources and a term: the
   kept terms fall into blocks of at most about `CELLS` sources times terms, a block becomes one
   matrix and gives the sums of absolute differences of each two sources, for tiles of about
   `TILE` sources at a time; blocks are summed.

A hot group or term costs one row per slice before the sums. Nothing is gathered for a whole
language but its list of sources (names and totals), which each block of it receives.

Cases: null texts hold no terms; a null language or source counts as ''; groups without terms take
part with the share of a count of 0; a language without kept terms has pairs of value 0 and no
`term` rows; a language with one source has no pairs; ties go by the item's bytes; repeated rows
count as documents of their own (ids are not read); a term may be as long as a text; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from silverline.llm.common import raw_texts, stored

LEAST_DOCS, TOP = 30, 50
SCALE, ADDED = 1_000_000_000, 5
SLICE_BYTES = 4 << 20
CELLS, TILE = 1 << 16, 1024
STEP = 10 ** 4

_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 0 for c in range(256))


def _radix_order(digits: list[np.ndarray]) -> np.ndarray:
    """The stable order of rows by 16-bit digits, most significant first."""
    order = np.arange(len(digits[0]))
    for digit in reversed(digits):
        order = order[np.argsort(digit[order], kind="stable")]  # numpy sorts 16 bits by radix
    return order


def _packed(buffer: bytes, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Eight bytes from each start as one big-endian word, zero from each size on."""
    words = np.ndarray(len(buffer) - 7, ">u8", buffer, strides=(1,))[starts].astype(np.uint64)
    rest = ((8 - np.clip(sizes, 0, 8)) * 8).astype(np.uint64)
    gone = rest >= 64
    rest[gone] = 0
    words = words >> rest << rest
    words[gone] = 0
    return words


def _sorted_buckets(buffer: bytes, starts: np.ndarray, sizes: np.ndarray
                    ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places in sorted order, whether each begins a new term), bucket by bucket."""
    count = (sizes + 1) // 2
    for digits in range(1, 9):
        at = np.nonzero(count == digits)[0]
        if not len(at):
            continue
        words = [_packed(buffer, starts[at] + k, sizes[at] - k) for k in range(0, 2 * digits, 8)]
        order = _radix_order([(words[d // 4] >> np.uint64(48 - 16 * (d % 4))).astype(np.uint16)
                              for d in range(digits)])
        words = [w[order] for w in words]
        yield at[order], _changes(words)
    for size in np.unique(sizes[sizes > 16]):
        at = np.nonzero(sizes == size)[0]
        terms = np.array([buffer[s:s + size] for s in starts[at].tolist()], f"S{size}")
        order = np.argsort(terms, kind="stable")
        yield at[order], _changes([terms[order]])


def _changes(columns: list[np.ndarray]) -> np.ndarray:
    """Whether each row differs from the one before in any of the columns."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for own in columns:
        new[1:] |= own[1:] != own[:-1]
    return new


def term_counts(texts: list[bytes], groups: np.ndarray) -> Iterator[tuple[list, np.ndarray, ...]]:
    """(terms, group of each, occurrences, documents), from texts and their group numbers."""
    order = np.argsort(groups, kind="stable")
    buffer = b"\0".join([texts[i] for i in order]).translate(_LETTERS) + bytes(16)
    lengths = np.array([len(texts[i]) + 1 for i in order], np.int64)
    inside = np.frombuffer(buffer, np.uint8) != 0
    edges = np.nonzero(np.diff(inside, prepend=False))[0]
    starts, sizes = edges[::2], edges[1::2] - edges[::2]
    doc = np.searchsorted(np.cumsum(lengths), starts, "right")
    group = groups[order]
    for at, new_term in _sorted_buckets(buffer, starts, sizes):
        docs = doc[at]
        new_doc = new_term | _changes([docs])
        own = group[docs]
        first = np.nonzero(new_term | _changes([own]))[0]
        places, long = starts[at[first]], sizes[at[first]]
        yield ([buffer[s:s + n] for s, n in zip(places.tolist(), long.tolist())], own[first],
               np.diff(first, append=len(at)), np.add.reduceat(new_doc.astype(np.int64), first))


def _slices(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about SLICE_BYTES, one row at least."""
    start, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if total and total + size > SLICE_BYTES:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def _counted(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs) of each slice, from (text, lang, source)."""
    for batch in rows:
        pairs = pa.StructArray.from_arrays(batch.columns[1:], ["lang", "source"])
        codes: dict = {}
        groups = np.array([codes.setdefault((p["lang"], p["source"]), len(codes)) for p in pairs.to_pylist()],
                          np.int64)
        names = [pa.array([k[i] for k in codes], pa.string()) for i in (0, 1)]
        texts = [t or b"" for t in raw_texts(batch.column(0))]
        for a, b in _slices(np.array([len(t) for t in texts])):
            for terms, own, n, docs in term_counts(texts[a:b], groups[a:b]):
                own = pa.array(own)
                yield pa.RecordBatch.from_arrays(
                    [names[0].take(own), names[1].take(own), pa.array(terms, pa.binary()).cast(pa.string()),
                     pa.array(n), pa.array(docs)], ["lang", "source", "term", "n", "docs"])


def _share(n: str, total: str) -> Column:
    """The share of a count in its group, in two steps that stay within 64 bits."""
    below, upper = f"({total} + {ADDED} * kept)", f"(({n} + {ADDED}) * {SCALE // STEP})"
    return F.expr(f"1 + {upper} div {below} * {STEP} + {upper} % {below} * {STEP} div {below}")


def _pair_sums(entries: pd.DataFrame, sources: pd.DataFrame) -> pd.DataFrame:
    """(lang, source, item, value): what a block's terms add for each source of a tile and each other one."""
    sources = sources.sort_values("source", ignore_index=True)
    column, terms = pd.factorize(entries["term"])
    shares = np.repeat(sources["empty"].to_numpy(np.int64)[:, None], len(terms), axis=1)
    row = pd.Index(sources["source"]).get_indexer(entries["source"])
    shares[row, column] = entries["share"].to_numpy(np.int64)
    own = np.nonzero(sources["tile"] == sources["part"])[0]
    sums = np.array([np.abs(shares - shares[i]).sum(axis=1) for i in own]).reshape(len(own), len(sources))
    a, b = np.repeat(own, len(sources)), np.tile(np.arange(len(sources)), len(own))
    names = sources["source"].to_numpy()
    out = pd.DataFrame({"lang": sources["lang"].iloc[0] if len(sources) else "", "source": names[a],
                        "item": names[b], "value": sums.ravel()})
    return out[a != b]


def _kept_terms(texts: DataFrame, least_docs: int) -> DataFrame:
    """(lang, term, n, own): kept terms, their occurrences, and those of each source that has any."""
    found = texts.mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
    by_source = found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    # A list holds one entry per source.
    return (by_source.groupBy("lang", "term")
            .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("own"))
            .filter(F.col("docs") >= least_docs).drop("docs"))


def _ranked(rows: DataFrame, top: int | None = None) -> DataFrame:
    """Numbered by value downwards, then by the item's bytes, within each source and language."""
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    rows = rows.withColumn("rank", F.row_number().over(order))
    return rows if top is None else rows.filter(F.col("rank") <= top)


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
          least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): distances to other sources and the most overused terms."""
    name = lambda c, own: F.coalesce(F.col(c), F.lit("")).alias(own)
    texts = docs.select(F.col(text).alias("text"), name(lang, "lang"), name(source, "source"))
    kept = stored(_kept_terms(texts, least_docs), "terms")
    each = kept.select("lang", "term", F.col("n").alias("all"), F.explode("own").alias("own")).select(
        "lang", "term", "all", "own.source", "own.n")

    known = texts.select("lang", "source").distinct()
    totals = each.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = (known.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"))
             .join(kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("n").alias("lang_total")),
                   "lang", "left").fillna(0, ["kept", "lang_total"]))
    groups = stored(known.join(totals, ["lang", "source"], "left").fillna(0, ["total"]).join(langs, "lang")
                    .withColumn("blocks", F.expr(f"greatest(1, (kept * sources + {CELLS - 1}) div {CELLS})"))
                    .withColumn("tiles", F.expr(f"(sources + {TILE - 1}) div {TILE}")), "groups")

    shares = (each.join(groups, ["lang", "source"])
              .withColumn("share", _share("n", "total")).withColumn("among", _share("`all`", "lang_total")))
    terms = _ranked(shares.filter("share > among")
                    .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                            (F.col("share") - F.col("among")).alias("value")), top)

    numbers = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    block = F.pmod(F.xxhash64("term"), F.col("blocks"))
    entries = (shares.select("lang", block.alias("block"), "tiles", "source", "term", "share")
               .withColumn("tile", numbers("tiles")).drop("tiles"))
    empty = F.when(F.col("kept") > 0, _share("0", "total")).otherwise(0)
    sides = (groups.select("lang", "source", empty.alias("empty"), "blocks", "tiles",
                           F.pmod(F.xxhash64("source"), F.col("tiles")).alias("part"))
             .withColumn("block", numbers("blocks")).withColumn("tile", numbers("tiles"))
             .drop("blocks", "tiles"))
    cell = ["lang", "block", "tile"]
    sums = (entries.groupBy(*cell).cogroup(sides.groupBy(*cell))
            .applyInPandas(_pair_sums, "lang string, source string, item string, value long"))
    pairs = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pairs = _ranked(pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value"))
    return pairs.union(terms)
