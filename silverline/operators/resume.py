"""Resume with a Bloom filter of what is done, so that only suspects are shuffled."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from silverline.operators.joins import skip_done
from silverline.operators.names import free_name

#: A block of the filter is 8 words of 64 bits; every key sets one bit in each word of one block.
WORDS, WORD_BITS = 8, 64
KEYS_A_BLOCK = 40
#: About 120 MB as a broadcast table.
MAX_BLOCKS = 1 << 20
_EXACT = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType, T.TimestampType)


def _hashable(left: T.DataType, right: T.DataType) -> bool:
    """Types whose equal values surely have equal hashes."""
    return left == right and (isinstance(left, _EXACT) or left == T.StringType())


def _block(key: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(blocks))


def _bit(key: str, word: int) -> Column:
    """The key's bit in a word, from six bits of a second hash."""
    place = F.shiftrightunsigned(F.xxhash64(F.col(key), F.lit(1)), 6 * word).bitwiseAND(WORD_BITS - 1)
    return F.call_function("shiftleft", F.lit(1).cast("long"), place.cast("int"))


def bloom_filter(done: DataFrame, key: str, blocks: int, place: str, words: list[str]) -> DataFrame:
    """One row per block in use: its place and words, merged from partial filters of the tasks."""
    return done.select(_block(key, blocks).alias(place), *[_bit(key, i).alias(w) for i, w in enumerate(words)]) \
        .groupBy(place).agg(*[F.bit_or(w).alias(w) for w in words])


def split_suspects(todo: DataFrame, done: DataFrame, key: str, blocks: int) -> tuple[DataFrame, DataFrame]:
    """Rows whose key may be done, and rows whose key surely is not; null keys are among the latter.

    The filter is a broadcast of `blocks` rows at most, so neither part is shuffled.
    """
    taken = [*todo.columns, key]
    place, words = free_name(taken, "_block"), [free_name(taken, f"_word_{i}") for i in range(WORDS)]
    known = F.broadcast(bloom_filter(done, key, blocks, place, words))
    probed = todo.withColumn(place, _block(key, blocks)).join(known, place, "left")
    hits = [F.col(w).bitwiseAND(_bit(key, i)) != 0 for i, w in enumerate(words)]
    suspect = F.coalesce(reduce(lambda a, b: a & b, hits), F.lit(False)) & F.col(key).isNotNull()
    return probed.filter(suspect).drop(place, *words), probed.filter(~suspect).drop(place, *words)


def skip_done_filtered(todo: DataFrame, done: DataFrame, key: str, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """`skip_done` for a large todo of mostly new keys: only rows that may be done are shuffled.

    Suspects are confirmed by an exact anti-join, so the answer is that of `skip_done`: null keys
    stay, repeated rows stay as often as they come. `todo` is read twice, which costs a scan and
    saves the shuffle. The filter's size follows the number of done keys, counted first; beyond
    `max_blocks`, and for keys whose hash might tell equal values apart, the plain join is used.
    """
    keys = done.select(key).filter(F.col(key).isNotNull())
    if not _hashable(todo.schema[key].dataType, done.schema[key].dataType):
        return skip_done(todo, done, key)
    blocks = keys.count() // KEYS_A_BLOCK + 1
    if blocks > max_blocks:
        return skip_done(todo, done, key)
    suspects, fresh = split_suspects(todo, keys, key, blocks)
    return suspects.join(keys, key, "left_anti").unionByName(fresh).select(*[F.col(f"`{c}`") for c in todo.columns])
