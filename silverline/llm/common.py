"""Helpers shared by the corpus operators.

Words are maximal runs of bytes other than space, tab, line feed, vertical tab, form feed and
carriage return. `bytes.split()` cuts at exactly those six, so UTF-8 text is split unchanged
and no other Unicode space counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from silverline.sources.shared import fresh_path

SPACE = r"[\x20\x09-\x0D]"
SAMPLE_PARTS = 64
WINDOWS = 8
BROADCAST_ROWS = 1 << 19
SPACES = " \t\n\x0b\x0c\r"


def raw_texts(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """UTF-8 bytes of a string column, without decoding them."""
    return column.cast(pa.binary()).to_pylist()


def integers(column: pa.Array | pa.ChunkedArray, null: int = -1) -> np.ndarray:
    """An integer column as an array; nulls become `null`."""
    return column.fill_null(null).to_numpy(zero_copy_only=False)


def word_ends(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Where each word starts and ends in the words joined by one space."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    return ends - sizes, ends


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept for testing: crc32 of its id as text leaves 2 modulo 4."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2, F.lit(False))


def sample_by_hash(df: DataFrame, group: str, key: str, size: int) -> DataFrame:
    """At most `size` rows of each group, those with the smallest key hashes.

    Chosen in two steps: a group's rows are thinned in `SAMPLE_PARTS` parts first, so the task
    that chooses finally sees a bounded number of rows, however many tasks there are.
    """
    order = [F.xxhash64(key), F.col(key)]
    parts = Window.partitionBy(group, F.pmod(F.xxhash64(key, F.lit(group)), F.lit(SAMPLE_PARTS))).orderBy(*order)
    whole = Window.partitionBy(group).orderBy(*order)
    thin = df.withColumn("_n", F.row_number().over(parts)).filter(F.col("_n") <= size)
    return thin.withColumn("_n", F.row_number().over(whole)).filter(F.col("_n") <= size).drop("_n")


def text_windows(text: str, max_chars: int) -> Column:
    """A text, or of a longer one `WINDOWS` stretches spread evenly over it, `max_chars` in all."""
    size = max_chars // WINDOWS
    parts = [F.substring(F.col(text), (F.floor((F.length(text) - size) * i / (WINDOWS - 1)) + 1).cast("int"), F.lit(size))
             for i in range(WINDOWS)]
    return F.when(F.length(text) <= max_chars, F.col(text)).otherwise(F.concat_ws(" ", *parts))


def batches(rows: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of at most `limit`, to bound what a task holds as objects."""
    for batch in rows:
        for start in range(0, batch.num_rows, limit):
            yield batch.slice(start, limit)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder once, by columns, and read again."""
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, name: str = "rows") -> DataFrame:
    """The rows with a unique number in `row`, stored so that every reader sees the same ones."""
    return stored(df.withColumn("row", F.monotonically_increasing_id()), name)


def bounded(df: DataFrame) -> DataFrame:
    """A stored table of a few numbers a row, marked for broadcast if it has at most BROADCAST_ROWS rows."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df
