"""Best-fit packing of documents into sequences of several permitted lengths.

Documents longer than the longest length are cut into full sequences and a rest; all others
stay whole. Rests and whole documents are packed by best fit, longest first: an item goes to the
open bin that it fills best. If none has room, a new bin opens at the length that costs least
for each word that it can still be expected to hold: `cost(length)` over the item plus what the
smaller items waiting in the same group can add to it. In the end every bin is downsized to the
shortest permitted length that holds its contents, so a bin opened wide costs nothing extra.

The default cost of a sequence of n words is n + n^2 / 65536 + 8: its words, the attention
between them, and a fixed share.

Items are dealt to groups by a hash of id and piece; a group holds about `items_a_group` items
on average, so the number of groups follows the rows and the memory of a task does not. Groups
are packed on their own and in a fixed order, so a rerun after a lost executor gives the same
bins. Only ids and sizes are packed: no text is moved. What is lost by not packing across groups is
at most a few half-filled bins for each group.

Cases: null texts and texts without words have nothing to pack and give no row; a null id is
packed like any other; rows sharing an id are separate items with their own `row`; a word is never
split; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from silverline.llm.mixing import word_count
from silverline.sources.shared import durable

LENGTHS = (512, 1024, 2048, 4096)
ITEMS_A_GROUP = 8192

SCHEMA = ("doc_id long, row long, piece long, start long, n_words long, "
          "bin_id string, bin_length long, bin_offset long")


def sequence_cost(length: int) -> float:
    return length + length * length / 65536 + 8


def opening(size: int, waiting: int, lengths: Sequence[int],
            cost: Callable[[int], float]) -> int:
    """The length to open for an item while `waiting` words of smaller items are still to come."""
    fit = [n for n in lengths if n >= size]
    return min(fit, key=lambda n: (cost(n) / (size + min(n - size, waiting)), -n))


def pack(sizes: Sequence[int], lengths: Sequence[int] = LENGTHS,
         cost: Callable[[int], float] = sequence_cost) -> tuple[list[int], list[int], list[int]]:
    """For items in falling order: the bin of each, its offset there, and the bins' lengths."""
    rooms: list[tuple[int, int]] = []  # (room left, bin), sorted
    used: list[int] = []
    room: list[int] = []
    at, offsets, waiting = [], [], sum(sizes)
    for size in sizes:
        waiting -= size
        found = bisect_left(rooms, (size, -1))
        if found < len(rooms):
            left, own = rooms.pop(found)
        else:
            own, left = len(used), opening(size, waiting, lengths, cost)
            used.append(0)
            room.append(left)
        at.append(own)
        offsets.append(used[own])
        used[own] += size
        if left > size:
            insort(rooms, (left - size, own))
    final = [min(n for n in lengths if n >= u) for u in used]
    return at, offsets, final


def _packer(lengths: Sequence[int], cost: Callable[[int], float]):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        items = group.sort_values(["n_words", "doc_id", "row", "piece"],
                                  ascending=[False, True, True, True], na_position="last")
        at, offsets, final = pack(items["n_words"].tolist(), lengths, cost)
        name = items["group"].iloc[0]
        return pd.DataFrame({
            "doc_id": items["doc_id"], "row": items["row"], "piece": items["piece"],
            "start": items["start"], "n_words": items["n_words"],
            "bin_id": [f"{name}-{b}" for b in at],
            "bin_length": np.array(final, np.int64)[at] if len(at) else np.zeros(0, np.int64),
            "bin_offset": offsets})
    return run


def pack_documents(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
                   lengths: Sequence[int] = LENGTHS,
                   cost: Callable[[int], float] = sequence_cost,
                   items_a_group: int = ITEMS_A_GROUP) -> DataFrame:
    """One row per packed piece: words start .. start + n_words of a document in a bin."""
    lengths = sorted(lengths)
    longest = lengths[-1]
    sized = durable(docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                                word_count(text).alias("size"))
                    .filter("size > 0").withColumn("row", F.monotonically_increasing_id()))
    pieces = (sized.withColumn("piece", F.explode(F.sequence(
        F.lit(0).cast("long"), F.expr(f"(size - 1) div {longest}"))))
        .withColumn("start", F.col("piece") * longest)
        .withColumn("n_words", F.least(F.lit(longest), F.col("size") - F.col("start"))))
    whole = pieces.filter(F.col("n_words") == longest).select(
        "doc_id", "row", "piece", "start", "n_words",
        F.concat(F.lit("f"), "row", F.lit("-"), "piece").alias("bin_id"),
        F.lit(longest).cast("long").alias("bin_length"), F.lit(0).cast("long").alias("bin_offset"))
    groups = max(1, -(-sized.count() // items_a_group))
    rest = (pieces.filter(F.col("n_words") < longest)
            .withColumn("group", F.pmod(F.xxhash64("doc_id", "row"), F.lit(groups)))
            .select("doc_id", "row", "piece", "start", "n_words", "group"))
    packed = rest.groupBy("group").applyInPandas(_packer(lengths, cost), SCHEMA)
    return whole.union(packed)
