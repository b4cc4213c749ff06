"""One row per key, numbering, first-seen accounting and upserts.

`row_number() = 1` is planned with a group limit on the map side: each task sends at most
one row per key, so a key holding a third of the table costs no more than any other. Columns that an
operator adds for a while get names that the frame does not have, so all of the caller's stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from silverline.operators.names import free_name
from silverline.sources.shared import durable


def _one_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    ranked = Window.partitionBy(*keys).orderBy(*order)
    rank = free_name(df.columns, "_rank")
    return df.withColumn(rank, F.row_number().over(ranked)).filter(F.col(rank) == 1).drop(rank)


def keep_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Newest row per key. `order` must be total within a key for a repeatable answer."""
    return _one_per_key(df, keys, [F.col(c).desc_nulls_last() for c in order])


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return _one_per_key(df, keys, [F.col(c).asc_nulls_last() for c in order])


def enumerate_items(df: DataFrame, items: str, into: str, position: str = "position") -> DataFrame:
    """One row per array item with its 1-based place; items dropped later keep their number."""
    others = [F.col(f"`{c}`") for c in df.columns if c != items]
    at = free_name([*df.columns, into, position], "_at")
    return (df.select(*others, F.posexplode(items).alias(at, into))
            .withColumn(position, F.col(at) + 1).drop(at))


def running_total(df: DataFrame, order: str, column: str, into: str) -> DataFrame:
    """Cumulative sum over the whole frame without putting the frame in one task.

    Rows are range-partitioned and stored, each range is summed on its own, and the ranges'
    totals (one row per shuffle partition) give every range its starting value. Storing
    pins the ranges, which are sampled and could differ if they were computed twice.
    """
    part, total, start = (free_name([*df.columns, into], c) for c in ("_range", "_sum", "_start"))
    ranges = durable(df.repartitionByRange(F.col(order)).withColumn(part, F.spark_partition_id()))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.groupBy(part).agg(F.sum(column).alias(total)).select(
        part, F.coalesce(F.sum(total).over(before), F.lit(0)).alias(start))
    within = Window.partitionBy(part).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    # At most one row per shuffle partition, hence safe to broadcast.
    return (ranges.join(F.broadcast(starts), part)
            .withColumn(into, F.sum(column).over(within) + F.col(start))
            .drop(part, start))


def first_seen(df: DataFrame, key: str, page: str) -> DataFrame:
    """Per page: keys first shown there, and how many distinct keys were known by then."""
    firsts = df.groupBy(key).agg(F.min(page).alias(page))
    new = firsts.groupBy(page).agg(F.count(F.lit(1)).alias("new_keys"))
    pages = df.groupBy(page).agg(F.count(F.lit(1)).alias("found"))
    per_page = pages.join(new, page, "left").fillna(0, ["new_keys"])
    return running_total(per_page, page, "new_keys", "known_keys")


def final_attempt(df: DataFrame, key: str, attempt: str, terminal: Column,
                  cols: list[str]) -> DataFrame:
    """One outcome per key: the first terminal attempt, otherwise the last retryable one."""
    row = F.struct(F.col(attempt).alias("attempts"), *cols)
    chosen = F.coalesce(F.min_by(row, F.when(terminal, F.col(attempt))),
                        F.max_by(row, F.col(attempt)))
    return df.groupBy(key).agg(chosen.alias("_row")).select(key, "_row.*")


def sort_by_position(df: DataFrame, position: str, then: list[str], missing: int = 9999) -> DataFrame:
    """Null and 0 positions sort as `missing`; `then` keeps the sort stable."""
    return df.orderBy(F.coalesce(F.nullif(F.col(position), F.lit(0)), F.lit(missing)), *then)


def dictionary_order(df: DataFrame, rating: str, name: str, *then: str) -> DataFrame:
    """Unrated last, best rating first, then by name."""
    return df.orderBy(F.col(rating).desc_nulls_last(), F.col(name).asc(), *then)


def head(df: DataFrame, order: list[str], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def concat_ragged(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Union by name; a column one side lacks is null there."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def union_priority(*sources: DataFrame) -> DataFrame:
    """Ragged union tagged with the place of each source, 1 first."""
    return concat_ragged(*[s.withColumn("source_priority", F.lit(i))
                           for i, s in enumerate(sources, start=1)])


def upsert_keep_last(old: DataFrame, new: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Union, then the newest row per key: new beats old, `order` decides within a side.

    Keys absent from the frame are ignored; with none left, exact duplicates collapse.
    """
    side = free_name([*old.columns, *new.columns], "_side")
    both = concat_ragged(old.withColumn(side, F.lit(0)), new.withColumn(side, F.lit(1)))
    known = [k for k in keys if k in both.columns]
    if not known:
        return both.drop(side).distinct()
    return keep_last(both, known, [side, *order]).drop(side)


def minus(todo: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Set difference of keys."""
    return todo.select(key).distinct().join(done.select(key), key, "left_anti")
