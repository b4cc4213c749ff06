"""Aggregations. Every function used merges partial results, so hot keys shrink before the shuffle."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F
from pyspark.sql import types as T


def row_audit(stages: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """Row count per (table, stage); counts need no column, so Parquet answers from footers."""
    counts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(table).alias("table_name"), F.lit(stage).alias("stage"), "n_rows")
        for (table, stage), df in stages.items()]
    return reduce(DataFrame.unionByName, counts)


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows while they pass to their sink, without another scan."""
    watch = Observation(name)
    return df.observe(watch, F.count(F.lit(1)).alias("n_rows")), watch


def status_counts(df: DataFrame, batch: list, status: str) -> DataFrame:
    s = F.col(status)
    return df.groupBy(*batch).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(s == "success").alias("success_count"),
        F.count_if(s == "partial").alias("partial_count"),
        F.count_if(s == "failed").alias("failed_count"))


def sum_or_null(df: DataFrame, keys: list, column, into: str, fallback=None) -> DataFrame:
    """Sum per group; a zero sum counts as nothing found and takes the fallback."""
    total = F.nullif(F.sum(column), F.lit(0))
    if fallback is not None:
        total = F.coalesce(total, fallback)
    return df.groupBy(*keys).agg(total.alias(into))


def filled(df: DataFrame, column: str) -> Column:
    """Not null, not empty text, not an empty array."""
    c, kind = F.col(column), df.schema[column].dataType
    if isinstance(kind, T.StringType):
        return c.isNotNull() & (c != "")
    if isinstance(kind, T.ArrayType):
        return c.isNotNull() & (F.size(c) > 0)
    return c.isNotNull()


def merge_fragments(df: DataFrame, keys: list[str], name: str, order: list[str],
                    cols: list[str]) -> DataFrame:
    """One row per (keys, case-folded name): each column takes its first filled value.

    "First" is by `order`, a total order such as (source priority, sequence). The spelling
    of the name is the first row's. `first_order` holds the place of that row.
    """
    at = F.struct(*order)
    merged = [F.min_by(F.col(c), F.when(filled(df, c), at)).alias(c) for c in cols]
    return (
        df.filter(filled(df, name))
        .groupBy(*keys, F.lower(F.col(name)).alias("_folded"))
        .agg(F.min_by(F.col(name), at).alias(name), *merged, F.min(at).alias("first_order"))
        .drop("_folded"))


def pivot_label_value(df: DataFrame, keys: list[str], label: str, value: str, order: str,
                      rules: dict[str, list[str]], mode: str = "last") -> DataFrame:
    """Long (label, value) rows to one row per key; the first rule matching a label owns it.

    `last` takes the last row of a rule, null or not; `first` the first non-null one.
    """
    target = None
    for name, words in rules.items():
        hit = reduce(lambda a, b: a | b, [F.col(label).contains(w) for w in words])
        target = F.when(hit, name) if target is None else target.when(hit, name)
    rows = df.withColumn("_target", target)
    v, mine = F.col(value), lambda n: F.col("_target") == n
    if mode == "first":
        picks = [F.min_by(v, F.when(mine(n) & v.isNotNull(), F.col(order))).alias(n) for n in rules]
    else:
        picks = [F.max_by(v, F.when(mine(n), F.col(order))).alias(n) for n in rules]
    return rows.groupBy(*keys).agg(*picks)


def any_flag(condition: Column, negative: Column | None = None) -> Column:
    """Aggregate: 1 if any row holds, null without evidence; negative evidence wins with 0."""
    positive = F.when(F.coalesce(F.bool_or(condition), F.lit(False)), 1)
    if negative is None:
        return F.when(F.bool_or(condition).isNotNull(), F.bool_or(condition).cast("int"))
    return F.when(F.coalesce(F.bool_or(negative), F.lit(False)), 0).otherwise(positive)


def distinct_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.agg(*[F.count_distinct(k).alias(f"n_{k}") for k in keys])


def ingredient_usage(bridge: DataFrame) -> DataFrame:
    """Bridge rows and distinct products per ingredient."""
    return bridge.groupBy("ingredient_id").agg(
        F.count(F.lit(1)).alias("bridge_rows"), F.count_distinct("product_id").alias("products"))


def rollup_audit(df: DataFrame, keys: list[str], sums: dict[str, Column]) -> DataFrame:
    """Rows and sums at every level of the keys, from all of them down to the grand total.

    `level` is the grouping id: 0 for full rows, one bit per key rolled up, the last key lowest, which
    tells a null key from a rolled-up one. Rows are first reduced to one per full key, so only
    those are copied for each level. Sums of no values are null; an empty table gives no rows.
    """
    full = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), *[F.sum(c).alias(n) for n, c in sums.items()])
    return full.rollup(*keys).agg(
        F.grouping_id().alias("level"), F.sum("n_rows").alias("n_rows"),
        *[F.sum(n).alias(n) for n in sums])
