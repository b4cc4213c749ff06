"""Key joins.

No join here forces a broadcast: key-only sides are broadcast by Spark when their size is
known to be under the session's limit, at planning or from shuffle statistics, and are
sort-merge joined with adaptive skew splitting otherwise. The fact table is always the left
side, the one that adaptive execution may split for every join type used.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from silverline.operators.names import free_name

Dims = list[tuple[DataFrame, str]]


def fk_filter(fact: DataFrame, dims: Dims, mode: str = "inner") -> DataFrame:
    """Keep fact rows whose keys exist in every dimension.

    `inner` repeats a row once per duplicate dimension key; `semi` never does.
    """
    how = {"inner": "inner", "semi": "left_semi"}[mode]
    for dim, key in dims:
        fact = fact.join(dim.select(key).filter(F.col(key).isNotNull()), key, how)
    return fact


def fk_orphans(fact: DataFrame, dims: Dims) -> DataFrame:
    """The rows `fk_filter` discards, null keys included, in one pass over the fact."""
    columns = fact.columns
    keyed = reduce(lambda a, b: a & b, [F.col(key).isNotNull() for _, key in dims])
    nulls, fact = fact.filter(~keyed), fact.filter(keyed)  # null keys would all meet in one task
    marks = []
    for i, (dim, key) in enumerate(dims):
        mark = free_name(columns, f"_known_{i}")
        marks.append(mark)
        known = dim.select(key).filter(F.col(key).isNotNull()).distinct()
        fact = fact.join(known.withColumn(mark, F.lit(True)), key, "left")
    missing = reduce(lambda a, b: a | b, [F.col(m).isNull() for m in marks])
    return fact.filter(missing).select(*columns).union(nulls)


def skip_done(todo: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Resume: drop keys already processed. A null key is never known, and skips the join."""
    nulls, keyed = todo.filter(F.col(key).isNull()), todo.filter(F.col(key).isNotNull())
    return keyed.join(done.select(key), key, "left_anti").unionByName(nulls).select(*todo.columns)


def canonical_lookup(df: DataFrame, column: str, lookup: DataFrame, into: str) -> DataFrame:
    """Replace through a (name, canonical) table with unique names, else keep the value."""
    found = free_name([*df.columns, into], "_canonical")
    table = lookup.select(F.col("name").alias(column), F.col("canonical").alias(found))
    return df.join(table, column, "left").withColumn(into, F.coalesce(F.col(found), F.col(column))).drop(found)


def prefer(first: DataFrame, second: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Per column, the first source's value unless it is null. `second` has unique keys."""
    theirs = {c: free_name([*first.columns, *cols], f"_{c}") for c in cols}
    other = second.select(key, *[F.col(c).alias(n) for c, n in theirs.items()])
    joined = first.join(other, key, "left")
    return (joined.withColumns({c: F.coalesce(F.col(c), F.col(n)) for c, n in theirs.items()})
            .drop(*theirs.values()))


def catalog_view(products: DataFrame, bridge: DataFrame, ingredients: DataFrame) -> DataFrame:
    """The star join: one row per product and ingredient, with the position in the list.

    Rows stay flat, so a product with any number of ingredients never sits in one cell.
    """
    return (bridge.join(products, "product_id").join(ingredients, "ingredient_id"))
