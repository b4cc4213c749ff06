"""Summaries of batches that merge without the rows: distinct keys and column profiles.

A summary is one small row per group (and column), so it is stored with its batch and later merged
over any set of batches. Aggregation is partial on the map side: a hot group shrinks before the
shuffle. Null keys and values are counted but enter no sketch; an empty table gives no groups.

Distinct keys are theta sketches of 2^`size` hashes: exact up to that many keys in a group, beyond
it within about 1 / sqrt(2^size) of the count (0.8 % at 14) of the larger side for differences. With
`slices` a group has one sketch for each share of the keys, by hash; `exact_slices` says how many keep
each share in its sketch, so that counts summed over the slices are exact for groups of any size. Values
are KLL sketches: exact up to about `k` values, beyond it ranks lie within about 2.3 / k^0.9 of the
rows. Exact counts stay in `aggregates.distinct_keys` and `quality.missing_profile`.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

SIZE, K = 14, 4096


def exact_slices(df: DataFrame, groups: list[str], size: int = SIZE) -> int:
    """Slices in which the sketches of these groups (the coarsest ones to merge to) lose no key.

    A group has no more keys than rows, and a slice on average half of what a sketch holds. From size 10
    up, a slice with more than twice the average is not to be expected in any table.
    """
    most = df.groupBy(*groups).count().agg(F.max("count")).first()[0] or 0
    return most // 2 ** (size - 1) + 1


def key_sketches(df: DataFrame, groups: list[str], key: str, size: int = SIZE, slices: int | None = None) -> DataFrame:
    """Per group: rows, rows without a key, and the sketch of its keys; with `slices` per group and `slice`."""
    if slices:
        df = df.withColumn("slice", F.pmod(F.xxhash64(key), F.lit(slices)))
        groups = [*groups, "slice"]
    return df.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(key).isNull()).alias("n_null"),
        F.theta_sketch_agg(F.col(key), size).alias("keys"))


def merge_key_sketches(sketches: DataFrame, groups: list[str], size: int = SIZE) -> DataFrame:
    """The same rows for coarser groups, or for all batches with no groups; name `slice` to keep the slices."""
    return sketches.groupBy(*groups).agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_null").alias("n_null"),
        F.theta_union_agg(F.col("keys"), size).alias("keys"))


def n_keys(sketch) -> Column:
    return F.theta_sketch_estimate(sketch)


def n_new_keys(sketch, earlier) -> Column:
    """Keys of the first sketch that the second has not seen; all of them without a second."""
    fresh = F.theta_sketch_estimate(F.theta_difference(sketch, earlier))
    return F.when(F.isnull(earlier), F.theta_sketch_estimate(sketch)).otherwise(fresh)


def column_profile(df: DataFrame, groups: list[str], columns: list[str], k: int = K) -> DataFrame:
    """Per group and numeric column: rows, nulls, least, greatest and a sketch of the values' ranks."""
    def summary(c: str) -> Column:
        value = F.col(c).cast("double")
        known = F.when(~F.isnan(value), value)
        return F.struct(F.lit(c).alias("column"), F.count(F.lit(1)).alias("n_rows"),
                        F.count_if(known.isNull()).alias("n_null"), F.min(known).alias("least"),
                        F.max(known).alias("greatest"), F.kll_sketch_agg_double(known, k).alias("ranks"))

    names = [f"_profile_{i}" for i in range(len(columns))]
    rows = df.groupBy(*groups).agg(*[summary(c).alias(n) for c, n in zip(columns, names)])
    return rows.select(*groups, F.inline(F.array(*names)))


def merge_profiles(profiles: DataFrame, groups: list[str], k: int = K) -> DataFrame:
    """Profiles of coarser groups; every column keeps its own row."""
    return profiles.groupBy(*groups, "column").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_null").alias("n_null"), F.min("least").alias("least"),
        F.max("greatest").alias("greatest"), F.kll_merge_agg_double(F.col("ranks"), k).alias("ranks"))


def _known(profile: str = "") -> Column:
    return F.col(f"{profile}n_rows") > F.col(f"{profile}n_null")


def with_quantiles(profiles: DataFrame, shares: dict[str, float]) -> DataFrame:
    """Quantiles by name: the least value with that share of the known values at or below it."""
    return profiles.withColumns({name: F.when(_known(), F.kll_sketch_get_quantile_double("ranks", F.lit(float(share))))
                                 for name, share in shares.items()})


def drift(before: DataFrame, after: DataFrame, groups: list[str], steps: int = 100) -> DataFrame:
    """Per group and column: change of the share of nulls, and how far the distributions lie apart.

    Each side's cumulative share at a value is counted on its `steps` quantiles; `distance` is the largest
    difference at the quantiles of both, within 2 / steps (and the sketches' error) of the
    Kolmogorov-Smirnov distance. Ties are counted alike on both sides, so equal sides have 0. Null keys of
    groups meet none. Columns or groups of one side only, and sides without values, have null.
    """
    keys = [*groups, "column"]
    shares = F.array(*[F.lit(i / steps) for i in range(1, steps + 1)])
    sides = [p.select(*keys, F.struct(
        "n_rows", "n_null", F.when(_known(), F.kll_sketch_get_quantile_double("ranks", shares)).alias("at")).alias(s))
        for p, s in ((before, "_before"), (after, "_after"))]
    one, two = F.col("_before.at"), F.col("_after.at")

    def gap(value: Column) -> Column:
        below = [F.size(F.filter(q, lambda x: x <= value)) for q in (one, two)]
        return F.abs(below[0] - below[1]) / steps

    null_share = {s: F.col(f"{s}.n_null") / F.col(f"{s}.n_rows") for s in ("_before", "_after")}
    return reduce(lambda a, b: a.join(b, keys, "full"), sides).select(
        *keys, (null_share["_after"] - null_share["_before"]).alias("null_change"),
        F.array_max(F.transform(F.concat(one, two), gap)).alias("distance"))
