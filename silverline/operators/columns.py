"""Column cleaning and row predicates. Narrow: one projection or filter each, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from silverline.functions import text as t


def cast_ids(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in cols})


def drop_columns(df: DataFrame, *cols: str) -> DataFrame:
    """Absent columns are ignored."""
    return df.drop(*cols)


def allow_list(df: DataFrame, column: str, allowed, default: str) -> DataFrame:
    return df.withColumn(column, t.allow_list(column, allowed, default))


def null_sentinel(df: DataFrame, column: str, max_bad: float) -> DataFrame:
    return df.withColumn(column, t.null_sentinel(column, max_bad))


def fill_null(df: DataFrame, column: str, value: str) -> DataFrame:
    """Only null is filled; blank text stays."""
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(value)))


def int_like(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: t.int_like(c) for c in cols})


def trim_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """Spaces only, as opposed to `clean_text`."""
    return df.withColumns({c: F.trim(F.col(c)) for c in cols})


def drop_values(df: DataFrame, column: str, bad: str) -> DataFrame:
    """Rows with the bad value go, and so do rows with null."""
    return df.filter(F.col(column) != bad)


def ensure_columns(df: DataFrame, cols: list[str], data_type: str = "string") -> DataFrame:
    absent = [c for c in cols if c not in df.columns]
    return df.withColumns({c: F.lit(None).cast(data_type) for c in absent}) if absent else df


def require_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """Fail on the schema, before any job runs."""
    absent = [c for c in cols if c not in df.columns]
    if absent:
        raise ValueError(f"Missing columns {absent}; available: {df.columns}")
    return df


def project_fields(df: DataFrame, fields: list[str], data_type: str = "string") -> DataFrame:
    """Fixed field order; extra columns are ignored, missing ones are null."""
    return df.select(*[
        F.col(f) if f in df.columns else F.lit(None).cast(data_type).alias(f) for f in fields])


def drop_null_keys(df: DataFrame, column: str, blank: bool = True) -> DataFrame:
    kept = F.col(column).isNotNull()
    if blank:
        kept = kept & (t.strip(F.col(column).cast("string")) != "")
    return df.filter(kept)


def reject_reason(rules: list[tuple[str, Column]]) -> Column:
    """Name of the first rule that holds; null for a valid row."""
    out = F.when(rules[0][1], F.lit(rules[0][0]))
    for reason, hit in rules[1:]:
        out = out.when(hit, F.lit(reason))
    return out


def classify_reject(df: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    return df.withColumn("reject_reason", reject_reason(rules))


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) parts of a classified frame."""
    return (df.filter(F.col("reject_reason").isNull()).drop("reject_reason"),
            df.filter(F.col("reject_reason").isNotNull()))


def valid_for_saving(df: DataFrame, key: str) -> DataFrame:
    """Complete and partial rows alike are kept as long as they have a key."""
    return df.filter(~t.is_missing(key, df.schema[key].dataType.simpleString()))


def stamp_batch(df: DataFrame, batch_id: str, source: str, version: str, ts: str) -> DataFrame:
    """Batch metadata as literals: one id and one time for the whole run."""
    at = F.to_timestamp_ntz(F.lit(ts))
    return df.withColumns({
        "batch_id": F.lit(batch_id), "source_name": F.lit(source),
        "pipeline_version": F.lit(version),
        "collected_at": t.iso_ts(at), "ingestion_date": t.ingestion_date(at)})
