"""Data-quality operators: missing fields, record status, crawl outcomes and logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from silverline.functions import fixed
from silverline.functions.text import is_missing


def _names_where(tests: list[tuple[str, Column]]) -> Column:
    return F.array_compact(F.array(*[F.when(hit, F.lit(name)) for name, hit in tests]))


def _missing(df: DataFrame, field: str) -> Column:
    if field not in df.columns:
        return F.lit(True)
    return is_missing(field, df.schema[field].dataType.simpleString())


def validate_record(df: DataFrame, required: list[str], optional: list[str]) -> DataFrame:
    """List missing fields, required first; only a missing required field makes it partial."""
    lacking = _names_where([(f, _missing(df, f)) for f in required + optional])
    bad = F.exists(F.array(*[_missing(df, f) for f in required]), lambda m: m)
    return df.withColumns({
        "extraction_status": F.when(bad, "partial").otherwise("success"),
        "missing_fields": lacking})


def missing_fields_any(df: DataFrame, ignore: list[str]) -> DataFrame:
    """Any null outside the ignored fields makes the record partial."""
    names = [c for c in df.columns if c not in ignore]
    return (df.withColumn("missing_fields", _names_where([(c, F.col(c).isNull()) for c in names]))
            .withColumn("extraction_status",
                        F.when(F.size("missing_fields") > 0, "partial").otherwise("success")))


def missing_profile(df: DataFrame, fields: list[str]) -> DataFrame:
    """Missing count per field of a table, in one aggregation."""
    counts = df.agg(F.count(F.lit(1)).alias("_rows"),
                    *[F.count_if(_missing(df, f)).alias(f) for f in fields])
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("missing"),
                               F.col("_rows").alias("total_rows")) for f in fields])
    return counts.select(F.inline(pairs))


def fetch_error(status: Column, body_length: Column, min_body: int = 1) -> Column:
    """Error type of one crawl attempt; null means the page is usable."""
    return (
        F.when((status == 200) & (F.coalesce(body_length, F.lit(0)) < min_body), "EmptyResponse")
        .when(status == 200, F.lit(None))
        .when(status.isin(fixed.ACCESS_DENIED_STATUS), "AccessDenied")
        .when(status.isin(fixed.NOT_FOUND_STATUS), "NotFound")
        .when(status.isin(fixed.RETRYABLE_STATUS), "RetryableHTTPError")
        .when(status.isNull(), "ConnectionError")
        .otherwise("HTTPError"))


def classify_fetch(df: DataFrame, status: str, body_length: str, min_body: int = 1) -> DataFrame:
    kind = fetch_error(F.col(status), F.col(body_length), min_body)
    return df.withColumn("error_type", kind).withColumn(
        "status", F.when(F.col("error_type").isNull(), "ok").otherwise("failed_fetch"))


def unread(nodes: Column) -> Column:
    """Error type of a page without nodes."""
    return F.when(nodes.isNull(), "ParseError")


def mark_failed(df: DataFrame) -> DataFrame:
    """Records with an error are failed, whatever fields they lack."""
    return df.withColumn("extraction_status", F.when(
        F.col("error_type").isNotNull(), "failed").otherwise(F.col("extraction_status")))


def run_log(df: DataFrame, key: str) -> DataFrame:
    """One log row per key; fields the run did not produce are null."""
    fields = {"status": "string", "http_status": "int", "attempts": "bigint",
              "error_type": "string", "error_message": "string",
              "missing_fields": "array<string>", "collected_at": "string"}
    return df.select(key, *[
        F.col(f).cast(kind).alias(f) if f in df.columns else F.lit(None).cast(kind).alias(f)
        for f, kind in fields.items()])


def discovery_log(pages: DataFrame, page: str, records: Column, error: Column) -> DataFrame:
    """Per page: records found, success, and the error if any."""
    return pages.groupBy(page).agg(
        F.coalesce(F.sum(F.when(error.isNull(), records).otherwise(0)), F.lit(0)).alias("records_found"),
        F.bool_and(error.isNull()).alias("success"),
        F.min(error).alias("error_type"))
