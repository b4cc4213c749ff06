"""Sinks: layer tables, raw-zone partitions, CSV, JSON lines, dead letters and manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from silverline.functions import fixed
from silverline.functions.jsonld import json_cells
from silverline.operators.columns import project_fields
from silverline.operators.keyed import keep_first
from silverline.sources.readers import ZONE


def write_parquet(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").parquet(path)
    return path


def write_partitioned(df: DataFrame, base: str, cols: list[str] = ZONE) -> str:
    """Hive layout; only the partitions present in the frame are replaced.

    Rows are brought together by partition first, and adaptive execution splits large ones, so
    the number of files follows the data and not the tasks.
    """
    (df.hint("rebalance", *cols).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*cols).parquet(base))
    return base


def write_csv(df: DataFrame, path: str, fields: list[str] | None = None) -> str:
    """Fixed field order, nested cells as JSON text, quotes doubled."""
    if fields:
        df = project_fields(df, fields)
    (json_cells(df).write.mode("overwrite")
     .options(header=True, escape='"', quote='"', emptyValue="").csv(path))
    return path


def write_jsonl(df: DataFrame, path: str) -> str:
    """Null fields are written out, text stays UTF-8."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return path


def save_unique(df: DataFrame, path: str, keys: list[str], order: list[str]) -> str:
    """Rewrite with the first row per key."""
    return write_parquet(keep_first(df, keys, order), path)


def dead_letters(df: DataFrame) -> DataFrame:
    """Failed keys in the failed-record layout."""
    kinds = {"http_status": "int", "attempts": "int"}
    rows = project_fields(df.filter(F.col("error_type").isNotNull()), fixed.FAILED_FIELDS)
    return rows.select(*[F.col(f).cast(kinds.get(f, "string")).alias(f) for f in fixed.FAILED_FIELDS])


def write_dead_letter(df: DataFrame, path: str) -> str:
    dead_letters(df).write.mode("append").parquet(path)
    return path


def manifest(records: DataFrame, keys: list[str], status: str, started: str, finished: str,
             outputs: dict[str, str], identity: dict[str, str] | None = None) -> DataFrame:
    """One row per batch: what was run, totals by status, first and last time, output paths.

    Failed records are a table of their own (see `failed_pages`), never a list in one
    cell: a bad batch may hold any number of them.
    """
    s = F.col(status)
    totals = records.groupBy(*keys).agg(
        F.min(started).alias("started_at"), F.max(finished).alias("finished_at"),
        F.count(F.lit(1)).alias("total_urls"),
        F.count_if(s == "success").alias("success_count"),
        F.count_if(s == "partial").alias("partial_count"),
        F.count_if(s == "failed").alias("failed_count"))
    return totals.withColumns({k: F.lit(v) for k, v in (identity or {}).items()}).withColumn(
        "output_files", F.struct(*[F.lit(v).alias(k) for k, v in outputs.items()]))


def failed_pages(records: DataFrame, keys: list[str], status: str, fields: list[str]) -> DataFrame:
    return records.filter(F.col(status) == "failed").select(*keys, *fields)


def write_manifest(records: DataFrame, path: str, keys: list[str], status: str, started: str,
                   finished: str, fields: list[str], identity: dict[str, str] | None = None,
                   outputs: dict[str, str] | None = None) -> str:
    """`totals/` holds the batch rows, `failed/` the failed records, both as JSON lines."""
    outputs = {**(outputs or {}), "failed_pages": f"{path}/failed"}
    write_jsonl(failed_pages(records, keys, status, fields), outputs["failed_pages"])
    write_jsonl(manifest(records, keys, status, started, finished, outputs, identity), f"{path}/totals")
    return path


def write_sorted_keys(df: DataFrame, column: str, path: str) -> str:
    """Distinct keys, ascending across and within files."""
    df.select(column).distinct().orderBy(column).write.mode("overwrite").option("header", True).csv(path)
    return path
