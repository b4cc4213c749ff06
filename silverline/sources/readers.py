"""Scans: header CSV, key lists, page tables, the partitioned raw zone and JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from silverline.functions.text import strip
from silverline.operators.columns import require_columns
from silverline.operators.keyed import keep_first
from silverline.sources.folders import list_folders

# Quoted cells may hold doubled quotes and commas, and line breaks where asked for.
_CSV = {"header": True, "escape": '"'}
ZONE = ["source", "entity", "ingestion_date", "batch_id"]


def all_strings(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def read_csv_strings(spark: SparkSession, path: str, columns: list[str] | None = None,
                     multi_line: bool = False) -> DataFrame:
    """Every column STRING. A file is split, one row per line; with line breaks inside cells
    (`multi_line`) one file is one task, so keep many files. Naming the columns saves a look
    at the header."""
    reader = spark.read.options(**{**_CSV, "multiLine": multi_line})
    if columns:
        reader = reader.schema(all_strings(columns))
    return reader.csv(path)


def read_csv_typed(spark: SparkSession, path: str, schema, multi_line: bool = False) -> DataFrame:
    return spark.read.options(**{**_CSV, "multiLine": multi_line}).schema(schema).csv(path)


def key_list(df: DataFrame, column: str, order: list[str], limit: int | None = None) -> DataFrame:
    """Stripped, non-blank keys, first occurrence each, in input order."""
    cleaned = require_columns(df, [column]).withColumn(column, strip(F.col(column).cast("string")))
    keys = keep_first(cleaned.filter(F.col(column) != ""), [column], order)
    return keys.orderBy(*order).limit(limit) if limit else keys


def read_key_list(spark: SparkSession, path: str, column: str, order: list[str],
                  limit: int | None = None, multi_line: bool = False) -> DataFrame:
    return key_list(read_csv_strings(spark, path, multi_line=multi_line), column, order, limit)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Page table; crawl columns that are not there come back as null."""
    df = spark.read.parquet(path)
    extra = {"http_status": "int", "collected_at": "timestamp"}
    return df.withColumns({c: F.lit(None).cast(k) for c, k in extra.items() if c not in df.columns})


def _newest_batch(spark: SparkSession, folder: str) -> str | None:
    """The greatest batch of the newest date; only directory names are looked at."""
    for day in sorted(list_folders(spark, f"{folder}/ingestion_date=*"), reverse=True):
        batches = list_folders(spark, f"{day}/batch_id=*")
        if batches:
            return max(b.rsplit("batch_id=", 1)[1] for b in batches)
    return None


def read_raw_zone(spark: SparkSession, base: str, schema, source: str, entity: str,
                  batch: str = "latest") -> DataFrame:
    """One batch of the raw zone: only its directories are read.

    The newest batch is found by listing directories, newest date first, not by opening files.
    """
    full = T.StructType(list(schema.fields)
                        + [T.StructField(c, T.StringType()) for c in ZONE if c not in schema.names])
    folder = f"{base}/source={source}/entity={entity}"
    batch = _newest_batch(spark, folder) if batch == "latest" else batch
    paths = list_folders(spark, f"{folder}/ingestion_date=*/batch_id={batch}") if batch else []
    if not paths:
        return spark.createDataFrame([], full)
    return spark.read.schema(full).option("basePath", base).parquet(*paths)


def read_jsonl(spark: SparkSession, path: str, schema) -> DataFrame:
    """One JSON object per line; keys an object lacks are null."""
    return spark.read.schema(schema).json(path)
