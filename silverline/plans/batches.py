"""Batch runs over stored pages: records, run log, dead letters and manifest from one pass.

Pages are parsed once into a record table; every output is derived from it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from silverline.functions import fixed
from silverline.operators.columns import ensure_columns, project_fields
from silverline.operators.quality import run_log
from silverline.plans.dictionary import build_ingredient_dictionary
from silverline.plans.source_products import FIELDS, build_source_products
from silverline.sources import writers as wr
from silverline.sources.shared import fresh_path

FAILED = "failed"


def _write_batch(spark: SparkSession, records: DataFrame, out: str, key: str, at: str,
                 fields: list[str], identity: dict[str, str]) -> dict[str, str]:
    """Write all outputs of a batch. `records` has one row per page, failed ones included."""
    stored = fresh_path(spark, "batch-records")
    records.write.parquet(stored)
    records = ensure_columns(spark.read.parquet(stored), ["error_message"]).withColumn(
        "collected_at", F.col(at))
    good = project_fields(records.filter(F.col("extraction_status") != FAILED), fields)
    bad = records.filter(F.col("extraction_status") == FAILED).withColumn("ingredient_url", F.col(key))
    outputs = {"records_jsonl": wr.write_jsonl(good, f"{out}/records_jsonl"),
               "records_csv": wr.write_csv(good, f"{out}/records_csv"),
               "run_log": wr.write_jsonl(
                   run_log(records.withColumn("status", F.col("extraction_status")), key), f"{out}/run_log"),
               "failed_urls": wr.write_dead_letter(bad, f"{out}/failed_urls")}
    outputs["manifest"] = wr.write_manifest(
        records, f"{out}/manifest", ["batch_id"], "extraction_status", "collected_at", "collected_at",
        [key, "error_type", "error_message"], identity, outputs)
    return outputs


def run_source_batch(spark: SparkSession, pages: DataFrame, out: str, batch_id: str, source: str,
                     source_url: str, ts: str, input_url_file: str, version: str = "v1",
                     partitions: int | None = None) -> dict[str, str]:
    """The second product source: paths of everything written."""
    records = build_source_products(pages, batch_id, source, source_url, ts, version=version,
                                    partitions=partitions, failures=True)
    return _write_batch(spark, records, out, "product_url", "scraped_at", FIELDS, {
        "source_name": source, "entity": "products", "pipeline_version": version,
        "input_url_file": input_url_file})


def run_dictionary_batch(spark: SparkSession, pages: DataFrame, out: str, batch_id: str, source: str,
                         source_url: str, ts: str, input_url_file: str, version: str = "v1",
                         partitions: int | None = None) -> dict[str, str]:
    """The ingredient dictionary: paths of everything written."""
    records = build_ingredient_dictionary(pages, batch_id, source, source_url, ts, version=version,
                                          partitions=partitions, failures=True)
    return _write_batch(spark, records, out, "ingredient_url", "collected_at", fixed.INGREDIENT_FIELDS, {
        "source_name": source, "entity": "ingredients", "pipeline_version": version,
        "input_url_file": input_url_file})
