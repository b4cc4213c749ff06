"""Second product source: pages to the 31-column product record."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from silverline.functions import fixed, jsonld, lists as ls
from silverline.functions.nodes import attr_is, both, cls, first_text, tag, with_nodes
from silverline.operators import pages as pg
from silverline.operators.columns import stamp_batch
from silverline.operators.quality import mark_failed, missing_fields_any, unread

FIELDS = [
    "record_id", "batch_id", "source_name", "source_type", "source_url", "source_product_id",
    "product_url", "product_name", "brand_name", "raw_category", "product_description",
    "ingredients_text", "raw_ingredients_list", "price", "currency", "sale_price", "rating",
    "review_count", "size", "image_url", "availability", "skin_type_claims",
    "skin_concern_claims", "product_highlights", "usage_instructions", "extraction_status",
    "missing_fields", "scraped_at", "ingestion_date", "pipeline_version", "raw_file_path",
]
ALWAYS_NULL = ["raw_category", "sale_price", "availability", "raw_file_path"]
IGNORED = ["sale_price", "raw_file_path"]


def build_source_products(pages: DataFrame, batch_id: str, source: str, source_url: str, ts: str,
                          ignore: list[str] = IGNORED, version: str = "v1",
                          partitions: int | None = None, failures: bool = False) -> DataFrame:
    """One record per page. With `failures`, pages that could not be read are marked as failed
    and the error is added to the fields."""
    n = F.col("nodes")
    df = with_nodes(pages, partitions=partitions, tree=True).withColumns({
        "sections": pg.labelled_sections(n), "rated": pg.rating_cascade(n, F.col("html")),
        "source_product_id": pg.sku(n),
        "product_name": first_text(n, both(tag("h1"), attr_is("id", "product-title"))),
        "brand_name": first_text(n, both(tag("a"), cls("override-pdp-brand"))),
        "price": first_text(n, attr_is("id", "product-price")),
        "image_url": jsonld.embedded_json_array("html", "images", "original")})
    df = df.select("url", "source_product_id", "product_name", "brand_name", "price", "image_url",
                   "sections.*", "rated.*", unread(n).alias("error_type"))
    df = stamp_batch(df, batch_id, source, version, ts).withColumns({
        "record_id": F.col("source_product_id"), "source_type": F.lit("website"),
        "source_url": F.lit(source_url), "product_url": F.col("url"), "currency": F.lit("USD"),
        "raw_ingredients_list": ls.split_list("ingredients_text", ",", fixed.INGREDIENT_DISCLAIMER),
        "skin_concern_claims": F.col("skin_type_claims"), "scraped_at": F.col("collected_at"),
        **{c: F.lit(None).cast("string") for c in ALWAYS_NULL}})
    made = [f for f in FIELDS if f not in ("extraction_status", "missing_fields")]
    done = missing_fields_any(df.select(*made, "error_type"), [*ignore, "error_type"])
    return mark_failed(done).select(*FIELDS, "error_type") if failures else done.select(*FIELDS)
