"""Ingredient detail pages to the ingredient dictionary."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from silverline.functions import fixed, lists as ls, text as t
from silverline.functions.nodes import with_nodes
from silverline.operators import pages as pg
from silverline.operators.columns import project_fields, stamp_batch, valid_for_saving
from silverline.operators.quality import mark_failed, unread, validate_record

def parse_ingredient_pages(pages: DataFrame, partitions: int | None = None) -> DataFrame:
    """Adds the fields found on each page; `pages` has url and html."""
    n, m = F.col("nodes"), F.col("content")
    df = with_nodes(pages, partitions=partitions).withColumn("content", pg.main_content(n))
    df = df.withColumns({
        "raw_ingredient_name": _title(n, m),
        "rating": t.normalize_rating(pg.labelled_value(n, m, "Rating:", ["div", "span"])),
        "benefits": pg.label_row_values(n, m, "Benefits"),
        "ingredient_categories": pg.label_row_values(n, m, "Categories"),
        "at_a_glance_points": pg.heading_list(n, m, "at a glance"),
        "full_description": pg.heading_paragraphs(n, m, "description", fixed.DESCRIPTION_CLASS),
        "related_ingredients": pg.related_items(n, m),
        "error_type": unread(n)}).drop("nodes", "content")
    name = t.normalize_name("raw_ingredient_name")
    return df.withColumns({
        "synonyms": ls.synonyms("at_a_glance_points", "full_description", "raw_ingredient_name"),
        "normalized_ingredient_name": name,
        "canonical_ingredient_name": t.canonical_name(name),
        "concerns": F.lit(None).cast("string"),
        "safety_notes": F.lit(None).cast("string")})


def _title(nodes, content):
    heading = F.get(F.filter(content, lambda x: x["tag"] == "h1"), F.lit(0))
    return pg.text_of(nodes, heading)


def build_ingredient_dictionary(pages: DataFrame, batch_id: str, source: str, source_url: str,
                                ts: str, version: str = "v1",
                                partitions: int | None = None, failures: bool = False) -> DataFrame:
    """One record per page that can be saved; with `failures` also those that could not be
    read, marked as failed, and the error beside the fields."""
    parsed = parse_ingredient_pages(pages, partitions).withColumn("ingredient_url", F.col("url"))
    stamped = stamp_batch(parsed, batch_id, source, version, ts).withColumns({
        "record_id": t.record_id("ingredient_url", f"{source}_ingredient"),
        "source_type": F.lit("website"), "source_url": F.lit(source_url),
        "raw_file_path": F.lit(None).cast("string")})
    checked = validate_record(
        stamped, fixed.REQUIRED_INGREDIENT_FIELDS, fixed.OPTIONAL_INGREDIENT_FIELDS)
    if failures:
        return mark_failed(checked.filter(F.col("ingredient_url").isNotNull())).select(
            *fixed.INGREDIENT_FIELDS, "error_type")
    return project_fields(valid_for_saving(checked, "ingredient_url"), fixed.INGREDIENT_FIELDS)
