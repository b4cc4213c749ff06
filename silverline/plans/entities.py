"""Product pages to product, ingredient, bridge, feature and rejected tables.

Extraction, precedence and the merge of a page's ingredient lists all happen inside the
page's row. Rows meet other rows only in the final keep-last per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from silverline.functions import fixed, jsonld, text as t
from silverline.functions.nodes import with_nodes
from silverline.functions.text import let
from silverline.operators import pages as pg
from silverline.operators.columns import ensure_columns, reject_reason
from silverline.operators.keyed import keep_last
from silverline.plans.features import recommendation_features
from silverline.sources.shared import fresh_path

CARD = ["product_id", "product_name", "brand_name", "category", "price", "image_url"]
DETAIL = ["description", "evidence_level", "science_tags", "science_details",
          "callout_type", "callout_text", "warning_type", "warning_text"]


def merge_ingredients(*sources: Column) -> Column:
    """Merge a page's ingredient arrays, most trusted first, by case-folded name.

    Rows sorted by (name, source, sequence) form one run per name; each field takes the first
    filled value of its run. The result is in list order: position, null or 0 as 9999, then
    first appearance. A missing position becomes the place in that order.
    """
    tagged = F.flatten(F.array(*[_tag(s, i) for i, s in enumerate(sources)]))

    def merged(rows: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(rows) - 1), lambda i: (i == 0) | (
            F.get(rows, i - 1)["key"] != F.get(rows, i)["key"]))
        return let(starts, lambda s: F.transform(s, lambda start, j: let(
            F.slice(rows, start + 1, F.coalesce(F.get(s, j + 1), F.size(rows)) - start), _merge_run)))

    runs = let(F.sort_array(tagged), lambda rows: F.when(F.size(rows) > 0, merged(rows)))
    numbered = F.transform(F.sort_array(runs), lambda r, i: r["row"].withField(
        "position", F.coalesce(F.nullif(r["row"]["position"], F.lit(0)), i + 1)))
    return F.coalesce(numbered, F.array().cast(pg.INGREDIENT_TYPE))


def _tag(source: Column, place: int) -> Column:
    return F.transform(source, lambda r, i: F.struct(
        F.lower(r["name"]).alias("key"), F.lit(place).alias("source"), i.alias("seq"), r.alias("row")))


def _merge_run(run: Column) -> Column:
    def first(field: str) -> Column:
        values = F.transform(run, lambda e: e["row"][field])
        return F.get(F.filter(values, lambda v: v.isNotNull() & (v.cast("string") != "")), F.lit(0))

    names = ["position", "raw_ingredient_name", "name", "concentration", *DETAIL]
    head = F.get(run, F.lit(0))
    return let(F.struct(*[first(n).alias(n) for n in names]), lambda row: F.struct(
        F.coalesce(F.nullif(row["position"], F.lit(0)), F.lit(9999)).alias("sort_position"),
        head["source"].alias("source"), head["seq"].alias("seq"), row.alias("row")))


def page_records(pages: DataFrame, base: str, source: str, min_body: int = fixed.MIN_BODY_LENGTH + 1,
                 partitions: int | None = None) -> DataFrame:
    """One compact row per page: product columns, its ingredient list, or a reject reason.

    `pages` has page_id, url, html, and optionally collected_at and listing-card columns.
    """
    df = ensure_columns(ensure_columns(pages, CARD), ["collected_at"], "timestamp")
    df = with_nodes(df, partitions=partitions).withColumn("objects", jsonld.jsonld_objects("nodes"))
    n = F.col("nodes")
    df = df.withColumns({"product_json": jsonld.jsonld_pick(F.col("objects"), "Product"),
                         "crumbs": jsonld.jsonld_breadcrumb(F.col("objects"))})
    card = {c: F.col(c) for c in CARD}
    df = df.withColumns({
        "meta": pg.product_meta(n, F.col("product_json"), F.col("crumbs"), base, card),
        "score": pg.scorecard(n), "spec": pg.specs(n), "badge": pg.badges(n),
        "safe": pg.safety(n), "skin": pg.skin_scores(n), "rated": pg.ratings(n),
        "free_from": pg.free_from(n), "country_of_origin": pg.origin(n),
        "ingredients": merge_ingredients(
            pg.ingredient_cards(n), pg.inci_list(n), pg.jsonld_ingredients(F.col("objects"))),
        "reject_reason": reject_reason([
            ("empty_url", t.is_missing("url")),
            ("failed_fetch", F.coalesce(F.length("html"), F.lit(0)) < min_body),
            ("parse_error", n.isNull()),
            *pg.page_reject(n, F.col("product_json"), F.col("brand_name"), F.col("image_url"))])})
    tag_text = t.safe_concat([F.col("meta.description"), F.col("spec.key_actives_text"),
                              F.col("badge.product_claims"), F.col("free_from")])
    prefer = lambda c: F.coalesce(F.col(f"score.{c}"), F.col(f"safe.{c}")).alias(c)
    return df.select(
        "page_id", "collected_at", "reject_reason",
        F.coalesce(t.blank_to_null("product_id"), t.md5_id("url")).alias("product_id"),
        t.strip("url").alias("product_url"), "meta.*", "spec.*", "rated.*", "skin.*",
        *[prefer(c) for c in ("pregnancy_safe", "fungal_acne_safe", "comedogenic_rating")],
        F.col("safe.irritation_rating"), F.col("safe.safety_notes"), "badge.*",
        t.keyword_tags(tag_text, fixed.BENEFIT_RULES).alias("benefits"),
        t.keyword_tags(tag_text, fixed.CONCERN_RULES).alias("concerns"),
        "free_from", "country_of_origin", F.lit(source).alias("source"), "ingredients")


def entity_tables(records: DataFrame) -> dict[str, DataFrame]:
    """The five tables. `records` should be a stored table: each result reads it once."""
    valid = records.filter(F.col("reject_reason").isNull())
    newest = ["collected_at", "page_id"]
    products = keep_last(valid.drop("ingredients", "reject_reason"), ["product_id"], newest)
    rows = valid.select(
        "page_id", "collected_at", "product_id", "product_name", "source",
        F.explode("ingredients").alias("i")).select(
        "*", "i.*", t.md5_id(F.col("i.name")).alias("ingredient_id")).withColumnRenamed(
        "name", "ingredient_name")
    latest = [*newest, "position"]
    ingredients = keep_last(
        rows.select("ingredient_id", "ingredient_name", *DETAIL, "source", *latest),
        ["ingredient_id"], latest)
    bridge = keep_last(
        rows.select("product_id", "product_name", "ingredient_id", "ingredient_name",
                    F.col("position").alias("ingredient_position"),
                    F.col("concentration").alias("ingredient_concentration"),
                    "raw_ingredient_name", "evidence_level", "source", *newest),
        ["product_id", "ingredient_id"], [*newest, "ingredient_position"])
    rejected = records.filter(F.col("reject_reason").isNotNull()).select(
        "page_id", "product_url", F.col("reject_reason").alias("reason"))
    return {
        "products": products.drop(*newest),
        "ingredients": ingredients.drop(*latest),
        "product_ingredients": bridge.drop(*newest),
        "features": recommendation_features(products),
        "rejected": rejected}


def build_entities(spark: SparkSession, pages: DataFrame, base: str, source: str,
                   records_path: str | None = None, min_body: int = fixed.MIN_BODY_LENGTH + 1,
                   partitions: int | None = None) -> dict[str, DataFrame]:
    """Extract once into a stored record table, then derive the five tables from it."""
    path = records_path or fresh_path(spark, "page-records")
    page_records(pages, base, source, min_body, partitions).write.mode("overwrite").parquet(path)
    return entity_tables(spark.read.parquet(path))
