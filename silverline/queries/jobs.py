"""Queries over the whole jobs and the data-quality operators."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from silverline.functions import fixed
from silverline.operators import quality as q
from silverline.operators.aggregates import row_audit
from silverline.plans import bronze_to_silver as b2s
from silverline.plans.batches import run_dictionary_batch, run_source_batch
from silverline.plans.dictionary import build_ingredient_dictionary
from silverline.plans.discovery import discover_ingredients, discover_products
from silverline.plans.entities import build_entities
from silverline.plans.features import recommendation_features
from silverline.plans.source_products import build_source_products
from silverline.queries.files import FETCH_SQL, fetch_log
from silverline.queries.markup import BASE, html, obj, script
from silverline.queries.registry import query
from silverline.sources import readers as rd
from silverline.sources.shared import fresh_path
from silverline.sources.writers import write_csv

# ---- Bronze tables made from part, supplier and lineitem ----


def bronze(d):
    k, s = F.col("p_partkey"), F.col("p_size")
    money = F.col("p_retailprice").cast("decimal(12,2)").cast("string")
    products = d.part.select(
        k.alias("product_id"), F.lower("p_name").alias("_norm"),
        F.when(k % 4 == 0, "USD").when(k % 4 == 1, "GBP").when(k % 4 == 2, "XXX").alias("currency"),
        F.when(k % 3 == 0, "skincarisma").when(k % 3 == 1, "cosmetics").otherwise(F.lower("p_type")).alias("source"),
        F.when(k % 7 == 0, "0.0").when(k % 7 == 1, "0.01").when(k % 7 == 2, "$12").otherwise(money).alias("price"),
        (s % 6).cast("string").alias("rating"),
        F.when(k % 10 != 0, F.col("p_brand")).alias("brand_name"),
        F.when(k % 5 == 0, "n/a").when(k % 5 == 1, F.concat(s, F.lit(".7"))).otherwise(
            F.concat(s, F.lit(".0"))).alias("number_of_reviews"))
    name = lambda key: F.when(F.col(key) % 13 == 0, " **†").when(F.col(key) % 11 == 0, "**†").otherwise(
        F.concat(F.lit("  "), F.lpad(F.col(key).cast("string"), 6, "0"), F.lit(" ")))
    ingredients = d.supplier.select(
        F.col("s_suppkey").alias("ingredient_id"), name("s_suppkey").alias("ingredient_name"),
        F.when(F.col("s_suppkey") % 2 == 0, "Strong").alias("evidence_level"),
        F.when(F.col("s_suppkey") % 3 == 0, "skincarisma").otherwise("elsewhere").alias("source"))
    bridge = d.lineitem.select(
        F.col("l_partkey").alias("product_id"), F.col("l_suppkey").alias("ingredient_id"),
        name("l_suppkey").alias("ingredient_name"), F.col("l_linenumber").alias("ingredient_position"),
        F.lit("5%").alias("ingredient_concentration"), F.lit("x").alias("evidence_level"))
    return products, ingredients, bridge


_PRODUCTS = """SELECT cast(p_partkey AS varchar) AS product_id,
  CASE p_partkey % 4 WHEN 1 THEN 'GBP' ELSE 'USD' END AS currency,
  CASE p_partkey % 3 WHEN 0 THEN 'skincarisma' WHEN 1 THEN 'cosmetics' ELSE 'unknown' END AS source,
  CASE WHEN p_partkey % 7 < 2 THEN NULL WHEN p_partkey % 7 = 2 THEN '$12'
       ELSE cast(cast(p_retailprice AS decimal(12,2)) AS varchar) END AS price,
  nullif(cast(p_size % 6 AS varchar), '0') AS rating,
  CASE WHEN p_partkey % 10 = 0 THEN 'Unknown' ELSE p_brand END AS brand_name,
  CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_size END AS number_of_reviews FROM part"""
_INGREDIENTS = """SELECT cast(s_suppkey AS varchar) AS ingredient_id, lpad(cast(s_suppkey AS varchar), 6, '0') AS ingredient_name,
  CASE WHEN s_suppkey % 2 = 0 THEN 'Strong' END AS evidence_level,
  CASE WHEN s_suppkey % 3 = 0 THEN 'skincarisma' ELSE 'unknown' END AS source
FROM supplier WHERE s_suppkey % 13 <> 0 AND s_suppkey % 11 <> 0"""
_BRIDGE = """SELECT cast(l_partkey AS varchar) AS product_id, cast(l_suppkey AS varchar) AS ingredient_id,
  lpad(cast(l_suppkey AS varchar), 6, '0') AS ingredient_name, l_linenumber AS ingredient_position
FROM lineitem WHERE l_suppkey % 13 <> 0 AND l_suppkey % 11 <> 0"""


@query("clean_products", _PRODUCTS)
def _(d):
    return b2s.clean_products(bronze(d)[0])


@query("clean_ingredients", _INGREDIENTS)
def _(d):
    return b2s.clean_ingredients(bronze(d)[1])


@query("clean_bridge", _BRIDGE)
def _(d):
    tables = b2s.silver_tables(*bronze(d))
    return tables["product_ingredients"]


@query("silver_products_with_bridge", f"""
WITH b AS (SELECT product_id, count(*) AS bridge_rows, count(DISTINCT ingredient_id) AS ingredients FROM ({_BRIDGE}) GROUP BY 1)
SELECT p.*, coalesce(bridge_rows, 0) AS bridge_rows, coalesce(ingredients, 0) AS ingredients
FROM ({_PRODUCTS}) p LEFT JOIN b USING (product_id)""")
def _(d):
    """Flagship: clean all three tables, then count the kept bridge rows of every product."""
    tables = b2s.silver_tables(*bronze(d))
    counts = tables["product_ingredients"].groupBy("product_id").agg(
        F.count(F.lit(1)).alias("bridge_rows"), F.count_distinct("ingredient_id").alias("ingredients"))
    return tables["products"].join(counts, "product_id", "left").fillna(0, ["bridge_rows", "ingredients"])


@query("bronze_to_silver", f"""
SELECT 'products' AS table_name, 'silver' AS stage, count(*) AS n_rows FROM part
UNION ALL SELECT 'ingredients', 'silver', count(*) FROM ({_INGREDIENTS})
UNION ALL SELECT 'product_ingredients', 'silver', count(*) FROM ({_BRIDGE})""")
def _(d):
    source, target = fresh_path(d.spark, "bronze"), fresh_path(d.spark, "silver")
    for name, df in zip(("ProductTable", "IngredientsTable", "BridgeTable"), bronze(d)):
        write_csv(df, f"{source}/{name}.csv")
    written = b2s.bronze_to_silver(d.spark, source, target)
    return row_audit({(n, "silver"): d.spark.read.parquet(f"{target}/{n}") for n in written})


# ---- Jobs over pages built from part and supplier ----

def _product_pages(d):
    k, s = F.col("p_partkey"), F.col("p_size")
    sample = script(obj(type="Product", image=F.array(F.lit("https://i.example.com/a.png"),
                                                      F.lit("/files/Ingredient_Example.png"))))
    listed = obj(type="ItemList", name="INCI", itemListElement=F.array(
        F.struct(F.lit(None).cast("int").alias("position"), F.col("p_type").alias("name")),
        F.struct(F.lit(2).alias("position"), F.lower("p_brand").alias("name"))))
    body = html(
        script(listed), F.when(k % 17 == 0, sample), '<h1 class="product__title">', F.when(k % 9 != 0, F.col("p_name")), "</h1>",
        '<meta itemprop="brand" content="', F.when(k % 10 == 0, "Hidden").otherwise(F.col("p_brand")), '">',
        '<section id="pp-overview"><p class="pp-subtitle">A soothing ', F.col("p_name"), "</p></section>",
        '<b class="product__price">$', s, '.25</b><div class="pp-scorecard"><div class="item"><i class="lbl">Fungal</i><i class="val">',
        F.when(s % 2 == 0, "No"), '</i></div></div><span class="pp-badge">Oil-Free</span>',
        '<div class="pp-ingredient"><h3>', F.upper("p_brand"), " ", s, '%</h3><p class="ing-desc">', F.col("p_type"), "</p></div>")
    card_brand = F.when(k % 10 == 0, "Hidden").otherwise(F.col("p_brand")).alias("brand_name")
    return d.part.select(k.alias("page_id"), html(BASE + "/p/", k).alias("url"), card_brand,
                         F.when(k % 8 != 0, body).alias("html"))


def _entities(d):
    cores = d.spark.sparkContext.defaultParallelism
    return build_entities(d.spark, _product_pages(d), BASE, "shop", min_body=1, partitions=cores)


def _nulls(kind: str, *names: str) -> str:
    return ", ".join(f"cast(NULL AS {kind}) AS {n}" for n in names)


_VALID = "FROM part WHERE p_partkey % 8 <> 0 AND p_partkey % 10 <> 0 AND p_partkey % 9 <> 0 AND p_partkey % 17 <> 0"
_PID = "md5('https://shop.example.com/p/' || p_partkey)"


@query("entity_products", f"""
SELECT {_PID} AS product_id, 'https://shop.example.com/p/' || p_partkey AS product_url, p_name AS product_name,
  p_brand AS brand_name, 'A soothing ' || p_name AS description, p_size || '.25' AS price, 'USD' AS currency,
  CASE WHEN p_size % 2 = 0 THEN 0 END AS fungal_acne_safe, 'Oil-Free' AS product_claims, 1 AS oil_free, 0 AS vegan,
  0 AS cruelty_free, 0 AS reef_safe, 0 AS fragrance_free, 0 AS alcohol_free, 0 AS paraben_free, 0 AS sulfate_free,
  0 AS silicone_free, 'soothing' AS benefits, 'redness' AS concerns, 'shop' AS source,
  {_nulls("varchar", "category", "sub_category", "image_url", "size", "product_type_text", "key_actives_text",
          "good_for_skin_types", "bad_for_skin_types", "skin_type_notes", "safety_notes", "free_from", "country_of_origin")},
  {_nulls("int", "ingredients_count", "oily_skin_score", "dry_skin_score", "sensitive_skin_score",
          "combination_skin_score", "normal_skin_score", "acne_prone_score", "pregnancy_safe", "irritation_rating")},
  {_nulls("double", "rating", "comedogenic_rating")}, {_nulls("bigint", "number_of_reviews")} {_VALID}""")
def _(d):
    return _entities(d)["products"]


@query("entity_ingredients", f"""
SELECT *, 'shop' AS source, {_nulls("varchar", "evidence_level", "science_tags", "science_details", "callout_type",
                                    "callout_text", "warning_type", "warning_text")} FROM (
SELECT md5(lower(p_brand)) AS ingredient_id, upper(p_brand) AS ingredient_name, max_by(p_type, p_partkey) AS description
{_VALID} GROUP BY p_brand
UNION ALL SELECT DISTINCT md5(lower(p_type)), p_type, cast(NULL AS varchar) {_VALID})""")
def _(d):
    return _entities(d)["ingredients"]


@query("entity_bridge", f"""
SELECT *, 'shop' AS source, cast(NULL AS varchar) AS evidence_level FROM (
SELECT {_PID} AS product_id, p_name AS product_name, md5(lower(p_brand)) AS ingredient_id,
  upper(p_brand) AS ingredient_name, 1 AS ingredient_position, p_size || '%' AS ingredient_concentration,
  upper(p_brand) || ' ' || p_size || '%' AS raw_ingredient_name {_VALID}
UNION ALL SELECT {_PID}, p_name, md5(lower(p_type)), p_type, 2, NULL, p_type {_VALID})""")
def _(d):
    return _entities(d)["product_ingredients"]


@query("entity_features", f"""
SELECT {_PID} AS product_id, 1 AS skin_type_oily, 0 AS skin_type_dry, 1 AS skin_type_sensitive,
  0 AS skin_type_combination, 0 AS skin_type_acne_prone, 0 AS concern_acne, 1 AS concern_redness,
  0 AS concern_hyperpigmentation, 0 AS concern_anti_aging, 0 AS concern_dryness, 1 AS suitable_for_oily,
  0 AS suitable_for_dry, 1 AS suitable_for_sensitive, 0 AS suitable_for_acne, 0 AS suitable_for_hyperpigmentation,
  0 AS suitable_for_anti_aging, 1 AS suitable_for_redness, 0 AS avoid_for_sensitive,
  CASE WHEN p_size % 2 = 0 THEN 1 END AS avoid_for_fungal_acne, CASE WHEN p_size % 2 = 0 THEN 0 END AS fungal_acne_safe,
  {_nulls("int", "pregnancy_safe", "irritation_risk")}, {_nulls("double", "comedogenic_risk")} {_VALID}""")
def _(d):
    return _entities(d)["features"]


@query("entity_rejected", """
SELECT p_partkey AS page_id, 'https://shop.example.com/p/' || p_partkey AS product_url,
  CASE WHEN p_partkey % 8 = 0 THEN 'failed_fetch' WHEN p_partkey % 10 = 0 THEN 'hidden_brand'
  WHEN p_partkey % 17 = 0 THEN 'ingredient_example_image' ELSE 'no_product_title' END AS reason
FROM part WHERE p_partkey % 8 = 0 OR p_partkey % 10 = 0 OR p_partkey % 9 = 0 OR p_partkey % 17 = 0""")
def _(d):
    return _entities(d)["rejected"]


def flat(df):
    """Lists as text, so that every column can be compared."""
    return df.withColumns({c: F.array_join(F.col(c).cast("array<string>"), "|") for c, kind in df.dtypes if kind.startswith("array")})


@query("ingredient_dictionary", f"""
SELECT 'third_ingredient_' || left(sha256('https://shop.example.com/i/' || s_suppkey), 16) AS record_id,
  '20260518_111454' AS batch_id, 'third' AS source_name, 'website' AS source_type, 'https://shop.example.com' AS source_url,
  'https://shop.example.com/i/' || s_suppkey AS ingredient_url, '2026-05-18' AS ingestion_date,
  '2026-05-18T11:14:54.000000' AS collected_at, 'v1' AS pipeline_version, s_name AS raw_ingredient_name,
  lower(s_name) AS normalized_ingredient_name,
  CASE WHEN s_suppkey % 4 = 0 THEN 'niacinamide' ELSE lower(s_name) END AS canonical_ingredient_name, 'GOOD' AS rating,
  'Calm' AS benefits, CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE 'About ' || s_name END AS full_description,
  CASE WHEN s_suppkey % 3 = 0 THEN 'partial' ELSE 'success' END AS extraction_status,
  CASE WHEN s_suppkey % 3 = 0 THEN 'full_description|' ELSE '' END ||
    'ingredient_categories|at_a_glance_points|synonyms|concerns|safety_notes' AS missing_fields,
  {_nulls("varchar", "raw_file_path", "ingredient_categories", "at_a_glance_points", "synonyms", "concerns",
          "safety_notes", "related_ingredients")}
FROM (SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 0 THEN 'Vitamin B3' ELSE s_name END AS s_name FROM supplier)""")
def _(d):
    k = F.col("s_suppkey")
    name = F.when(k % 4 == 0, "Vitamin B3").otherwise(F.col("s_name"))
    text = F.when(k % 3 != 0, html("<h2>Description</h2><div><p>About ", name, "</p></div>"))
    pages = d.supplier.select(html(BASE + "/i/", k).alias("url"), html(
        "<body><main><h1> ", name, "</h1><span>Rating: good</span><div>Benefits: <a>Calm</a></div>", text, "</main></body>").alias("html"))
    out = build_ingredient_dictionary(pages, "20260518_111454", "third", BASE, "2026-05-18T11:14:54",
                                      partitions=d.spark.sparkContext.defaultParallelism)
    return flat(out)


@query("source_products", f"""
SELECT cast(p_partkey AS varchar) AS record_id, 'b' AS batch_id, 'second' AS source_name, 'website' AS source_type,
  'https://shop.example.com' AS source_url, cast(p_partkey AS varchar) AS source_product_id,
  'https://shop.example.com/p/' || p_partkey AS product_url, p_name AS product_name, p_brand AS brand_name,
  p_type || ', , ' || p_brand || '. For the latest information' AS ingredients_text,
  p_type || '|' || p_brand || '.' AS raw_ingredients_list, '$' || p_size AS price, 'USD' AS currency,
  'partial' AS extraction_status, 'raw_category|product_description|rating|review_count|size|image_url|availability|' ||
  'skin_type_claims|skin_concern_claims|product_highlights|usage_instructions' AS missing_fields,
  '2026-05-18T11:14:54.000000' AS scraped_at, '2026-05-18' AS ingestion_date, 'v1' AS pipeline_version,
  cast(NULL AS double) AS rating, cast(NULL AS int) AS review_count,
  {_nulls("varchar", "raw_category", "product_description", "sale_price", "size", "image_url", "availability",
          "skin_type_claims", "skin_concern_claims", "product_highlights", "usage_instructions", "raw_file_path")}
FROM part""")
def _(d):
    k = F.col("p_partkey")
    pages = d.part.select(html(BASE + "/p/", k).alias("url"), html(
        '<h1 id="product-title">', F.col("p_name"), '</h1><a class="override-pdp-brand">', F.col("p_brand"),
        '</a><i id="product-price">$', F.col("p_size"), '</i><i id="view-item-container" data-track-push="', k,
        '"></i><button data-tracking-push aria-controls="c">Ingredients</button><div id="c"><p class="attribute-content">',
        F.col("p_type"), ", , ", F.col("p_brand"), ". For the latest information<p>Another note<li>a<li>b</div>").alias("html"))
    out = build_source_products(pages, "b", "second", BASE, "2026-05-18T11:14:54",
                                partitions=d.spark.sparkContext.defaultParallelism)
    return flat(out)


def _source_pages(d):
    k = F.col("p_partkey")
    body = html('<h1 id="product-title">', F.when(k % 5 != 0, F.col("p_name")), "</h1>")
    return d.part.select(html(BASE + "/p/", k).alias("url"), F.when(k % 7 != 0, body).alias("html"))


def _source_batch(d):
    return run_source_batch(
        d.spark, _source_pages(d), fresh_path(d.spark, "source-batch"), "20260518_111454", "second", BASE,
        "2026-05-18T11:14:54", "/in/urls.csv", partitions=d.spark.sparkContext.defaultParallelism)


@query("source_batch_manifest", """
SELECT '20260518_111454' AS batch_id, 'second' AS source_name, 'products' AS entity, 'v1' AS pipeline_version,
  '/in/urls.csv' AS input_url_file, '2026-05-18T11:14:54.000000' AS started_at, '2026-05-18T11:14:54.000000' AS finished_at,
  count(*) AS total_urls, 0::BIGINT AS success_count, count(*) FILTER (WHERE p_partkey % 7 <> 0) AS partial_count,
  count(*) FILTER (WHERE p_partkey % 7 = 0) AS failed_count,
  'failed,failed_urls,records_csv,records_jsonl,run_log' AS outputs FROM part""")
def _(d):
    names = ["records_jsonl", "records_csv", "run_log", "failed_urls", "failed_pages"]
    files = ", ".join(f"{n}: string" for n in names)
    made = rd.read_jsonl(d.spark, f"{_source_batch(d)['manifest']}/totals", (
        "batch_id string, source_name string, entity string, pipeline_version string, input_url_file string, "
        "started_at string, finished_at string, total_urls long, success_count long, partial_count long, "
        f"failed_count long, output_files struct<{files}>"))
    ends = F.array(*[F.substring_index(F.col(f"output_files.{n}"), "/", -1) for n in names])
    return made.withColumn("outputs", F.array_join(F.array_sort(ends), ",")).drop("output_files")


@query("source_batch_records", """
SELECT 'https://shop.example.com/p/' || p_partkey AS product_url, CASE WHEN p_partkey % 5 <> 0 THEN p_name END AS product_name,
  'partial' AS extraction_status FROM part WHERE p_partkey % 7 <> 0""")
def _(d):
    return rd.read_jsonl(d.spark, _source_batch(d)["records_jsonl"],
                         "product_url string, product_name string, extraction_status string")


@query("source_batch_log", """
SELECT 'https://shop.example.com/p/' || p_partkey AS product_url, CASE WHEN p_partkey % 7 = 0 THEN 'failed' ELSE 'partial' END AS status,
  CASE WHEN p_partkey % 7 = 0 THEN 'ParseError' END AS error_type, '2026-05-18T11:14:54.000000' AS collected_at FROM part""")
def _(d):
    return rd.read_jsonl(d.spark, _source_batch(d)["run_log"],
                         "product_url string, status string, error_type string, collected_at string")


@query("dictionary_batch_failures", """
SELECT 'https://shop.example.com/i/' || s_suppkey AS ingredient_url, cast(NULL AS int) AS http_status, cast(NULL AS int) AS attempts,
  'ParseError' AS error_type, cast(NULL AS varchar) AS error_message, '2026-05-18T11:14:54.000000' AS collected_at
FROM supplier WHERE s_suppkey % 3 = 0""")
def _(d):
    k = F.col("s_suppkey")
    pages = d.supplier.select(html(BASE + "/i/", k).alias("url"), F.when(k % 3 != 0, html(
        "<body><main><h1>", F.col("s_name"), "</h1></main></body>")).alias("html"))
    made = run_dictionary_batch(d.spark, pages, fresh_path(d.spark, "dictionary-batch"), "b", "third", BASE,
                                "2026-05-18T11:14:54", "/in/urls.csv", partitions=d.spark.sparkContext.defaultParallelism)
    return d.spark.read.parquet(made["failed_urls"])


# ---- Discovery over list pages: page n shows the products or ingredients of its orders' lines ----

def _listing(d, card: Column):
    """One page per order of up to seven cards; the same key shows up on many pages."""
    cards = F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))), lambda x: card(x["l_partkey"]))
    return (d.lineitem.filter("l_orderkey is not null").groupBy(F.col("l_orderkey").alias("page"))
            .agg(F.array_join(cards, "").alias("body"))
            .select("page", F.when(F.col("page") % 11 != 0, html("<html><table>", F.col("body"), "</table>")).alias("html")))


_SHOWN = """shown AS (SELECT l_orderkey AS page, l_partkey AS k, min(l_linenumber) AS at FROM lineitem
  WHERE l_orderkey % 11 <> 0 GROUP BY ALL), firsts AS (SELECT k, min(page) AS page FROM shown GROUP BY 1)"""


def _products(d):
    card = lambda k: html('<div class="card f-column"><p class="product-card__title"><a class="reversed-link" href="/p/', k,
                          '#c">Item ', k, "</a></p></div>")
    return discover_products(_listing(d, card), BASE, d.spark.sparkContext.defaultParallelism)


@query("discover_product_links", f"""
WITH {_SHOWN} SELECT 'https://shop.example.com/p/' || k || '#c' AS product_url, 'Item ' || k AS product_name, page FROM firsts""")
def _(d):
    return _products(d)["links"].select("product_url", "product_name", "page")


@query("discover_product_progress", f"""
WITH {_SHOWN}, found AS (SELECT l_orderkey AS page, count(*) AS found FROM lineitem WHERE l_orderkey % 11 <> 0 GROUP BY 1),
new AS (SELECT page, count(*) AS new_keys FROM firsts GROUP BY 1)
SELECT page, found, coalesce(new_keys, 0) AS new_keys, sum(coalesce(new_keys, 0)) OVER (ORDER BY page)::BIGINT AS known_keys
FROM found LEFT JOIN new USING (page)""")
def _(d):
    return _products(d)["progress"]


@query("discover_ingredient_urls", f"""
WITH {_SHOWN} SELECT 'https://shop.example.com/ingredient-dictionary/ingredient-' || k || '.html' AS ingredient_url,
  'Name ' || k AS ingredient_name_from_list, 'Good' AS rating_from_list, page FROM firsts""")
def _(d):
    return _ingredients(d)["links"].select("ingredient_url", "ingredient_name_from_list", "rating_from_list", "page")


def _ingredients(d):
    row = lambda k: html('<tr><td><a href="/ingredient-dictionary/ingredient-', k, '.html#top"><h3>Name ', k,
                         '</h3></a></td><td><i class="xColoredIngredientRating1">Good</i></td></tr>')
    return discover_ingredients(_listing(d, row), BASE, "third", d.spark.sparkContext.defaultParallelism)


@query("discover_ingredient_log", """
SELECT l_orderkey AS page, CASE WHEN l_orderkey % 11 = 0 THEN 0 ELSE count(*) END AS records_found,
  l_orderkey % 11 <> 0 AS success, CASE WHEN l_orderkey % 11 = 0 THEN 'ParseError' END AS error_type
FROM lineitem GROUP BY l_orderkey""")
def _(d):
    return _ingredients(d)["log"]


@query("recommendation_features", """
SELECT doc_id AS product_id,
  cast(contains(t, 'oily') OR contains(t, 'oil-free') OR contains(t, 'sebum') OR contains(t, 'matte') OR coalesce(CASE WHEN quality = 1 THEN 5 ELSE 2 END, 0) >= 4 AS int) AS skin_type_oily,
  cast(contains(t, 'dry skin') OR contains(t, 'dryness') OR contains(t, 'hydrating') OR coalesce(CASE WHEN toxic = 1 THEN 4 END, 0) >= 4 AS int) AS skin_type_dry,
  cast(contains(t, 'sensitive') OR contains(t, 'soothing') OR contains(t, 'calming') AS int) AS skin_type_sensitive,
  cast(contains(t, 'combination skin') AS int) AS skin_type_combination,
  cast(contains(t, 'acne-prone') OR contains(t, 'acne prone') AS int) AS skin_type_acne_prone,
  cast(contains(t, 'acne') OR contains(t, 'blemish') OR contains(t, 'salicylic') OR contains(t, 'bha') OR contains(t, 'non-comedogenic') AS int) AS concern_acne,
  cast(contains(t, 'redness') OR contains(t, 'soothing') OR contains(t, 'calming') OR contains(t, 'centella') AS int) AS concern_redness,
  cast(contains(t, 'hyperpigmentation') OR contains(t, 'dark spot') OR contains(t, 'brightening') OR contains(t, 'niacinamide') OR contains(t, 'vitamin c') AS int) AS concern_hyperpigmentation,
  cast(contains(t, 'anti-aging') OR contains(t, 'wrinkle') OR contains(t, 'retinol') OR contains(t, 'peptide') AS int) AS concern_anti_aging,
  cast(contains(t, 'dryness') OR contains(t, 'hydration') OR contains(t, 'moisture') OR contains(t, 'barrier') AS int) AS concern_dryness,
  cast(contains(t, 'oily') OR contains(t, 'oil-free') OR contains(t, 'matte') OR coalesce(CASE WHEN quality = 1 THEN 5 ELSE 2 END, 0) >= 4 AS int) AS suitable_for_oily,
  cast(contains(t, 'dry skin') OR contains(t, 'hydrating') OR contains(t, 'moisturizing') OR coalesce(CASE WHEN toxic = 1 THEN 4 END, 0) >= 4 AS int) AS suitable_for_dry,
  cast(contains(t, 'sensitive') OR contains(t, 'soothing') AS int) AS suitable_for_sensitive,
  cast(contains(t, 'acne-prone') OR contains(t, 'non-comedogenic') AS int) AS suitable_for_acne,
  cast(contains(t, 'hyperpigmentation') OR contains(t, 'dark spot') OR contains(t, 'brightening') AS int) AS suitable_for_hyperpigmentation,
  cast(contains(t, 'anti-aging') OR contains(t, 'wrinkle') OR contains(t, 'retinol') OR contains(t, 'peptide') AS int) AS suitable_for_anti_aging,
  cast(contains(t, 'redness') OR contains(t, 'soothing') OR contains(t, 'calming') AS int) AS suitable_for_redness,
  cast((contains(t, 'fragrance') OR contains(t, 'alcohol denat'))
    AND NOT (contains(t, 'fragrance-free') OR contains(t, 'alcohol-free')) AS int) AS avoid_for_sensitive,
  cast(toxic = 0 AS int) AS avoid_for_fungal_acne, toxic AS fungal_acne_safe, quality AS pregnancy_safe,
  cast(NULL AS int) AS comedogenic_risk, cast(NULL AS int) AS irritation_risk
FROM (SELECT d.doc_id, lower(d.text) AS t, quality, toxic FROM documents d LEFT JOIN labels USING (doc_id))""")
def _(d):
    rows = d.documents.join(d.labels, "doc_id", "left").select(
        F.col("doc_id").alias("product_id"), F.col("text").alias("description"),
        F.when(F.col("quality") == 1, 5).otherwise(2).alias("oily_skin_score"),
        F.when(F.col("toxic") == 1, 4).alias("dry_skin_score"),
        F.col("toxic").alias("fungal_acne_safe"), F.col("quality").alias("pregnancy_safe"))
    return recommendation_features(rows)


# ---- Data quality ----

def _gaps(d):
    k = F.col("c_custkey")
    return d.customer.select(
        k, F.when(k % 3 == 0, " ").when(k % 3 == 1, F.col("c_name")).alias("name"),
        F.when(k % 5 != 0, F.col("c_mktsegment")).alias("segment"), F.when(k % 2 == 0, F.col("c_acctbal")).alias("balance"))


@query("validate_record", """
SELECT c_custkey, CASE WHEN c_custkey % 3 <> 1 OR c_custkey % 5 = 0 THEN 'partial' ELSE 'success' END AS extraction_status,
  concat_ws(',', CASE WHEN c_custkey % 3 <> 1 THEN 'name' END, CASE WHEN c_custkey % 5 = 0 THEN 'segment' END,
    CASE WHEN c_custkey % 2 <> 0 THEN 'balance' END, 'synonyms') AS missing_fields FROM customer""")
def _(d):
    out = q.validate_record(_gaps(d), ["name", "segment"], ["balance", "synonyms"])
    return out.select("c_custkey", "extraction_status", F.array_join("missing_fields", ",").alias("missing_fields"))


@query("missing_fields_any", """
SELECT c_custkey, CASE WHEN c_custkey % 3 = 2 OR c_custkey % 2 <> 0 THEN 'partial' ELSE 'success' END AS extraction_status,
  concat_ws(',', CASE WHEN c_custkey % 3 = 2 THEN 'name' END, CASE WHEN c_custkey % 2 <> 0 THEN 'balance' END) AS missing_fields
FROM customer""")
def _(d):
    out = q.missing_fields_any(_gaps(d), ["segment"])
    return out.select("c_custkey", "extraction_status", F.array_join("missing_fields", ",").alias("missing_fields"))


@query("missing_profile", """
SELECT field, count(*) FILTER (WHERE gone) AS missing, count(*) AS total_rows FROM (
  SELECT 'name' AS field, c_custkey % 3 <> 1 AS gone FROM customer
  UNION ALL SELECT 'segment', c_custkey % 5 = 0 FROM customer
  UNION ALL SELECT 'balance', c_custkey % 2 <> 0 FROM customer) GROUP BY 1""")
def _(d):
    return q.missing_profile(_gaps(d), ["name", "segment", "balance"])


@query("classify_fetch", f"""
SELECT event_id, http_status, error_type, CASE WHEN error_type IS NULL THEN 'ok' ELSE 'failed_fetch' END AS status FROM ({FETCH_SQL})""")
def _(d):
    return q.classify_fetch(fetch_log(d), "http_status", "body_length").select(
        "event_id", "http_status", "error_type", "status")


@query("run_log", f"""
SELECT ingredient_url, CASE WHEN error_type IS NULL THEN 'ok' ELSE 'failed_fetch' END AS status, http_status,
  cast(attempts AS bigint) AS attempts, error_type, cast(NULL AS varchar) AS error_message, collected_at,
  CASE WHEN event_type = 'error' THEN 'body,title' END AS missing_fields
FROM ({FETCH_SQL}) JOIN (SELECT event_id, event_type FROM events) USING (event_id)""")
def _(d):
    lacking = F.when(F.col("event_type") == "error", F.array(F.lit("body"), F.lit("title")))
    rows = fetch_log(d).join(d.events.select("event_id", "event_type"), "event_id").withColumn("missing_fields", lacking)
    log = q.run_log(q.classify_fetch(rows, "http_status", "body_length"), "ingredient_url")
    return log.withColumn("missing_fields", F.array_join("missing_fields", ","))


@query("discovery_log", """
SELECT page_id, CASE WHEN page_id % 7 = 0 THEN 0 ELSE len(regexp_extract_all(html, '<a\\s')) END AS records_found,
  page_id % 7 <> 0 AS success, CASE WHEN page_id % 7 = 0 THEN 'Timeout' END AS error_type FROM pages""".replace("\\\\", "\\"))
def _(d):
    links = F.size(F.regexp_extract_all("html", F.lit(r"(<a\s)"), F.lit(1)))
    error = F.when(F.col("page_id") % 7 == 0, "Timeout")
    return q.discovery_log(d.pages, "page_id", links, error)
