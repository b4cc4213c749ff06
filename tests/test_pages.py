from pyspark.sql import functions as F

import random

import pyarrow as pa
import pytest

from silverline.functions import nodes as nd
from silverline.functions.nodes import raw_text, joined_text, select, tag, with_nodes
from silverline.plans.dictionary import build_ingredient_dictionary
from silverline.plans.entities import build_entities, page_records
from silverline.plans.source_products import build_source_products
from silverline.operators import pages as pg

BASE = "https://shop.example.com"

PRODUCT = """<html><head>
<script type="application/ld+json">{"@graph": [
 {"@type": ["Thing", "Product"], "name": "Calm &amp; Soothe Serum", "brand": {"name": "Acme"},
  "image": ["//img.example.com/a.png"], "offers": {"price": 12.5, "priceCurrency": "GBP"},
  "description": "A serum"},
 {"@type": "BreadcrumbList", "itemListElement": [{"position": 3, "name": "Serums"},
  {"position": 1, "name": "Home"}, {"position": 2, "name": "Skincare"}, {"name": "Last"}]},
 {"@type": "ItemList", "name": "INCI list", "itemListElement": [{"name": "Zinc"},
  {"position": 2, "name": "Aqua"}]}]}</script>
<script type="application/ld+json">{bad</script></head><body>
<div class="breadcrumbs"><a>Home</a></div><h1 class="product__title">Serum</h1>
<section id="pp-overview"><p class="pp-subtitle">Hydrating  serum with<b>Vitamin C</b></p></section>
<div class="pp-scorecard">
 <div class="item"><span class="lbl">Pregnancy</span><span class="val">Yes</span></div>
 <div class="item"><span class="lbl">Fungal Acne</span><span class="val">?</span></div>
 <div class="item"><span class="lbl">Comedogenic</span><span class="val">2 / 5</span></div></div>
<div class="pp-spec"><i class="lbl">Size</i><i class="val">30 ml</i></div>
<div class="pp-spec"><i class="lbl">Ingredients</i><i class="val">24 in all</i></div>
<div class="pp-spec"><i class="lbl">Key Active</i><i class="val">Retinol</i></div>
<span class="pp-badge">Vegan</span><span class="pp-badge">Oil-Free</span><span class="pp-badge">Vegan</span>
<div class="free-list">Free from: Parabens, Sulfates</div>
<div class="pp-skin-card"><div class="type">Oi<b>ly</b> Skin</div><b class="rate">Excellent</b></div>
<div class="pp-skin-card"><div class="type">Dry Skin</div><b class="rate">Poor</b></div>
<div class="pp-safety"><div class="pp-safety-item caution"><strong>Fungal acne</strong><p>May feed. 1/5</p></div>
 <div class="pp-safety-item"><strong>Irritation</strong><p>Irritating</p></div>
 <div class="pp-safety-item"><strong>Other</strong><p>non-irritating</p></div></div>
<div class="pp-verdict"><b class="score">4.5 of 5</b></div>
<div class="pp-review-card"><div class="stat"><b class="lbl">Reviews</b><b class="num">1,200</b></div>
 <div class="stat"><b class="lbl">reviews</b><b class="num">7</b></div></div>
<div class="pp-origin"><span class="text">Made in France</span></div>
<div class="pp-ingredient"><h3>Niacinamide 5 % <span class="tag">Strong</span></h3>
 <p class="ing-desc">B3</p><ul class="pp-science"><li><strong>Study:</strong> one</li><li>two</li></ul>
 <div class="pp-callout good">Nice</div><div class="pp-warning">Careful</div></div>
<div class="pp-ingredient"><p>no heading</p></div>
<div class="pp-ingredient"><h3>Retinol</h3></div>
<div class="pp-accordion"><label>Full ingredient list</label><div class="pp-acc-content">
 <p>24 ingredients</p><p>(INCI): Aqua, niacinamide 4%, This product, 1,2-Hexanediol. FREE FROM: x, y</p></div></div>
</body></html>"""

HIDDEN = "<html><body><div class='breadcrumbs'><a>Hidden</a></div><h1>x</h1></body></html>"


def _pages(spark):
    rows = [(1, f"{BASE}/p/1", PRODUCT), (2, f"{BASE}/p/2", HIDDEN), (3, f"{BASE}/p/3", None),
            (4, " ", PRODUCT), (5, f"{BASE}/p/5", "<html><h1> </h1></html>")]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


MARKUP = """<div>|</div>|<p class="a  b">|</p>|text|a & b|&amp;|&lt|&#65;|&|<|>|<br>|<br/>|<script>|</script>|</ script>|</SCRIPT>|var t="</p>"
<!--|-->|<!-- ad -->|<!DOCTYPE html>|<title>|</title>|<style>|</style>|<template>|</template>|<a href="/x?a=1" data-x>|</a>|<a href="/x&amp;y">
<IMG SRC=x>|<textarea>|</textarea>|<x y=1>|</p >|<img alt="" alt="z" />|<li>|</li>|<p class="a>b">|<p class='q'>|é|</|<a|<noscript>
</noscript>|<svg/>|<p a="1"b="2">|<script src="x"/>|{"a": "&amp;"}""".replace("\n", "|").split("|")


def test_plain_markup_is_read_as_the_tokenizer_reads_it():
    draw, known, plain = random.Random(7), {}, 0
    for page in [PRODUCT, HIDDEN, "", *("".join(draw.choices(MARKUP, k=draw.randint(1, 8))) for _ in range(30_000))]:
        quick = nd._flatten_plain(page, known)
        if quick is not None:
            parser = nd._Flattener()
            parser.feed(page)
            assert quick == parser.finish(), page
            plain += 1
    assert plain > 5_000 and nd._flatten_plain(PRODUCT, known)


def test_product_record(spark):
    row = page_records(_pages(spark), BASE, "shop", min_body=1).filter("page_id = 1").first()
    want = {
        "product_name": "Calm & Soothe Serum", "brand_name": "Acme", "category": "Skincare",
        "sub_category": "Serums", "image_url": "https://img.example.com/a.png", "price": "12.5",
        "currency": "GBP", "description": "Hydrating serum with Vitamin C", "size": "30 ml",
        "ingredients_count": 24, "key_actives_text": "Retinol", "product_type_text": None,
        "pregnancy_safe": 1, "fungal_acne_safe": 0, "comedogenic_rating": 2.0,
        "irritation_rating": 0, "product_claims": "Oil-Free|Vegan", "vegan": 1, "oil_free": 1,
        "reef_safe": 0, "free_from": "Parabens|Sulfates", "oily_skin_score": 5, "dry_skin_score": 1,
        "acne_prone_score": None, "good_for_skin_types": "OilySkin", "bad_for_skin_types": "Dry Skin",
        "skin_type_notes": "OilySkin: 5/5|Dry Skin: 1/5", "rating": 4.5, "number_of_reviews": 8,
        "country_of_origin": "France", "benefits": "brightening|hydrating", "concerns": "anti_aging",
        "safety_notes": "Fungal acne: May feed. 1/5|Irritation: Irritating|Other: non-irritating",
        "reject_reason": None}
    assert {k: row[k] for k in want} == want


def test_merged_ingredients(spark):
    row = page_records(_pages(spark), BASE, "shop", min_body=1).filter("page_id = 1").first()
    got = [(i["position"], i["name"], i["concentration"], i["description"]) for i in row["ingredients"]]
    assert got == [
        (1, "Niacinamide", "5%", "B3"), (1, "Aqua", None, None), (3, "Retinol", None, None),
        (4, "1", None, None), (5, "2-Hexanediol", None, None), (6, "Zinc", None, None)]
    first = row["ingredients"][0]
    assert first["evidence_level"] == "Strong" and first["raw_ingredient_name"] == "Niacinamide 5 %"
    assert first["science_tags"] == "Study" and first["science_details"] == "Study: one|two"
    assert first["callout_type"] == "good" and first["callout_text"] == "Nice"
    assert first["warning_type"] is None and first["warning_text"] == "Careful"


def test_entities_and_rejects(spark):
    out = build_entities(spark, _pages(spark), BASE, "shop", min_body=1)
    reasons = {r["page_id"]: r["reason"] for r in out["rejected"].collect()}
    assert reasons == {2: "hidden_breadcrumb", 3: "failed_fetch", 4: "empty_url", 5: "no_product_title"}
    assert out["products"].count() == 1 and out["ingredients"].count() == 6
    assert out["product_ingredients"].count() == 6
    feature = out["features"].first()
    assert feature["skin_type_oily"] == 1 and feature["avoid_for_fungal_acne"] == 1


def test_only_one_python_node(spark):
    df = page_records(_pages(spark), BASE, "shop")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "Exchange hashpartitioning" not in plan


def test_text_modes_and_unclosed_tags(spark):
    df = with_nodes(spark.createDataFrame(
        [("<p>Oil<b>y</b><p>two<br>lines<script>var t='</p>';</script></div>",)], "html string"))
    n = F.col("nodes")
    assert df.select(raw_text(n), joined_text(n)).first() == ("Oilytwolines", "Oil y two lines")
    assert df.select(F.size(select(n, tag("p"), tag("p")))).first()[0] == 1


@pytest.mark.parametrize("step", [nd.html_nodes, nd.html_tree_nodes])
def test_nodes_of_a_batch_are_never_held_together(step):
    """Nodes take many times the room of their markup, so they leave a few pages at a time."""
    dense, long = "<p>" + "<b>x</b>" * 2_000, "<i>" + "y" * 2 * nd.PART_BYTES
    pages = [None, "", long, *["<b>z</b>"] * 200, *[dense] * 100, long, None]
    whole = pa.array(pages, pa.string())
    parts = list(step.func(iter([whole.slice(0, 5), whole.slice(5, 0), whole.slice(5)])))
    assert max(p.nbytes for p in parts) < 16 * nd.PART_BYTES
    assert max(len(p) for p in parts) <= nd.PART_PAGES
    sizes = [None if n is None else len(n) for p in parts for n in p.to_pylist()]
    assert sizes == [None, 0, 2, *[2] * 200, *[4_001] * 100, 2, None]


def test_parts_keep_pages_and_their_order(spark):
    pages = spark.range(0, 1_000, 1, 3).select("id", F.when(F.col("id") % 7 > 0, F.concat(
        F.lit("<p>"), F.repeat(F.lit("x"), (F.col("id") % 5 * 20_000).cast("int")),
        F.lit("<b>"), "id")).alias("html"))
    read = with_nodes(pages).select("id", "html", F.element_at("nodes", -1)["text"].alias("last")).collect()
    assert len(read) == 1_000 and all(r["last"] == (r["html"] and str(r["id"])) for r in read)
    none = with_nodes(pages.filter("id < 0")).select(F.size("nodes")).collect()
    assert none == []


SOURCE = """<html><body><h1 id="product-title">Cream</h1><a class="override-pdp-brand">Acme</a>
<div id="product-price">$38.00</div><div id="view-item-container" data-track-push="sku1"></div>
<button data-tracking-push aria-controls="c1">Ingredients</button>
<button data-tracking-push>Volume</button><button data-tracking-push aria-controls="c1">Volume</button>
<div id="c1"><div class="attribute-content">Water, Glycerin,, Zinc. For the latest information see</div></div>
<span aria-label="3.9 out of 5 stars"></span><div class="bv-rnr__x">4.4</div> Read 1,234 Reviews
<script>const images = [{"original": "https://i/a.png"}];</script></body></html>"""


def test_source_products(spark):
    pages = spark.createDataFrame([(f"{BASE}/p/9", SOURCE)], "url string, html string")
    row = build_source_products(pages, "b1", "second", BASE, "2026-05-18T11:14:54").first()
    assert row["raw_ingredients_list"] == ["Water", "Glycerin", "Zinc."]
    assert (row["rating"], row["review_count"], row["record_id"]) == (4.4, 1234, "sku1")
    assert row["size"] is None and row["image_url"] == "https://i/a.png"
    assert row["extraction_status"] == "partial" and row["missing_fields"] == [
        "raw_category", "product_description", "size", "availability", "skin_type_claims",
        "skin_concern_claims", "product_highlights", "usage_instructions"]


DETAIL_PAGE = """<body><nav><div>Benefits: no</div></nav><main><h1>Niacinamide</h1>
<div>x<div>Rating: <span>best</span></div><div><b>Benefits:</b> <a>Soothing</a><a>Oil Control</a></div>
<div>Categories: Vitamins, Antioxidant, vitamins</div></div>
<h2>Niacinamide at a glance</h2><div><ul><li>AKA vitamin B3 and nicotinamide</li><li>Calms</li></ul></div>
<h3>Description of it</h3><div class="x IngredientPagestyles__Description-y"><p>Also known as Vitamin B3, a vitamin.</p>
<p> </p><p>Second.</p></div><div>See: <a>Zinc</a><a>zinc</a></div></main></body>"""


def test_ingredient_dictionary(spark):
    pages = spark.createDataFrame([(f"{BASE}/i/1", DETAIL_PAGE)], "url string, html string")
    row = build_ingredient_dictionary(pages, "b1", "third", BASE, "2026-05-18T11:14:54").first()
    want = {
        "raw_ingredient_name": "Niacinamide", "canonical_ingredient_name": "niacinamide",
        "rating": "BEST", "benefits": ["Soothing", "Oil Control"],
        "ingredient_categories": ["Vitamins", "Antioxidant"],
        "at_a_glance_points": ["AKA vitamin B3 and nicotinamide", "Calms"],
        "full_description": "Also known as Vitamin B3, a vitamin.\n\nSecond.",
        "synonyms": ["vitamin B3", "nicotinamide"], "related_ingredients": ["Zinc"],
        "extraction_status": "success", "missing_fields": ["concerns", "safety_notes"],
        "ingestion_date": "2026-05-18"}
    assert {k: row[k] for k in want} == want


def test_listing_and_dictionary_rows(spark):
    html = ("<div class='f-column card'><p class='product-card__title'><a class='reversed-link' href='/p/1'>"
            "One</a></p><p class='product-card__vendor'><span>Vendor:</span> Acme</p>"
            "<div class='product-card__image'><img src='//i/x.png' alt=' a  b '></div></div>"
            "<div class='f-column card'>no title</div>"
            "<table><tr><td><h3>Zinc</h3><b class='ColoredIngredientRating-x'>Good</b>"
            "<a href='/ingredient-dictionary/ingredient-zinc.html#x'><span>Read More</span></a></td></tr></table>"
            "<a href='/ingredient-dictionary/ingredient-aqua.html'>Read more</a>")
    df = with_nodes(spark.createDataFrame([(html,)], "html string"))
    n = F.col("nodes")
    card = df.select(F.explode(pg.listing_cards(n, BASE)).alias("c")).select("c.*").collect()
    assert len(card) == 1 and card[0]["product_url"] == f"{BASE}/p/1"
    assert (card[0]["brand_name"], card[0]["image_url"], card[0]["image_alt"]) == ("Acme", "https://i/x.png", "a b")
    rows = df.select(F.explode(pg.dictionary_rows(n, BASE, "p")).alias("c")).select("c.*").collect()
    assert [(r["ingredient_name_from_list"], r["rating_from_list"], r["ingredient_url"]) for r in rows] == [
        ("Zinc", "Good", f"{BASE}/ingredient-dictionary/ingredient-zinc.html"),
        (None, None, f"{BASE}/ingredient-dictionary/ingredient-aqua.html")]
