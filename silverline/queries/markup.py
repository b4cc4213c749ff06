"""Page rules and linked-data functions over pages that Spark builds from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from silverline.functions import jsonld, text as t
from silverline.functions.nodes import first_text, tag, with_nodes
from silverline.operators import pages as pg
from silverline.operators.keyed import enumerate_items
from silverline.queries.registry import query

BASE = "https://shop.example.com"


def html(*parts) -> Column:
    """Concatenate literal markup and columns; a null column is empty."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit(""))
                      for p in parts])


def parsed(df):
    """Nodes of pages that come as one small split: every core gets a share."""
    return with_nodes(df, partitions=df.sparkSession.sparkContext.defaultParallelism)


def built(df, key: str, *parts):
    return parsed(df.select(key, html(*parts).alias("html")))


def script(body: Column) -> Column:
    return html('<script type="application/ld+json">', body, "</script>")


def obj(**fields) -> Column:
    """JSON object text; `type` becomes `@type`."""
    return F.to_json(F.struct(*[(F.lit(v) if isinstance(v, str) else v).alias("@type" if k == "type" else k)
                                for k, v in fields.items()]))


def unwrap(df, column: str, *keys: str):
    return df.select(*keys, F.col(column).alias("_s")).select(*keys, "_s.*")


# ---- Linked data ----

def _product_page(d):
    k = F.col("p_partkey")
    product = obj(type="Product", name=F.col("p_name"))
    other = obj(type="Thing", name=F.col("p_brand"))
    listed = obj(type=F.array(F.lit("Thing"), F.lit("Product")), name=F.upper("p_name"))
    body = (F.when(k % 4 == 0, html('{"@graph": [', other, ",", product, "]}"))
            .when(k % 4 == 1, html("[", other, ",", listed, ",", product, "]"))
            .when(k % 4 == 2, product).otherwise(html("{bad ", other)))
    page = html("<html>", script(body), "<p>x</p>", script(other), "</html>")
    return built(d.part, "p_partkey", page).select("p_partkey", jsonld.jsonld_objects("nodes").alias("objects"))


@query("jsonld_script_forms", """
SELECT p_partkey, CASE p_partkey % 5 WHEN 3 THEN '' WHEN 4 THEN p_name ELSE p_brand END AS names FROM part""")
def _(d):
    k = F.col("p_partkey")
    own, other = obj(name=F.col("p_brand")), obj(name=F.col("p_name"))
    page = (F.when(k % 5 == 0, html("<script type=application/ld+json>", own, "</script>"))
            .when(k % 5 == 1, html("<SCRIPT ID='x' TYPE=' Application/LD+JSON '>", own, "</SCRIPT >"))
            .when(k % 5 == 2, html("<script>var a = '<b>';</script><script async type='application/ld+json'>", own, "</script>"))
            .when(k % 5 == 3, html("<!-- ", script(own), " --><script type='text/ld+json'>", own, "</script>"))
            .otherwise(html(script(F.lit("{bad")), script(other))))
    names = F.transform(jsonld.jsonld_objects("nodes"), lambda o: F.try_variant_get(o, "$.name", "string"))
    return built(d.part, "p_partkey", page).select("p_partkey", F.array_join(names, "|").alias("names"))


@query("jsonld_objects", """
SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'Thing|Product|Thing' WHEN 1 THEN 'Thing|["Thing","Product"]|Product|Thing'
  WHEN 2 THEN 'Product|Thing' ELSE 'Thing' END AS types FROM part""")
def _(d):
    types = F.transform("objects", lambda o: F.try_variant_get(o, '$["@type"]', "string"))
    return _product_page(d).select("p_partkey", F.array_join(types, "|").alias("types"))


@query("jsonld_pick", """
SELECT p_partkey, CASE p_partkey % 4 WHEN 1 THEN upper(p_name) WHEN 3 THEN NULL ELSE p_name END AS name FROM part""")
def _(d):
    found = jsonld.jsonld_pick(F.col("objects"), "Product")
    return _product_page(d).select("p_partkey", F.try_variant_get(found, "$.name", "string").alias("name"))


@query("jsonld_item_list", r"""
WITH n AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
           FROM documents)
SELECT doc_id, i AS position, trim(regexp_replace(regexp_replace(line, '<[^>]*>', ' ', 'g'), '[\s\x{0b}\x{85}\p{Z}]+', ' ', 'g')) AS name
FROM n WHERE trim(regexp_replace(regexp_replace(line, '<[^>]*>', ' ', 'g'), '[\s\x{0b}\x{85}\p{Z}]+', ' ', 'g')) <> ''""")
def _(d):
    items = F.transform(F.split("text", "\n"), lambda x, i: F.struct((i + 1).alias("position"), x.alias("name")))
    page = script(obj(type="ItemList", name=" INCI list", itemListElement=items))
    rows = built(d.documents, "doc_id", page).select("doc_id", F.explode(
        jsonld.jsonld_item_list(jsonld.jsonld_objects("nodes"))).alias("r"))
    return rows.select("doc_id", "r.position", "r.name")


@query("jsonld_breadcrumb", """
SELECT c_custkey, r_name || '|' || n_name || '|' || c_name AS crumbs
FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey""")
def _(d):
    item = lambda c, at=None: F.struct(F.lit(at).cast("int").alias("position"), F.col(c).alias("name"))
    crumbs = F.array(item("c_name"), item("n_name", 2), item("r_name", 1))
    page = html(script(obj(type="BreadcrumbList", itemListElement=crumbs)),
                script(obj(type="BreadcrumbList", itemListElement=F.array(item("c_name", 1)))))
    df = d.customer.join(d.nation, F.col("n_nationkey") == F.col("c_nationkey")).join(
        d.region, F.col("r_regionkey") == F.col("n_regionkey"))
    names = jsonld.jsonld_breadcrumb(jsonld.jsonld_objects("nodes"))
    return built(df, "c_custkey", page).select("c_custkey", F.array_join(names, "|").alias("crumbs"))


@query("jsonld_poly_fields", """
SELECT p_partkey, p_brand AS brand, 'https://i.example.com/' || p_partkey AS image,
  CASE WHEN p_partkey % 3 <> 0 THEN cast(p_size AS varchar) END AS price FROM part""")
def _(d):
    k = F.col("p_partkey")
    image = html("https://i.example.com/", k)
    offers = F.struct(F.col("p_size").alias("price"))
    brand = F.when(k % 2 == 0, obj(brand=F.col("p_brand"), image=image)).otherwise(
        obj(brand=F.struct(F.col("p_brand").alias("name")), image=F.array(image, F.lit("x"))))
    offer = F.when(k % 3 == 0, obj(offers=F.array(offers))).otherwise(obj(offers=offers))
    product = F.try_parse_json(brand)
    return d.part.select(
        "p_partkey", jsonld.brand_of(product).alias("brand"), jsonld.image_of(product).alias("image"),
        jsonld.offer_field(F.try_parse_json(offer), "price").alias("price"))


@query("embedded_json_array", """
SELECT p_partkey, CASE WHEN p_partkey % 5 <> 0 THEN 'https://i.example.com/' || p_partkey END AS image FROM part""")
def _(d):
    k = F.col("p_partkey")
    page = html("<script>const images = [", F.when(k % 5 == 0, "{bad").otherwise(""),
                '\n{"original": "https://i.example.com/', k, '"}, {"original": "second"}]; var x = [1];</script>')
    return d.part.select("p_partkey", jsonld.embedded_json_array(page, "images", "original").alias("image"))


@query("json_cells", """
SELECT doc_id, lang, cast(to_json(string_split(text, ' ')) AS varchar) AS words FROM documents""")
def _(d):
    return jsonld.json_cells(d.documents.select("doc_id", "lang", F.split("text", " ").alias("words")))


@query("explode_bridge", """
SELECT cast(doc_id AS varchar) AS product_id, i AS ingredient_position, md5(lower(trim(line))) AS ingredient_id
FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
             generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)""")
def _(d):
    rows = d.documents.select(F.col("doc_id").cast("string").alias("product_id"), F.split("text", "\n").alias("lines"))
    bridge = enumerate_items(rows, "lines", "line", "ingredient_position")
    return bridge.select("product_id", "ingredient_position", t.md5_id(F.trim("line")).alias("ingredient_id"))


# ---- Elements, texts and links of the given pages ----

_UNESCAPE = """replace(replace(replace(replace({}, '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&amp;', '&')"""
_TEXT = r"trim(regexp_replace(" + _UNESCAPE + r", '[\s\p{{Z}}]+', ' ', 'g'))"


@query("extract_elements", f"""
SELECT page_id, 'title' AS rule, {_TEXT.format("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)")} AS value FROM pages
UNION ALL SELECT page_id, 'h1', {_TEXT.format("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)")} FROM pages
UNION ALL SELECT page_id, 'nav', {_TEXT.format("unnest(regexp_extract_all(html, '<li><a href=[^>]*>([^<]*)</a>', 1))")} FROM pages""")
def _(d):
    rules = {"title": (tag("title"),), "h1": (tag("h1"),), "nav": (tag("nav"), tag("li"), tag("a"))}
    return pg.extract_elements(parsed(d.pages), "page_id", rules).select("page_id", "rule", "value")


@query("first_text", f"""
SELECT page_id, {_TEXT.format("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)")} AS name FROM pages""")
def _(d):
    return parsed(d.pages).select("page_id", first_text(
        F.col("nodes"), (tag("article"), tag("h6")), tag("h1"), tag("title")).alias("name"))


@query("extract_links", r"""
SELECT DISTINCT page_id, CASE WHEN href LIKE '/%' THEN 'https://shop.example.com' || href ELSE href END AS link FROM (
  SELECT page_id, regexp_replace(unnest(regexp_extract_all(html, '<a\s[^>]*href="([^"]*)"', 1)), '#.*$', '') AS href FROM pages)""")
def _(d):
    return pg.extract_links(parsed(d.pages), "page_id", BASE)


_FORMS = {"double": "https://shop.example.com/d/{k}", "single": "https://shop.example.com/s/{k}?a=1&b=2",
          "bare": "https://shop.example.com/b/{k}", "upper": "https://shop.example.com/u/{k}",
          "dots": "https://shop.example.com/x/z/{k}", "up": "https://shop.example.com/r/{k}/",
          "away": "https://other.example.com/a/{k}"}


@query("extract_link_forms", " UNION ALL ".join(
    f"SELECT s_suppkey, replace('{url}', '{{k}}', s_suppkey::VARCHAR) AS link FROM supplier" for url in _FORMS.values()))
def _(d):
    """Every way to write an anchor; the answer is known from how the page is built."""
    k = F.col("s_suppkey")
    pages = built(
        d.supplier, "s_suppkey", '<p><a class="c" href="/d/', k, '#top">1</a><a href = "/d/', k, '">again</a>',
        "<a href='/s/", k, "?a=1&amp;b=2'>2</a><a href=/b/", k, ">3</a><A HREF='/u/", k, "'>4</A>",
        '<!-- <a href="/gone/', k, '">5</a> --><a name="x">6</a><a href="/x/y/../z/./', k, '">7</a><a href="../r/q/../',
        k, '/.">8</a><a href="//other.example.com/a/', k, '">9</a><script>"<a href=\'/no\'>"</script></p>')
    return pg.extract_links(pages, "s_suppkey", BASE)


@query("main_content", r"""
SELECT page_id, len(regexp_extract_all(html, '<a\s')) AS links_in_body, 1 AS headings FROM pages""")
def _(d):
    return parsed(d.pages).select("page_id", pg.main_content(F.col("nodes")).alias("m")).select(
        "page_id", F.size(F.filter("m", lambda n: n["tag"] == "a")).alias("links_in_body"),
        F.size(F.filter("m", lambda n: n["tag"] == "h1")).alias("headings"))


# ---- Product sections of built pages ----

@query("listing_cards", """
SELECT p_partkey, md5('https://shop.example.com/p/' || p_partkey) AS product_id,
  'https://shop.example.com/p/' || p_partkey AS product_url, p_name AS product_name, p_brand AS brand_name,
  CASE WHEN p_size % 4 <> 0 THEN p_type END AS category, '$' || p_size AS price,
  CASE WHEN p_size % 3 <> 0 THEN 'https://i.example.com/' || p_partkey END AS image_url,
  CASE WHEN p_size % 3 <> 0 THEN p_brand || ' ' || p_name END AS image_alt FROM part""")
def _(d):
    k, s = F.col("p_partkey"), F.col("p_size")
    image = html('<div class="product-card__image"><img src="//i.example.com/', k, '" alt=" ', F.col("p_brand"),
                 "  ", F.col("p_name"), '"></div>')
    pages = built(
        d.part, "p_partkey",
        '<div class="f-column card"><p>no link</p></div><div class="card f-column">',
        '<div class="product-card__title"><a class="reversed-link x" href="/p/', k, '">', F.col("p_name"), "</a></div>",
        '<div class="product-card__vendor"><span>Vendor:</span>', F.col("p_brand"), "</div>",
        '<div class="product-card__type">Type: ', F.when(s % 4 != 0, F.col("p_type")), "</div>",
        '<div class="f-price__regular"><b class="f-price-item--regular">$', s, "</b></div>",
        F.when(s % 3 != 0, image), "</div>")
    cards = pages.select("p_partkey", F.explode(pg.listing_cards(F.col("nodes"), BASE)).alias("c"))
    return unwrap(cards, "c", "p_partkey")


@query("dictionary_rows", """
SELECT s_suppkey, 'dict_' || left(sha256('https://shop.example.com/ingredient-dictionary/ingredient-' || s_suppkey), 16) AS record_id,
  CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE s_name END AS ingredient_name_from_list,
  CASE WHEN s_suppkey % 2 = 0 THEN 'Good' END AS rating_from_list, 'about ' || s_name AS short_description,
  'https://shop.example.com/ingredient-dictionary/ingredient-' || s_suppkey AS ingredient_url FROM supplier""")
def _(d):
    k = F.col("s_suppkey")
    pages = built(
        d.supplier, "s_suppkey", '<table><tr><td><a href="/other">x</a></td></tr><tr><td>',
        F.when(k % 3 != 0, html("<h3>", F.col("s_name"), "</h3>")),
        F.when(k % 2 == 0, '<i class="ColoredIngredientRating-a">Good</i>'),
        '<p class="q IngredientList__Description">about ', F.col("s_name"), "</p>",
        '<a href="/ingredient-dictionary/ingredient-', k, '#top"><span>Read More</span></a></td></tr></table>')
    rows = pages.select("s_suppkey", F.explode(pg.dictionary_rows(F.col("nodes"), BASE, "dict")).alias("r"))
    return unwrap(rows, "r", "s_suppkey")


def _item(label, value) -> Column:
    return html('<div class="item"><span class="lbl">', label, '</span><span class="val">', value, "</span></div>")


@query("scorecard", """
SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 1 WHEN 1 THEN 0 END AS pregnancy_safe,
  CASE WHEN p_size % 2 = 0 THEN 0 END AS fungal_acne_safe, cast(p_size % 6 AS double) AS comedogenic_rating FROM part""")
def _(d):
    s = F.col("p_size")
    answer = F.when(s % 3 == 0, "Yes").when(s % 3 == 1, "No").otherwise("?")
    pages = built(d.part, "p_partkey", '<div class="pp-scorecard">',
                  _item("Pregnancy", F.lit("yes")), _item("PREGNANCY safe", answer),
                  _item("Fungal Acne", F.when(s % 2 == 0, "unknown")),
                  _item("Comedogenic", html(s % 6, " / 5")), _item("Comedogenic", F.lit("n/a")), "</div>",
                  _item("Pregnancy", F.lit("outside")))
    return unwrap(pages.select("p_partkey", pg.scorecard(F.col("nodes")).alias("x")), "x", "p_partkey")


@query("specs", """
SELECT p_partkey, p_size || ' ml' AS size, p_type AS product_type_text,
  CASE WHEN p_size % 2 = 0 THEN p_name END AS key_actives_text, p_size AS ingredients_count FROM part""")
def _(d):
    spec = lambda label, value: html('<div class="pp-spec"><b class="lbl">', label, '</b><b class="val">', value, "</b></div>")
    s = F.col("p_size")
    pages = built(d.part, "p_partkey", spec("Size", html(s, " <i>ml</i>")), spec("Type", F.col("p_type")),
                  spec("Key Active", F.lit("old")), spec("Actives", F.when(s % 2 == 0, F.col("p_name"))),
                  spec("Ingredients", html(s, " of 99")), '<div class="pp-spec"><b class="lbl">Size</b></div>')
    return unwrap(pages.select("p_partkey", pg.specs(F.col("nodes")).alias("x")), "x", "p_partkey")


@query("badges", """
SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'Oil Free|' ELSE '' END || p_type || '|Vegan' AS product_claims,
  1 AS vegan, 0 AS cruelty_free, 0 AS reef_safe, 0 AS fragrance_free, 0 AS alcohol_free, 0 AS paraben_free,
  0 AS sulfate_free, 0 AS silicone_free, cast(p_size % 2 = 0 AS int) AS oil_free FROM part WHERE p_type NOT IN ('ECONOMY', 'LARGE', 'MEDIUM')
UNION ALL
SELECT p_partkey, p_type || CASE WHEN p_size % 2 = 0 THEN '|Oil Free' ELSE '' END || '|Vegan', 1, 0, 0, 0, 0, 0, 0, 0,
  cast(p_size % 2 = 0 AS int) FROM part WHERE p_type IN ('ECONOMY', 'LARGE', 'MEDIUM')""")
def _(d):
    badge = lambda x: html('<span class="pp-badge x"> ', x, "</span>")
    pages = built(d.part, "p_partkey", badge("Vegan"), badge(F.col("p_type")), badge("Vegan"), badge(" "),
                  F.when(F.col("p_size") % 2 == 0, badge("Oil  Free")))
    return unwrap(pages.select("p_partkey", pg.badges(F.col("nodes")).alias("x")), "x", "p_partkey")


@query("free_from", """
SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN NULL WHEN p_size % 3 = 1 THEN
  array_to_string(list_sort(list_distinct(string_split(p_name, ' '))), '|') ELSE p_brand || '|note' END AS free_from FROM part""")
def _(d):
    s = F.col("p_size")
    listed = html('<div class="free-list">FREE from:  ', F.replace("p_name", F.lit(" "), F.lit(", <b>,|</b>")), "</div>")
    note = lambda x: html('<div><span class="qn-icon"><span>', x, "</span></span></div>")
    notes = html('<div class="quick-products-container">', note("note"), note(F.col("p_brand")), note("note"), "</div>")
    pages = built(d.part, "p_partkey", note("outside"), F.when(s % 3 == 1, listed), F.when(s % 3 != 0, notes))
    return pages.select("p_partkey", pg.free_from(F.col("nodes")).alias("free_from"))


@query("skin_scores", """
WITH o AS (SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 5 WHEN '2-HIGH' THEN 4 WHEN '3-MEDIUM' THEN 3
  WHEN '5-LOW' THEN 1 END AS score FROM orders)
SELECT o_orderkey, score AS oily_skin_score, 0 AS dry_skin_score, cast(NULL AS int) AS sensitive_skin_score,
  cast(NULL AS int) AS combination_skin_score, cast(NULL AS int) AS normal_skin_score, cast(NULL AS int) AS acne_prone_score,
  CASE WHEN score >= 4 THEN 'OilySkin' END AS good_for_skin_types,
  CASE WHEN score <= 2 THEN 'OilySkin|Dry' ELSE 'Dry' END AS bad_for_skin_types,
  coalesce('OilySkin: ' || score || '/5|', '') || 'Dry: 0/5' AS skin_type_notes FROM o""")
def _(d):
    card = lambda kind, rate: html('<div class="pp-skin-card"><div class="type">', kind, '</div><b class="rate">',
                                   rate, "</b></div>")
    p = F.col("o_orderpriority")
    rate = (F.when(p == "1-URGENT", "Excellent").when(p == "2-HIGH", "VERY good").when(p == "3-MEDIUM", "moderate")
            .when(p == "5-LOW", "poor").otherwise("great"))
    pages = built(d.orders, "o_orderkey", card("Oily <b>Skin</b>", rate), card("Dry", "Avoid"), card("Other", "Good"))
    return unwrap(pages.select("o_orderkey", pg.skin_scores(F.col("nodes")).alias("x")), "x", "o_orderkey")


@query("safety", """
SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 1 WHEN 1 THEN 0 END AS pregnancy_safe, cast(NULL AS int) AS fungal_acne_safe,
  cast(p_size % 6 AS double) AS comedogenic_rating, CASE p_size % 4 WHEN 0 THEN 0 WHEN 1 THEN 1 END AS irritation_rating,
  'Pregnancy: ' || p_name || '|Fungal: Clogs ' || (p_size % 6) || '/5|Pores: 9/5' ||
  CASE p_size % 4 WHEN 0 THEN ' irritating, non-irritating' WHEN 1 THEN ' Irritating' ELSE '' END AS safety_notes FROM part""")
def _(d):
    s = F.col("p_size")
    item = lambda c, label, text: html('<div class="pp-safety-item ', c, '"><strong>', label, "</strong><p>", text, "</p></div>")
    verdict = F.when(s % 4 == 0, "irritating, non-irritating").when(s % 4 == 1, "Irritating").otherwise("")
    pages = built(d.part, "p_partkey", '<div class="pp-safety">',
                  item(F.when(s % 3 == 0, "safe").when(s % 3 == 1, "caution").otherwise("x"), "Pregnancy", F.col("p_name")),
                  item("unsafe", "Fungal", html("Clogs ", s % 6, "/5")), item("safe", "Pores", html("9/5 ", verdict)),
                  '<div class="pp-safety-item"><strong>No text</strong></div></div>')
    return unwrap(pages.select("p_partkey", pg.safety(F.col("nodes")).alias("x")), "x", "p_partkey")


@query("ratings", """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity / 10 AS rating,
  CASE WHEN l_linenumber % 3 = 0 THEN 115 WHEN l_linenumber % 3 = 1 THEN cast(l_quantity AS bigint) + l_linenumber END AS number_of_reviews
FROM lineitem""")
def _(d):
    n, q = F.col("l_linenumber"), F.col("l_quantity").cast("int")
    stat = lambda label, num: html('<div class="stat"><i class="lbl">', label, '</i><i class="num">', num, "</i></div>")
    page = html('<div class="pp-verdict"><b class="score">', (q / 10).cast("string"), " / 5</b></div>",
                F.when(n % 3 == 1, html('<div class="pp-review-card">', stat("Reviews", q), stat("stars", "4"),
                                        stat("reviews", n), "</div>")),
                F.when(n % 3 == 0, '<div class="pp-title"><span class="num">115+ REVIEWS</span></div>'))
    keys = ["l_orderkey", "l_linenumber", "l_partkey"]
    pages = parsed(d.lineitem.select(*keys, page.alias("html")))
    return unwrap(pages.select(*keys, pg.ratings(F.col("nodes")).alias("x")), "x", *keys)


@query("origin", """
SELECT c_custkey, CASE WHEN c_custkey % 4 <> 0 THEN n_name END AS country_of_origin
FROM customer JOIN nation ON n_nationkey = c_nationkey""")
def _(d):
    df = d.customer.join(d.nation, F.col("n_nationkey") == F.col("c_nationkey"))
    pages = built(df, "c_custkey", '<div class="pp-origin">', F.when(F.col("c_custkey") % 4 != 0, html(
        '<span class="text">Made in ', F.col("n_name"), "</span>")), "</div>")
    return pages.select("c_custkey", pg.origin(F.col("nodes")).alias("country_of_origin"))


_CARD_COLUMNS = """NULL AS description, NULL AS evidence_level, NULL AS science_tags, NULL AS science_details,
  NULL AS callout_type, NULL AS callout_text, NULL AS warning_type, NULL AS warning_text"""


@query("ingredient_cards", """
SELECT p_partkey, 2 AS position, p_name || ' ' || p_size || ' %' AS raw_ingredient_name, p_name AS name,
  p_size || '%' AS concentration, p_type AS description, p_brand AS evidence_level, 'Fact|Study' AS science_tags,
  'Study: ' || p_brand || '|plain|Fact: x' AS science_details, 'good|big' AS callout_type, 'one|two' AS callout_text,
  NULL AS warning_type, p_name AS warning_text FROM part
UNION ALL SELECT p_partkey, 4, p_brand, p_brand, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM part""")
def _(d):
    pages = built(
        d.part, "p_partkey", '<div class="pp-ingredient">no name</div>',
        '<div class="pp-ingredient"><h3>', F.col("p_name"), " ", F.col("p_size"), ' % <span class="tag">', F.col("p_brand"),
        '</span></h3><p class="ing-desc">', F.col("p_type"), '</p><ul class="pp-science"><li><strong>Study:</strong> ',
        F.col("p_brand"), "</li><li>plain</li><li><strong>Fact:</strong>x</li></ul>",
        '<div class="pp-callout">one</div><div class="pp-callout good big">two</div><p class="pp-warning">', F.col("p_name"),
        '</p></div><div class="pp-ingredient"><h3>Free from: x</h3></div><div class="pp-ingredient"><h3>', F.col("p_brand"),
        "</h3></div>")
    rows = pages.select("p_partkey", F.explode(pg.ingredient_cards(F.col("nodes"))).alias("r"))
    return unwrap(rows, "r", "p_partkey")


@query("inci_list", f"""
SELECT p_partkey, 1 AS position, p_name AS raw_ingredient_name, p_name AS name, NULL AS concentration, {_CARD_COLUMNS} FROM part
UNION ALL SELECT p_partkey, 3, p_brand || ' ' || p_size || '%', p_brand, p_size || '%', {_CARD_COLUMNS} FROM part
UNION ALL SELECT p_partkey, 4, p_type, p_type, NULL, {_CARD_COLUMNS} FROM part""")
def _(d):
    pages = built(
        d.part, "p_partkey", '<div class="pp-accordion"><label>Other</label><div class="pp-acc-content"><p>a long text, with a comma</p>',
        '</div></div><div class="pp-accordion"><label>Full Ingredient list</label><div class="pp-acc-content">',
        "<p>24 ingredients</p><p>short, one</p><p>(INCI): ", F.col("p_name"), ", , ", F.col("p_brand"), " ", F.col("p_size"), "%, ",
        F.col("p_type"), ". FREE FROM: parabens, oil</p><p>another long text, not used</p></div></div>")
    rows = pages.select("p_partkey", F.explode(pg.inci_list(F.col("nodes"))).alias("r"))
    return unwrap(rows, "r", "p_partkey")


@query("product_meta", """
SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN p_name WHEN 1 THEN p_name || ' title' ELSE 'card' END AS product_name,
  CASE p_partkey % 3 WHEN 0 THEN p_brand WHEN 1 THEN p_brand || ' meta' END AS brand_name, NULL AS sub_category,
  CASE p_partkey % 3 WHEN 1 THEN p_type END AS category,
  CASE p_partkey % 3 WHEN 0 THEN 'https://i.example.com/a' WHEN 1 THEN 'https://shop.example.com/b' END AS image_url,
  CASE p_partkey % 3 WHEN 0 THEN left(repeat(p_name || ' ', 80), 600) WHEN 1 THEN p_brand || ' about' END AS description,
  CASE p_partkey % 3 WHEN 0 THEN p_size || '.5' WHEN 1 THEN p_size || '.0' END AS price,
  CASE p_partkey % 3 WHEN 0 THEN 'EUR' ELSE 'USD' END AS currency FROM part""")
def _(d):
    k, s = F.col("p_partkey"), F.col("p_size")
    offers = F.struct(html(s, ".5").alias("price"), F.lit("EUR").alias("priceCurrency"))
    product = script(obj(type="Product", name=F.col("p_name"), brand=F.struct(F.col("p_brand").alias("name")), offers=offers,
                         image=F.array(F.lit("//i.example.com/a")), description=F.repeat(html(F.col("p_name"), " "), F.lit(80))))
    plain = html(
        '<h1 class="product__title">', F.col("p_name"), ' title</h1><meta itemprop="brand" content="', F.col("p_brand"),
        ' meta"><b itemprop="category">', F.col("p_type"), '</b><div class="product__media"><img data-src="/b 2x"></div>',
        '<b class="product__price">now $', s, '.0 each</b><section id="pp-overview"><p class="pp-subtitle">', F.col("p_brand"),
        " about</p></section>")
    pages = built(d.part, "p_partkey", F.when(k % 3 == 0, product).when(k % 3 == 1, plain))
    objects = jsonld.jsonld_objects("nodes")
    meta = pg.product_meta(F.col("nodes"), jsonld.jsonld_pick(objects, "Product"), jsonld.jsonld_breadcrumb(objects),
                           BASE, {"product_name": F.lit("card")})
    return unwrap(pages.select("p_partkey", meta.alias("x")), "x", "p_partkey")


def _button(title, target) -> Column:
    return html('<button data-tracking-push="1" ', target, "> ", title, "</button>")


_SECTIONS = '<div id="c{0}"><p>x</p><div class="attribute-content"><b>'


@query("section_by_heading", """
SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_name || ' ' || p_brand END AS ingredients FROM part""")
def _(d):
    target = F.when(F.col("p_size") % 3 == 0, "").otherwise('aria-controls="c2"')
    pages = built(d.part, "p_partkey", _button("Volume", 'aria-controls="c1"'), _button("INGREDIENTS", target),
                  _button("Ingredients", 'aria-controls="c1"'), _SECTIONS.format(1), "no</b></div></div>",
                  _SECTIONS.format(2), F.col("p_name"), "</b>", F.col("p_brand"), "</div></div>")
    return pages.select("p_partkey", pg.section_by_heading(F.col("nodes"), "Ingredients").alias("ingredients"))


@query("labelled_sections", """
SELECT p_partkey, p_name AS product_description, p_brand AS ingredients_text, p_size || ' ml' AS size,
  NULL AS skin_type_claims, p_type AS product_highlights, NULL AS usage_instructions,
  CASE WHEN p_size % 2 = 0 THEN NULL ELSE cast(p_partkey AS varchar) END AS sku FROM part""")
def _(d):
    names = ["Product Overview", "Ingredients", "Volume", "Highlights"]
    values = [F.col("p_name"), F.col("p_brand"), html(F.col("p_size"), " ml"), F.col("p_type")]
    parts = []
    for i, (name, value) in enumerate(zip(names, values)):
        parts += [_button(name, f'aria-controls="c{i}"'), _SECTIONS.format(i), value, "</b></div></div>"]
    container = F.when(F.col("p_size") % 2 == 0, '<div id="view-item-container"></div>')
    pages = built(d.part, "p_partkey", *parts, _button("How to Use", 'aria-controls="none"'), container,
                  '<i id="ratingSummary" data-sku="', F.col("p_partkey"), '"></i>')
    n = F.col("nodes")
    return unwrap(pages.select("p_partkey", pg.sku(n).alias("sku"), pg.labelled_sections(n).alias("x")),
                  "x", "p_partkey", "sku")


@query("rating_cascade", """
SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 4.5 WHEN 1 THEN 4.4 WHEN 2 THEN 3.0 WHEN 3 THEN 2.5 ELSE 1.5 END::double AS rating,
  CASE p_partkey % 5 WHEN 0 THEN 1000 + p_size WHEN 1 THEN p_size WHEN 2 THEN p_size WHEN 3 THEN p_size END AS review_count FROM part""")
def _(d):
    k, s = F.col("p_partkey") % 5, F.col("p_size")
    page = (
        F.when(k == 0, html('<i aria-label="3 out of 5"></i><i aria-label="4.5 out of 5 stars. Read 1,', F.lpad(s.cast("string"), 3, "0"),
                            ' reviews"></i><div class="bv-rnr__x">2.0</div>'))
        .when(k == 1, html('<i aria-label="3.9 out of 5"></i><div class="x bv-rnr__a">none</div><div class="bv-rnr__b"> 4.4 </div>Read ', s, " Reviews"))
        .when(k == 2, html('<i aria-label="3 out of 5"></i><i aria-label="Read ', s, ' review"></i>'))
        .when(k == 3, html('<script>{"averageRating": "2.5", "numReviews": ', s, "}</script>"))
        .otherwise("<div>9.5</div><div> 1.5 </div>"))
    pages = built(d.part, "p_partkey", page)
    return unwrap(pages.select("p_partkey", pg.rating_cascade(F.col("nodes"), F.col("html")).alias("x")), "x", "p_partkey")


# ---- Ingredient detail pages ----

def _detail(d):
    k = F.col("s_suppkey")
    name = F.col("s_name")
    benefits = F.when(k % 2 == 0, html("<div><b>Benefits:</b> <a>Soothing</a>, <a>", name, "</a><a>soothing</a></div>")).otherwise(
        html("<div>BENEFITS: Calm, ", name, ", ,calm</div>"))
    return parsed(d.supplier.select("s_suppkey", html(
        "<body><div>Rating: outside</div><main><h1>", name, "</h1><div>x<span> Rating: ", F.col("s_nationkey"), " best</span>", benefits,
        "</div><h2>", name, " at a glance</h2><p>t</p><div><ul><li>AKA ", name, "</li><li> </li><li>aka ", name, "</li></ul><ul><li>no</li></ul></div>",
        '<h3>Full Description</h3><div>skip</div><div class="a IngredientPagestyles__Description-b"><p>One ', name, "</p><p> </p><p>Two</p></div>",
        "<section>See: <a>Zinc</a><a>", name, "</a></section><div>see: <a>lower</a></div></main></body>").alias("html"))
    ).withColumn("scope", pg.main_content(F.col("nodes")))


@query("label_row_values", """
SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN 'Soothing|' || s_name ELSE 'Calm|' || s_name END AS benefits, NULL AS categories
FROM supplier""")
def _(d):
    n, m = F.col("nodes"), F.col("scope")
    return _detail(d).select(
        "s_suppkey", F.array_join(pg.label_row_values(n, m, "Benefits"), "|").alias("benefits"),
        F.array_join(pg.label_row_values(n, m, "Categories"), "|").alias("categories"))


@query("labelled_value", "SELECT s_suppkey, s_nationkey || ' best' AS rating FROM supplier")
def _(d):
    return _detail(d).select("s_suppkey", pg.labelled_value(
        F.col("nodes"), F.col("scope"), "Rating:", ["div", "span"], 200).alias("rating"))


@query("heading_block", """
SELECT s_suppkey, 'AKA ' || s_name AS points, 'One ' || s_name || chr(10) || chr(10) || 'Two' AS description FROM supplier""")
def _(d):
    n, m = F.col("nodes"), F.col("scope")
    return _detail(d).select(
        "s_suppkey", F.array_join(pg.heading_list(n, m, "at a glance"), "|").alias("points"),
        pg.heading_paragraphs(n, m, "description", "IngredientPagestyles__Description").alias("description"))


@query("related_items", "SELECT s_suppkey, 'Zinc|' || s_name AS related FROM supplier")
def _(d):
    related = pg.related_items(F.col("nodes"), F.col("scope"))
    return _detail(d).select("s_suppkey", F.array_join(related, "|").alias("related"))
