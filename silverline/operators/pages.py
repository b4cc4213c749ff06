"""Rules over a page's node list. Each returns native columns of the page's own row.

`nodes` is the column made by `with_nodes`. Rules that yield several fields return a struct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from silverline.functions import fixed, jsonld, lists as ls, text as t
from silverline.functions.nodes import (
    TEXT, attr, attr_has, attr_is, both, cls, cls_like, either, first_of, first_text, inside,
    joined_text, nearest_above, other_classes, raw_text, select, select_one, tag, text_of)
from silverline.functions.text import let


def _children(nodes: Column, outer: Column, body) -> Column:
    """Apply `body(subtree, element)` to every element of an array."""
    return F.transform(outer, lambda n: let(inside(nodes, n), lambda sub: body(sub, n)))


def _field(sub: Column, nodes: Column, *path, raw: bool = False) -> Column:
    """Text of the first match inside a subtree; its own subtree is cut from the page."""
    return text_of(nodes, select_one(sub, *path), raw)


def _low(c: Column) -> Column:
    return t.safe_lower(c)


# ---- Long form and links ----

def extract_elements(pages: DataFrame, key: str, rules: dict[str, tuple], nodes: str = "nodes") -> DataFrame:
    """Long table (key, rule, at, value, value_raw) of every match of the named paths."""
    page = F.col(nodes)

    def matches(name: str, path: tuple) -> Column:
        return F.transform(select(page, *path), lambda n: let(inside(page, n), lambda sub: F.struct(
            F.lit(name).alias("rule"), n["at"].alias("at"), joined_text(sub).alias("value"),
            raw_text(sub).alias("value_raw"))))

    found = F.flatten(F.array(*[matches(name, path) for name, path in rules.items()]))
    return pages.select(key, F.explode(found).alias("e")).select(key, "e.*")


def extract_links(pages: DataFrame, key: str, base: str, part: str = "", nodes: str = "nodes") -> DataFrame:
    """Distinct (key, absolute fragment-free link) of the anchors whose href contains `part`.

    Distinct within a page, which is one row: nothing is shuffled.
    """
    hrefs = F.transform(select(F.col(nodes), both(tag("a"), attr_has("href", part))),
                        lambda n: t.drop_fragment(t.absolute_url(attr(n, "href"), base, resolve=True)))
    links = F.array_distinct(F.filter(hrefs, lambda u: u.isNotNull()))
    return pages.select(key, F.explode(links).alias("link"))


def listing_cards(nodes: Column, base: str) -> Column:
    """Product cards of a listing page; cards without a title link are skipped."""
    title = (cls("product-card__title"), both(tag("a"), cls("reversed-link")))

    def described(sub, link, url):
        img = select_one(sub, cls("product-card__image"), tag("img"))
        price = (cls("f-price__regular"), cls("f-price-item--regular"))
        return let(img, lambda i: F.struct(
            t.md5_id(url, fold=False).alias("product_id"),
            url.alias("product_url"),
            text_of(nodes, link).alias("product_name"),
            t.strip_label(_field(sub, nodes, cls("product-card__vendor")), "Vendor:").alias("brand_name"),
            t.blank_to_null(t.strip_label(
                _field(sub, nodes, cls("product-card__type")), "Type:")).alias("category"),
            _field(sub, nodes, *price).alias("price"),
            t.absolute_url(attr(i, "src"), base, resolve=True).alias("image_url"),
            t.clean_text(attr(i, "alt")).alias("image_alt")))

    def card(sub, n):
        return let(select_one(sub, *title), lambda link: F.when(link.isNotNull(), let(
            t.absolute_url(attr(link, "href"), base, resolve=True),
            lambda url: described(sub, link, url))))

    cards = select(nodes, both(tag("div"), cls("f-column"), cls("card")))
    return F.filter(_children(nodes, cards, card), lambda c: c.isNotNull())


def dictionary_rows(nodes: Column, base: str, prefix: str) -> Column:
    """Rows of a dictionary list page: one per detail link, described by its table row."""
    def described(link: Column, row: Column) -> Column:
        body = inside(nodes, row)
        title = F.coalesce(_field(body, nodes, tag("h3")), text_of(nodes, link))
        url = t.drop_fragment(t.absolute_url(attr(link, "href"), base, resolve=True))
        return let(F.struct(title.alias("title"), url.alias("url")), lambda e: named(e, body))

    def named(e: Column, body: Column) -> Column:
        return F.struct(
            t.record_id(e["url"], prefix).alias("record_id"),
            F.when(F.lower(e["title"]) != "read more", e["title"]).alias("ingredient_name_from_list"),
            _field(body, nodes, cls_like(fixed.LIST_RATING_CLASS)).alias("rating_from_list"),
            _field(body, nodes, cls_like(fixed.LIST_DESCRIPTION_CLASS)).alias("short_description"),
            e["url"].alias("ingredient_url"))

    links = select(nodes, both(tag("a"), attr_has("href", fixed.DICTIONARY_LINK)))
    return F.transform(links, lambda link: let(
        nearest_above(nodes, link, tag("tr")), lambda row: described(link, row)))


# ---- Product page sections ----

def _pairs(nodes: Column, items: Column, rules: dict[str, list[str]], need_both: bool,
           joined_value: bool) -> Column:
    """(rule, value) of every label and value element; the label decides the rule."""
    def texts(e):
        value = text_of(nodes, e["val"]) if joined_value else _low(text_of(nodes, e["val"], raw=True))
        rule = let(_low(text_of(nodes, e["lbl"], raw=True)), lambda label: ls.rule_of(label, rules))
        out = F.struct(rule.alias("rule"), value.alias("value"))
        return F.when(e["lbl"].isNotNull() & e["val"].isNotNull(), out) if need_both else out

    def pair(sub, n):
        return let(F.struct(select_one(sub, cls("lbl")).alias("lbl"),
                            select_one(sub, cls("val")).alias("val")), texts)

    return F.filter(_children(nodes, items, pair), lambda p: p.isNotNull())


def _valued(pairs: Column, convert) -> Column:
    return F.transform(pairs, lambda p: F.struct(
        p["rule"].alias("rule"), convert(p["value"]).alias("value")))


def scorecard(nodes: Column) -> Column:
    rules = {"pregnancy_safe": ["pregnancy"], "fungal_acne_safe": ["fungal"],
             "comedogenic_rating": ["comedogenic"]}

    def fields(pairs):
        flags = _valued(pairs, t.yes_no)
        return F.struct(
            *[ls.label_value(flags, n).alias(n) for n in ("pregnancy_safe", "fungal_acne_safe")],
            ls.label_value(_valued(pairs, t.ratio_of_5), "comedogenic_rating", "last_value")
            .alias("comedogenic_rating"))

    return let(_pairs(nodes, select(nodes, cls("pp-scorecard"), cls("item")), rules, False, False), fields)


def specs(nodes: Column) -> Column:
    rules = {"size": ["size"], "product_type_text": ["type"], "key_actives_text": ["active"],
             "ingredients_count": ["ingredient"]}

    def fields(pairs):
        return F.struct(
            *[ls.label_value(pairs, n).alias(n) for n in list(rules)[:3]],
            ls.label_value(_valued(pairs, t.first_int), "ingredients_count", "last_value")
            .alias("ingredients_count"))

    return let(_pairs(nodes, select(nodes, cls("pp-spec")), rules, True, True), fields)


def _texts(nodes: Column, found: Column, raw: bool = False) -> Column:
    texts = F.transform(found, lambda n: t.clean_text(text_of(nodes, n, raw)))
    return F.filter(texts, lambda x: x.isNotNull())


def badges(nodes: Column) -> Column:
    """Sorted claims and nine always-0/1 flags."""
    def fields(e):
        return F.struct(ls.sorted_set(e["texts"]).alias("product_claims"), *t.claim_flags(e["joined"]).values())

    return let(_texts(nodes, select(nodes, cls("pp-badge"))), lambda b: let(F.struct(
        b.alias("texts"), F.lower(F.array_join(b, " ")).alias("joined")), fields))


def free_from(nodes: Column) -> Column:
    """The free-from list, else the quick-note labels."""
    listed = t.strip_label(first_text(nodes, cls("free-list")), "FREE FROM:", prefix_only=True)
    notes = select(nodes, cls("quick-products-container"), both(tag("span"), cls("qn-icon")), tag("span"))
    return F.coalesce(ls.sorted_set(ls.split_list(listed, r",\s*|\|\s*")),
                      ls.sorted_set(_texts(nodes, notes, raw=True)))


def _first_key(text: Column, names: dict[str, str]) -> Column:
    pairs = list(names.items())
    out = F.when(text.contains(pairs[0][0]), F.lit(pairs[0][1]))
    for word, value in pairs[1:]:
        out = out.when(text.contains(word), F.lit(value))
    return out


def skin_scores(nodes: Column) -> Column:
    """Six score columns, good and bad lists, and notes, from the rated skin cards."""
    def labelled(e):
        pieces = F.transform(F.filter(inside(nodes, e["kind"]), lambda x: x["tag"] == TEXT),
                             lambda x: t.strip(x["text"]))
        return F.struct(
            F.array_join(pieces, "").alias("label"),
            _first_key(e["word"], fixed.SKIN_TYPE_COLUMNS).alias("column"),
            t.score_label(e["rate"]).alias("score"))

    def rated(sub, n):
        return let(select_one(sub, cls("type")), lambda kind: let(F.struct(
            kind.alias("kind"), _low(text_of(nodes, kind, raw=True)).alias("word"),
            _field(sub, nodes, cls("rate"), raw=True).alias("rate")), labelled))

    def fields(rows):
        def joined(test, text):
            return t.blank_to_null(F.array_join(
                F.transform(F.filter(rows, lambda r: test(r["score"])), text), "|"))

        scores = [F.try_element_at(F.filter(rows, _column_is(c)), F.lit(-1))["score"].alias(c)
                  for c in fixed.SKIN_TYPE_COLUMNS.values()]
        return F.struct(
            *scores,
            joined(lambda s: s >= fixed.GOOD_SCORE, lambda r: r["label"]).alias("good_for_skin_types"),
            joined(lambda s: s <= fixed.BAD_SCORE, lambda r: r["label"]).alias("bad_for_skin_types"),
            joined(lambda s: s.isNotNull(),
                   lambda r: F.concat(r["label"], F.lit(": "), r["score"].cast("string"), F.lit("/5")))
            .alias("skin_type_notes"))

    cards = _children(nodes, select(nodes, cls("pp-skin-card")), rated)
    kept = F.filter(cards, lambda r: r["column"].isNotNull() & r["score"].isNotNull())
    return let(kept, fields)


def _column_is(name: str):
    return lambda r: r["column"] == name


def safety(nodes: Column) -> Column:
    """Flags by exact class, first n-of-5, irritation (a denial wins), and short notes."""
    def facts(e, flag):
        low, detail = _low(e["label"]), _low(e["detail"])
        note = F.concat(F.coalesce(t.clean_text(e["label"]), F.lit("")), F.lit(": "),
                        F.coalesce(t.clean_text(e["detail"]), F.lit("")))
        return F.struct(
            F.when(t.contains_any(low, ["pregnancy", "breastfeeding"]), flag).alias("pregnancy"),
            F.when(low.contains("fungal"), flag).alias("fungal"),
            t.ratio_of_5(F.concat_ws(" ", low, detail)).alias("ratio"),
            F.when(t.contains_any(detail, ["non-irritating", "non irritating"]), 0)
            .when(detail.contains("irritating"), 1).alias("irritating"),
            F.when(e["label"].isNotNull() & e["detail"].isNotNull(), t.truncate(note, 300)).alias("note"))

    def item(sub, n):
        flag = F.when(cls("safe")(n), 1).when(cls("caution")(n), 0)
        return let(F.struct(_field(sub, nodes, tag("strong"), raw=True).alias("label"),
                            _field(sub, nodes, tag("p"), raw=True).alias("detail")),
                   lambda e: facts(e, flag))

    def first_value(rows, field):
        return F.get(F.filter(rows, lambda r: r[field].isNotNull()), F.lit(0))[field].alias

    def fields(rows):
        irritating = F.filter(F.transform(rows, lambda r: r["irritating"]), lambda x: x.isNotNull())
        return F.struct(
            first_value(rows, "pregnancy")("pregnancy_safe"),
            first_value(rows, "fungal")("fungal_acne_safe"),
            first_value(rows, "ratio")("comedogenic_rating"),
            F.array_min(irritating).alias("irritation_rating"),
            ls.ordered_list(F.transform(rows, lambda r: r["note"])).alias("safety_notes"))

    items = select(nodes, cls("pp-safety"), cls("pp-safety-item"))
    return let(_children(nodes, items, item), fields)


def ratings(nodes: Column) -> Column:
    """Verdict score; review counts summed over cards, else the number in the title."""
    def reviews(sub, n):
        label = _low(_field(sub, nodes, cls("lbl"), raw=True))
        return F.when(label.contains("review"), t.first_int(_field(sub, nodes, cls("num"), raw=True)))

    counts = _children(nodes, select(nodes, cls("pp-review-card"), cls("stat")), reviews)
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + F.coalesce(x, F.lit(0)))
    titled = t.first_int(first_text(nodes, (cls("pp-title"), cls("num")), raw=True)).cast("long")
    return F.struct(
        t.first_number(first_text(nodes, (cls("pp-verdict"), cls("score")), raw=True)).alias("rating"),
        F.coalesce(let(total, lambda x: F.nullif(x, F.lit(0))), titled).alias("number_of_reviews"))


def origin(nodes: Column) -> Column:
    found = t.clean_text(first_text(nodes, (cls("pp-origin"), cls("text")), raw=True))
    return t.strip_label(found, "Made in")


INGREDIENT_TYPE = (
    "array<struct<position:int,raw_ingredient_name:string,name:string,concentration:string,"
    "description:string,evidence_level:string,science_tags:string,science_details:string,"
    "callout_type:string,callout_text:string,warning_type:string,warning_text:string>>")


def ingredient_cards(nodes: Column) -> Column:
    """One struct per ingredient card; a card that is skipped still takes its number."""
    def notes(sub, name):
        found = select(sub, cls(name))
        kinds = F.filter(F.transform(found, lambda n: other_classes(n, name)), lambda k: k.isNotNull())
        return (F.get(kinds, F.lit(0)), ls.ordered_list(_texts(nodes, found)))

    def described(sub, at, title, badge):
        heading = F.filter(inside(nodes, title), lambda x: badge.isNull() | (
            (x["at"] < badge["at"]) | (x["at"] > badge["last"])))
        items = select(sub, both(tag("ul"), cls("pp-science")), tag("li"))
        strong = _texts(nodes, F.filter(F.transform(items, lambda li: select_one(
            inside(nodes, li), tag("strong"))), lambda s: s.isNotNull()))
        callout, warning = notes(sub, "pp-callout"), notes(sub, "pp-warning")
        return let(joined_text(heading), lambda raw: let(t.ingredient_name(raw), lambda named: F.struct(
            (at + 1).alias("position"), raw.alias("raw_ingredient_name"),
            named["name"].alias("name"), named["concentration"].alias("concentration"),
            _field(sub, nodes, either(both(tag("p"), cls("ing-desc")),
                                      attr_is("itemprop", "description"))).alias("description"),
            text_of(nodes, badge).alias("evidence_level"),
            ls.sorted_set(F.transform(strong, lambda s: F.rtrim(s, F.lit(":")))).alias("science_tags"),
            ls.ordered_list(_texts(nodes, items)).alias("science_details"),
            callout[0].alias("callout_type"), callout[1].alias("callout_text"),
            warning[0].alias("warning_type"), warning[1].alias("warning_text"))))

    def card(n, at):
        return let(inside(nodes, n), lambda sub: let(select_one(sub, tag("h3")), lambda title: F.when(
            title.isNotNull(),
            let(select_one(inside(nodes, title), cls("tag")),
                lambda badge: described(sub, at, title, badge)))))

    rows = F.transform(select(nodes, both(tag("div"), cls("pp-ingredient"))), card)
    return F.filter(rows, lambda r: r["name"].isNotNull()).cast(INGREDIENT_TYPE)


def listed_ingredients(rows: Column) -> Column:
    """(position, raw) structs to ingredient structs with only the name filled in."""
    def row(r):
        return let(t.ingredient_name(r["raw"]), lambda named: F.struct(
            r["position"].cast("int").alias("position"), r["raw"].alias("raw_ingredient_name"),
            named["name"].alias("name"), named["concentration"].alias("concentration"),
            *[F.lit(None).cast("string").alias(c) for c in (
                "description", "evidence_level", "science_tags", "science_details",
                "callout_type", "callout_text", "warning_type", "warning_text")]))

    return F.filter(F.transform(rows, row), lambda r: r["name"].isNotNull()).cast(INGREDIENT_TYPE)


def inci_list(nodes: Column) -> Column:
    """Full ingredient list: the first long comma paragraph of each matching accordion."""
    def pieces(sub, n):
        label = _low(_field(sub, nodes, tag("label"), raw=True))
        content = select_one(sub, cls("pp-acc-content"))
        paragraphs = _texts(nodes, select(inside(nodes, content), tag("p")))
        long_list = F.get(F.filter(paragraphs, lambda p: p.contains(",") & (F.length(p) > 20)
                                   & ~p.rlike(r"(?i)^[0-9]+\s+ingredients?$")), F.lit(0))
        text = F.regexp_replace(long_list, r"(?is)FREE FROM:.*", "")
        text = F.regexp_replace(text, r"(?i)^\(?INCI\)?\s*:?\s*", "")
        parts = F.transform(F.split(text, ","), lambda raw, i: F.struct(
            (i + 1).alias("position"), F.btrim(raw, F.lit(" .")).alias("raw")))
        return F.when(let(label, lambda x: t.contains_any(x, ["full ingredient", "inci"])), parts)

    found = _children(nodes, select(nodes, cls("pp-accordion")), pieces)
    return listed_ingredients(F.flatten(F.filter(found, lambda p: p.isNotNull())))


def jsonld_ingredients(objects: Column) -> Column:
    return listed_ingredients(F.transform(jsonld.jsonld_item_list(objects), lambda r: F.struct(
        r["position"].alias("position"), r["name"].alias("raw"))))


_TITLE = (both(tag("h1"), cls("product__title")), (cls("product__title"), tag("h1")), tag("h1"))


def product_meta(nodes: Column, product: Column, crumbs: Column, base: str,
                 card: dict[str, Column]) -> Column:
    """Name, brand, category, image, price, currency and description with their fallbacks."""
    def or_card(name: str, *values: Column) -> Column:
        last = card.get(name, F.lit(None).cast("string"))
        return F.coalesce(*[t.blank_to_null(v) for v in values], last).alias(name)

    def meta(prop):
        return let(select_one(nodes, attr_is("itemprop", prop)), lambda found: F.coalesce(
            t.clean_text(t.blank_to_null(attr(found, "content"))), text_of(nodes, found)))

    name = t.clean_text(F.try_variant_get(product, "$.name", "string"), strip_tags=True)
    second = F.get(crumbs, F.lit(1))
    image = first_of(nodes, (cls("product__media"), tag("img")), (cls("product__media-item"), tag("img")))
    source = let(image, lambda i: F.coalesce(
        t.blank_to_null(attr(i, "src")),
        F.get(F.split(t.strip(attr(i, "data-src")), r"\s+"), F.lit(0))))
    prices = [t.parse_price(first_text(nodes, cls(c)))
              for c in ("f-price-item--regular", "price-item--regular", "product__price")]
    overview = first_text(nodes, (attr_is("id", "pp-overview"), cls("pp-subtitle")))
    described = t.truncate(t.clean_text(
        F.try_variant_get(product, "$.description", "string"), strip_tags=True), 600)
    offered = F.nullif(jsonld.offer_field(product, "price"), F.lit("0"))
    return F.struct(
        or_card("product_name", name, first_text(nodes, *_TITLE)),
        or_card("brand_name", jsonld.brand_of(product), meta("brand")),
        or_card("category", F.when((F.size(crumbs) >= 3) & (_low(second) != "home"), second),
                meta("category")),
        F.when(F.size(crumbs) >= 4, F.get(crumbs, F.lit(2))).alias("sub_category"),
        or_card("image_url", t.absolute_url(jsonld.image_of(product), base), t.absolute_url(source, base)),
        F.coalesce(overview, described).alias("description"),
        or_card("price", offered, *prices),
        F.coalesce(jsonld.offer_field(product, "priceCurrency"), F.lit("USD")).alias("currency"))


def page_reject(nodes: Column, product: Column, brand: Column, image: Column) -> list[tuple[str, Column]]:
    """Ordered rules that tell hidden, sample and broken pages from products."""
    crumbs = F.lower(F.array_join(_texts(nodes, select(nodes, cls("breadcrumbs"), tag("a")), raw=True), " "))
    title = first_text(nodes, tag("h1"), raw=True)
    seen_brand = F.coalesce(t.blank_to_null(jsonld.brand_of(product)), brand)
    seen_image = F.coalesce(t.blank_to_null(jsonld.image_text(product)), image)
    return [
        ("hidden_brand", _low(seen_brand) == "hidden"),
        ("ingredient_example_image", _low(seen_image).contains("ingredient_example")),
        ("hidden_breadcrumb", F.coalesce(crumbs.contains("hidden"), F.lit(False))),
        ("no_product_title", t.clean_text(title).isNull()),
    ]


# ---- Sections found by heading or label ----

def section_by_heading(nodes: Column, title: str) -> Column:
    """Text controlled by the first button with the title; no target means null."""
    buttons = select(nodes, both(tag("button"), attr_has("data-tracking-push")))
    button = F.get(F.filter(buttons, lambda b: F.coalesce(
        F.lower(text_of(nodes, b)) == title.lower(), F.lit(False))), F.lit(0))
    target = t.blank_to_null(attr(button, "aria-controls"))
    return let(target, lambda i: first_text(nodes, (
        both(tag("div"), lambda n: F.coalesce(n["attrs"]["id"] == i, F.lit(False))),
        cls("attribute-content"))))


def labelled_sections(nodes: Column) -> Column:
    titles = {"product_description": "Product Overview", "ingredients_text": "Ingredients",
              "size": "Volume", "skin_type_claims": "Skin Type & Concerns",
              "product_highlights": "Highlights", "usage_instructions": "How to Use"}
    return F.struct(*[section_by_heading(nodes, v).alias(k) for k, v in titles.items()])


def sku(nodes: Column) -> Column:
    """If the container is there its attribute is final, even when null."""
    container = select_one(nodes, attr_is("id", "view-item-container"))
    rating = select_one(nodes, attr_is("id", "ratingSummary"))
    return F.when(container.isNotNull(), attr(container, "data-track-push")).otherwise(
        attr(rating, "data-sku"))


def rating_cascade(nodes: Column, html: Column) -> Column:
    """struct(rating, review_count) by ordered fallbacks.

    A label with both wins outright. Otherwise a visible rating beats a label's rating, and
    the page source is the last resort for either value.
    """
    def found(text, pattern, group=1):
        return t.blank_to_null(F.regexp_extract(text, pattern, group))

    def first_label(labels, pattern, group=1):
        hits = F.filter(F.transform(labels, lambda x: found(x, pattern, group)), lambda x: x.isNotNull())
        return F.get(hits, F.lit(0))

    def fields(labels):
        both_rating = first_label(labels, fixed.LABEL_RATING_AND_REVIEWS)
        both_count = first_label(labels, fixed.LABEL_RATING_AND_REVIEWS, 2)
        shown = F.filter(_texts(nodes, select(nodes, both(tag("div"), cls_like(fixed.VISIBLE_RATING_CLASS)))),
                         lambda x: x.rlike(fixed.VISIBLE_RATING))
        scripts = [found(html, p) for p in fixed.SCRIPT_RATINGS]
        counts = [found(html, p) for p in fixed.SCRIPT_REVIEWS]
        rating = F.coalesce(F.get(shown, F.lit(0)), first_label(labels, fixed.LABEL_RATING),
                            *scripts, found(html, fixed.LAST_RESORT_RATING))
        reviews = F.coalesce(first_label(labels, fixed.LABEL_REVIEWS),
                             found(html, fixed.LABEL_REVIEWS), *counts)
        whole = both_rating.isNotNull()
        return F.struct(
            F.when(whole, both_rating).otherwise(rating).try_cast("double").alias("rating"),
            t.comma_int(F.when(whole, both_count).otherwise(reviews)).alias("review_count"))

    labels = F.filter(F.transform(nodes, lambda n: n["attrs"]["aria-label"]), lambda x: x.isNotNull())
    return let(labels, fields)


def main_content(nodes: Column) -> Column:
    """Nodes of the content container: by class, then `main`, then `body`, else the page."""
    preds = [cls_like(c) for c in fixed.CONTENT_CLASSES] + [tag(x) for x in fixed.CONTENT_TAGS]
    return let(first_of(nodes, *preds), lambda n: F.when(n.isNotNull(), inside(nodes, n)).otherwise(nodes))


def _starting_with(nodes: Column, scope: Column, tags: list[str], prefix: str,
                   longest: int | None = None) -> Column:
    """Elements whose text starts with a prefix (any case), in document order.

    Only elements around a text node with that start are looked at, so the text of every
    other element is never put together.
    """
    low = prefix.lower()
    starts = F.filter(scope, lambda n: (n["tag"] == TEXT) & F.coalesce(
        F.lower(t.clean_text(n["text"])).startswith(low), F.lit(False)))
    around = let(starts, lambda s: F.filter(scope, lambda n: tag(*tags)(n) & F.exists(
        s, lambda x: (x["at"] > n["at"]) & (x["at"] <= n["last"]))))
    def fits(text):
        ok = F.lower(text).startswith(low)
        return ok if longest is None else ok & (F.length(text) <= longest)

    return F.filter(around, lambda n: let(text_of(nodes, n), fits))


def label_row_values(nodes: Column, scope: Column, label: str, longest: int = 300) -> Column:
    """Link texts of the first short row that starts with `label:`, else its comma parts."""
    rows = _starting_with(nodes, scope, ["div"], label + ":", longest)

    def values(row):
        links = ls.clean_list(F.transform(select(inside(nodes, row), tag("a")), lambda a: text_of(nodes, a)))
        parts = ls.clean_list(F.split(t.after_colon(text_of(nodes, row)), ","))
        return F.coalesce(links, parts)

    return let(F.get(rows, F.lit(0)), lambda row: F.when(row.isNotNull(), values(row)))


def labelled_value(nodes: Column, scope: Column, label: str, tags: list[str],
                   longest: int | None = None) -> Column:
    """Value after the colon of the first element that starts with the label."""
    first = F.get(_starting_with(nodes, scope, tags, label, longest), F.lit(0))
    return t.after_colon(text_of(nodes, first))


def _heading(nodes: Column, scope: Column, words: str) -> Column:
    return F.get(F.filter(select(scope, tag("h2", "h3")), lambda h: F.coalesce(
        F.lower(text_of(nodes, h)).contains(words), F.lit(False))), F.lit(0))


def _next(nodes: Column, after: Column, pred) -> Column:
    """First match anywhere later in the document."""
    return F.get(F.filter(nodes, lambda n: (n["at"] > after["at"]) & pred(n)), F.lit(0))


def heading_list(nodes: Column, scope: Column, words: str) -> Column:
    """Items of the first list after a heading."""
    def items(h):
        return let(_next(nodes, h, tag("ul")), lambda u: F.transform(
            select(inside(nodes, u), tag("li")), lambda li: text_of(nodes, li)))

    return let(_heading(nodes, scope, words), lambda h: ls.clean_list(items(h)))


def heading_paragraphs(nodes: Column, scope: Column, words: str, container: str) -> Column:
    """Paragraphs of the container after a heading, joined by a blank line."""
    def block(h):
        return F.coalesce(_next(nodes, h, both(tag("div"), cls_like(container))),
                          _next(nodes, h, tag("div")))

    return let(_heading(nodes, scope, words), lambda h: let(block(h), lambda b: ls.ordered_list(
        _texts(nodes, select(inside(nodes, b), tag("p"))), "\n\n")))


def related_items(nodes: Column, scope: Column) -> Column:
    """Link texts of the short blocks that start with `See:`."""
    blocks = F.filter(_starting_with(nodes, scope, ["div", "section"], "See:", 199),
                      lambda n: text_of(nodes, n).startswith("See:"))
    links = F.flatten(F.transform(blocks, lambda b: F.transform(
        select(inside(nodes, b), tag("a")), lambda a: text_of(nodes, a))))
    return ls.clean_list(links)
