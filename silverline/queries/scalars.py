"""Queries over the text, number, id, time and list functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from silverline.functions import fixed, lists as ls, text as t
from silverline.queries.registry import query

# Unicode white space for RE2, whose \s is ASCII only.
_WS = r"[\s\x{0b}\x{85}\p{Z}]+"


def _clean(x: str) -> str:
    return f"nullif(trim(regexp_replace({x}, '{_WS}', ' ', 'g')), '')"


def _sql_list(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


def _any(x: str, words) -> str:
    return "(" + " OR ".join(f"contains({x}, '{w}')" for w in words) + ")"


@query("clean_text", f"SELECT doc_id, {_clean('text')} AS text FROM documents")
def _(d):
    return d.documents.select("doc_id", t.clean_text("text").alias("text"))


@query("clean_text_markup", f"""
SELECT page_id, {_clean("replace(replace(regexp_replace(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '(?s)<!--.*?-->|<[^>]*>', ' ', 'g'), '&quot;', chr(34)), '&amp;', '&')")} AS text
FROM pages""")
def _(d):
    article = F.regexp_extract("html", "(?s)<article>(.*?)</article>", 1)
    return d.pages.select("page_id", t.clean_text(article, strip_tags=True).alias("text"))


_MARKED = (
    "M&uuml;ller", "&#00000065;&#x0042;&#X43;", "&amp;lt;", "a &lt; b", "pH < 5 and > 3", "1<2>0",
    "x<script>var y = '<b>';</script>z", "<style>p{}</style>s", "<b title=\"a>b\">t</b>", "<!-- no > -->c",
    "&unknown; &copy &AMP;", "&#150;&#0;&#xD800;&#99999999999;", "<br/>l<P>m", "&nbsp;&NotEqualTilde;")
_PLAIN = (
    "Müller", "ABC", "&lt;", "a < b", "pH < 5 and > 3", "1<2>0", "x z", "s", "t", "c", "&unknown; © &",
    "\u2013\ufffd\ufffd\ufffd", "l m", "\u2242\u0338")


@query("clean_text_references", "SELECT s_suppkey, CASE s_suppkey % %d %s END || ' ' || s_name AS text FROM supplier".replace(
    "%d", str(len(_PLAIN))).replace("%s", " ".join(f"WHEN {i} THEN '{x}'" for i, x in enumerate(_PLAIN))))
def _(d):
    """References of all kinds, `<` as text, and markup whose content is not text."""
    marked = F.element_at(F.array(*map(F.lit, _MARKED)), (F.col("s_suppkey") % len(_MARKED) + 1).cast("int"))
    return d.supplier.select("s_suppkey", t.clean_text(F.concat(marked, F.lit(" "), "s_name"), strip_tags=True).alias("text"))


@query("absolute_url_dots", """
SELECT s_suppkey, 'https://shop.example.com/' || CASE s_suppkey % 6 WHEN 0 THEN 'y/' || s_suppkey WHEN 1 THEN 'a/' || s_suppkey || '?q=/../x'
  WHEN 2 THEN s_suppkey || '/' WHEN 3 THEN '..a/' || s_suppkey WHEN 4 THEN s_suppkey || '#a/../b' ELSE 'b/' || s_suppkey || '/' END AS link
FROM supplier""")
def _(d):
    k = F.col("s_suppkey").cast("string")
    paths = (("/x/../y/", ""), ("a/./", "?q=/../x"), ("../../", "/."), ("/..a/", ""), ("/a/b/../../", "#a/../b"), ("b/c/../", "/d/.."))
    made = [F.concat(F.lit(a), k, F.lit(b)) for a, b in paths]
    link = F.element_at(F.array(*made), (F.col("s_suppkey") % 6 + 1).cast("int"))
    return d.supplier.select("s_suppkey", t.absolute_url(link, "https://shop.example.com", resolve=True).alias("link"))


@query("absolute_url_from_page", """
SELECT s_suppkey, 'https://shop.example.com' || CASE s_suppkey % 6 WHEN 0 THEN '/y/' || s_suppkey WHEN 1 THEN '/c/' || s_suppkey
  WHEN 2 THEN '/d/b/' || s_suppkey WHEN 3 THEN '/d/e?a=' || s_suppkey WHEN 4 THEN '/d/' || s_suppkey ELSE '/' || s_suppkey END AS link
FROM supplier""")
def _(d):
    """Links of a page that is not at the root of its host."""
    k = F.col("s_suppkey").cast("string")
    paths = ("/x/../y/", "../c/", "a/../b/", "?a=", "./", "../../../")
    link = F.element_at(F.array(*[F.concat(F.lit(x), k) for x in paths]), (F.col("s_suppkey") % 6 + 1).cast("int"))
    return d.supplier.select("s_suppkey", t.absolute_url(link, "https://shop.example.com/d/e", resolve=True).alias("link"))


@query("clean_text_unterminated", "SELECT s_suppkey, s_name || CASE WHEN s_suppkey % 4 = 3 THEN ' < 5' ELSE '' END AS text FROM supplier")
def _(d):
    """Comments, scripts and styles that are never closed reach to the end of the text."""
    ends = ("<script>var x = '<b>' + 1", " <!-- open <p>", "<STYLE type='a'> p { } </script>", " < 5")
    end = F.element_at(F.array(*map(F.lit, ends)), (F.col("s_suppkey") % 4 + 1).cast("int"))
    return d.supplier.select("s_suppkey", t.clean_text(F.concat("s_name", end), strip_tags=True).alias("text"))


@query("safe_lower", """
SELECT c_custkey, lower(trim(coalesce(CASE WHEN c_custkey % 4 <> 0 THEN ' ' || c_mktsegment END, ''))) AS segment
FROM customer""")
def _(d):
    text = F.when(F.col("c_custkey") % 4 != 0, F.concat(F.lit(" "), F.col("c_mktsegment")))
    return d.customer.select("c_custkey", t.safe_lower(text).alias("segment"))


@query("absolute_url", """
SELECT page_id, href, CASE WHEN href LIKE '//%' THEN 'https:' || href WHEN href LIKE '/%'
  THEN 'https://shop.example.com' || href ELSE href END AS link
FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a\\s[^>]*href="([^"]*)"', 1)) AS href FROM pages
      UNION ALL SELECT page_id, url FROM pages
      UNION ALL SELECT page_id, regexp_replace(url, '^https?:', '') FROM pages)""".replace("\\\\", "\\"))
def _(d):
    hrefs = d.pages.select("page_id", F.explode(F.concat(
        F.regexp_extract_all("html", F.lit(r'<a\s[^>]*href="([^"]*)"'), F.lit(1)),
        F.array("url", F.regexp_replace("url", "^https?:", "")))).alias("href"))
    return hrefs.select("page_id", "href", t.absolute_url("href", "https://shop.example.com/").alias("link"))


@query("absolute_url_resolved", r"""
SELECT page_id, 'https://shop.example.com/' || regexp_replace(url, '^https?://[^/]*/', '') AS link FROM pages""")
def _(d):
    relative = F.regexp_replace("url", "^https?://[^/]*/", "")
    up = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("../"), relative)).otherwise(relative)
    return d.pages.select("page_id", t.absolute_url(up, "https://shop.example.com", resolve=True).alias("link"))


@query("drop_fragment", "SELECT page_id, regexp_replace(url, '#.*$', '') AS url FROM pages")
def _(d):
    return d.pages.select("page_id", t.drop_fragment("url").alias("url"))


@query("md5_ids", """
SELECT p_partkey, md5(lower(trim(p_name))) AS folded, md5(' ' || upper(p_name)) AS as_is FROM part""")
def _(d):
    loud = F.concat(F.lit(" "), F.upper("p_name"))
    return d.part.select("p_partkey", t.md5_id(loud).alias("folded"), t.md5_id(loud, fold=False).alias("as_is"))


@query("record_id", "SELECT page_id, 'page_' || left(sha256(url), 16) AS record_id FROM pages")
def _(d):
    return d.pages.select("page_id", t.record_id("url", "page").alias("record_id"))


@query("slug", r"""
SELECT page_id, coalesce(nullif(rtrim(left(trim(regexp_replace(regexp_replace(lower(trim(url)), 'https?://', '', 'g'),
  '[^a-z0-9]+', '_', 'g'), '_'), 30), '_'), ''), 'unknown') AS slug FROM pages""")
def _(d):
    return d.pages.select("page_id", t.slug("url", 30).alias("slug"))


@query("parse_price", """
SELECT l_orderkey, l_linenumber, l_partkey, cast(cast(l_extendedprice AS decimal(12,2)) AS varchar) AS price
FROM lineitem""")
def _(d):
    text = F.concat(F.lit("From $"), F.format_number(F.col("l_extendedprice").cast("decimal(12,2)"), 2), F.lit(" now"))
    return d.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", t.parse_price(text).alias("price"))


@query("first_int", """
SELECT c_custkey, try_cast(nullif(regexp_extract(c_name, '([0-9]+)', 1), '') AS int) AS first_int FROM customer""")
def _(d):
    return d.customer.select("c_custkey", t.first_int("c_name").alias("first_int"))


@query("comma_int", "SELECT p_partkey, cast(p_retailprice * 100 AS int) AS cents FROM part")
def _(d):
    return d.part.select("p_partkey", t.comma_int(
        F.format_number(F.round(F.col("p_retailprice") * 100).cast("int"), 0)).alias("cents"))


@query("ratio_of_5", """
SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN NULL ELSE (p_size % 6) + 0.5 END::double AS ratio FROM part""")
def _(d):
    number = F.concat((F.col("p_size") % 6).cast("string"), F.lit(".5"))
    text = F.when(F.col("p_size") % 3 == 0, number).otherwise(F.concat(F.lit("rated "), number, F.lit(" / 5 by users")))
    return d.part.select("p_partkey", t.ratio_of_5(text).alias("ratio"))


@query("yes_no", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN 0 END AS flag FROM orders""")
def _(d):
    s = F.col("o_orderstatus")
    text = F.when(s == "O", " Yes, and no").when(s == "F", "unknown").otherwise("n/a")
    return d.orders.select("o_orderkey", t.yes_no(text).alias("flag"))


@query("score_label", """
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 5 WHEN '2-HIGH' THEN 4 WHEN '3-MEDIUM' THEN 3
  WHEN '4-NOT SPECIFIED' THEN 0 END AS score FROM orders""")
def _(d):
    labels = {"urgent": 5, "high": 4, "medium": 3, "not": 0}
    return d.orders.select("o_orderkey", t.score_label("o_orderpriority", labels).alias("score"))


@query("strip_label", """
SELECT c_custkey, replace(c_name, 'Customer#', '') AS anywhere, replace(c_name, 'Customer#', '') AS at_start
FROM customer""")
def _(d):
    return d.customer.select("c_custkey", t.strip_label("c_name", "Customer#").alias("anywhere"),
                             t.strip_label(F.upper("c_name"), "customer#", prefix_only=True).alias("at_start"))


@query("after_colon", "SELECT n_nationkey, n_name || ': ' || n_nationkey AS value FROM nation")
def _(d):
    text = F.concat(F.lit("Made in:  "), F.col("n_name"), F.lit(": "), F.col("n_nationkey").cast("string"))
    return d.nation.select("n_nationkey", t.after_colon(text).alias("value"))


@query("split_list", f"""
SELECT doc_id, array_to_string(list_filter(list_transform(string_split_regex(text, '[,.]'),
  lambda x: trim(regexp_replace(x, '^{_WS}|{_WS}$', '', 'g'))), lambda x: x <> ''), '|') AS parts FROM documents""")
def _(d):
    return d.documents.select("doc_id", F.array_join(ls.split_list("text", "[,.]"), "|").alias("parts"))


@query("split_list_cut", """
SELECT p_partkey, array_to_string(string_split(p_name, ' '), '|') AS parts FROM part""")
def _(d):
    text = F.concat(F.replace("p_name", F.lit(" "), F.lit(", ,")), F.lit(",. For the latest information, see"))
    parts = ls.split_list(text, r",\.?", fixed.INGREDIENT_DISCLAIMER)
    return d.part.select("p_partkey", F.array_join(parts, "|").alias("parts"))


@query("clean_list", """
WITH w AS (SELECT doc_id, unnest(string_split(text, ' ')) AS word, generate_subscripts(string_split(text, ' '), 1) AS i
           FROM documents),
c AS (SELECT doc_id, i, nullif(trim(regexp_replace(word, '%s', ' ', 'g')), '') AS word FROM w),
f AS (SELECT doc_id, i, word FROM c WHERE word IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY doc_id, lower(word) ORDER BY i) = 1)
SELECT doc_id, string_agg(word, '|' ORDER BY i) AS words FROM f GROUP BY doc_id""" % _WS)
def _(d):
    words = F.array_join(ls.clean_list(F.split("text", " ")), "|")
    # A filter is not pushed below the generator, so no list is cleaned twice.
    return d.documents.select("doc_id", F.explode_outer(F.array(words)).alias("words")).filter("words is not null")


@query("sorted_set", """
SELECT doc_id, nullif(array_to_string(list_sort(list_distinct(string_split(text, ' '))), '|'), '') AS words
FROM documents""")
def _(d):
    return d.documents.select("doc_id", ls.sorted_set(F.split("text", " ")).alias("words"))


@query("ordered_list", """
SELECT doc_id, nullif(array_to_string(list_filter(string_split(text, chr(10)), lambda x: x NOT LIKE 'A%'), '|'), '') AS lines
FROM documents""")
def _(d):
    lines = F.transform(F.split("text", "\n"), lambda x: F.when(~x.startswith("A"), x))
    return d.documents.select("doc_id", ls.ordered_list(lines).alias("lines"))


@query("ingredient_name", """
SELECT p_partkey, CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_name END AS name,
  CASE WHEN p_size % 7 = 0 THEN NULL WHEN p_size % 2 = 0 THEN '~' || p_size || '-' || (p_size + 1) || '%'
       WHEN p_size % 3 = 0 THEN p_size || '%' END AS concentration FROM part""")
def _(d):
    k, n = F.col("p_size"), F.col("p_size").cast("string")
    amount = (F.when(k % 2 == 0, F.concat(F.lit(" ~"), n, F.lit(" - "), (k + 1).cast("string"), F.lit(" % –")))
              .when(k % 3 == 0, F.concat(F.lit(" "), n, F.lit("%."))).otherwise(" —"))
    lead = F.when(k % 7 == 0, "Free From: ").otherwise("  ")
    named = t.ingredient_name(F.concat(lead, F.col("p_name"), amount))
    return d.part.select("p_partkey", named.alias("n")).select("p_partkey", "n.name", "n.concentration")


@query("normalize_name", "SELECT p_partkey, lower(p_name) AS name, upper(p_type) AS rating FROM part")
def _(d):
    spaced = F.concat(F.lit("\t "), F.replace("p_name", F.lit(" "), F.lit("   ")), F.lit("\n"))
    return d.part.select("p_partkey", t.normalize_name(F.upper(spaced)).alias("name"),
                         t.normalize_rating(F.lower("p_type")).alias("rating"))


@query("canonical_name", """
SELECT p_partkey, CASE p_name WHEN 'red ring' THEN 'ruby ring' WHEN 'blue bolt' THEN 'bolt' ELSE p_name END AS name
FROM part""")
def _(d):
    return d.part.select("p_partkey", t.canonical_name(
        "p_name", {"red ring": "ruby ring", "blue bolt": "bolt"}).alias("name"))


_TAGS = {"prep": ["the ", "und "], "verbs": ["ing", "tion"], "accent": ["é", "ü"], "never": ["zzzzzz"]}


@query("keyword_tags", "SELECT doc_id, nullif(concat_ws('|', {}), '') AS tags FROM documents".format(", ".join(
    f"CASE WHEN {_any('lower(text)', _TAGS[k])} THEN '{k}' END" for k in sorted(_TAGS))))
def _(d):
    return d.documents.select("doc_id", t.keyword_tags("text", _TAGS).alias("tags"))


_CLAIMS = {"red": ["red"], "small_or_bolt": ["small", "bolt"], "oil_free": ["oil-free", "oil free"]}


@query("claim_flags", "SELECT p_partkey, {} FROM part".format(", ".join(
    f"cast({_any('lower(p_name)', v)} AS int) AS {k}" for k, v in _CLAIMS.items())))
def _(d):
    return d.part.select("p_partkey", *t.claim_flags(F.upper("p_name"), _CLAIMS).values())


@query("synonyms", """
SELECT p_partkey, nullif(array_to_string(list_filter(list_distinct_ordered, lambda x: x <> lower(p_type)), '|'), '') AS names
FROM (SELECT p_partkey, p_type, CASE WHEN split_part(p_name, ' ', 1) = split_part(p_name, ' ', 2)
        THEN [split_part(p_name, ' ', 1), lower(p_brand)]
        ELSE [split_part(p_name, ' ', 1), split_part(p_name, ' ', 2), lower(p_brand)] END AS list_distinct_ordered
      FROM part)""")
def _(d):
    first, second = F.split("p_name", " ")[0], F.split("p_name", " ")[1]
    points = F.array(F.concat(F.lit("AKA "), first, F.lit(" and "), second), F.lit("Calms"))
    text = F.concat(F.lit("x. Also known as "), F.lower("p_brand"), F.lit(", generically as "),
                    first, F.lit(". Also known as "), F.lower("p_type"), F.lit("."))
    return d.part.select("p_partkey", F.array_join(ls.synonyms(points, text, F.col("p_type")), "|").alias("names"))


@query("safe_concat", """
SELECT c_custkey, coalesce(CASE WHEN c_custkey % 3 <> 0 THEN c_name END, '') || ' ' ||
  coalesce(CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END, '') || ' ' || c_nationkey AS text FROM customer""")
def _(d):
    k = F.col("c_custkey")
    parts = [F.when(k % 3 != 0, F.col("c_name")), F.when(k % 2 == 0, F.col("c_mktsegment")), "c_nationkey"]
    return d.customer.select("c_custkey", t.safe_concat(parts).alias("text"))


@query("truncate", "SELECT doc_id, left(text, 300) AS text FROM documents")
def _(d):
    return d.documents.select("doc_id", t.truncate("text", 300).alias("text"))


@query("batch_times", """
SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') AS batch_id, strftime(ts, '%Y-%m-%d') AS ingestion_date,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS collected_at FROM events""")
def _(d):
    return d.events.select("event_id", t.batch_id("ts").alias("batch_id"),
                           t.ingestion_date("ts").alias("ingestion_date"), t.iso_ts("ts").alias("collected_at"))


@query("is_missing", """
SELECT doc_id, cast(doc_id % 3 <> 2 AS int) AS text_missing, cast(doc_id % 2 = 0 AS int) AS list_missing
FROM documents""")
def _(d):
    k = F.col("doc_id")
    text = F.when(k % 3 == 0, "  ").when(k % 3 == 2, F.col("text"))
    items = F.when(k % 4 == 0, F.array().cast("array<string>")).when(k % 2 == 1, F.split("text", " "))
    return d.documents.select("doc_id", t.is_missing(text).cast("int").alias("text_missing"),
                              t.is_missing(items, "array<string>").cast("int").alias("list_missing"))
