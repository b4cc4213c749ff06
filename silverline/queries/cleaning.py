"""Queries over column cleaning, joins, aggregates, keyed operators, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from silverline.functions import text as t
from silverline.operators import aggregates as ag, columns as cl, joins as jn, keyed as ky
from silverline.queries.registry import query

# ---- Columns and predicates ----


@query("cast_ids", """
SELECT cast(l_orderkey AS varchar) AS l_orderkey, cast(l_partkey AS varchar) AS l_partkey,
       cast(l_suppkey AS varchar) AS l_suppkey, l_linenumber FROM lineitem""")
def _(d):
    df = d.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    return cl.cast_ids(df, ["l_orderkey", "l_partkey", "l_suppkey"])


@query("drop_columns", "SELECT p_partkey, p_name, p_type, p_size FROM part")
def _(d):
    return cl.drop_columns(d.part, "p_brand", "p_retailprice", "not_there")


@query("allow_list_priority", """
SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN o_orderpriority
       ELSE 'OTHER' END AS o_orderpriority FROM orders""")
def _(d):
    return cl.allow_list(d.orders.select("o_orderkey", "o_orderpriority"),
                         "o_orderpriority", ["1-URGENT", "2-HIGH"], "OTHER")


@query("allow_list_segment", """
SELECT c_custkey, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_custkey % 3 <> 0
       THEN c_mktsegment ELSE 'unknown' END AS c_mktsegment FROM customer""")
def _(d):
    df = d.customer.select("c_custkey", F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment"))
                           .alias("c_mktsegment"))
    return cl.allow_list(df, "c_mktsegment", ["BUILDING", "MACHINERY"], "unknown")


@query("allow_list_lang", """
SELECT doc_id, CASE WHEN lang IN ('de', 'en') THEN lang ELSE 'other' END AS lang FROM documents""")
def _(d):
    return cl.allow_list(d.documents.select("doc_id", "lang"), "lang", ["de", "en"], "other")


@query("null_sentinel_discount", """
SELECT l_orderkey, l_linenumber, l_partkey,
       CASE WHEN l_discount <= 0.01 THEN NULL ELSE l_discount END AS l_discount FROM lineitem""")
def _(d):
    df = d.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_discount")
    return cl.null_sentinel(df, "l_discount", 0.01)


@query("null_sentinel_text", """
SELECT c_custkey, CASE WHEN c_acctbal <= 0 THEN NULL
       WHEN c_custkey % 5 = 0 THEN '$' || cast(cast(c_acctbal AS decimal(12,2)) AS varchar)
       ELSE cast(cast(c_acctbal AS decimal(12,2)) AS varchar) END AS balance
FROM customer WHERE NOT (c_acctbal <= 0 AND c_custkey % 5 = 0)
UNION ALL
SELECT c_custkey, '$' || cast(cast(c_acctbal AS decimal(12,2)) AS varchar)
FROM customer WHERE c_acctbal <= 0 AND c_custkey % 5 = 0""")
def _(d):
    text = F.col("c_acctbal").cast("decimal(12,2)").cast("string")
    df = d.customer.select("c_custkey", F.when(F.col("c_custkey") % 5 == 0, F.concat(F.lit("$"), text))
                           .otherwise(text).alias("balance"))
    return cl.null_sentinel(df, "balance", 0)


@query("fill_null", """
SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 'Unknown' WHEN event_id % 4 = 1 THEN ''
       ELSE props END AS props FROM events""")
def _(d):
    k = F.col("event_id") % 4
    df = d.events.select("event_id", F.when(k == 1, "").when(k > 1, F.col("props")).alias("props"))
    return cl.fill_null(df, "props", "Unknown")


@query("int_like", """
SELECT l_orderkey, l_linenumber, l_partkey,
       CASE l_linenumber % 4 WHEN 2 THEN NULL WHEN 3 THEN 0 ELSE cast(l_quantity AS int) END AS qty
FROM lineitem""")
def _(d):
    whole = F.col("l_quantity").cast("int").cast("string")
    k = F.col("l_linenumber") % 4
    text = (F.when(k == 0, F.concat(whole, F.lit(".0"))).when(k == 1, F.concat(F.lit(" "), whole, F.lit(".7 ")))
            .when(k == 2, F.concat(whole, F.lit(",000"))).otherwise(F.concat(F.lit("."), whole)))
    df = d.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", text.alias("qty"))
    return cl.int_like(df, ["qty"])


@query("trim_columns", "SELECT n_nationkey, n_name FROM nation")
def _(d):
    padded = F.concat(F.lit("  "), F.col("n_name"), F.lit(" "))
    return cl.trim_columns(d.nation.select("n_nationkey", padded.alias("n_name")), ["n_name"])


@query("drop_values", """
SELECT p_partkey, p_type FROM (
  SELECT p_partkey, CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_type END AS p_type FROM part)
WHERE p_type <> 'PROMO'""")
def _(d):
    df = d.part.select("p_partkey", F.when(F.col("p_partkey") % 11 != 0, F.col("p_type")).alias("p_type"))
    return cl.drop_values(df, "p_type", "PROMO")


@query("ensure_columns", """
SELECT c_custkey, c_name, cast(NULL AS varchar) AS brand_name, cast(NULL AS varchar) AS category
FROM customer""")
def _(d):
    return cl.ensure_columns(d.customer.select("c_custkey", "c_name"), ["c_name", "brand_name", "category"])


@query("require_columns", "SELECT s_suppkey, s_name FROM supplier")
def _(d):
    return cl.require_columns(d.supplier, ["s_suppkey", "s_name"]).select("s_suppkey", "s_name")


@query("project_fields", """
SELECT s_name, s_suppkey, cast(NULL AS varchar) AS product_url FROM supplier""")
def _(d):
    return cl.project_fields(d.supplier, ["s_name", "product_url", "s_suppkey"])


@query("drop_null_keys", """
SELECT event_id, cast(user_id AS varchar) AS user_key FROM events
WHERE event_id % 5 <> 0 AND event_id % 7 <> 0""")
def _(d):
    e = F.col("event_id")
    key = F.when(e % 7 == 0, "  ").when(e % 5 != 0, F.col("user_id").cast("string"))
    return cl.drop_null_keys(d.events.select("event_id", key.alias("user_key")), "user_key")


_REJECT_SQL = """
SELECT page_id, url, CASE WHEN url LIKE '%.example.net%' THEN 'hidden_host'
  WHEN url LIKE '%?%' THEN 'query_string'
  WHEN nullif(trim(regexp_extract(html, '<h1>([^<]*)</h1>', 1)), '') IS NULL THEN 'no_product_title'
  END AS reject_reason FROM pages"""


def _rejects(d):
    title = t.clean_text(F.regexp_extract("html", "<h1>([^<]*)</h1>", 1))
    return cl.classify_reject(d.pages, [
        ("hidden_host", F.col("url").contains(".example.net")),
        ("query_string", F.col("url").contains("?")),
        ("no_product_title", title.isNull())])


@query("classify_reject", _REJECT_SQL)
def _(d):
    return _rejects(d).select("page_id", "url", "reject_reason")


@query("split_rejects", f"""
SELECT 'valid' AS part, page_id, NULL AS reject_reason FROM ({_REJECT_SQL}) WHERE reject_reason IS NULL
UNION ALL
SELECT 'rejected', page_id, reject_reason FROM ({_REJECT_SQL}) WHERE reject_reason IS NOT NULL""")
def _(d):
    valid, rejected = cl.split_rejects(_rejects(d))
    none = F.lit(None).cast("string").alias("reject_reason")
    return valid.select(F.lit("valid").alias("part"), "page_id", none).unionByName(
        rejected.select(F.lit("rejected").alias("part"), "page_id", "reject_reason"))


@query("valid_for_saving", """
SELECT doc_id, source FROM (SELECT doc_id, CASE WHEN doc_id % 6 = 0 THEN ' ' WHEN doc_id % 6 = 1
  THEN NULL ELSE source END AS source FROM documents) WHERE trim(source) <> ''""")
def _(d):
    k = F.col("doc_id") % 6
    df = d.documents.select("doc_id", F.when(k == 0, " ").when(k > 1, F.col("source")).alias("source"))
    return cl.valid_for_saving(df, "source")


@query("stamp_batch", """
SELECT n_nationkey, '20260518_111454' AS batch_id, 'catalog' AS source_name, 'v1' AS pipeline_version,
       '2026-05-18T11:14:54.000000' AS collected_at, '2026-05-18' AS ingestion_date FROM nation""")
def _(d):
    return cl.stamp_batch(d.nation.select("n_nationkey"), "20260518_111454", "catalog", "v1",
                          "2026-05-18T11:14:54")


# ---- Joins ----

_BRIDGE = "SELECT l_orderkey, l_linenumber, l_partkey AS p_partkey, l_suppkey AS s_suppkey FROM lineitem"
_PARTS = "SELECT p_partkey FROM part WHERE p_size < 30"
_SUPPLIERS = "SELECT s_suppkey FROM supplier WHERE s_acctbal > 1000"


def _bridge(d):
    return d.lineitem.select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("p_partkey"),
                             F.col("l_suppkey").alias("s_suppkey"))


def _dims(d, copies=1):
    parts, suppliers = d.part.filter("p_size < 30"), d.supplier.filter("s_acctbal > 1000")
    if copies == 2:
        parts = parts.unionByName(d.part.filter("p_size < 10"))
        suppliers = suppliers.unionByName(suppliers)
    return [(parts, "p_partkey"), (suppliers, "s_suppkey")]


@query("fk_filter_inner", f"""
SELECT b.* FROM ({_BRIDGE}) b JOIN ({_PARTS} UNION ALL SELECT p_partkey FROM part WHERE p_size < 10)
USING (p_partkey) JOIN ({_SUPPLIERS} UNION ALL {_SUPPLIERS}) USING (s_suppkey)""")
def _(d):
    return jn.fk_filter(_bridge(d), _dims(d, copies=2))


@query("fk_filter_semi", f"""
SELECT * FROM ({_BRIDGE}) WHERE p_partkey IN ({_PARTS}) AND s_suppkey IN ({_SUPPLIERS})""")
def _(d):
    return jn.fk_filter(_bridge(d), _dims(d, copies=2), mode="semi")


@query("fk_orphans", f"""
SELECT * FROM ({_BRIDGE}) WHERE p_partkey NOT IN ({_PARTS}) OR s_suppkey NOT IN ({_SUPPLIERS})""")
def _(d):
    return jn.fk_orphans(_bridge(d), _dims(d, copies=2))


@query("skip_done", """
SELECT c_custkey, c_name FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)""")
def _(d):
    done = d.orders.filter("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return jn.skip_done(d.customer.select("c_custkey", "c_name"), done, "c_custkey")


@query("canonical_lookup", """
SELECT p_partkey, CASE p_type WHEN 'STANDARD' THEN 'NORMAL' WHEN 'ECONOMY' THEN 'BASIC'
       ELSE p_type END AS canonical FROM part""")
def _(d):
    first = d.part.filter("p_type in ('STANDARD', 'ECONOMY')").select(F.col("p_type").alias("name")).distinct()
    lookup = first.withColumn("canonical", F.when(F.col("name") == "STANDARD", "NORMAL").otherwise("BASIC"))
    return jn.canonical_lookup(d.part.select("p_partkey", "p_type"), "p_type", lookup, "canonical").drop("p_type")


@query("prefer", """
WITH s AS (SELECT s_nationkey, min(s_name) AS name, max(s_acctbal) AS bal FROM supplier GROUP BY 1)
SELECT c_custkey, c_nationkey AS nation,
       coalesce(CASE WHEN c_custkey % 3 <> 0 THEN c_name END, s.name) AS name,
       coalesce(CASE WHEN c_custkey % 2 = 0 THEN c_acctbal END, s.bal) AS bal
FROM customer LEFT JOIN s ON s_nationkey = c_nationkey""")
def _(d):
    k = F.col("c_custkey")
    first = d.customer.select("c_custkey", F.col("c_nationkey").alias("nation"),
                              F.when(k % 3 != 0, F.col("c_name")).alias("name"),
                              F.when(k % 2 == 0, F.col("c_acctbal")).alias("bal"))
    second = d.supplier.groupBy(F.col("s_nationkey").alias("nation")).agg(
        F.min("s_name").alias("name"), F.max("s_acctbal").alias("bal"))
    return jn.prefer(first, second, "nation", ["name", "bal"])


@query("catalog_view", """
SELECT cast(l_orderkey AS varchar) AS product_id, o_orderstatus AS product_status,
       cast(l_partkey AS varchar) AS ingredient_id, p_name AS ingredient_name,
       l_linenumber AS ingredient_position
FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey""")
def _(d):
    text = lambda c, a: F.col(c).cast("string").alias(a)
    bridge = d.lineitem.select(text("l_orderkey", "product_id"), text("l_partkey", "ingredient_id"),
                               F.col("l_linenumber").alias("ingredient_position"))
    products = d.orders.select(text("o_orderkey", "product_id"), F.col("o_orderstatus").alias("product_status"))
    ingredients = d.part.select(text("p_partkey", "ingredient_id"), F.col("p_name").alias("ingredient_name"))
    return jn.catalog_view(products, bridge, ingredients)


# ---- Aggregates ----

_AUDITED = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


@query("row_audit", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, 'read' AS stage, count(*) AS n_rows FROM {n}" for n in _AUDITED))
def _(d):
    return ag.row_audit({(n, "read"): getattr(d, n) for n in _AUDITED})


_STATUS_SQL = """CASE WHEN event_type IN ('view', 'click', 'purchase') THEN 'success'
       WHEN event_type = 'signup' THEN 'partial' ELSE 'failed' END"""


def _statuses(d):
    kind = F.col("event_type")
    return d.events.withColumns({
        "status": F.when(kind.isin("view", "click", "purchase"), "success")
        .when(kind == "signup", "partial").otherwise("failed"),
        "batch_day": F.date_format("ts", "yyyy-MM-dd")})


@query("status_counts", f"""
SELECT strftime(ts, '%Y-%m-%d') AS batch_day, count(*) AS total,
  count(*) FILTER (WHERE {_STATUS_SQL} = 'success') AS success_count,
  count(*) FILTER (WHERE {_STATUS_SQL} = 'partial') AS partial_count,
  count(*) FILTER (WHERE {_STATUS_SQL} = 'failed') AS failed_count
FROM events GROUP BY 1""")
def _(d):
    return ag.status_counts(_statuses(d), ["batch_day"], "status")


@query("sum_or_null", """
SELECT l_orderkey, cast(coalesce(nullif(sum(CASE WHEN l_returnflag = 'R' THEN cast(l_quantity AS bigint)
       ELSE 0 END), 0), max(l_linenumber)) AS bigint) AS reviews FROM lineitem GROUP BY 1""")
def _(d):
    returned = F.when(F.col("l_returnflag") == "R", F.col("l_quantity").cast("bigint")).otherwise(0)
    return ag.sum_or_null(d.lineitem, ["l_orderkey"], returned, "reviews",
                          F.max("l_linenumber").cast("bigint"))


def _fragments(d):
    k = F.col("c_custkey")
    return d.customer.select(
        (k % 3).alias("source_priority"), k.alias("seq"), "c_mktsegment",
        F.when(k % 2 == 0, F.upper(F.concat(F.lit("item"), k % 40))).otherwise(
            F.concat(F.lit("item"), k % 40)).alias("name"),
        F.when(k % 5 == 0, "").when(k % 5 < 3, F.col("c_name")).alias("description"),
        F.when(k % 4 == 0, F.col("c_nationkey")).alias("position"))


@query("merge_fragments", """
WITH f AS (
  SELECT c_custkey % 3 AS p, c_custkey AS seq, c_mktsegment,
         CASE WHEN c_custkey % 2 = 0 THEN upper('item' || (c_custkey % 40)) ELSE 'item' || (c_custkey % 40) END AS name,
         CASE WHEN c_custkey % 5 = 0 THEN '' WHEN c_custkey % 5 < 3 THEN c_name END AS description,
         CASE WHEN c_custkey % 4 = 0 THEN c_nationkey END AS position FROM customer)
SELECT c_mktsegment, first(name ORDER BY p, seq) AS name,
       first(description ORDER BY p, seq) FILTER (WHERE description <> '') AS description,
       first(position ORDER BY p, seq) FILTER (WHERE position IS NOT NULL) AS position
FROM f GROUP BY c_mktsegment, lower(name)""")
def _(d):
    return ag.merge_fragments(_fragments(d), ["c_mktsegment"], "name", ["source_priority", "seq"],
                              ["description", "position"]).drop("first_order")


_PIVOT = {"seen": ["view"], "clicked": ["click"], "bought": ["purchase"], "any_sign": ["s"]}


@query("pivot_label_value_last", """
SELECT user_id, max_by(value, event_id) FILTER (WHERE event_type = 'view') AS seen,
  arg_max_null(CASE WHEN event_id % 3 <> 0 THEN value END, event_id) FILTER (WHERE event_type = 'click') AS clicked,
  max_by(value, event_id) FILTER (WHERE event_type = 'purchase') AS bought,
  max_by(value, event_id) FILTER (WHERE event_type = 'signup') AS any_sign
FROM events GROUP BY 1""")
def _(d):
    value = F.when((F.col("event_type") != "click") | (F.col("event_id") % 3 != 0), F.col("value"))
    return ag.pivot_label_value(d.events.withColumn("value", value), ["user_id"], "event_type", "value",
                                "event_id", _PIVOT)


@query("pivot_label_value_first", """
SELECT user_id, min_by(v, event_id) FILTER (WHERE event_type = 'view' AND v IS NOT NULL) AS seen,
  min_by(v, event_id) FILTER (WHERE event_type = 'click' AND v IS NOT NULL) AS clicked,
  min_by(v, event_id) FILTER (WHERE event_type = 'purchase' AND v IS NOT NULL) AS bought,
  min_by(v, event_id) FILTER (WHERE event_type = 'signup' AND v IS NOT NULL) AS any_sign
FROM (SELECT *, CASE WHEN event_id % 3 <> 0 THEN value END AS v FROM events) GROUP BY 1""")
def _(d):
    df = d.events.withColumn("value", F.when(F.col("event_id") % 3 != 0, F.col("value")))
    return ag.pivot_label_value(df, ["user_id"], "event_type", "value", "event_id", _PIVOT, "first")


@query("any_flag", """
SELECT user_id, max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS bought,
  CASE WHEN bool_or(event_type = 'error') THEN 0 WHEN bool_or(event_type = 'purchase') THEN 1 END AS irritation,
  max(CASE WHEN value > 50 THEN CASE WHEN event_type = 'click' THEN 1 ELSE 0 END END) AS high_click
FROM events GROUP BY 1""")
def _(d):
    kind = F.col("event_type")
    return d.events.groupBy("user_id").agg(
        ag.any_flag(kind == "purchase").alias("bought"),
        ag.any_flag(kind == "purchase", negative=kind == "error").alias("irritation"),
        ag.any_flag(F.when(F.col("value") > 50, kind == "click")).alias("high_click"))


@query("distinct_keys", """
SELECT count(DISTINCT user_id) AS n_user_id, count(DISTINCT event_type) AS n_event_type FROM events""")
def _(d):
    return ag.distinct_keys(d.events, ["user_id", "event_type"])


@query("ingredient_usage", """
SELECT cast(l_partkey AS varchar) AS ingredient_id, count(*) AS bridge_rows,
       count(DISTINCT l_orderkey) AS products FROM lineitem GROUP BY 1""")
def _(d):
    return ag.ingredient_usage(d.lineitem.select(
        F.col("l_partkey").cast("string").alias("ingredient_id"), F.col("l_orderkey").alias("product_id")))


# ---- One row per key, numbering ----

@query("keep_last", """
SELECT event_id, user_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""")
def _(d):
    return ky.keep_last(d.events, ["user_id", "event_type"], ["ts", "event_id"]).select(
        "event_id", "user_id", "event_type", "value")


@query("keep_first", """
SELECT o_custkey, o_orderkey, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1""")
def _(d):
    return ky.keep_first(d.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select(
        "o_custkey", "o_orderkey", "o_totalprice")


@query("enumerate_items", r"""
SELECT doc_id, i AS position, trim(lines[i]) AS line FROM (
  SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM (
    SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents))
WHERE trim(lines[i]) <> ''""")
def _(d):
    rows = d.documents.select("doc_id", F.split("text", "\n").alias("lines"))
    numbered = ky.enumerate_items(rows, "lines", "line").withColumn("line", F.trim("line"))
    return numbered.filter("line <> ''")


@query("first_seen", """
WITH e AS (SELECT user_id, strftime(ts, '%Y-%m-%d %H') AS page FROM events),
f AS (SELECT user_id, min(page) AS page FROM e GROUP BY 1),
n AS (SELECT page, count(*) AS new_keys FROM f GROUP BY 1),
p AS (SELECT page, count(*) AS found FROM e GROUP BY 1)
SELECT page, found, coalesce(new_keys, 0) AS new_keys,
       cast(sum(coalesce(new_keys, 0)) OVER (ORDER BY page) AS bigint) AS known_keys
FROM p LEFT JOIN n USING (page)""")
def _(d):
    return ky.first_seen(d.events.select("user_id", F.date_format("ts", "yyyy-MM-dd HH").alias("page")),
                         "user_id", "page")


@query("final_attempt", """
SELECT user_id, coalesce(min(event_id) FILTER (WHERE event_type <> 'error'), max(event_id)) AS attempts,
       coalesce(min_by(event_type, event_id) FILTER (WHERE event_type <> 'error'),
                max_by(event_type, event_id)) AS event_type
FROM events GROUP BY 1""")
def _(d):
    return ky.final_attempt(d.events, "user_id", "event_id", F.col("event_type") != "error", ["event_type"])


# ---- Sorts and limits ----

@query("sort_keys", "SELECT url FROM pages ORDER BY url")
def _(d):
    return d.pages.select("url").orderBy("url")


@query("sort_by_position", """
SELECT p_partkey, pos FROM (SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_size % 10 END AS pos
FROM part) ORDER BY coalesce(nullif(pos, 0), 9999), p_partkey""")
def _(d):
    df = d.part.select("p_partkey", F.when(F.col("p_size") % 5 != 0, F.col("p_size") % 10).alias("pos"))
    return ky.sort_by_position(df, "pos", ["p_partkey"])


@query("dictionary_order", """
SELECT c_custkey, c_name, CASE WHEN c_custkey % 9 <> 0 THEN c_acctbal END AS rating FROM customer
ORDER BY rating IS NULL, rating DESC, c_name""")
def _(d):
    df = d.customer.select("c_custkey", "c_name",
                           F.when(F.col("c_custkey") % 9 != 0, F.col("c_acctbal")).alias("rating"))
    return ky.dictionary_order(df, "rating", "c_name")


@query("head", """
SELECT o_orderkey, o_totalprice FROM (SELECT * FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 100)
WHERE o_orderstatus <> 'F'""")
def _(d):
    first = ky.head(d.orders, ["o_orderdate", "o_orderkey"], 100)
    return first.filter("o_orderstatus <> 'F'").select("o_orderkey", "o_totalprice")


# ---- Set operations ----

@query("concat_ragged", """
SELECT c_name AS name, c_nationkey AS nation, c_mktsegment AS segment, NULL AS balance FROM customer
UNION ALL SELECT s_name, s_nationkey, NULL, s_acctbal FROM supplier""")
def _(d):
    a = d.customer.select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"),
                          F.col("c_mktsegment").alias("segment"))
    b = d.supplier.select(F.col("s_nationkey").alias("nation"), F.col("s_name").alias("name"),
                          F.col("s_acctbal").alias("balance"))
    return ky.concat_ragged(a, b)


@query("union_priority", """
SELECT nation, min(source_priority) AS best, count(*) AS n FROM (
  SELECT c_nationkey AS nation, 1 AS source_priority FROM customer WHERE c_acctbal > 9000
  UNION ALL SELECT s_nationkey, 2 FROM supplier
  UNION ALL SELECT n_nationkey, 3 FROM nation) GROUP BY 1""")
def _(d):
    tagged = ky.union_priority(
        d.customer.filter("c_acctbal > 9000").select(F.col("c_nationkey").alias("nation")),
        d.supplier.select(F.col("s_nationkey").alias("nation")),
        d.nation.select(F.col("n_nationkey").alias("nation")))
    return tagged.groupBy("nation").agg(F.min("source_priority").alias("best"), F.count(F.lit(1)).alias("n"))


@query("distinct_key_set", "SELECT DISTINCT o_custkey FROM orders")
def _(d):
    return d.orders.select("o_custkey").distinct()


@query("minus_keys", """
SELECT DISTINCT c_custkey FROM customer
EXCEPT SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'""")
def _(d):
    done = d.orders.filter("o_orderpriority = '1-URGENT'")
    return ky.minus(d.customer, done.select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


@query("upsert_keep_last", """
WITH old AS (SELECT *, 0 AS side FROM events WHERE event_id % 3 <> 0),
new AS (SELECT *, 1 AS side FROM events WHERE event_id % 3 = 0)
SELECT user_id, event_type, event_id, value FROM (SELECT * FROM old UNION ALL SELECT * FROM new)
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY side DESC, event_id DESC) = 1""")
def _(d):
    cols = ["user_id", "event_type", "event_id", "value"]
    old, new = d.events.filter("event_id % 3 <> 0"), d.events.filter("event_id % 3 = 0")
    return ky.upsert_keep_last(old.select(cols), new.select(cols),
                               ["user_id", "event_type", "not_there"], ["event_id"])


@query("upsert_whole_rows", """
SELECT DISTINCT o_custkey, o_orderstatus FROM orders""")
def _(d):
    rows = d.orders.select("o_custkey", "o_orderstatus")
    return ky.upsert_keep_last(rows, rows, ["not_there"], [])
