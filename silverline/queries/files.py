"""Queries that write with a sink and read back with a source, in batch and as streams.

Paths lie in the folder the session's executors share.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from silverline.functions import text as t
from silverline.operators.columns import reject_reason
from silverline.operators.quality import classify_fetch
from silverline.queries.registry import query
from silverline.sources import readers as rd, writers as wr
from silverline.sources.shared import fresh_path
from silverline.streaming import loads

# ---- Sources and sinks ----


@query("csv_strings_round_trip", """
SELECT cast(c_custkey AS varchar) AS c_custkey, 'a "' || c_name || '",' || chr(10) || chr(10) || 'é' AS c_name,
  CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS c_mktsegment FROM customer""")
def _(d):
    path = fresh_path(d.spark, "csv-strings")
    name = F.concat(F.lit('a "'), F.col("c_name"), F.lit('",\n\né'))
    rows = d.customer.select("c_custkey", name.alias("c_name"),
                             F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")).alias("c_mktsegment"))
    wr.write_csv(rows, path)
    return rd.read_csv_strings(d.spark, path, multi_line=True)


@query("csv_typed_round_trip", "SELECT p_partkey, p_name, p_size, p_retailprice FROM part")
def _(d):
    path = fresh_path(d.spark, "csv-typed")
    wr.write_csv(d.part, path, ["p_partkey", "p_name", "p_size", "p_retailprice"])
    return rd.read_csv_typed(d.spark, path, "p_partkey long, p_name string, p_size int, p_retailprice double")


@query("csv_fields_json_cells", """
SELECT lang, cast(NULL AS varchar) AS missing, cast(to_json(string_split(text, ' ')) AS varchar) AS words,
       cast(doc_id AS varchar) AS doc_id FROM documents""")
def _(d):
    path = fresh_path(d.spark, "csv-json")
    wr.write_csv(d.documents.withColumn("words", F.split("text", " ")), path, ["lang", "missing", "words", "doc_id"])
    return rd.read_csv_strings(d.spark, path)


@query("key_list", """
SELECT cast(o_custkey AS varchar) AS key FROM orders GROUP BY o_custkey ORDER BY min(o_orderkey) LIMIT 500""")
def _(d):
    path = fresh_path(d.spark, "key-list")
    key = F.concat(F.lit(" "), F.col("o_custkey").cast("string"), F.lit("  "))
    wr.write_csv(d.orders.select(key.alias("key"), F.lpad(F.col("o_orderkey").cast("string"), 20, "0").alias("at")), path)
    return rd.read_key_list(d.spark, path, "key", ["at"], limit=500).select("key")


@query("read_pages", "SELECT page_id, url, length(html) AS n, NULL::int AS http_status FROM pages")
def _(d):
    return rd.read_pages(d.spark, f"{d.folder}/pages.parquet").select(
        "page_id", "url", F.length("html").alias("n"), "http_status")


def _zone(d):
    path = fresh_path(d.spark, "raw-zone")
    day = F.date_format("ts", "yyyy-MM-dd")
    rows = d.events.select(
        "event_id", "user_id", "event_type", F.lit("web").alias("source"), F.lit("events").alias("entity"),
        day.alias("ingestion_date"), F.concat(F.date_format("ts", "yyyyMMdd"), F.lit("_020000")).alias("batch_id"))
    return rows, wr.write_partitioned(rows, path)


@query("raw_zone_latest", """
SELECT event_id, user_id, event_type, strftime(ts, '%Y%m%d') || '_020000' AS batch_id FROM events
WHERE strftime(ts, '%Y-%m-%d') = (SELECT max(strftime(ts, '%Y-%m-%d')) FROM events)""")
def _(d):
    rows, path = _zone(d)
    schema = rows.select("event_id", "user_id", "event_type").schema
    return rd.read_raw_zone(d.spark, path, schema, "web", "events").select(
        "event_id", "user_id", "event_type", "batch_id")


@query("partition_overwrite", """
SELECT strftime(ts, '%Y-%m-%d') AS ingestion_date,
  CASE WHEN strftime(ts, '%Y-%m-%d') = (SELECT max(strftime(ts, '%Y-%m-%d')) FROM events) THEN 'rerun' ELSE event_type END AS event_type,
  count(*) AS n FROM events GROUP BY ALL""")
def _(d):
    rows, path = _zone(d)
    last = d.events.agg(F.date_format(F.max("ts"), "yyyy-MM-dd")).first()[0]
    wr.write_partitioned(rows.filter(F.col("ingestion_date") == last).withColumn("event_type", F.lit("rerun")), path)
    full = d.spark.read.schema(rows.schema).option("basePath", path).parquet(path)
    return full.groupBy("ingestion_date", "event_type").agg(F.count(F.lit(1)).alias("n"))


@query("jsonl_round_trip", """
SELECT s_suppkey, s_name || ' é' AS s_name, CASE WHEN s_suppkey % 2 = 0 THEN s_acctbal END AS s_acctbal,
  cast(NULL AS varchar) AS absent FROM supplier""")
def _(d):
    path = fresh_path(d.spark, "jsonl")
    rows = d.supplier.select("s_suppkey", F.concat("s_name", F.lit(" é")).alias("s_name"),
                             F.when(F.col("s_suppkey") % 2 == 0, F.col("s_acctbal")).alias("s_acctbal"))
    wr.write_jsonl(rows, path)
    return rd.read_jsonl(d.spark, path, "s_suppkey long, s_name string, s_acctbal double, absent string")


@query("jsonl_keeps_nulls", """
SELECT '{"n_nationkey":' || n_nationkey || ',"note":null}' AS line FROM nation""")
def _(d):
    path = fresh_path(d.spark, "jsonl-nulls")
    wr.write_jsonl(d.nation.select("n_nationkey", F.lit(None).cast("string").alias("note")), path)
    return d.spark.read.text(path).withColumnRenamed("value", "line")


@query("parquet_round_trip", "SELECT * FROM part")
def _(d):
    path = fresh_path(d.spark, "parquet")
    wr.write_parquet(d.part.withColumn("p_name", F.lit("old")), path)
    return d.spark.read.parquet(wr.write_parquet(d.part, path))


@query("save_unique", """
SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1""")
def _(d):
    path = fresh_path(d.spark, "unique")
    rows = d.orders.select("o_custkey", "o_orderkey")
    return d.spark.read.parquet(wr.save_unique(rows, path, ["o_custkey"], ["o_orderkey"]))


_STATUS = """CASE cast(floor(value) AS bigint) % 9 WHEN 0 THEN 403 WHEN 1 THEN 404 WHEN 2 THEN 503 WHEN 3 THEN 418 ELSE 200 END"""


def fetch_log(d):
    """Events as a crawl log: the value decides the HTTP status, the type the body length."""
    k = F.floor("value") % 9
    return d.events.select(
        F.concat(F.lit("https://shop.example.com/"), F.col("event_id")).alias("ingredient_url"), "event_id", "user_id",
        F.when(k == 0, 403).when(k == 1, 404).when(k == 2, 503).when(k == 3, 418).otherwise(200).alias("http_status"),
        F.when(F.col("event_type") == "error", 0).otherwise(700).alias("body_length"),
        F.lit(1).alias("attempts"), t.iso_ts("ts").alias("collected_at"))


FETCH_SQL = f"""SELECT event_id, user_id, 'https://shop.example.com/' || event_id AS ingredient_url, {_STATUS} AS http_status,
  1 AS attempts, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS collected_at,
  CASE {_STATUS} WHEN 403 THEN 'AccessDenied' WHEN 404 THEN 'NotFound' WHEN 503 THEN 'RetryableHTTPError'
    WHEN 418 THEN 'HTTPError' ELSE CASE WHEN event_type = 'error' THEN 'EmptyResponse' END END AS error_type FROM events"""


@query("dead_letters", f"""
SELECT ingredient_url, http_status, attempts, error_type, cast(NULL AS varchar) AS error_message, collected_at
FROM ({FETCH_SQL}) WHERE error_type IS NOT NULL""")
def _(d):
    path = fresh_path(d.spark, "dead-letters")
    return d.spark.read.parquet(wr.write_dead_letter(classify_fetch(fetch_log(d), "http_status", "body_length"), path))


_RUN = """CASE WHEN event_type = 'error' THEN 'failed' WHEN event_type = 'signup' THEN 'partial' ELSE 'success' END"""


def _manifest(d):
    path = fresh_path(d.spark, "manifest")
    status = reject_reason([("failed", F.col("event_type") == "error"), ("partial", F.col("event_type") == "signup"),
                            ("success", F.lit(True))])
    records = d.events.select(F.date_format("ts", "yyyyMMdd").alias("batch_id"), status.alias("status"),
                              t.iso_ts("ts").alias("at"), "event_id")
    return wr.write_manifest(records, path, ["batch_id"], "status", "at", "at", ["event_id"])


@query("manifest", f"""
SELECT strftime(ts, '%Y%m%d') AS batch_id, min(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')) AS started_at,
  max(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')) AS finished_at, count(*) AS total_urls,
  count(*) FILTER (WHERE {_RUN} = 'success') AS success_count, count(*) FILTER (WHERE {_RUN} = 'partial') AS partial_count,
  count(*) FILTER (WHERE {_RUN} = 'failed') AS failed_count FROM events GROUP BY 1""")
def _(d):
    return rd.read_jsonl(d.spark, f"{_manifest(d)}/totals", "batch_id string, started_at string, finished_at string, "
                         "total_urls long, success_count long, partial_count long, failed_count long")


@query("manifest_failed_pages", f"""
SELECT strftime(ts, '%Y%m%d') AS batch_id, event_id FROM events WHERE {_RUN} = 'failed'""")
def _(d):
    return rd.read_jsonl(d.spark, f"{_manifest(d)}/failed", "batch_id string, event_id long")


@query("sorted_keys_file", "SELECT DISTINCT url FROM pages")
def _(d):
    path = fresh_path(d.spark, "sorted-keys")
    return rd.read_csv_strings(d.spark, wr.write_sorted_keys(d.pages, "url", path))


# ---- Incremental loads ----

def _two_drops(d, columns):
    """The events as two file drops; a stream over the folder, run after each drop."""
    path = fresh_path(d.spark, "drops")
    rows = d.events.select(*columns)
    middle = d.events.agg(F.expr("percentile_approx(event_id, 0.5)")).first()[0]
    drops = [rows.filter(F.col("event_id") <= middle), rows.filter(F.col("event_id") > middle)]
    return path, rows.schema, [lambda x=x: x.write.mode("append").parquet(path) for x in drops]


@query("incremental_append", "SELECT event_id, user_id, event_type FROM events")
def _(d):
    source, schema, drops = _two_drops(d, ["event_id", "user_id", "event_type"])
    sink, ckpt = fresh_path(d.spark, "append"), fresh_path(d.spark, "append-log")
    for drop in drops:
        drop()
        loads.incremental_append(loads.file_stream(d.spark, source, schema), sink, ckpt).awaitTermination()
    return d.spark.read.schema(schema).parquet(sink)


@query("stream_unique", """
SELECT user_id, min(event_id) AS event_id FROM events GROUP BY 1""")
def _(d):
    source, schema, drops = _two_drops(d, ["event_id", "user_id"])
    sink, ckpt = fresh_path(d.spark, "unique"), fresh_path(d.spark, "unique-log")
    for drop in drops:
        drop()
        loads.stream_unique(loads.file_stream(d.spark, source, schema), sink, ckpt, "user_id", ["event_id"]).awaitTermination()
    return loads.unique_rows(d.spark, sink, schema)


@query("stream_upsert", """
SELECT user_id, event_type, event_id, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) = 1""")
def _(d):
    columns, keys = ["event_id", "user_id", "event_type", "value"], ["user_id", "event_type"]
    source, schema, drops = _two_drops(d, columns)
    target, ckpt = fresh_path(d.spark, "upsert"), fresh_path(d.spark, "upsert-log")
    for drop in drops:
        drop()
        loads.stream_upsert(loads.file_stream(d.spark, source, schema), target, ckpt, keys, ["event_id"]).awaitTermination()
    return loads.current_rows(d.spark, target, schema, keys, ["event_id"])
