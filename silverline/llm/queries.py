"""The numbered corpus queries over the given tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from silverline.llm import (chat, divergence, langid, line_dedup, mixing, neighbours, packing, quality,
                            resampling, secrets, simhash, substrings, toxicity)
from silverline.llm.common import held_out
from silverline.queries.folder import use_local_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            use_local_folder(spark)
            return fn(spark, folder)

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql.strip()
        return fn
    return register


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@_query("op1_substrings")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    kept = substrings.dedup_substrings(_table(spark, folder, "documents"))
    return kept.select("doc_id", "n_words", "n_removed",
                       F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


@_query("op2_neighbours")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(_table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


@_query("op3_line_dedup", r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
seen AS (
  SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) > 1),
marked AS (
  SELECT k.doc_id, k.line, k.i, s.first IS NOT NULL AND s.first <> k.doc_id AS dropped
  FROM keyed k LEFT JOIN seen s USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT dropped), ''))
    AS kept_sha256
FROM marked GROUP BY doc_id""")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    kept = line_dedup.dedup_lines(_table(spark, folder, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped",
                       F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


@_query("op4_simhash")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        "component_id")


@_query("op9_language_id")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    model = langid.fit(docs, ~held_out(F.col("doc_id")))
    return langid.identify(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


@_query("op10_toxicity")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    scorer = toxicity.fit(toxicity.training_rows(docs, labels, ~held_out(F.col("doc_id"))))
    return toxicity.score_texts(docs, scorer).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


@_query("op5_mixing", r"""
WITH RECURSIVE
sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
    row_number() OVER () AS r FROM documents),
own AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    row_number() OVER (ORDER BY source NULLS LAST) AS sid FROM sized GROUP BY source),
weighed AS (SELECT *, (sid - 1) % 3 + 1 AS weight FROM own),
filling AS (
  SELECT *, row_number() OVER f AS k,
    (sum(source_size) OVER ())::DOUBLE AS total,
    coalesce(sum(3 * source_size) OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
      AS full_before,
    sum(weight) OVER (f ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_left
  FROM weighed WINDOW f AS (ORDER BY source_size / weight, sid)),
level AS (
  SELECT (total - full_before) / weight_left AS level FROM filling
  WHERE 3 * source_size >= weight * ((total - full_before) / weight_left) ORDER BY k LIMIT 1),
aimed AS (
  SELECT w.*, least(3.0::DOUBLE * source_size, weight * level) AS target,
    (source_size + 63) // 64 AS blocks FROM weighed w, level),
needed AS (
  SELECT *, CASE WHEN source_size > 0
    THEN floor(target * blocks / source_size * 1024)::BIGINT ELSE 0 END AS slots FROM aimed),
summed AS (
  SELECT *, sum(slots) OVER (ORDER BY sid) AS upto, sum(slots) OVER () AS fine FROM needed),
arcs AS (
  SELECT *, floor((upto - slots)::DOUBLE / fine::DOUBLE * 1073741824.0)::BIGINT AS low,
    floor(upto::DOUBLE / fine::DOUBLE * 1073741824.0)::BIGINT AS high FROM summed),
points AS (
  SELECT slot, slot % 1073741824 * 663608941 % 1073741824 AS point
  FROM (SELECT unnest(range((SELECT ((max(fine) + 1023) // 1024)::BIGINT FROM summed))) AS slot)),
ranked AS (
  SELECT sid, blocks, row_number() OVER (PARTITION BY sid ORDER BY slot) - 1 AS rank
  FROM points JOIN arcs ON point >= low AND point < high),
uses AS (
  SELECT sid, rank % blocks AS block, count(*) AS uses FROM ranked
  WHERE rank < 3 * blocks GROUP BY ALL),
ranges AS (SELECT greatest(1, count(*) // 4096) AS n FROM sized),
marked AS (
  SELECT sized.*, a.sid, a.source_size, a.target,
    md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS mark
  FROM sized JOIN arcs a ON sized.source IS NOT DISTINCT FROM a.source),
laid AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY sid
    ORDER BY ('0x' || substr(mark, 1, 8))::BIGINT % (SELECT n FROM ranges), mark, doc_id, size, r
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM marked),
cut AS (
  SELECT *, unnest(range(start // 64, (start + size - 1) // 64 + 1)) AS block
  FROM laid WHERE size > 0),
sums AS (
  SELECT r, sum((least(start + size, (block + 1) * 64) - greatest(start, block * 64)) * uses) AS t
  FROM cut JOIN uses USING (sid, block) GROUP BY r)
SELECT doc_id, size::BIGINT AS size, source_size, target,
  coalesce(t, 0)::BIGINT AS taken
FROM laid LEFT JOIN sums USING (r)""")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return (mixing.mix(_table(spark, folder, "documents")).taken()
            .select("doc_id", "size", "source_size", "target", "taken"))


@_query("op6_packing")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(_table(spark, folder, "documents")).drop("row")


@_query("op7_chat", r"""
WITH rows AS (
  SELECT conv_id, turn, role, text FROM conversations UNION ALL
  VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'),
         (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
filled AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM rows),
escaped AS (
  SELECT *, length(replace(replace(replace(text, '\', '\\'), '###', '\h'), '</turn>', '\e'))
    + length(replace(replace(replace(replace(replace(role, '\', '\\'), '###', '\h'),
        '</turn>', '\e'), ':', '\c'), chr(10), '\n'))
    + length('### :') + 1 + length('</turn>') + 1 AS chars FROM filled),
said AS (
  SELECT conv_id, count(*) AS n_turns, sum(chars)::BIGINT AS formatted_chars,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')
      AS loss
  FROM escaped GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars,
  sha256(loss) AS loss_sha256, formatted_chars FROM said""")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                  "conv_id long, turn long, role string, text string")
    rows = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    formatted = chat.format_trees(chat.conversation_messages(rows.union(extra)))
    conv_id = F.when(F.col("tree") != chat.NO_TREE, F.col("tree")).alias("conv_id")
    return chat.read_back_digests(formatted).select(conv_id, "*").drop("tree")


@_query("op8_quality")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(_table(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "quality")


@_query("op11_divergence", r"""
WITH filled AS (
  SELECT row_number() OVER () AS r, coalesce(text, '') AS text, coalesce(lang, '') AS lang,
    coalesce(source, '') AS source FROM documents),
found AS (
  SELECT r, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM filled),
whole AS (
  SELECT lang, term, count(*) AS n FROM found GROUP BY ALL HAVING count(DISTINCT r) >= 30),
counted AS (
  SELECT lang, source, term, count(*) AS n FROM found JOIN whole USING (lang, term) GROUP BY ALL),
langs AS (SELECT lang, count(*) AS v, sum(n) AS n FROM whole GROUP BY lang),
groups AS (
  SELECT lang, source, v, langs.n AS ln, coalesce(c.n, 0) AS gn
  FROM (SELECT DISTINCT lang, source FROM filled) LEFT JOIN langs USING (lang)
  LEFT JOIN (SELECT lang, source, sum(n) AS n FROM counted GROUP BY ALL) c USING (lang, source)),
shares AS (
  SELECT g.lang, g.source, w.term, coalesce(c.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (g.gn + 5 * g.v) AS p,
    1 + (1000000000::HUGEINT * (w.n + 5)) // (g.ln + 5 * g.v) AS q
  FROM groups g JOIN whole w USING (lang) LEFT JOIN counted c USING (lang, source, term)),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(d.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
    FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source
    GROUP BY ALL) d ON d.lang = a.lang AND d.source = a.source AND d.item = b.source),
over AS (
  SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM over))
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank FROM ranked
WHERE part = 'pair' OR rank <= 50""")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(_table(spark, folder, "documents"))


@_query("op12_secrets")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    found = secrets.scan(docs, secrets.fit(secrets.labelled_values(docs)))
    return found.select("doc_id", "n_assign", "n_access", "n_hex",
                        F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"),
                        "spans", "n_format", "values")


@_query("op13_resampling", r"""
WITH RECURSIVE
steps AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k:
    CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS step),
texts AS (
  SELECT 's' AS side, row_number() OVER () AS r, doc_id, text FROM documents
  UNION ALL SELECT 't', row_number() OVER (), NULL, text FROM benchmark),
words AS (
  SELECT side, r, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM texts),
named AS (SELECT DISTINCT word, hex(encode(word)) AS bytes FROM words),
hashed AS (
  SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
      range(length(bytes) // 2), lambda i: ('0x' || substr(bytes, 2 * i + 1, 2))::BIGINT)),
    lambda c, b: xor(c // 256, step[xor(c % 256, b) + 1])), 4294967295) % 10000 AS bucket
  FROM named, steps),
features AS (SELECT side, r, bucket, count(*) AS n FROM words JOIN hashed USING (word) GROUP BY ALL),
counts AS (
  SELECT bucket, coalesce(sum(n) FILTER (WHERE side = 's'), 0)::DOUBLE AS s,
    coalesce(sum(n) FILTER (WHERE side = 't'), 0)::DOUBLE AS t FROM features GROUP BY bucket),
gains AS (
  SELECT bucket, floor(1000 * ln((t + 1) * (sum(s) OVER () + 10000)
    / ((s + 1) * (sum(t) OVER () + 10000))))::BIGINT AS gain FROM counts),
weights AS (
  SELECT r, sum(n)::BIGINT AS n_features, floor(sum(n * gain)::DOUBLE / sum(n))::BIGINT AS weight
  FROM features JOIN gains USING (bucket) WHERE side = 's' GROUP BY r),
scored AS (
  SELECT doc_id, r, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT
      + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM texts LEFT JOIN weights USING (r) WHERE side = 's'),
ranked AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS able
  FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 10 * able // 100 THEN rank END AS rank
FROM scored LEFT JOIN ranked USING (r)""")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    drawn = resampling.resample(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")
