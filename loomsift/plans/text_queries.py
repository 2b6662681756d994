"""Text normalisation, filters and duplicate removal."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators.dedup import against_ledger, first_wins, per_group
from ..operators.profile import as_map, count_by, length_stats, tier_pivot
from ..session import table
from ..sources.feeds import on_topic, union_in_order
from .base import ASCII_WORDS, CHATS_SQL, ITEMS_SQL, TOPIC, category, category_sql, chats, items, query

_STRIP = r"regexp_replace({}, '^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$', '', 'g')"


@query(f"""
WITH first AS (SELECT doc_id, source, text, row_number() OVER (
  PARTITION BY left(regexp_replace(lower(split_part(text, chr(10), 1)), '[^a-z0-9]', '', 'g'), 50) ORDER BY doc_id) AS rn FROM documents)
SELECT coalesce(source, 'unknown') AS source, count(*) AS n FROM first WHERE rn = 1 AND length(text) >= 300 GROUP BY 1
""")
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    first = first_wins(docs, [X.title_key(F.substring_index("text", "\n", 1))], [F.col("doc_id")])
    return count_by(first.where(F.length("text") >= 300), F.col("source"), "source")


@query(f"SELECT page_id, left({_STRIP.format("regexp_replace(" + _STRIP.format('html') + ", '<[^>]+>', '', 'g')")}, 500) AS summary FROM pages")
def html_strip_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", X.html_summary(F.col("html")).alias("summary"))


@query(r"SELECT doc_id, regexp_replace(text, '[\s\x1c-\x1f]+', ' ', 'g') AS text FROM documents")
def whitespace_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", X.collapse(F.col("text")).alias("text"))


@query(f"""
WITH {ITEMS_SQL}, flat AS (SELECT *, {ASCII_WORDS.replace("(text", "(title || ' ' || summary")} AS t FROM items)
SELECT ordinal, source FROM flat WHERE source IN ('src1', 'src2') OR regexp_matches(t, '(?i)\\b({'|'.join(TOPIC)})\\b')
""")
def keyword_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return on_topic(items(spark, sf_dir), ["src1", "src2"], TOPIC).select("ordinal", "source")


@query(f"""
WITH {ITEMS_SQL} SELECT ordinal FROM items
WHERE regexp_matches({ASCII_WORDS.replace('(text', '(title')}, '(?i)\\b(the|thand|reand)\\b') AND source <> 'arxiv'
""")
def title_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = items(spark, sf_dir).where("source <> 'arxiv'")
    return rows.where(X.holds_any(F.col("title"), ("the", "thand", "reand"))).select("ordinal")


_KEY = "left(regexp_replace(lower(text), '[^a-z0-9]', '', 'g'), 50)"


@query(f"SELECT doc_id, title_key FROM (SELECT doc_id, {_KEY} AS title_key, row_number() OVER (PARTITION BY {_KEY} ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1")
def title_key_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", X.title_key(F.col("text")).alias("title_key"))
    return first_wins(docs, [F.col("title_key")], [F.col("doc_id")])


@query("""
WITH f AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN md5(source) ELSE left(sha256(left(text, 200)), 16) END AS fingerprint FROM documents)
SELECT fingerprint, min(doc_id) AS doc_id FROM f GROUP BY fingerprint
""")
def fingerprint_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = F.when(F.col("doc_id") % 3 == 0, F.md5("source")).otherwise("")
    docs = table(spark, sf_dir, "documents").select("doc_id", X.fingerprint(given, F.col("text")).alias("fingerprint"))
    return first_wins(docs, [F.col("fingerprint")], [F.col("doc_id")])


@query("""
WITH f AS (SELECT doc_id, text, row_number() OVER (PARTITION BY left(sha256(left(text, 200)), 16) ORDER BY length(text), doc_id) AS rn FROM documents)
SELECT doc_id, CAST(length(text) AS BIGINT) AS n FROM f WHERE rn = 1 AND length(text) >= 300
""")
def dedup_then_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An invalid first record suppresses a valid later copy."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.length("text").cast("long").alias("n"))
    first = first_wins(docs, [X.fingerprint(F.lit(None).cast("string"), F.col("text"))], [F.col("n"), F.col("doc_id")])
    return first.where("n >= 300").select("doc_id", "n")


@query("SELECT source, count(*) AS n FROM documents GROUP BY source")
def source_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_by(table(spark, sf_dir, "documents"), F.col("source"), "source")


@query("SELECT string_agg(source || '=' || n, ',' ORDER BY source) AS counts FROM (SELECT source, count(*) AS n FROM documents GROUP BY source)")
def source_count_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = as_map(count_by(table(spark, sf_dir, "documents"), F.col("source"), "source"), "source")
    return counts.select(F.array_join(F.transform(F.array_sort(F.map_entries("counts")), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",").alias("counts"))


@query(f"SELECT coalesce(CASE WHEN doc_id % 11 <> 0 THEN {category_sql('doc_id')} END, 'unknown') AS category, count(*) AS n FROM documents GROUP BY 1")
def category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = F.when(F.col("doc_id") % 11 != 0, category(F.col("doc_id")))
    return count_by(table(spark, sf_dir, "documents"), named, "category")


@query(f"""
WITH t AS (SELECT {category_sql('d.doc_id')} AS category, CASE quality WHEN 1 THEN 'gen' WHEN 0 THEN 'rewrite' END AS tier
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)
SELECT coalesce(category, 'all') AS category, count(*) FILTER (tier = 'gen') AS n_gen, count(*) FILTER (tier = 'rewrite') AS n_rewrite, count(*) AS n_all
FROM t GROUP BY ROLLUP (category)
""")
def tier_pivot_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels"), "doc_id").withColumn("category", category(F.col("doc_id")))
    return tier_pivot(labelled, "category", F.when(F.col("quality") == 1, "gen").otherwise("rewrite"), ["gen", "rewrite"])


@query("SELECT round(avg(length(text)), 6) AS avg_len, CAST(min(length(text)) AS BIGINT) AS min_len, CAST(max(length(text)) AS BIGINT) AS max_len FROM documents")
def length_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return length_stats(table(spark, sf_dir, "documents"), F.col("text")).withColumn("avg_len", F.round("avg_len", 6))


@query("SELECT count(*) FILTER (trim(text) <> '') AS n_filled, count(*) AS n_all FROM documents")
def line_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").agg(F.count_if(F.trim("text") != "").alias("n_filled"), F.count("*").alias("n_all"))


@query(f"WITH {CHATS_SQL} SELECT conv_id, CAST(len(messages) AS BIGINT) AS n FROM chats WHERE len(messages) >= 3")
def msg_count_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chats(spark, sf_dir).select("conv_id", F.size("messages").cast("long").alias("n")).where("n >= 3")


@query(f"WITH {CHATS_SQL} SELECT conv_id, CAST(length(messages[-1].content) AS BIGINT) AS n FROM chats WHERE length(messages[-1].content) >= 300")
def last_msg_len_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = F.try_element_at("messages", F.lit(-1))["content"]
    return chats(spark, sf_dir).select("conv_id", F.length(last).cast("long").alias("n")).where("n >= 300")


@query("""
WITH t AS (SELECT conv_id, turn, CASE WHEN turn % 2 = 1 THEN '<think>' || left(text, 20) || chr(10) || '</think>  ' || text ELSE text END AS raw FROM conversations)
SELECT conv_id, turn, regexp_replace(raw, '(?s)<think>.*?</think>\\s*', '', 'g') AS text,
  length(regexp_replace(raw, '(?s)<think>.*?</think>\\s*', '', 'g')) > 600 // 2 AS accepted FROM t
""")
def think_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.gates import draft_accepted

    thought = F.concat(F.lit("<think>"), F.substring("text", 1, 20), F.lit("\n</think>  "), F.col("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.when(F.col("turn") % 2 == 1, thought).otherwise(F.col("text")).alias("raw"))
    clean = X.drop_thinking(F.col("raw"))
    return rows.select("conv_id", "turn", clean.alias("text"), draft_accepted(clean, F.lit(600)).alias("accepted"))


@query(f"SELECT doc_id, source FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents) WHERE rn <= 20")
def feed_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return per_group(table(spark, sf_dir, "documents").select("doc_id", "source"), [F.col("source")], [F.col("doc_id")], 20)


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def done_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return against_ledger(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels"), "doc_id")


@query("""
SELECT 0 AS source_ord, doc_id AS id, source, CAST(NULL AS VARCHAR) AS url FROM documents
UNION ALL SELECT 1, page_id, NULL, url FROM pages
""")
def union_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "source")
    return union_in_order([docs, table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), "url")])


@query("SELECT DISTINCT source FROM documents")
def distinct_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("source").distinct()


@query(f"""
SELECT doc_id, 'own-' || {category_sql('doc_id')} || '-' || lpad(CAST(doc_id AS VARCHAR), 6, '0') AS id,
  left(sha256('v2-' || {category_sql('doc_id')} || '-' || doc_id || '-' || left(text, 200)), 16) AS fingerprint FROM documents
""")
def record_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = category(F.col("doc_id"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", X.record_id("own", named, F.col("doc_id")).alias("id"),
        X.record_fingerprint(named, F.col("doc_id"), F.col("text"), "v2-").alias("fingerprint"),
    )


@query("""
SELECT event_id, strftime(make_timestamp(epoch_us(ts) // 1000000 * 1000000), '%Y-%m-%dT%H:%M:%S+00:00') AS iso, strftime(ts, '%Y-%m-%d') AS day,
  CAST(isodow(ts) AS BIGINT) AS weekday FROM events
""")
def iso_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    return table(spark, sf_dir, "events").select(
        "event_id", X.iso_utc(F.unix_seconds(ts)).alias("iso"), F.date_format(ts, "yyyy-MM-dd").alias("day"),
        F.extract(F.lit("DAYOFWEEK_ISO"), ts).cast("long").alias("weekday"),
    )


