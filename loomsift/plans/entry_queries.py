"""The built-in transforms run end to end over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.scenarios import chosen_branches, dealt, scenarios
from ..session import table
from ..transforms import assembling, built_in, collecting, evaluating
from .base import CHATS_SQL, ITEMS_SQL, PAIRS_SQL, TOPIC, chats, items, pairs, query

ALLOWED = ("src0", "src1")


@query(f"""
WITH {ITEMS_SQL}, kept AS (
  SELECT * FROM items WHERE source IN {ALLOWED} OR regexp_matches(regexp_replace(title || ' ' || summary, '[^\\x00-\\x7F\\p{{Z}}\\p{{P}}\\p{{S}}\\p{{C}}\\p{{M}}]', '_', 'g'), '(?i)\\b({'|'.join(TOPIC)})\\b')
), first AS (SELECT *, row_number() OVER (PARTITION BY left(regexp_replace(lower(title), '[^a-z0-9]', '', 'g'), 50) ORDER BY ordinal) AS rn FROM kept)
SELECT ordinal, source, title FROM first WHERE rn = 1
""")
def entry_collect(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = items(spark, sf_dir).withColumnRenamed("ordinal", "place").withColumn("source_ord", F.lit(0))
    made = built_in(collect=collecting(ALLOWED, TOPIC))["collect"](items=rows)
    return made["signals"].select(F.col("place").alias("ordinal"), "source", "title")


@query(f"""
WITH {CHATS_SQL}, f AS (SELECT *, messages[len(messages)].content AS answer FROM chats),
r AS (SELECT *, row_number() OVER (PARTITION BY left(sha256(left(coalesce(answer, ''), 200)), 16) ORDER BY conv_id) AS rn FROM f),
w AS (SELECT * FROM r WHERE rn = 1 AND len(messages) >= 3 AND length(answer) >= 300),
s AS (SELECT *, row_number() OVER (ORDER BY sha256('42:' || conv_id), conv_id) AS rank, count(*) OVER () AS total FROM w)
SELECT conv_id, CASE WHEN rank <= greatest(500, CAST(floor(total * 0.05) AS BIGINT)) THEN 'eval' ELSE 'train' END AS split, CAST(length(answer) AS BIGINT) AS n FROM s
""")
def entry_assemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chats(spark, sf_dir).select(F.col("conv_id").alias("ordinal"), F.lit(None).cast("string").alias("given"), F.lit("chat").alias("category"), "messages")
    made = built_in(assemble=assembling())["assemble"](records=rows)
    both = made["train"].withColumn("split", F.lit("train")).unionByName(made["eval"].withColumn("split", F.lit("eval")))
    return both.select(F.col("ordinal").alias("conv_id"), "split", F.length(F.try_element_at("messages", F.lit(-1))["content"]).cast("long").alias("n"))


_LINE = """'{{"instruction":' || to_json(instruction) || ',"response":' || to_json(response) || CASE WHEN score IS NULL THEN '' ELSE ',"score":' || to_json(score) END
  || ',"domain":"test"' || CASE WHEN extra THEN ',"note":"x"' ELSE '' END || '}}'""".replace("{{", "{").replace("}}", "}")
_GOOD = "len(errors) = 0 AND length(instruction) + length(response) BETWEEN 200 AND 32000 AND score >= 0.7"


@query(f"""
WITH {PAIRS_SQL}, lined AS (SELECT *, {_LINE} AS line FROM judged),
good AS (SELECT *, row_number() OVER (ORDER BY sha256('42:' || pair_id), pair_id) AS rank, count(*) OVER () AS total FROM lined WHERE {_GOOD}),
cut AS (SELECT *, CASE WHEN rank <= greatest(1, CAST(floor(total * 0.95) AS BIGINT)) THEN 'train' ELSE 'eval' END AS split FROM good)
SELECT 'pairs' AS name, (SELECT count(*) FROM good) AS pair_count,
  (SELECT count(*) FROM cut WHERE split = 'train') AS train_count, (SELECT count(*) FROM cut WHERE split = 'eval') AS eval_count,
  (SELECT sha256(coalesce(string_agg(line || chr(10), '' ORDER BY rank), '')) FROM cut WHERE split = 'train') AS train_sha256,
  (SELECT sha256(coalesce(string_agg(line || chr(10), '' ORDER BY rank), '')) FROM cut WHERE split = 'eval') AS eval_sha256,
  (SELECT count(*) FROM judged WHERE NOT coalesce({_GOOD}, false)) AS rejected
""")
def entry_factory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of whole lines: validated, split and hashed as files."""
    lines = pairs(spark, sf_dir).select(F.col("pair_id").alias("ordinal"), "line")
    return built_in()["factory"](lines=lines)["manifest"]


@query(f"""
WITH {PAIRS_SQL}, s AS (
  SELECT pair_id, 'length_ratio' AS metric, least(length(instruction), length(response)) / greatest(length(instruction), length(response), 1) AS score FROM pairs
  UNION ALL SELECT pair_id, 'exact_match', CASE WHEN regexp_replace(reverse(instruction), '^\\s+|\\s+$', '', 'g') = regexp_replace(response, '^\\s+|\\s+$', '', 'g') THEN 1.0 ELSE 0.0 END FROM pairs)
SELECT pair_id, metric, round(CAST(score AS DOUBLE), 9) AS score FROM s
""")
def entry_evaluate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs scored by a Python predictor that keeps a text's length."""
    backwards = evaluating(lambda text: text[::-1] if text else "", keep=["pair_id"])
    made = built_in(evaluate=backwards)["evaluate"](pairs=pairs(spark, sf_dir).select("pair_id", "instruction", "response"))
    return made["results"].select("pair_id", "metric", F.round("score", 9).alias("score"))


@query()
def entry_cook(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scenarios of the daily set, one for each document, by the deterministic stub, gated;
    no twin, as the stub's second tier is Python. ``generated_stub`` compares its texts."""
    work = dealt(table(spark, sf_dir, "documents"), F.col("doc_id"), chosen_branches(families=["daily"]))
    made = built_in()["cook"](scenarios=scenarios(spark, work, families=["daily"]))
    return made["texts"].select("category", "idx", "tier", "attempts", F.length("text").cast("long").alias("n"))
