"""Quotas: waves that fill them, turns by what is left of them, weights, weekly limits."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import split as S
from ..operators.generate import generate, two_tier
from ..operators.render import weekly
from ..operators.waves import in_waves
from ..session import table
from .base import CATEGORIES, category, category_sql, query


@dataclass(frozen=True)
class Recite:
    """A stub that says the first part of its prompt."""

    part: int

    def complete(self, prompt: str, max_tokens: int) -> str:
        return prompt[: len(prompt) // self.part]


#: Characters that a text must have.
LEAST = 400


@query(f"""
WITH RECURSIVE goal AS (SELECT count(*) // 18 AS target FROM documents),
c AS (SELECT {category_sql('doc_id')} AS category, doc_id // 6 AS idx, CAST(length(text) AS BIGINT) AS n,
  CASE WHEN length(text) // 2 >= {LEAST} THEN 'gen' WHEN length(text) >= {LEAST} THEN 'rewrite' END AS tier FROM documents),
sent AS (SELECT category, i, count(idx) AS sent, count(tier) AS passed
  FROM (SELECT DISTINCT category FROM c) JOIN (SELECT unnest(range(0, 2 * target + 1)) AS i FROM goal) ON true LEFT JOIN c USING (category)
  WHERE idx < i OR i = 0 GROUP BY category, i),
upto AS (SELECT category, list(CASE WHEN i = 0 THEN 0 ELSE sent END ORDER BY i) AS sent, list(CASE WHEN i = 0 THEN 0 ELSE passed END ORDER BY i) AS passed FROM sent GROUP BY category),
wave(category, asked, waves) AS (
  SELECT category, CAST(0 AS BIGINT), 0 FROM upto
  UNION ALL
  SELECT w.category, asked + CAST(least(
      greatest(1, CAST(ceil((target - passed[asked + 1]) * (asked + 1) / (passed[asked + 1] + 1)) AS BIGINT)),
      greatest(1, CAST(floor(target * CAST(1.2 AS DOUBLE)) AS BIGINT) - passed[asked + 1]), 2 * target - asked) AS BIGINT), waves + 1
  FROM wave w JOIN upto USING (category) JOIN goal ON true WHERE passed[asked + 1] < target AND asked < 2 * target
),
told AS (SELECT category, max(asked) AS asked, max(waves) AS waves FROM wave GROUP BY category),
kept AS (SELECT c.*, asked, waves, row_number() OVER (PARTITION BY category ORDER BY idx) AS place FROM c JOIN told USING (category) WHERE tier IS NOT NULL AND idx < asked)
SELECT category, idx, tier, CASE tier WHEN 'gen' THEN n // 2 ELSE n END AS n, kept.asked, upto.sent[kept.asked + 1] AS sent, waves
FROM kept JOIN upto USING (category) JOIN goal ON true WHERE place <= target
""")
def cook_in_waves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as prompts: the first tier says half of one, the second all of it. Each
    category makes what its quota needs, and tells what it asked for."""
    docs = table(spark, sf_dir, "documents")
    prompts = docs.select(
        category(F.col("doc_id")).alias("category"), F.floor(F.col("doc_id") / 6).alias("idx"), F.col("text").alias("prompt"),
        F.lit(100).alias("max_tokens"), F.lit(0).alias("min_len"),
    )
    make = lambda df: two_tier(df, lambda x: generate(x, Recite(2), retries=1), lambda x: generate(x, Recite(1), retries=1), F.length("text") >= LEAST, recheck=True)
    kept, quotas = in_waves(prompts, make, F.col("tier") != "failed", dict.fromkeys(CATEGORIES, docs.count() // 18))
    told = spark.createDataFrame([(name, q.asked, q.sent, q.waves) for name, q in quotas.items()], "category string, asked long, sent long, waves int")
    return kept.join(F.broadcast(told), "category").select("category", "idx", "tier", F.length("text").cast("long").alias("n"), "asked", "sent", "waves")


@query("""
WITH p AS (SELECT event_type, event_id, row_number() OVER w AS pick, count(*) OVER (PARTITION BY event_type) AS quota FROM events WINDOW w AS (PARTITION BY event_type ORDER BY event_id)),
t AS (SELECT *, row_number() OVER (ORDER BY (2 * pick - 1) / (2 * quota), event_type) AS turn FROM p),
names AS (SELECT list(event_type ORDER BY event_type) AS names FROM (SELECT DISTINCT event_type FROM events)),
c AS (SELECT t.turn, n.name, count(*) FILTER (WHERE t.event_type = n.name) OVER (PARTITION BY n.name ORDER BY t.turn) - CASE WHEN t.event_type = n.name THEN 1 ELSE 0 END AS k
  FROM t JOIN (SELECT unnest(names) AS name FROM names) n ON true)
SELECT t.turn, event_type, event_id, pick, (SELECT max(b) FROM (SELECT turn, string_agg(CAST(k AS VARCHAR), ',' ORDER BY name) AS b FROM c GROUP BY turn) x WHERE x.turn = t.turn) AS before FROM t
""")
def quota_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events take turns by what is left of their types' quotas; with each turn, the picks
    of every type before it."""
    events = table(spark, sf_dir, "events").select("event_type", "event_id")
    quotas = {r[0]: r[1] for r in events.groupBy("event_type").count().orderBy("event_type").collect()}  # a handful
    dealt = S.apportioned(S.numbered(events, "event_type", "event_id"), "event_type", "pick", quotas)
    return dealt.select("turn", "event_type", "event_id", "pick", F.array_join(F.col("before").cast("array<string>"), ",").alias("before"))


@query("""
WITH w AS (SELECT c_custkey, CAST(floor(c_acctbal) AS BIGINT) AS weight FROM customer WHERE floor(c_acctbal) > 0),
s AS (SELECT c_custkey, weight, CAST(sum(weight) OVER (ORDER BY sha256('42:' || c_custkey), c_custkey ROWS UNBOUNDED PRECEDING) AS BIGINT) AS high, CAST(sum(weight) OVER () AS BIGINT) AS total FROM w),
r AS (SELECT event_id, CAST(floor(CAST('0x' || left(sha256('5:' || event_id), 8) AS BIGINT) / 4294967296.0 * (SELECT max(CAST(total AS DOUBLE)) FROM s)) AS BIGINT) AS spot FROM events)
SELECT event_id, c_custkey FROM r JOIN s ON spot >= high - weight AND spot < high
""")
def roulette_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer for each event, by a draw weighted with the customers' balances."""
    weights = table(spark, sf_dir, "customer").select("c_custkey", F.floor("c_acctbal").alias("weight"))
    events = table(spark, sf_dir, "events").select("event_id")
    return S.roulette(events, S.roll(5, F.col("event_id")), S.spans(weights, "c_custkey", "weight"), "c_custkey")


@query("""
WITH e AS (SELECT *, CAST(ts AS DATE) AS day FROM events WHERE ts IS NOT NULL),
j AS (SELECT day, CAST(sum(n) OVER (ORDER BY day RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW) AS BIGINT) AS n_rows FROM (SELECT day, count(*) AS n FROM e GROUP BY day)),
s AS (SELECT j.day AS journal_day, n_rows, event_id, value, row_number() OVER (PARTITION BY j.day, user_id, event_type ORDER BY value DESC, event_id) AS rn
  FROM j JOIN e ON e.day <= j.day AND e.day > j.day - INTERVAL 7 DAYS),
p AS (SELECT *, row_number() OVER (PARTITION BY journal_day ORDER BY value DESC, event_id) AS place FROM s WHERE rn = 1)
SELECT journal_day, CAST(place AS INTEGER) AS place, event_id, value, n_rows FROM p WHERE place <= 30
""")
def weekly_journal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each day, the thirty best items of the seven days up to it, each once."""
    events = table(spark, sf_dir, "events")
    listed = weekly(events, "ts", ["user_id", "event_type"], [F.desc("value"), F.col("event_id")])
    return listed.select("journal_day", "place", "event_id", "value", "n_rows")
