"""Runs that go on over time: keys in a state store, progress, several writers."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.evaluate import results
from ..operators.generate import GenerationError, Stopped, generate
from ..session import table, work_path
from ..sources import jsonl
from ..sources.commit_log import CommitLog
from ..streaming.incremental import result
from ..streaming.stateful import run_stateful
from .base import PAIRS_SQL, pairs, query


@query("SELECT user_id, min(event_id) AS event_id FROM events GROUP BY user_id")
def resume_stateful(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First event of each user over three runs of a growing folder, the second of which
    fails while it writes and is run again."""
    source, output, state = (work_path(spark, n) for n in ("arrivals", "kept", "progress"))
    events = table(spark, sf_dir, "events").select("event_id", "user_id")
    size = (events.agg(F.max("event_id")).first()[0] or 0) + 1
    run = lambda keep: run_stateful(spark, source, events.schema, output, state, F.col("user_id"), [F.col("event_id")], keep)
    whole = lambda df: df
    broken = lambda df: df.where(F.when(F.col("user_id") >= 0, F.raise_error(F.lit("stopped")).cast("boolean")))
    for third in range(3):
        events.where(F.floor(F.col("event_id") * 3 / size) == third).write.mode("append").parquet(source)
        if third == 1:
            try:
                run(broken)
            except Exception as error:
                if "stopped" not in str(error):
                    raise
        run(whole)
    return result(spark, output).select("user_id", "event_id")


@query("""
WITH e AS (SELECT *, event_id * 4 // (SELECT max(event_id) + 1 FROM events) AS batch FROM events),
u AS (SELECT user_id, min(batch) AS batch FROM e GROUP BY user_id)
SELECT CAST(batch AS BIGINT) AS batch, read, coalesce(new, 0) AS new, coalesce(kept, 0) AS kept
FROM (SELECT batch, count(*) AS read FROM e GROUP BY batch) LEFT JOIN (SELECT batch, count(*) AS new, count(*) FILTER (WHERE user_id % 2 = 0) AS kept FROM u GROUP BY batch) USING (batch)
""")
def progress_listener(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a listener hears of one run in four triggers: rows read, new, and kept."""
    source, output, state, told = (work_path(spark, n) for n in ("arrivals", "kept", "progress", "told"))
    events = table(spark, sf_dir, "events").select("event_id", "user_id")
    size = (events.agg(F.max("event_id")).first()[0] or 0) + 1
    for quarter in range(4):  # a file each, the oldest first
        events.where(F.floor(F.col("event_id") * 4 / size) == quarter).coalesce(1).write.mode("append").parquet(source)
    tell = lambda snapshot: jsonl.write_json(spark, f"{told}/{uuid.uuid4().hex}.json", snapshot)
    run_stateful(spark, source, events.schema, output, state, F.col("user_id"), [F.col("event_id")], lambda df: df.where("user_id % 2 = 0"), files=1, tell=tell)
    return spark.read.schema("batch long, read long, new long, kept long").json(told, multiLine=True)


@query("""
WITH odd AS (SELECT user_id, min(event_id) AS event_id, CAST(1 AS BIGINT) AS entry FROM events WHERE event_id % 2 = 1 GROUP BY user_id),
even AS (SELECT user_id, min(event_id) AS event_id, CAST(2 AS BIGINT) AS entry FROM events WHERE event_id % 2 = 0 AND user_id NOT IN (SELECT user_id FROM odd) GROUP BY user_id)
SELECT * FROM odd UNION ALL SELECT * FROM even
""")
def shared_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two writers with common users, both drafts made before either is committed; the
    later one judges its users again. A third has nothing new."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id")
    path = work_path(spark, "shared")
    writer = lambda: CommitLog(spark, path, events.schema)
    told = F.col("user_id"), [F.col("event_id")]
    even, odd = writer().draft(events.where("event_id % 2 = 0"), *told), writer().draft(events.where("event_id % 2 = 1"), *told)
    writer().commit(odd)
    writer().commit(even)
    writer().append(events, *told)
    return writer().read()


@dataclass(frozen=True)
class Refusing:
    """A stub that repeats its prompt, and has no credit for some of them."""

    refuses: bool

    def complete(self, prompt: str, max_tokens: int) -> str:
        if self.refuses and len(prompt) % 20 == 7:
            raise GenerationError(403)
        return f"> {prompt}"


@query("""
WITH p AS (SELECT DISTINCT text FROM conversations WHERE text IS NOT NULL), n AS (SELECT count(*) AS n, count(*) FILTER (WHERE length(text) % 20 = 7) AS bad FROM p)
SELECT n AS prompts, bad > 0 AS stopped, bad > 0 AS cancelled, n AS answered, CAST(0 AS BIGINT) AS twice, n AS in_parts, (SELECT CAST(sum(length(text) + 2) AS BIGINT) FROM conversations) AS chars FROM n
""")
def fatal_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as prompts of a run that a refusal ends, and the run that takes it up: what
    either answered makes up the whole, and nothing was asked for twice."""
    store = work_path(spark, "answers")
    prompts = table(spark, sf_dir, "conversations").select("text").withColumnRenamed("text", "prompt").withColumns({"max_tokens": F.lit(10), "min_len": F.lit(0)})
    answered = cancelled = 0
    try:
        generate(prompts, Refusing(True), store=store)
    except Stopped as told:
        answered, cancelled = told.answered, told.cancelled
    made = generate(prompts, Refusing(False), store=store)
    files = spark.read.schema("prompt_key string").parquet(f"{store}/answers").agg(F.count("*").alias("rows"), F.count_distinct("prompt_key").alias("answered")).first()
    whole = made.agg(F.count_distinct("prompt").alias("prompts"), F.sum(F.length("text")).cast("long").alias("chars"))
    return whole.select(
        "prompts", F.lit(cancelled > 0).alias("stopped"), F.lit(cancelled > 0).alias("cancelled"), F.lit(files.answered).cast("long").alias("answered"),
        F.lit(files.rows - files.answered).cast("long").alias("twice"), F.lit(answered + cancelled if cancelled else files.answered).cast("long").alias("in_parts"), "chars",
    )


class Overlap:
    """Shared words of prediction and reference, lengths, and, of short ones, equality."""

    def score(self, predictions: list[str | None], references: list[str | None]) -> Iterator[dict[str, float]]:
        for said, wanted in zip(predictions, references, strict=True):
            a, b = set((said or "").split(" ")), set((wanted or "").split(" "))
            out = {"shared": len(a & b) / len(a | b), "longer": float(len(said or "") > len(wanted or ""))}
            if len(wanted or "") < 500:
                out["exact"] = float(said == wanted)
            yield out


@query(f"""
WITH {PAIRS_SQL}, w AS (SELECT pair_id, instruction, response, list_distinct(string_split(instruction, ' ')) AS a, list_distinct(string_split(response, ' ')) AS b FROM pairs),
s AS (SELECT pair_id, 'shared' AS metric, len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))) AS score FROM w
  UNION ALL SELECT pair_id, 'longer', CASE WHEN length(instruction) > length(response) THEN 1.0 ELSE 0.0 END FROM w
  UNION ALL SELECT pair_id, 'exact', CASE WHEN instruction = response THEN 1.0 ELSE 0.0 END FROM w WHERE length(response) < 500)
SELECT pair_id, metric, round(CAST(score AS DOUBLE), 9) AS score FROM s
""")
def own_scorer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs scored by a scorer of three metrics, one of which long answers don't have."""
    rows = results(pairs(spark, sf_dir), F.col("instruction"), F.col("response"), "run", "model", "now", metrics=Overlap(), keep=["pair_id"])
    return rows.select("pair_id", "metric", F.round("score", 9).alias("score"))
