"""Files written and read back: latest of several, merged, hashed, appended, logged."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.render import report
from ..session import table, work_path
from ..sources import hashed, jsonl
from ..streaming.incremental import append_new, appended, resume_counts, run_once
from ..transforms import built_in, evaluating, manufacturing
from .base import PAIRS_SQL, pairs, query
from .entry_queries import _GOOD, _LINE


@query("""
SELECT n_regionkey, row_number() OVER (ORDER BY n_nationkey) - 1 AS place, n_name AS title, CAST(n_nationkey AS BIGINT) AS score
FROM nation WHERE n_regionkey = (SELECT max(n_regionkey) FROM nation)
""")
def latest_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An envelope a region, as daily files; the items of the latest."""
    folder = work_path(spark, "daily")
    regions: dict[int, list] = {}
    for r in table(spark, sf_dir, "nation").orderBy("n_nationkey").collect():  # a small dimension
        regions.setdefault(r.n_regionkey, []).append({"source": str(r.n_regionkey), "title": r.n_name, "score": r.n_nationkey})
    for key, items in regions.items():
        jsonl.write_json(spark, f"{folder}/signals_2024-01-{key + 1:02d}.json", {"date": f"2024-01-{key + 1:02d}", "total_signals": len(items), "signals": items})
    found = jsonl.envelope(spark, jsonl.latest(spark, folder))
    return found.select(F.col("source").cast("int").alias("n_regionkey"), F.col("ordinal").cast("long").alias("place"), "title", "score")


@query("SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS place FROM events")
def merged_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file of lines for each event type, merged in the types' order, read in order."""
    events = table(spark, sf_dir, "events").select("event_type", "event_id", F.to_json(F.struct("event_type", "event_id")).alias("line"))
    parts, path = jsonl.write_parts(events, work_path(spark, "types"), "event_type", F.col("line"), ["event_id"]), work_path(spark, "merged")
    frames = [jsonl.lines(spark, [folder]) for _, folder in sorted(parts.items())]  # each type's own files
    jsonl.merge_in_order([f.drop("source_ord") for f in frames], path, ["file", "block", "row"])
    rows = jsonl.parsed(jsonl.lines(spark, [path]), "event_type string, event_id long")
    arrival = Window.partitionBy("event_type").orderBy("source_ord", "file", "block", "row")
    return rows.select("record.*", "source_ord", "file", "block", "row").select("event_type", "event_id", F.row_number().over(arrival).cast("long").alias("place"))


@query("SELECT event_type AS category, count(*) AS written FROM events GROUP BY 1 UNION ALL SELECT 'none', 0")
def resume_line_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines already written for each category, one of which has no file."""
    events = table(spark, sf_dir, "events")
    folder = work_path(spark, "written")
    parts = jsonl.write_parts(events, folder, "event_type", F.to_json(F.struct("event_id")), ["event_id"])
    counts = resume_counts(spark, parts | {"none": f"{folder}/none"})
    return spark.createDataFrame(list(counts.items()), "category string, written long")


@query("""
SELECT '# Daily' || chr(10) || '**Date:** 2024-05-01' || chr(10) || '**Signals:** ' || count(*) || ' items from ' || count(DISTINCT source) || ' sources'
  || chr(10) || chr(10) || '---' || chr(10) || chr(10) || 'Longest: ' || max(length(text)) AS line FROM documents
""")
def markdown_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report written as one document and read back."""
    told = table(spark, sf_dir, "documents").agg(F.count("*").alias("n"), F.count_distinct("source").alias("sources"), F.max(F.length("text")).alias("longest")).first()
    path = f"{work_path(spark, 'report')}.md"
    jsonl.write_text(spark, path, report("Daily", "2024-05-01", told.n, told.sources, f"Longest: {told.longest}"))
    return spark.read.text(path, wholetext=True).select(F.col("value").alias("line"))


@query(f"""
WITH {PAIRS_SQL}, lined AS (SELECT pair_id, {_LINE} AS line FROM judged)
SELECT count(*) AS n, sha256(string_agg(line || chr(10), '' ORDER BY pair_id)) AS sha256, count(*) AS read_back FROM lined
""")
def hashed_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs' lines as one file of several parts: its digest and its lines."""
    path = work_path(spark, "hashed")
    told = jsonl.write_hashed(pairs(spark, sf_dir), path, "pair_id", F.col("line"), files=3)
    return spark.read.text(path).agg(F.count("*").alias("read_back")).select(F.lit(told.n).cast("long").alias("n"), F.lit(told.sha256).alias("sha256"), "read_back")


@query("""
SELECT coalesce(source, 'none') AS source, count(*) AS n, CAST(sum(octet_length(encode(line)) + 1) AS BIGINT) AS bytes, sha256(string_agg(line || chr(10), '' ORDER BY doc_id)) AS sha256,
  count(*) AS read_back
FROM (SELECT source, doc_id, '{"doc_id":' || doc_id || ',"text":' || to_json(text) || '}' AS line FROM documents) GROUP BY source
""")
def files_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file of documents for each source, hashed while it is written; its digest and size
    from the manifest, and its lines as they are read back."""
    docs, path = table(spark, sf_dir, "documents"), work_path(spark, "by-source")
    told = hashed.write_by(docs, path, F.col("source"), F.to_json(F.struct("doc_id", "text")), ["doc_id"])
    back = spark.read.text(path, pathGlobFilter="*.jsonl").groupBy(F.element_at(F.split("_metadata.file_name", "/"), -1).alias("file")).agg(F.count("*").alias("read_back"))
    return told.join(back, "file").select(F.coalesce("name", F.lit("none")).alias("source"), F.col("rows").alias("n"), "bytes", "sha256", "read_back")


@query("SELECT user_id, min(event_id) AS event_id FROM events GROUP BY user_id")
def append_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First event of each user over appends that overlap, the last one empty."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id")
    last = events.agg(F.max("event_id")).first()[0] or 0
    output = work_path(spark, "appended")
    for part in (events.where(F.col("event_id") <= last // 2), events.where(F.col("event_id") >= last // 3), events):
        append_new(part, output, F.col("user_id"), [F.col("event_id")])
    return appended(spark, output, events.schema).select("user_id", "event_id")


@query("""
WITH e AS (SELECT *, event_id <= (SELECT max(event_id) // 2 FROM events) AS early FROM events), u AS (SELECT user_id, bool_or(early) AS early FROM e GROUP BY user_id)
SELECT 0 AS batch, (SELECT count(*) FROM e WHERE early) AS read, (SELECT count(*) FROM u WHERE early) AS new, (SELECT count(*) FROM u WHERE early AND user_id % 2 = 0) AS kept
UNION ALL SELECT 1, (SELECT count(*) FROM e WHERE NOT early), (SELECT count(*) FROM u WHERE NOT early), (SELECT count(*) FROM u WHERE NOT early AND user_id % 2 = 0)
""")
def progress_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What two incremental runs tell of their batches, through files."""
    source, output, state, told = (work_path(spark, n) for n in ("arrivals", "kept", "progress", "told"))
    events = table(spark, sf_dir, "events").select("event_id", "user_id")
    middle = (events.agg(F.max("event_id")).first()[0] or 0) // 2
    tell = lambda snapshot: jsonl.write_json(spark, f"{told}/{uuid.uuid4().hex}.json", snapshot)
    for part in (events.where(F.col("event_id") <= middle), events.where(F.col("event_id") > middle)):
        part.write.mode("append").parquet(source)
        run_once(spark, source, events.schema, output, state, F.col("user_id"), [F.col("event_id")], lambda df: df.where("user_id % 2 = 0"), snapshot=tell)
    return spark.read.schema("batch int, read long, new long, kept long").json(told, multiLine=True)


@query(f"WITH {PAIRS_SQL} SELECT 2 * count(*) AS n, count(*) AS exact, 2 AS metrics FROM pairs")
def eval_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of a predictor that knows every answer, logged as JSONL and read back."""
    path = work_path(spark, "log")
    rows = pairs(spark, sf_dir).select(F.col("response").alias("instruction"), "response")
    built_in(evaluate=evaluating(lambda text: text, path=path))["evaluate"](pairs=rows)
    log = spark.read.schema("metric string, score double").json(path)
    return log.agg(F.count("*").alias("n"), F.count_if((F.col("metric") == "exact_match") & (F.col("score") == 1)).alias("exact"), F.count_distinct("metric").cast("int").alias("metrics"))


@query(f"""
WITH {PAIRS_SQL}, good AS (SELECT *, row_number() OVER (ORDER BY sha256('42:' || pair_id), pair_id) AS rank, count(*) OVER () AS total FROM judged WHERE {_GOOD}),
lined AS (SELECT *, {_LINE} AS line FROM good)
SELECT pair_id, line, CASE WHEN rank <= greatest(1, CAST(floor(total * 0.95) AS BIGINT)) THEN 'train' ELSE 'eval' END AS split FROM lined
""")
def split_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The factory's two files, read back."""
    paths = {split: work_path(spark, split) for split in ("train", "eval")}
    keyed = pairs(spark, sf_dir).select(F.col("pair_id").alias("ordinal"), "line")
    made = manufacturing(paths=paths)(lines=keyed)
    ids = made["train"].withColumn("split", F.lit("train")).unionByName(made["eval"].withColumn("split", F.lit("eval")))
    back = None
    for split, path in paths.items():
        rows = jsonl.in_order(spark, path).select(F.lit(split).alias("split"), "place", F.col("line").alias("found"))
        back = rows if back is None else back.union(rows)
    return ids.join(back, ["split", "place"]).select(F.col("ordinal").alias("pair_id"), F.col("found").alias("line"), "split")


#: Frames that a table's rows ask a transform of; the last name is nobody's.
_ASKED = ("cook", "factory", "collect", "evaluate", "assemble", "publish")


@query(f"""
SELECT name, CASE name WHEN 'publish' THEN NULL ELSE rank() OVER (ORDER BY name) END AS place,
  CASE name WHEN 'assemble' THEN 'records' WHEN 'collect' THEN 'items' WHEN 'cook' THEN 'scenarios' WHEN 'evaluate' THEN 'pairs' WHEN 'factory' THEN 'lines' END AS inputs,
  CASE WHEN name = 'evaluate' THEN '' WHEN name <> 'publish' THEN 'missing' END AS problems, n
FROM (SELECT ({list(_ASKED)})[CAST(event_id % {len(_ASKED)} AS INTEGER) + 1] AS name, count(*) AS n FROM events GROUP BY 1)
""")
def transform_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names that events ask for, looked up in the catalogue of built-in transforms: its
    order, the inputs declared, and whether a frame of pairs would do."""
    known, frames = built_in(), {"pairs": pairs(spark, sf_dir)}
    rows = [(name, place, ",".join(step.inputs), "; ".join(p.split(": ")[1] for p in step.problems(frames))) for place, (name, step) in enumerate(known.items(), 1)]
    steps = spark.createDataFrame(rows, "name string, place long, inputs string, problems string")
    name = F.element_at(F.array(*map(F.lit, _ASKED)), (F.col("event_id") % len(_ASKED) + 1).cast("int"))
    asked = table(spark, sf_dir, "events").groupBy(name.alias("name")).agg(F.count("*").alias("n"))
    return asked.join(F.broadcast(steps), "name", "left")  # a row for each transform
