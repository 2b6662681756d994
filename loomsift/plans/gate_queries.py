"""Quality gates, contracts and policies."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import count_any
from ..operators import gates as G
from ..operators.contracts import EVAL, MANIFEST, errors, good_pair, missing_inputs, validated
from ..operators.evaluate import SANITY_LENGTHS, averaged, expectations, expected, results
from ..operators.policy import config_issues, protected, training_steps
from ..operators.profile import manifest as manifest_of
from ..operators.split import factory_split
from ..session import table
from .base import ASCII_WORDS, BANNED, CATEGORIES_2, GENERIC, PAIRS_SQL, category, category_sql, pairs, query

#: The two gate profiles, with words that occur in the driver's data, and without the
#: degeneration test where DuckDB must follow.
FIRST = replace(G.FIRST, banned=BANNED, degenerate=False)
SECOND = replace(G.SECOND, banned=BANNED, generic=GENERIC, degenerate=False)
#: The same with looser limits, under which more checks decide.
LOOSE = replace(SECOND, banned_most=9, generic_most=9, structure=0)


def _count(pattern: str, text: str = "t") -> str:
    return f"CAST(len(regexp_extract_all({text}, '{pattern}')) AS BIGINT)"


def _case(values: dict, default: int, c: str = "category") -> str:
    return f"CASE {c} {' '.join(f'WHEN {k!r} THEN {v}' for k, v in values.items())} ELSE {default} END"


_WORDS = f"(?i)\\b({'|'.join(BANNED)})\\b"
_GENERIC = f"(?i)\\b({'|'.join(GENERIC)})\\b"
_DOCS = f"d AS (SELECT doc_id, text, {ASCII_WORDS} AS t, {category_sql('doc_id')} AS category FROM documents)"
_DOCS_2 = f"d AS (SELECT doc_id, text, {ASCII_WORDS} AS t, {category_sql('doc_id', CATEGORIES_2)} AS category FROM documents)"


def docs(spark: SparkSession, sf_dir: str, names: tuple[str, ...] | None = None) -> DataFrame:
    named = category(F.col("doc_id"), names) if names else category(F.col("doc_id"))
    return table(spark, sf_dir, "documents").select("doc_id", "text", named.alias("category"))


@query(f"WITH {_DOCS} SELECT doc_id, length(text) >= {_case(G.FIRST_LENGTHS, 500)} AS long_enough FROM d")
def gate_len(spark: SparkSession, sf_dir: str) -> DataFrame:
    least = G.lookup(G.FIRST_LENGTHS, F.col("category"), 500)
    return docs(spark, sf_dir).select("doc_id", (F.length("text") >= least).alias("long_enough"))


@query(f"WITH {_DOCS} SELECT doc_id, {_count(_WORDS)} AS n_banned, {_count(_GENERIC)} AS n_generic FROM d")
def gate_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    return docs(spark, sf_dir).select("doc_id", count_any(text, BANNED).alias("n_banned"), count_any(text, GENERIC).alias("n_generic"))


@query(f"WITH {_DOCS} SELECT doc_id, {_count(G.SPECIFIC)} AS n_first, {_count(G.SPECIFIC + G.UNITS)} AS n_second FROM d")
def gate_specifics(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    return docs(spark, sf_dir).select("doc_id", G.specifics(text).alias("n_first"), G.specifics(text, G.SPECIFIC + G.UNITS).alias("n_second"))


_LISTED = "replace(replace(text, chr(10), chr(10) || '- '), '. ', '.' || chr(10) || '## ')"


@query(f"SELECT doc_id, {_count(G.STRUCTURE, _LISTED)} AS n_structure FROM documents")
def gate_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their lines made list items and sentences made headings."""
    listed = F.replace(F.replace("text", F.lit("\n"), F.lit("\n- ")), F.lit(". "), F.lit(".\n## "))
    return docs(spark, sf_dir).select("doc_id", G.structure(listed).alias("n_structure"))


#: A unit of 40 characters or more that comes three times starts with the same 40
#: characters each time, so its length is a distance between two places of those.
_DEGENERATE = """
WITH line AS (SELECT rid, row_number() OVER () AS lid, line FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM (SELECT row_number() OVER () AS rid, text FROM documents)) WHERE length(line) >= 120),
place AS (SELECT lid, i, substr(line, i, 40) AS w FROM (SELECT lid, line, unnest(range(1, length(line) - 38)) AS i FROM line)),
often AS (SELECT lid, w FROM place GROUP BY lid, w HAVING count(*) >= 3),
held AS (SELECT lid, i, w FROM place SEMI JOIN often USING (lid, w)),
unit AS (SELECT a.lid, a.i, b.i - a.i AS p FROM held a JOIN held b ON a.lid = b.lid AND a.w = b.w AND b.i - a.i >= 40 JOIN held c ON c.lid = a.lid AND c.w = a.w AND c.i = 2 * b.i - a.i),
bad AS (SELECT DISTINCT rid FROM unit JOIN line USING (lid) WHERE substr(line, i, p) = substr(line, i + p, p) AND substr(line, i, p) = substr(line, i + 2 * p, p))
"""


#: The same by the distance of a window to the next equal one, for windows of 40, 80, 160,
#: ... characters: a stretch of smallest period d shows as a run of distances d as soon as
#: the windows are as long as d. Lines without equal windows go no further. Windows are
#: cut from blocks, since a cut far into a text takes as long as the way there.
_RUNS = """
WITH RECURSIVE numbered AS MATERIALIZED (SELECT doc_id, text, row_number() OVER () AS rid FROM documents),
line AS (SELECT rid, row_number() OVER () AS lid, line FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM numbered) WHERE length(line) >= 120),
block AS (SELECT lid, b * 500 AS base, substr(line, b * 500 + 1, 539) AS s FROM (SELECT lid, line, unnest(range(0, (length(line) + 499) // 500)) AS b FROM line)),
place AS (SELECT lid, base + i AS i, hash(substr(s, i, 40)) AS h FROM (SELECT lid, base, s, unnest(range(1, least(501, length(s) - 38))) AS i FROM block)),
step AS (
  SELECT lid, i, h, lead(i) OVER (PARTITION BY lid, h ORDER BY i) - i AS lag, CAST(40 AS BIGINT) AS size FROM place
  UNION ALL
  SELECT lid, i, h, lead(i) OVER (PARTITION BY lid, h ORDER BY i) - i AS lag, 2 * size FROM (
    SELECT lid, i, size, hash(h, lead(h, CAST(size AS INTEGER)) OVER (PARTITION BY lid ORDER BY i)) AS h, lead(i, CAST(size AS INTEGER)) OVER (PARTITION BY lid ORDER BY i) AS other
    FROM (SELECT *, max(lag) OVER (PARTITION BY lid) AS recurs FROM step) WHERE recurs IS NOT NULL) WHERE other IS NOT NULL),
run AS (SELECT lid, size, lag, count(*) AS n FROM (SELECT lid, size, lag, i - row_number() OVER (PARTITION BY lid, size, lag ORDER BY i) AS part FROM step WHERE lag <= size) GROUP BY lid, size, lag, part),
bad AS (SELECT DISTINCT rid FROM run JOIN line USING (lid) WHERE n + size - 1 + lag >= 3 * lag * CAST(ceil(40 / lag) AS BIGINT))
"""


#: Twins by comparing every pair of equal windows, too slow for whole tables; tests run
#: them on the smallest beside the registered ones.
SLOW = {"gate_degenerate": f"{_DEGENERATE} SELECT doc_id, rid IN (SELECT rid FROM bad) AS degenerate FROM (SELECT doc_id, row_number() OVER () AS rid FROM documents)"}


@query(f"{_RUNS} SELECT doc_id, rid IN (SELECT rid FROM bad) AS degenerate FROM numbered")
def gate_degenerate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(spark, sf_dir).select("doc_id", G.degenerate(F.col("text")).alias("degenerate"))


def _verdict_sql(source: str, lengths: dict, length: int, specific: dict, least: int, pattern: str, banned: int, generic: int | None, structure: int, structured: str) -> str:
    told = f"WHEN n_generic > {generic} THEN 'generic_blog_' || n_generic" if generic is not None else ""
    return f"""
WITH {source}, m AS (SELECT doc_id, category, CAST(length(text) AS BIGINT) AS n, {_case(lengths, length)} AS need,
  {_count(_WORDS)} AS n_banned, {_count(_GENERIC)} AS n_generic, {_count(pattern)} AS n_specific, {_case(specific, least)} AS need_specific,
  {_count(G.STRUCTURE, 'text')} AS n_structure FROM d),
v AS (SELECT doc_id, CASE WHEN n < need THEN 'too_short_' || n || '/' || need
  WHEN n_banned > {banned} THEN 'corporate_speak_' || n_banned {told}
  WHEN n_specific < need_specific THEN 'vague_' || n_specific || '/' || need_specific
  WHEN {structured} AND n_structure < {structure} THEN 'no_structure_' || n_structure ELSE 'pass' END AS reason FROM m)
SELECT doc_id, reason = 'pass' AS passed, reason FROM v
"""


@query(_verdict_sql(_DOCS, G.FIRST_LENGTHS, 500, G.FIRST_SPECIFICS, 5, G.SPECIFIC, 2, None, 3, "category IN ('briefing', 'journal')"))
def gate_verdict_v1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.gated(docs(spark, sf_dir), F.col("text"), F.col("category"), FIRST).select("doc_id", "passed", "reason")


@query(_verdict_sql(_DOCS_2, G.SECOND_LENGTHS, 600, G.SECOND_SPECIFICS, 8, G.SPECIFIC + G.UNITS, 1, 0, 2, "true"))
def gate_verdict_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.gated(docs(spark, sf_dir, CATEGORIES_2), F.col("text"), F.col("category"), SECOND).select("doc_id", "passed", "reason")


@query(_verdict_sql(_DOCS_2, G.SECOND_LENGTHS, 600, G.SECOND_SPECIFICS, 8, G.SPECIFIC + G.UNITS, 9, 9, 0, "true"))
def gate_verdict_v2_loose(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.gated(docs(spark, sf_dir, CATEGORIES_2), F.col("text"), F.col("category"), LOOSE).select("doc_id", "passed", "reason")


_FULL = (
    _verdict_sql(_DOCS, G.FIRST_LENGTHS, 500, G.FIRST_SPECIFICS, 5, G.SPECIFIC, 2, None, 3, "category IN ('briefing', 'journal')").strip().removeprefix("WITH")
    .replace("WHEN n_banned >", "WHEN doc_id IN (SELECT doc_id FROM named WHERE rid IN (SELECT rid FROM bad)) THEN 'degenerate' WHEN n_banned >", 1)
)
SLOW["gate_verdict_full"] = f"{_DEGENERATE}, named AS (SELECT doc_id, row_number() OVER () AS rid FROM documents), {_FULL}"


@query(f"{_RUNS}, named AS (SELECT doc_id, rid FROM numbered), {_FULL}")
def gate_verdict_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole first gate, degeneration included."""
    return G.gated(docs(spark, sf_dir), F.col("text"), F.col("category"), replace(FIRST, degenerate=True)).select("doc_id", "passed", "reason")


#: Header gates over strings that occur in the driver's prose.
HEADERS = {"briefing": G.HeaderGate(300, ("the ", "ing", "tion")), "trends": G.HeaderGate(500, ("and ", "er")), "company": G.HeaderGate(800, ("or ",))}


@query(f"WITH {_DOCS} SELECT doc_id, CASE category " + " ".join(
    f"WHEN '{k}' THEN length(text) >= {g.least} AND " + " AND ".join(f"contains(text, '{h}')" for h in g.headers) for k, g in HEADERS.items()
) + " ELSE true END AS passed FROM d")
def gate_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(spark, sf_dir).select("doc_id", G.header_verdict(F.col("text"), F.col("category"), HEADERS).alias("passed"))


_MARKED = {name: " ".join(gate.headers) for name, gate in G.HEADER_GATES.items()}
_KINDS = tuple(_MARKED)


@query(f"""
WITH d AS (SELECT doc_id, {category_sql('doc_id', _KINDS)} AS kind, text FROM documents),
m AS (SELECT doc_id, kind, text || CASE WHEN doc_id % 2 = 0 THEN CASE kind {' '.join(f"WHEN '{k}' THEN ' {h}'" for k, h in _MARKED.items())} END WHEN doc_id % 5 = 0 THEN ' NAME: SIGNAL:' ELSE '' END AS text FROM d)
SELECT doc_id, kind, CASE kind {' '.join(f"WHEN '{k}' THEN length(text) >= {g.least} AND " + ' AND '.join(f"contains(text, '{h}')" for h in g.headers) for k, g in G.HEADER_GATES.items())} END AS passed FROM m
""")
def gate_headers_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three structured formats' own headers, put into every second document."""
    kind = category(F.col("doc_id"), _KINDS)
    headers = F.create_map(*[F.lit(x) for item in _MARKED.items() for x in item])[kind]
    ending = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit(" "), headers)).when(F.col("doc_id") % 5 == 0, F.lit(" NAME: SIGNAL:")).otherwise("")
    marked = table(spark, sf_dir, "documents").select("doc_id", kind.alias("kind"), F.concat("text", ending).alias("text"))
    return marked.select("doc_id", "kind", G.header_verdict(F.col("text"), F.col("kind")).alias("passed"))


#: What is wrong with a pair's line, by conv_id % 7.
_WRONG = """
WITH {pairs}, v AS (SELECT pair_id, instruction, response, extra, score, conv_id % 7 AS kind,
  CASE WHEN length(instruction) < 10 THEN 'Field ''instruction'': length ' || length(instruction) || ' < minLength 10' END AS short_i,
  CASE WHEN length(response) < 50 THEN 'Field ''response'': length ' || length(response) || ' < minLength 50' END AS short_r FROM pairs)
SELECT pair_id, CASE kind WHEN 5 THEN 'malformed' ELSE array_to_string(list_sort(list_filter([
  CASE WHEN kind = 2 THEN 'Field ''instruction'': expected string' ELSE short_i END, CASE WHEN kind = 6 THEN 'Missing required field: response' ELSE short_r END,
  CASE kind WHEN 1 THEN 'Field ''score'': expected number' WHEN 2 THEN NULL WHEN 3 THEN 'Field ''score'': above maximum 1.0' WHEN 4 THEN 'Field ''score'': below minimum 0.0' WHEN 6 THEN NULL ELSE NULL END,
  CASE WHEN kind = 6 THEN 'Missing required field: domain' END, CASE WHEN kind = 0 THEN 'Unexpected field: more' END], lambda x: x IS NOT NULL)), '; ') END AS errors FROM v
"""


@query(_WRONG.format(pairs=PAIRS_SQL))
def contract_errors_varied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with a wrong type, a bound passed, a field too many or too few, or cut off."""
    told = pairs(spark, sf_dir).withColumn("domain", F.lit("test"))
    line = lambda score, *names, **extra: F.to_json(F.struct(*names, F.lit(score).alias("score"), *(F.lit(v).alias(k) for k, v in extra.items())))
    whole = ("instruction", "response", "domain")
    kinds = [
        line(0.5, *whole, more=1), line("x", *whole), line(True, F.lit(5).alias("instruction"), "response", "domain"), line(1.5, *whole),
        line(-0.25, *whole), F.concat(F.lit("{"), line(0.5, *whole)), line(1, "instruction"),
    ]
    chosen = F.coalesce(*[F.when(F.col("conv_id") % 7 == k, made) for k, made in enumerate(kinds)])
    return validated(told.select("pair_id", chosen.alias("line")), "line").select("pair_id", F.array_join("errors", "; ").alias("errors"))


@query(f"WITH {PAIRS_SQL} SELECT pair_id, array_to_string(errors, '; ') AS errors FROM judged")
def contract_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validated(pairs(spark, sf_dir), "line").select("pair_id", F.array_join("errors", "; ").alias("errors"))


@query(f"WITH {PAIRS_SQL} SELECT pair_id, len(errors) = 0 AS valid FROM judged")
def contract_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validated(pairs(spark, sf_dir), "line").select("pair_id", (F.size("errors") == 0).alias("valid"))


_GOOD = "len(errors) = 0 AND length(instruction) + length(response) BETWEEN 200 AND 32000 AND score >= 0.7"


@query(f"WITH {PAIRS_SQL} SELECT pair_id FROM judged WHERE {_GOOD}")
def pair_quality_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = validated(pairs(spark, sf_dir), "line")
    return rows.where(good_pair(F.col("instruction"), F.col("response"), F.col("score"), F.col("errors"))).select("pair_id")


@query(f"""
WITH {PAIRS_SQL}, good AS (SELECT *, row_number() OVER (ORDER BY sha256('42:' || pair_id), pair_id) AS rank, count(*) OVER () AS total FROM judged WHERE {_GOOD}),
cut AS (SELECT *, CASE WHEN rank <= greatest(1, CAST(floor(total * 0.95) AS BIGINT)) THEN 'train' ELSE 'eval' END AS split FROM good)
SELECT 'pairs' AS name, (SELECT count(*) FROM good) AS pair_count,
  (SELECT count(*) FROM cut WHERE split = 'train') AS train_count, (SELECT count(*) FROM cut WHERE split = 'eval') AS eval_count,
  (SELECT sha256(coalesce(string_agg(CAST(pair_id AS VARCHAR) || chr(10), '' ORDER BY rank), '')) FROM cut WHERE split = 'train') AS train_sha256,
  (SELECT sha256(coalesce(string_agg(CAST(pair_id AS VARCHAR) || chr(10), '' ORDER BY rank), '')) FROM cut WHERE split = 'eval') AS eval_sha256,
  (SELECT count(*) FROM judged WHERE NOT coalesce({_GOOD}, false)) AS rejected
""")
def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Split, counts and content digests; a pair's line is its id here."""
    rows = validated(pairs(spark, sf_dir), "line")
    good = F.coalesce(good_pair(F.col("instruction"), F.col("response"), F.col("score"), F.col("errors")), F.lit(False))
    judged = rows.select("pair_id", good.alias("good"))
    cut = factory_split(judged.where("good"), "pair_id")
    head = F.greatest(F.lit(1), F.floor(F.col("total") * 0.95))
    placed = cut.withColumn("place", F.col("rank") - F.when(F.col("split") == "eval", head).otherwise(0))
    return manifest_of(placed, F.col("pair_id").cast("string"), "pairs", ~F.col("good"), judged)


#: What is wrong with a document's manifest, by doc_id % 7, and with a label's evaluation
#: record, by doc_id % 5; the rest depends on the text's length and the label.
_CONTRACTS = """
WITH m AS (SELECT doc_id, doc_id % 7 AS kind, coalesce(length(text), 0) AS n FROM documents),
e AS (SELECT doc_id, doc_id % 5 AS kind, toxic FROM labels),
said AS (
  SELECT 'manifest' AS contract, doc_id, CASE kind WHEN 3 THEN ['malformed'] ELSE [
    CASE WHEN kind = 1 OR n < 1 THEN 'Field ''pair_count'': below minimum 1' END,
    CASE WHEN kind = 1 THEN 'Field ''version'': does not match the pattern' END,
    CASE WHEN kind = 1 THEN 'Field ''vertical'': not one of the allowed values' END,
    CASE WHEN kind = 1 THEN 'Missing required field: splits.train' END,
    CASE WHEN kind <> 1 AND n < 1 THEN 'Field ''splits.train.count'': below minimum 1' END,
    CASE WHEN kind = 2 THEN 'Field ''name'': expected string' END,
    CASE WHEN kind = 2 THEN 'Field ''splits.train.sha256'': does not match the pattern' END,
    CASE WHEN kind = 2 THEN 'Unexpected field: splits.more' END,
    CASE WHEN kind = 2 AND n > 1000 THEN 'Field ''format_distribution.x'': out of bounds' END,
    CASE WHEN kind = 4 AND n < 501 THEN 'Field ''splits.eval.count'': below minimum 1' END,
    CASE WHEN kind = 5 THEN 'Missing required field: name' END,
    CASE WHEN kind = 5 THEN 'Unexpected field: title' END] END AS errors FROM m
  UNION ALL SELECT 'eval', doc_id, [
    CASE WHEN kind = 1 THEN 'Field ''metric'': not one of the allowed values' END,
    CASE WHEN kind = 1 THEN 'Field ''score'': expected number' END,
    CASE WHEN kind = 2 THEN 'Missing required field: score' END,
    CASE WHEN kind = 3 THEN 'Field ''vertical'': not one of the allowed values' END,
    CASE WHEN kind <> 4 AND toxic < 1 THEN 'Field ''samples'': below minimum 1' END,
    CASE WHEN kind = 4 THEN 'Unexpected field: label' END] FROM e)
SELECT contract, doc_id, array_to_string(list_sort(list_filter(errors, lambda x: x IS NOT NULL)), '; ') AS errors FROM said
"""


def _manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest line for each document."""
    text = F.coalesce("text", F.lit(""))
    n, kind = F.length(text), F.col("doc_id") % 7
    named = lambda **fields: F.struct(*(F.lit(v).alias(k) for k, v in fields.items()))
    side = lambda count, **more: named(path="part", count=count, sha256=F.sha2(text, 256), **more)
    line = lambda splits, **fields: F.to_json(named(**({"name": F.coalesce("source", F.lit("none")), "version": "v1", "vertical": "core", "pair_count": n, "splits": splits} | fields)))
    train = named(train=side(n))
    kinds = [
        line(train), line(named(), version="1", vertical="other", pair_count=0),
        line(named(train=named(path="part", count=n, sha256="zz"), more=1), name=5, format_distribution=named(x=n / 1000)), F.concat(F.lit("{"), text),
        line(named(train=side(n), eval=side(n - 500))), F.to_json(named(title="t", version="v2", vertical="signal", pair_count=n, splits=train)),
        line(train, created_at="2024-01-01", format_distribution=named(x=0.5), metadata=named(note="x")),
    ]
    return table(spark, sf_dir, "documents").select("doc_id", F.coalesce(*[F.when(kind == i, made) for i, made in enumerate(kinds)]).alias("line"))


def _evaluations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line of an evaluation log for each label."""
    kind = F.col("doc_id") % 5
    told = lambda **fields: F.to_json(F.struct(F.lit("r").alias("run_id"), F.lit("m").alias("model"), *(F.lit(v).alias(k) for k, v in fields.items())))
    score, samples = F.col("quality").cast("double"), F.col("toxic")
    kinds = [
        told(metric="accuracy", score=score, samples=samples), told(metric="length_ratio", score="x", samples=samples), told(metric="loss", samples=samples),
        told(metric="structure", score=score, samples=samples, vertical="none", timestamp="2024"), told(metric="relevance", score=F.col("quality"), label=samples),
    ]
    return table(spark, sf_dir, "labels").select("doc_id", F.coalesce(*[F.when(kind == i, made) for i, made in enumerate(kinds)]).alias("line"))


@query(_CONTRACTS)
def contract_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifests of all documents and evaluation records of all labels against their contracts."""
    told = lambda rows, contract, name: rows.select(F.lit(name).alias("contract"), "doc_id", F.array_join(errors(F.col("line"), contract), "; ").alias("errors"))
    return told(_manifests(spark, sf_dir), MANIFEST, "manifest").union(told(_evaluations(spark, sf_dir), EVAL, "eval"))


_PLACES = ("core", "docs/core", "tests", "./core", "contracts", "src", "Core", "core.d")


@query(f"""
WITH p AS (SELECT page_id, ({list(_PLACES)})[CAST(page_id % {len(_PLACES)} AS INTEGER) + 1] || '/' || regexp_extract(url, '://[^/]*/([^?#]*)', 1) AS path FROM pages)
SELECT page_id, path, starts_with(path, 'core/') OR starts_with(path, 'contracts/') OR starts_with(path, 'tests/') AS protected FROM p
""")
def protected_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages' paths below folders of which some are protected and some only look so."""
    folder = F.element_at(F.array(*map(F.lit, _PLACES)), (F.col("page_id") % len(_PLACES) + 1).cast("int"))
    path = F.concat(folder, F.lit("/"), F.regexp_extract("url", "://[^/]*/([^?#]*)", 1))
    return table(spark, sf_dir, "pages").select("page_id", path.alias("path"), protected(path).alias("protected"))


@query("""
WITH c AS (SELECT d.doc_id, l.doc_id IS NOT NULL AS there, length(text) % 320 AS r, d.doc_id % 13 / 1000 AS lr, d.doc_id % 4 AS b FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
SELECT doc_id, array_to_string(list_filter([
  CASE WHEN NOT there THEN 'dataset not found' END, CASE WHEN r NOT BETWEEN 8 AND 256 THEN 'lora_r out of range' END,
  CASE WHEN lr <= 0 OR lr > 0.01 THEN 'learning_rate out of range' END, CASE WHEN b < 1 THEN 'batch_size below 1' END], lambda x: x IS NOT NULL), '; ') AS issues FROM c
""")
def config_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A training configuration for each document; its data set is there if it has a label."""
    docs = table(spark, sf_dir, "documents").select("doc_id", (F.length("text") % 320).alias("r"))  # no text in the join
    labels = table(spark, sf_dir, "labels").select("doc_id", F.lit(True).alias("there"))
    rows = docs.join(labels, "doc_id", "left")
    issues = config_issues(F.coalesce("there", F.lit(False)), F.col("r"), F.col("doc_id") % 13 / 1000, F.col("doc_id") % 4)
    return rows.select("doc_id", F.array_join(issues, "; ").alias("issues"))


@query("SELECT source, CAST(count(*) // 32 * 3 AS BIGINT) AS steps, CAST(floor(count(*) // 32 * 3 * 0.05) AS BIGINT) AS warm_up FROM documents GROUP BY source")
def training_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps, warm = training_steps(F.col("n"), 3)
    return table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n")).select("source", steps.cast("long").alias("steps"), warm.cast("long").alias("warm_up"))


@query("""
SELECT conv_id, turn, array_to_string(list_filter(['turn', 'role', 'text'], lambda k: NOT list_contains(
  CASE conv_id % 3 WHEN 0 THEN ['turn', 'role', 'text'] WHEN 1 THEN ['turn', 'text'] ELSE [role] END, k)), ',') AS missing FROM conversations
""")
def input_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    required = F.array(*map(F.lit, ("turn", "role", "text")))
    given = F.when(F.col("conv_id") % 3 == 0, required).when(F.col("conv_id") % 3 == 1, F.array(F.lit("turn"), F.lit("text"))).otherwise(F.array("role"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.array_join(missing_inputs(required, given), ",").alias("missing"))


_SCORES = f"""
WITH {PAIRS_SQL}, b AS (SELECT pair_id, response, (SELECT text FROM benchmark WHERE item_id = pair_id % (SELECT count(*) FROM benchmark)) AS prediction FROM pairs),
p AS (SELECT pair_id, response, CASE WHEN pair_id % 5 = 0 THEN ' ' || response || chr(10) ELSE coalesce(prediction, '') END AS prediction FROM b),
s AS (
  SELECT pair_id, 'length_ratio' AS metric, least(length(prediction), length(response)) / greatest(length(prediction), length(response), 1) AS score FROM p
  UNION ALL SELECT pair_id, 'exact_match', CASE WHEN regexp_replace(prediction, '^\\s+|\\s+$', '', 'g') = regexp_replace(response, '^\\s+|\\s+$', '', 'g') THEN 1.0 ELSE 0.0 END FROM p
)"""


def _eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    bench = table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("item"))
    n = bench.agg(F.count("*").alias("n_items"))  # one row
    told = pairs(spark, sf_dir).crossJoin(n).join(bench, F.expr("try_mod(pair_id, n_items) = item_id"), "left")
    prediction = F.when(F.col("pair_id") % 5 == 0, F.concat(F.lit(" "), F.col("response"), F.lit("\n"))).otherwise(F.coalesce("item", F.lit("")))
    return results(told, prediction, F.col("response"), "run", "stub", "2024-01-01T00:00:00+00:00", keep=["pair_id"])


@query(f"{_SCORES} SELECT pair_id, metric, round(CAST(score AS DOUBLE), 9) AS score, CAST(1 AS BIGINT) AS samples FROM s")
def eval_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _eval(spark, sf_dir).select("pair_id", "metric", F.round("score", 9).alias("score"), "samples")


@query(f"{_SCORES} SELECT metric, round(avg(CAST(score AS DOUBLE)), 6) AS score, count(*) AS samples FROM s GROUP BY metric")
def eval_scores_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return averaged(_eval(spark, sf_dir)).select("metric", F.round("score", 6).alias("score"), "samples")


#: Words of the driver's prose that kinds must hold, and marks for the structured ones.
_HOLDS = {
    "BRIEFING": ("the", "ing"), "CULTURE_REPORT": ("a", "e"), "TREND_ANALYSIS": ("tion",), "COMPANY_PROFILE": ("er ", "s "), "MARKET_BRIEF": ("and",),
    "JOURNAL": ("of the",), "SIGNAL_EXTRACTION": ("de ", "la"), "GAP_DETECTION": ("st",), "TREND_SYNTHESIS": ("en", "ar", "or"),
}
_SANITY = ", ".join(f"('{kind}', {least if least is not None else 'NULL'}, {list(_HOLDS.get(kind, []))})" for kind, least in SANITY_LENGTHS.items())


@query(f"""
WITH kinds AS (SELECT list(kind ORDER BY place) AS kinds FROM (VALUES {", ".join(f"('{k}', {i})" for i, k in enumerate(SANITY_LENGTHS))}) v(kind, place)),
d AS (SELECT doc_id, kinds[CAST(doc_id % 10 AS INTEGER) + 1] AS kind, coalesce(text, '') AS text FROM documents JOIN kinds ON true),
m AS (SELECT *, {ASCII_WORDS} AS t FROM d)
SELECT doc_id, kind, m.least IS NULL OR length(text) >= m.least AS long_enough, len(list_filter(holds, lambda h: NOT contains(text, h))) = 0 AS contains_all,
  m.least IS NULL OR NOT regexp_matches(t, '(?i)\\b(boundless synergy|quantum leap forward|seamlessly empower|next[- ]level value)\\b') AS clean
FROM (SELECT doc_id, kind, text, t, e.least, e.holds FROM m JOIN (VALUES {_SANITY}) e(name, least, holds) ON kind = name) m
""")
def sanity_expectations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ten kinds of sanity answers, with words that occur in the data."""
    kinds = F.array(*map(F.lit, SANITY_LENGTHS))
    rows = table(spark, sf_dir, "documents").select("doc_id", F.element_at(kinds, (F.col("doc_id") % 10 + 1).cast("int")).alias("kind"), "text")
    return expectations(rows, expected(spark, _HOLDS, headers={}), "text", "kind").drop("text")
