"""Splits, quotas, rendering, generation, feeds and incremental runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import render as R
from ..operators import scenarios as C
from ..operators import split as S
from ..operators.dedup import first_wins, per_group
from ..operators.generate import Echo, calls_by_kind, generate, two_tier
from ..operators.profile import progress
from ..session import table, work_path
from ..sources import feeds
from ..sources.jsonl import lines, parsed, write_jsonl
from ..streaming.incremental import result, run_once
from .base import CHATS_SQL, ITEMS_SQL, category, category_sql, chats, items, query, scores

_RANKED = "r AS (SELECT doc_id, source, row_number() OVER (ORDER BY sha256('42:' || doc_id), doc_id) AS rank, count(*) OVER () AS total FROM documents)"


@query(f"WITH {_RANKED} SELECT doc_id, rank, CASE WHEN rank <= greatest(1, CAST(floor(total * 0.95) AS BIGINT)) THEN 'train' ELSE 'eval' END AS split FROM r")
def split_factory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.factory_split(table(spark, sf_dir, "documents").select("doc_id"), "doc_id").select("doc_id", "rank", "split")


@query(f"WITH {_RANKED} SELECT CASE WHEN rank <= greatest(500, CAST(floor(total * 0.05) AS BIGINT)) THEN 'eval' ELSE 'train' END AS split, source, count(*) AS n FROM r GROUP BY 1, 2")
def split_assembler(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = S.assembler_split(table(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id")
    return rows.groupBy("split", "source").agg(F.count("*").alias("n"))


@query(f"SELECT doc_id, category FROM (SELECT doc_id, {category_sql('doc_id')} AS category, row_number() OVER (PARTITION BY doc_id % 6 ORDER BY doc_id) AS rn FROM documents) WHERE rn <= 25")
def quota_per_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", category(F.col("doc_id")).alias("category"))
    return per_group(rows, [F.col("category")], [F.col("doc_id")], 25)


@query("SELECT range AS idx FROM range(600) WHERE range NOT IN (SELECT doc_id FROM labels) ORDER BY idx LIMIT 360")
def work_queue_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("idx"))
    return S.work_queue(spark, 300, done)


@query("SELECT doc_id % 8 AS sub, count(*) AS n FROM documents GROUP BY 1")
def round_robin_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").groupBy(S.round_robin(F.col("doc_id"), 8).alias("sub")).agg(F.count("*").alias("n"))


_POOL = ("amber", "birch", "cobalt", "delta", "ember")
_POOL_SQL = "['amber', 'birch', 'cobalt', 'delta', 'ember']"


@query(f"""
SELECT doc_id, {_POOL_SQL}[CAST(CAST('0x' || left(sha256('7:' || doc_id), 8) AS BIGINT) % 5 AS INTEGER) + 1] AS choice,
  array_to_string(list_transform(list_sort(list_transform({_POOL_SQL}, lambda x: sha256('7:' || doc_id || ':' || x) || x))[1:2], lambda y: substr(y, 65)), ',') AS two
FROM documents
""")
def seeded_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id", S.pick(_POOL, 7, F.col("doc_id")).alias("choice"), F.array_join(S.pick_some(_POOL, 2, 7, F.col("doc_id")), ",").alias("two")
    )


@query("SELECT doc_id FROM documents ORDER BY sha256('42:' || doc_id), doc_id LIMIT 50")
def sample_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.sample(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", 50)


@query("""
WITH r AS (SELECT event_id, CAST('0x' || left(sha256('11:' || event_id), 8) AS BIGINT) / 4294967296.0 * 24000 AS roll FROM events)
SELECT CASE WHEN roll < 9000 THEN 'extraction' WHEN roll < 16500 THEN 'gaps' ELSE 'trends' END AS category, count(*) AS n FROM r GROUP BY 1
""")
def weighted_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = {"extraction": 9000, "gaps": 7500, "trends": 7500}
    chosen = S.weighted(left, S.roll(11, F.col("event_id")))
    return table(spark, sf_dir, "events").groupBy(chosen.alias("category")).agg(F.count("*").alias("n"))


_NEWS_LINE = """'- ' || title || CASE WHEN coalesce(score, 0) <> 0 THEN ' [HN: ' || score || ' pts, ' || coalesce(comments, 0) || ' comments]' ELSE '' END
    || CASE WHEN coalesce(summary, '') <> '' THEN chr(10) || '  ' || left(summary, 200) ELSE '' END"""
_PAPER_LINE = """'- ' || title || CASE WHEN len(authors) > 0 THEN ' (' || array_to_string(authors[1:3], ', ') || ')' ELSE '' END
    || CASE WHEN coalesce(summary, '') <> '' THEN chr(10) || '  ' || left(summary, 200) ELSE '' END"""
_LINES = f"""{ITEMS_SQL}, lined AS (
  SELECT ordinal, CASE WHEN source = 'arxiv' THEN 'papers' ELSE 'news' END AS section, CASE WHEN source = 'arxiv' THEN {_PAPER_LINE} ELSE {_NEWS_LINE} END AS line FROM items
), shown AS (
  SELECT * FROM (SELECT section, line, row_number() OVER (PARTITION BY section ORDER BY ordinal) AS place FROM lined) WHERE place <= CASE section WHEN 'papers' THEN 10 ELSE 15 END
)"""


@query(f"WITH {_LINES} SELECT section, CAST(place AS INTEGER) AS place, line FROM shown")
def briefing_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.briefing_lines(items(spark, sf_dir), "ordinal", scores(spark, sf_dir))


_STYLE = R.ReportStyle()


@query(f"""
WITH {_LINES} SELECT 'Write the daily briefing for 2024-05-01.' || chr(10) || chr(10) || 'Signals of the day (' || (SELECT count(*) FROM items) || ' from '
  || (SELECT count(DISTINCT source) FROM items) || ' sources):' || chr(10) || chr(10)
  || '{_STYLE.news}' || chr(10) || (SELECT string_agg(line, chr(10) ORDER BY place) FROM shown WHERE section = 'news') || chr(10) || chr(10)
  || '{_STYLE.papers}' || chr(10) || (SELECT string_agg(line, chr(10) ORDER BY place) FROM shown WHERE section = 'papers') || chr(10) || chr(10)
  || '{_STYLE.closing}' AS prompt
""")
def briefing_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.briefing_prompt(items(spark, sf_dir), "ordinal", "2024-05-01", details=scores(spark, sf_dir))


@query(f"""
WITH {ITEMS_SQL}, shown AS (SELECT * FROM items ORDER BY ordinal LIMIT 30)
SELECT 'Write the weekly journal for the week ending 2024-05-01.' || chr(10) || chr(10) || 'Signals of the week (' || (SELECT count(*) FROM items) || '):' || chr(10) || chr(10)
  || (SELECT string_agg('- [' || source || '] ' || title || CASE WHEN coalesce(summary, '') <> '' THEN chr(10) || '  ' || left(summary, 150) ELSE '' END, chr(10) ORDER BY ordinal) FROM shown)
  || chr(10) || chr(10) || '{_STYLE.journal_closing}' AS prompt
""")
def journal_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.journal_prompt(items(spark, sf_dir), "ordinal", "2024-05-01")


@query("""
SELECT conv_id, string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>', chr(10) ORDER BY turn) || chr(10) AS text FROM conversations GROUP BY conv_id
""")
def chat_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chats(spark, sf_dir).select("conv_id", R.chat_text(F.col("messages")).alias("text"))


@query(f"""
WITH {CHATS_SQL}, s AS (SELECT conv_id, list_filter(messages, lambda m: m.role = 'user') AS u, list_filter(messages, lambda m: m.role = 'assistant') AS a FROM chats)
SELECT conv_id, unnest(range(1, least(len(u), len(a)) + 1)) AS place, unnest(list_transform(range(1, least(len(u), len(a)) + 1), lambda i: u[i].content || '|' || a[i].content)) AS pair FROM s
""")
def zip_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = lambda role: F.transform(F.filter("messages", lambda m: m["role"] == role), lambda m: m["content"])
    rows = chats(spark, sf_dir).select("conv_id", F.posexplode(R.zipped(said("user"), said("assistant"))).alias("place", "z"))
    return rows.select("conv_id", (F.col("place") + 1).cast("long").alias("place"), F.concat("z.left", F.lit("|"), "z.right").alias("pair"))


@query("""
WITH t AS (SELECT CAST(sum(w) AS BIGINT) AS total_written, CAST(sum(g) AS BIGINT) AS total_target, CAST(sum(p) AS BIGINT) AS total_gen_pass, CAST(sum(w - p) AS BIGINT) AS total_rewritten
  FROM (SELECT event_type, count(*) AS w, 5000 AS g, count(*) FILTER (value > 10) AS p FROM events GROUP BY event_type))
SELECT *, round(total_rewritten / greatest(total_gen_pass + total_rewritten, 1) * 100, 1) AS rewrite_rate, round(total_written / 37.5, 1) AS rate_per_min, CAST(37.5 AS DOUBLE) AS elapsed_min,
  round((total_target - total_written) / greatest(total_written / 37.5, 1) / 60, 1) AS eta_hours FROM t
""")
def progress_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("written"), F.count_if(F.col("value") > 10).alias("gen_pass"))
    return progress(rows.withColumn("target", F.lit(5000)).withColumn("rewritten", F.col("written") - F.col("gen_pass")), F.lit(2250.0))


@query("""
WITH t AS (SELECT doc_id, text, length(text) >= 1200 AS ok FROM documents)
SELECT doc_id, CASE WHEN ok THEN 'gen' ELSE 'rewrite' END AS tier, CAST(length(CASE WHEN ok THEN text ELSE '> ' || text END) AS BIGINT) AS n FROM t
""")
def two_tier_stub(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tiers whose stubs are expressions: the text, and the text marked."""
    rows = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("prompt"))
    done = two_tier(
        rows, lambda df: df.withColumn("text", F.col("prompt")), lambda df: df.withColumn("text", F.concat(F.lit("> "), F.col("prompt"))),
        F.length("text") >= 1200,
    )
    return done.select("doc_id", "tier", F.length("text").cast("long").alias("n"))


_KEYED = "'42:' || family || ':' || category || ':' || idx || ':"


def _listed(names) -> str:
    return "[" + ", ".join("'" + n.replace("'", "''") + "'" for n in names) + "]"


def _one_sql(members, key: str) -> str:
    return f"{_listed(members)}[CAST(CAST('0x' || left(sha256({_KEYED}{key}'), 8) AS BIGINT) % {len(members)} AS INTEGER) + 1]"


def _some_sql(members, n: int, key: str) -> str:
    return f"list_transform(list_sort(list_transform({_listed(members)}, lambda x: sha256({_KEYED}{key}:' || x) || x))[1:{n}], lambda y: substr(y, 65))"


def _slot_sql(slot: C.Slot, place: int) -> str:
    own, also = C.POOLS.get(slot.pool, ()), C.POOLS.get(slot.also, ())
    if slot.kind == "outline":
        return "outline"
    if slot.kind == "number":
        return f"CAST({slot.low} + CAST('0x' || left(sha256({_KEYED}{place}'), 8) AS BIGINT) % {slot.n} AS VARCHAR)"
    if slot.kind == "one":
        return _one_sql([*own, *also], str(place))
    if slot.kind == "pairs":
        left, right = _some_sql(own, slot.n, str(place)), _some_sql(also, slot.n, f"{place}:also")
        return f"array_to_string(list_transform(range(1, {min(slot.n, len(own), len(also))} + 1), lambda i: '- ' || ({left})[i] || ': ' || ({right})[i]), chr(10))"
    some = _some_sql(own, slot.n, str(place))
    return f"array_to_string({some}, '; ')" if slot.kind == "row" else f"'- ' || array_to_string({some}, chr(10) || '- ')"


def _prompt_sql(branch: C.Branch) -> str:
    parts, slots = C.cut(branch.template)
    text = lambda part: "'" + part.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"
    return " || ".join([x for i, slot in enumerate(slots) for x in (text(parts[i]), _slot_sql(slot, i))] + [text(parts[-1])])


def _work(spark: SparkSession, sf_dir: str, families: list[str] | None = None, categories: list[str] | None = None) -> DataFrame:
    """One scenario for each document, dealt to the categories in turn."""
    branches = C.chosen_branches(families=families, categories=categories)
    return C.scenarios(spark, C.dealt(table(spark, sf_dir, "documents"), F.col("doc_id"), branches), families=families, categories=categories)


def _scenarios_sql(families: tuple[str, ...] | None = None, categories: tuple[str, ...] | None = None) -> str:
    own = [b for b in C.BRANCHES if (families is None or b.family in families) and (categories is None or b.category in categories)]
    turns = {(b.family, b.category): max(x.sub for x in own if (x.family, x.category) == (b.family, b.category)) + 1 for b in own}
    rows = ", ".join(f"('{f}', '{c}', {place}, {k})" for place, ((f, c), k) in enumerate(sorted(turns.items())))
    at = lambda b: f"WHEN family = '{b.family}' AND category = '{b.category}' AND sub = {b.sub} THEN"
    formats = " ".join(f"{at(b)} {_one_sql(b.formats, 'format')}" for b in own)
    prompts = " ".join(f"{at(b)} {_prompt_sql(b)}" for b in own)
    specs = ", ".join(f"('{f}', {_listed([C.OUTLINES[f]])}[1], {least}, {most})" for f, (least, most) in C.FORMAT_LIMITS.items())
    return f"""t(family, category, place, k) AS (VALUES {rows}),
i AS (SELECT family, category, doc_id // {len(turns)} AS idx, doc_id // {len(turns)} % k AS sub FROM documents JOIN t ON place = doc_id % {len(turns)}),
f AS (SELECT *, CASE {formats} END AS format FROM i),
o(format, outline, min_len, max_tokens) AS (VALUES {specs}),
scenario AS (SELECT family, category, idx, sub, format, CASE {prompts} END AS prompt, CAST(min_len AS INTEGER) AS min_len, CAST(max_tokens AS INTEGER) AS max_tokens FROM f JOIN o USING (format))"""


@query(f"WITH {_scenarios_sql()} SELECT * FROM scenario")
def prompt_scenarios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sets' scenarios, one for each document."""
    return _work(spark, sf_dir)


@query(f"WITH {_scenarios_sql(families=('cascade',))} SELECT family, category, idx, prompt FROM scenario ORDER BY family, category, idx LIMIT 20")
def dry_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The head that a trial run over the documents would ask for."""
    return C.head(_work(spark, sf_dir, families=["cascade"]), most=1000, dry_run=20).select("family", "category", "idx", "prompt")


_ECHO = Echo()


_STUB_SQL = f"""
WITH {_scenarios_sql(categories=('culture', 'market', 'gap_detection'))}, s AS (SELECT *, sha256('gen:' || prompt) AS h FROM scenario),
e AS (SELECT *, least(max_tokens, 40 + CAST('0x' || left(h, 2) AS BIGINT)) AS n FROM s),
w AS (SELECT *, CAST(list_sum(list_transform(range(0, n), lambda i: length({_listed(_ECHO.words)}[CAST(CAST('0x' || substr(h, CAST(i % 32 * 2 + 1 AS INTEGER), 2) AS BIGINT) % {len(_ECHO.words)} AS INTEGER) + 1]))) + n - 1 AS BIGINT) AS size FROM e),
stub AS (SELECT family, category, idx, CASE WHEN size > min_len // 2 THEN 1 ELSE 4 END AS attempts, CASE WHEN size > min_len // 2 THEN NULL ELSE 'too short' END AS error,
  CASE WHEN size > min_len // 2 THEN CAST(size AS INTEGER) END AS n_chars FROM w)
"""


def _stub(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generate(_work(spark, sf_dir, categories=["culture", "market", "gap_detection"]), _ECHO)


@query(f"{_STUB_SQL} SELECT * FROM stub")
def generated_stub(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents' scenarios completed by the deterministic Python stub; attempts and errors."""
    return _stub(spark, sf_dir).select("family", "category", "idx", "attempts", "error", F.length("text").alias("n_chars"))


@query(f"{_STUB_SQL} SELECT CAST(sum(attempts) AS BIGINT) AS total, count(error) AS error, count(n_chars) AS completed FROM stub")
def call_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls of the stub in all, rows that ended with an error, rows with a text."""
    return calls_by_kind(_stub(spark, sf_dir))


def _payloads(spark: SparkSession, sf_dir: str, kind: int) -> DataFrame:
    """Documents as feeds, a line an item: every third as RSS, as Atom, as a paper feed.
    Payloads of ids that end in 9 are cut off. Titles hold the white space of the line."""
    escaped = lambda x: F.replace(F.replace(F.replace(x, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    feed, joined = F.col("doc_id").cast("string"), lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))

    def rss(line: Column, place: Column) -> Column:
        body = joined("<p>Of <b>", line, "</b></p>")
        return joined("<item><title> ", escaped(line), " </title><link>http://a/", feed, "/", place.cast("string"), "</link><description>", escaped(body), "</description><pubDate>Mon</pubDate></item>")

    def atom(line: Column, place: Column) -> Column:
        dated = F.when(place % 2 == 0, "<updated>2024</updated>").otherwise("<published>2023</published><updated>2024</updated>")
        return joined("<entry><title>", escaped(line), "</title><link href=\"http://b/", feed, "/", place.cast("string"), "\"/><summary>", escaped(line), "</summary>", dated, "</entry>")

    def paper(line: Column, place: Column) -> Column:
        at = joined("http://p/", feed, "/", place.cast("string"))
        page = F.when(place % 2 == 0, joined("<link href=\"", at, ".html\" type=\"text/html\"/>")).otherwise("<link href=\"x\" type=\"application/pdf\"/>")
        names = F.array_join(F.transform(F.sequence(F.lit(1), (place % 7 + 1).cast("int")), lambda i: joined("<author><name>A", i.cast("string"), "</name></author>")), "")
        return joined("<entry><id>", at, "</id><title>", escaped(line), "\n  end</title><summary>On  ", escaped(line), "\n </summary><published>2024</published>", names, page, "<category term=\"cs.CL\"/></entry>")

    opening, closing, item = (
        ("<rss version=\"2.0\"><channel>", "</channel></rss>", rss),
        ("<feed xmlns=\"http://www.w3.org/2005/Atom\">", "</feed>", atom),
        ("<feed xmlns=\"http://www.w3.org/2005/Atom\">", "</feed>", paper),
    )[kind]
    found = F.transform(F.split(F.col("text"), "\n", -1), item)
    ending = F.when(F.col("doc_id") % 10 == 9, "").otherwise(closing)
    rows = table(spark, sf_dir, "documents").where(F.col("doc_id") % 3 == kind)
    return rows.select(feed.alias("source"), joined(opening, F.array_join(found, ""), ending).alias("body"))


_LINE_STRIP = r"regexp_replace({}, '^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$', '', 'g')"
_LINE_FLAT = r"regexp_replace({}, '[\s\x1c-\x1f]+', ' ', 'g')"


@query(f"""
WITH line AS (SELECT doc_id, CAST(doc_id AS VARCHAR) AS feed, unnest(string_split(text, chr(10))[1:20]) AS line, CAST(generate_subscripts(string_split(text, chr(10))[1:20], 1) - 1 AS INTEGER) AS place
  FROM documents WHERE doc_id % 10 <> 9),
item AS (SELECT *, {_LINE_STRIP.format('line')} AS title FROM line),
entry AS (SELECT *, row_number() OVER (PARTITION BY doc_id, title ORDER BY place) AS rn FROM item WHERE doc_id % 3 = 1 AND title <> '')
SELECT 0 AS source_ord, feed AS source, place, title, 'http://a/' || feed || '/' || place AS url, left({_LINE_STRIP.format("regexp_replace('Of ' || line, '<[^>]+>', '', 'g')")}, 500) AS summary, 'Mon' AS published, CAST(NULL AS VARCHAR) AS authors
FROM item WHERE doc_id % 3 = 0
UNION ALL SELECT 1, feed, place, title, 'http://b/' || feed || '/' || place, left({_LINE_STRIP.format("regexp_replace(title, '<[^>]+>', '', 'g')")}, 500), CASE place % 2 WHEN 0 THEN '2024' ELSE '2023' END, NULL FROM entry WHERE rn = 1
UNION ALL SELECT 2, 'arxiv', place, {_LINE_FLAT.format(_LINE_STRIP.format("line || ' end'"))}, 'http://p/' || feed || '/' || place || CASE place % 2 WHEN 0 THEN '.html' ELSE '' END,
  left({_LINE_FLAT.format(_LINE_STRIP.format("'On ' || line"))}, 500), '2024', array_to_string(list_transform(range(1, least(place % 7 + 1, 5) + 1), lambda i: 'A' || i), ',') FROM item WHERE doc_id % 3 = 2
""")
def xml_feed_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads of each kind made of whole documents, some of them broken. A feed's first
    twenty items count, and an Atom feed's first of each title."""
    found = feeds.union_in_order([parse(_payloads(spark, sf_dir, kind)) for kind, parse in enumerate((feeds.rss, feeds.atom, feeds.papers))])
    return found.select("source_ord", "source", "place", "title", "url", "summary", "published", F.array_join("authors", ",").alias("authors"))


@query("""
SELECT event_id AS rank, event_id AS id, 'Item ' || event_id || ' on neural things' AS title, CAST(floor(value) AS BIGINT) AS score FROM events
WHERE event_id < 100 AND event_id % 3 = 0 AND event_id % 2 = 0 ORDER BY event_id LIMIT 15
""")
def story_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A story list made of events: every third is a story, every second on topic."""
    on = F.when(F.col("event_id") % 2 == 0, F.lit(" on neural things")).otherwise(F.lit(" on bread"))
    told = F.struct(
        F.when(F.col("event_id") % 3 == 0, "story").otherwise("job").alias("type"),
        F.concat(F.lit("Item "), F.col("event_id").cast("string"), on).alias("title"), F.floor("value").alias("score"),
    )
    rows = table(spark, sf_dir, "events").select(F.col("event_id").alias("rank"), F.col("event_id").alias("id"), F.to_json(told).alias("body"))
    return feeds.stories(rows).select(F.col("place").alias("rank"), F.col("place").alias("id"), "title", "score")


@query("SELECT doc_id, source, CAST(length(text) AS BIGINT) AS n FROM documents")
def jsonl_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "jsonl")
    write_jsonl(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), path)
    rows = parsed(lines(spark, [path, path + "-missing"]), "doc_id long, source string, text string")
    return rows.select("record.doc_id", "record.source", F.length("record.text").cast("long").alias("n"))


@query("SELECT user_id, min(event_id) AS event_id FROM events GROUP BY user_id")
def resume_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First event of each user over two incremental runs of a growing folder."""
    source, output, checkpoint = (work_path(spark, n) for n in ("arrivals", "kept", "progress"))
    events = table(spark, sf_dir, "events").select("event_id", "user_id")
    middle = events.agg(F.percentile_approx("event_id", 0.5)).first()[0]
    for part in (events.where(F.col("event_id") <= middle), events.where(F.col("event_id") > middle)):
        part.write.mode("append").parquet(source)
        run_once(spark, source, events.schema, output, checkpoint, F.col("user_id"), [F.col("event_id")])
    return result(spark, output).select("user_id", "event_id")


@query("""
WITH f AS (SELECT d.*, row_number() OVER (PARTITION BY left(sha256(left(text, 200)), 16) ORDER BY doc_id) AS rn FROM documents d),
kept AS (SELECT * FROM f WHERE rn = 1 AND length(text) >= 300),
r AS (SELECT *, row_number() OVER (ORDER BY sha256('42:' || doc_id), doc_id) AS rank, count(*) OVER () AS total FROM kept)
SELECT CASE WHEN rank <= greatest(500, CAST(floor(total * 0.05) AS BIGINT)) THEN 'eval' ELSE 'train' END AS split, lang, count(*) AS n, round(avg(length(text)), 6) AS avg_len FROM r GROUP BY 1, 2
""")
def assembled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The assembler end to end: first-wins fingerprint, length, split, profile."""
    from ..functions.text import fingerprint

    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    first = first_wins(docs, [fingerprint(F.lit(None).cast("string"), F.col("text"))], [F.col("doc_id")]).where(F.length("text") >= 300)
    cut = S.assembler_split(first, "doc_id")
    return cut.groupBy("split", "lang").agg(F.count("*").alias("n"), F.round(F.avg(F.length("text")), 6).alias("avg_len"))
