"""Feed payloads to items: RSS 2.0, Atom, paper feeds and story lists.

A payload is a row (source, body); parsing is native (``from_xml``), so a broken body
gives no items and never fails a job. Fetching is separate (``HttpSource``): anything
that yields payload rows will do, such as replayed files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.text import collapse, holds_any, html_summary, iso_utc, strip
from ..operators.dedup import first_wins

# Limits per source, and the summary's length.
FEED_LIMIT, PAPER_LIMIT, STORY_LIMIT, STORY_IDS = 20, 20, 15, 100
PAPER_AUTHORS, SUMMARY = 5, 500
PAPER_SOURCE, STORY_SOURCE = "arxiv", "hackernews"
STORY_URL = "https://news.ycombinator.com/item?id="
# End of fixed values.

#: Default topic words; a parameter.
TOPIC = ("language models?", "neural", "machine learning", "datasets?", "robots?")

RSS_SCHEMA = "channel struct<item: array<struct<title: string, link: string, description: string, pubDate: string>>>"
ATOM_SCHEMA = (
    "entry array<struct<title: string, link: array<struct<_href: string, _type: string>>, id: string, summary: string, "
    "published: string, updated: string, author: array<struct<name: string>>, category: array<struct<_term: string>>>>"
)


def _text(x: Column) -> Column:
    return strip(F.coalesce(x, F.lit("")))


def _items(payloads: DataFrame, field: Column, limit: int) -> DataFrame:
    """(source, place, e) for the first entries of each payload."""
    return payloads.select("source", F.posexplode(F.slice(field, 1, limit)).alias("place", "e"))


def rss(payloads: DataFrame, limit: int = FEED_LIMIT) -> DataFrame:
    tree = payloads.withColumn("t", F.from_xml("body", RSS_SCHEMA, {"mode": "PERMISSIVE"}))
    e = F.col("e")
    return _items(tree, F.col("t.channel.item"), limit).select(
        "source", "place", _text(e["title"]).alias("title"), _text(e["link"]).alias("url"),
        html_summary(e["description"], SUMMARY).alias("summary"), _text(e["pubDate"]).alias("published"),
    )


def atom(payloads: DataFrame, limit: int = FEED_LIMIT) -> DataFrame:
    """Entries without a title go, as do later ones of the same title and feed."""
    tree = payloads.withColumn("t", F.from_xml("body", ATOM_SCHEMA, {"mode": "PERMISSIVE"}))
    e = F.col("e")
    dated = F.coalesce(F.nullif(e["published"], F.lit("")), e["updated"])
    items = _items(tree, F.col("t.entry"), limit).select(
        "source", "place", _text(e["title"]).alias("title"),
        F.coalesce(F.try_element_at(e["link"], F.lit(1))["_href"], F.lit("")).alias("url"),
        html_summary(e["summary"], SUMMARY).alias("summary"), _text(dated).alias("published"),
    )
    return first_wins(items.where("title <> ''"), [F.col("source"), F.col("title")], [F.col("place")])


def papers(payloads: DataFrame, limit: int = PAPER_LIMIT) -> DataFrame:
    tree = payloads.withColumn("t", F.from_xml("body", ATOM_SCHEMA, {"mode": "PERMISSIVE"}))
    e = F.col("e")
    page = F.try_element_at(F.filter(e["link"], lambda x: x["_type"] == "text/html"), F.lit(1))["_href"]
    names = F.filter(F.transform(e["author"], lambda a: strip(a["name"])), lambda n: F.coalesce(n, F.lit("")) != "")
    terms = F.filter(F.transform(e["category"], lambda c: c["_term"]), lambda c: F.coalesce(c, F.lit("")) != "")
    none = F.array().cast("array<string>")
    return _items(tree, F.col("t.entry"), limit).select(
        F.lit(PAPER_SOURCE).alias("source"), "place", collapse(_text(e["title"])).alias("title"),
        F.coalesce(F.nullif(page, F.lit("")), e["id"], F.lit("")).alias("url"),
        F.substring(collapse(_text(e["summary"])), 1, SUMMARY).alias("summary"), _text(e["published"]).alias("published"),
        F.slice(F.coalesce(names, none), 1, PAPER_AUTHORS).alias("authors"), F.coalesce(terms, none).alias("categories"),
    )


STORY_SCHEMA = "type string, title string, url string, time long, score long, descendants long"


def stories(payloads: DataFrame, topic: Sequence[str] = TOPIC, limit: int = STORY_LIMIT, ids: int = STORY_IDS) -> DataFrame:
    """Payload rows (rank, id, body) to the first stories on topic, by rank."""
    s = payloads.where(F.col("rank") < ids).withColumn("s", F.from_json("body", STORY_SCHEMA))
    title = F.coalesce(F.col("s.title"), F.lit(""))
    return (
        s.where((F.col("s.type") == "story") & holds_any(title, topic)).orderBy("rank").limit(limit)
        .select(
            F.lit(STORY_SOURCE).alias("source"), F.col("rank").alias("place"), title.alias("title"),
            F.coalesce("s.url", F.concat(F.lit(STORY_URL), F.col("id").cast("string"))).alias("url"), F.lit("").alias("summary"),
            iso_utc(F.coalesce("s.time", F.lit(0))).alias("published"),
            F.coalesce("s.score", F.lit(0)).alias("score"), F.coalesce("s.descendants", F.lit(0)).alias("comments"),
        )
    )


def on_topic(items: DataFrame, allowed: Sequence[str], topic: Sequence[str] = TOPIC) -> DataFrame:
    """Items of allowed feeds, and of others those whose title or summary hits."""
    text = F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("summary", F.lit("")))
    return items.where(F.coalesce(F.col("source").isin(*allowed), F.lit(False)) | holds_any(text, topic))


def union_in_order(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows, with ``source_ord`` saying from which frame; columns that a frame
    lacks are null."""
    out = None
    for i, frame in enumerate(frames):
        part = frame.withColumn("source_ord", F.lit(i))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


class HttpSource(DataSource):
    """``spark.read.format("http_payloads")``: one row (source, body) per URL, fetched
    on executors. ``urls`` is a list of ``name=url`` lines; a failed fetch gives a
    null body."""

    @classmethod
    def name(cls) -> str:
        return "http_payloads"

    def schema(self) -> str:
        return "source string, body string"

    def reader(self, schema) -> DataSourceReader:
        return _HttpReader(dict(self.options))


class _HttpReader(DataSourceReader):
    def __init__(self, options: dict):
        self.wanted = [x.split("=", 1) for x in options.get("urls", "").splitlines() if "=" in x]
        self.timeout = float(options.get("timeout", 15))

    def partitions(self):
        return [InputPartition(i) for i in range(len(self.wanted))]

    def read(self, partition):
        import urllib.request

        name, url = self.wanted[partition.value]
        try:
            with urllib.request.urlopen(url, timeout=self.timeout) as answer:  # noqa: S310
                body = answer.read().decode("utf-8", "replace")
        except OSError:
            body = None
        yield name, body


def register(spark: SparkSession) -> None:
    spark.dataSource.register(HttpSource)
