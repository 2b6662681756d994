"""Row sets to text: report prompts and chat text.

Wording is a parameter (``ReportStyle``); structure, order and limits are the engine's.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import head
from .dedup import first_wins, per_group

# How many lines a report shows, and how much of a summary.
NEWS, PAPERS, AUTHORS, NEWS_SUMMARY = 15, 10, 3, 200
JOURNAL, JOURNAL_SUMMARY = 30, 150
PAPER_SOURCE = "arxiv"
IM_START, IM_END = "<|im_start|>", "<|im_end|>"
# End of fixed values.


@dataclass(frozen=True)
class ReportStyle:
    opening: str = "Write the daily briefing for {date}."
    counted: str = "Signals of the day ({n} from {sources} sources):"
    news: str = "## News"
    papers: str = "## Papers"
    closing: str = "Write for a reader with ten minutes: facts first, sources named, doubts marked as doubts."
    journal_opening: str = "Write the weekly journal for the week ending {date}."
    journal_counted: str = "Signals of the week ({n}):"
    journal_closing: str = "Write it as one argument: what changed, what it costs, and whom to ask about it next week."


def _filled(text: str, **values: Column) -> Column:
    out = F.lit(text)
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), value.cast("string"))
    return out


def _present(x: Column) -> Column:
    return F.coalesce(x, F.lit("")) != ""


def news_line(title: Column, summary: Column, score: Column, comments: Column) -> Column:
    """Points show only for a score that is neither missing nor 0."""
    shown = F.coalesce(score, F.lit(0)) != 0
    points = F.when(shown, F.format_string(" [HN: %s pts, %s comments]", score.cast("string"), F.coalesce(comments, F.lit(0)).cast("string"))).otherwise("")
    return F.concat(F.lit("- "), title, points, _summary(summary, NEWS_SUMMARY))


def paper_line(title: Column, summary: Column, authors: Column) -> Column:
    names = F.array_join(F.slice(F.coalesce(authors, F.array().cast("array<string>")), 1, AUTHORS), ", ")
    shown = F.when(names != "", F.concat(F.lit(" ("), names, F.lit(")"))).otherwise("")
    return F.concat(F.lit("- "), title, shown, _summary(summary, NEWS_SUMMARY))


def journal_line(source: Column, title: Column, summary: Column) -> Column:
    return F.concat(F.lit("- ["), F.coalesce(source, F.lit("?")), F.lit("] "), title, _summary(summary, JOURNAL_SUMMARY))


def _summary(summary: Column, n: int) -> Column:
    return F.when(_present(summary), F.concat(F.lit("\n  "), head(summary, n))).otherwise("")


def briefing_lines(items: DataFrame, order: str, details: DataFrame | None = None) -> DataFrame:
    """(section, place, line) of the lines a briefing shows. Items have source, title,
    summary, authors and a total order, and score and comments of their own or in
    ``details``, a row for each ``order``, which only the items that are shown look up."""
    paper = F.coalesce(F.col("source"), F.lit("")) == PAPER_SOURCE
    rows = items.withColumn("section", F.when(paper, "papers").otherwise("news"))
    place = F.row_number().over(Window.partitionBy("section").orderBy(order))
    limit = F.when(F.col("section") == "papers", PAPERS).otherwise(NEWS)
    # The window's bound lets Spark limit each group before the shuffle.
    shown = rows.withColumn("place", place).where(F.col("place") <= max(NEWS, PAPERS)).where(F.col("place") <= limit)
    if details is not None:
        shown = shown.join(details, order, "left")
    line = F.when(F.col("section") == "papers", paper_line(F.col("title"), F.col("summary"), F.col("authors"))).otherwise(
        news_line(F.col("title"), F.col("summary"), F.col("score"), F.col("comments"))
    )
    return shown.select("section", line.alias("line"), "place")


def _joined(lines: DataFrame, section: str) -> Column:
    own = F.sort_array(F.collect_list(F.when(F.col("section") == section, F.struct("place", "line"))))
    return F.array_join(F.transform(own, lambda s: s["line"]), "\n")


def briefing_prompt(items: DataFrame, order: str, date: str, style: ReportStyle = ReportStyle(), details: DataFrame | None = None) -> DataFrame:
    """One row: prompt. Sections without items are left out."""
    counts = items.agg(F.count("*").alias("n"), F.count_distinct(F.coalesce("source", F.lit("unknown"))).alias("sources"))
    lines = briefing_lines(items, order, details)  # at most NEWS + PAPERS rows
    parts = lines.agg(_joined(lines, "news").alias("news"), _joined(lines, "papers").alias("papers"))
    section = lambda title, c: F.when(_present(F.col(c)), F.concat(F.lit(title + "\n"), F.col(c), F.lit("\n\n"))).otherwise("")
    prompt = F.concat(
        _filled(style.opening + "\n\n" + style.counted + "\n\n", date=F.lit(date), n=F.col("n"), sources=F.col("sources")),
        section(style.news, "news"), section(style.papers, "papers"), F.lit(style.closing),
    )
    return counts.crossJoin(parts).select(prompt.alias("prompt"))  # one row by one row


def journal_prompt(items: DataFrame, order: str, date: str, style: ReportStyle = ReportStyle()) -> DataFrame:
    counts = items.agg(F.count("*").alias("n"))
    shown = items.orderBy(order).limit(JOURNAL).select(F.lit("all").alias("section"), F.col(order).alias("place"), journal_line(F.col("source"), F.col("title"), F.col("summary")).alias("line"))
    text = shown.agg(_joined(shown, "all").alias("lines"))
    prompt = F.concat(
        _filled(style.journal_opening + "\n\n" + style.journal_counted + "\n\n", date=F.lit(date), n=F.col("n")),
        F.when(_present(F.col("lines")), F.concat(F.col("lines"), F.lit("\n"))).otherwise(""), F.lit("\n" + style.journal_closing),
    )
    return counts.crossJoin(text).select(prompt.alias("prompt"))


def weekly(items: DataFrame, day: str, item: Sequence[str], rank: Sequence[Column], days: int = 7, most: int | None = None) -> DataFrame:
    """The journal's material for each day that has rows: the best ``most`` items of the
    ``days`` days up to it, an item once however often it occurs. Adds ``journal_day``,
    ``place`` and ``n_rows``, the rows of those days by a RANGE frame over the days.

    An item's best row stands for it; ``rank`` must put rows in one order. The best of a
    period are among the best of each of its days, so a day sends ``most`` items to each
    journal at most and no task sees a whole period. Rows without a day are left out;
    items that are null are one item."""
    most = JOURNAL if most is None else most
    rows = items.where(F.col(day).isNotNull()).withColumn("_day", F.datediff(F.col(day).cast("date"), F.lit("1970-01-01").cast("date")))
    counts = rows.groupBy("_day").agg(F.count("*").alias("_n"))  # one row a day
    frame = Window.orderBy("_day").rangeBetween(1 - days, Window.currentRow)
    journals = counts.select(F.col("_day").alias("_journal"), F.sum("_n").over(frame).alias("n_rows"))
    best = first_wins(rows, [F.col("_day"), *map(F.col, item)], rank)
    best = per_group(best, [F.col("_day")], rank, most)
    sent = best.withColumn("_journal", F.explode(F.sequence(F.col("_day"), F.col("_day") + (days - 1))))
    sent = sent.join(F.broadcast(journals), "_journal")  # one row a day
    once = first_wins(sent, [F.col("_journal"), *map(F.col, item)], rank)
    place = F.row_number().over(Window.partitionBy("_journal").orderBy(*rank))
    listed = once.withColumn("place", place).where(F.col("place") <= most)
    return listed.withColumn("journal_day", F.date_add(F.lit("1970-01-01").cast("date"), F.col("_journal"))).drop("_day", "_journal")


def report(title: str, date: str, total: int, sources: int, body: str) -> str:
    """A finished report as Markdown: a header, then the body."""
    return f"# {title}\n**Date:** {date}\n**Signals:** {total} items from {sources} sources\n\n---\n\n{body}"


def chat_text(messages: Column) -> Column:
    """An array of (role, content) structs to marked text."""
    turns = F.transform(messages, lambda m: F.concat(F.lit(IM_START), m["role"], F.lit("\n"), m["content"], F.lit(IM_END)))
    return F.concat(F.array_join(turns, "\n"), F.lit("\n"))


def messages_of(turns: DataFrame, key: str, order: str, role: str, text: str) -> DataFrame:
    """Turns to one row per conversation with its ordered messages."""
    told = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(role).alias("role"), F.col(text).alias("content"))))
    return turns.groupBy(key).agg(F.transform(told, lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))).alias("messages"))


def zipped(left: Column, right: Column) -> Column:
    """Pairs by position, cut to the shorter list."""
    n = F.least(F.size(left), F.size(right))
    return F.arrays_zip(F.slice(left, F.lit(1), n).alias("left"), F.slice(right, F.lit(1), n).alias("right"))
