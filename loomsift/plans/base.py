"""Registration of queries with their SQL, and adapters over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name, with its DuckDB twin."""

    def take(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return take


#: Topic and vocabulary words that occur in the driver's invented prose.
TOPIC = ("thand", "stand", "thering", "edition")
BANNED = ("of the", "in the", "to the", "de la")
GENERIC = ("that it", "for the")

CATEGORIES = ("briefing", "trends", "company", "culture", "market", "journal")
CATEGORIES_2 = ("infra", "industry", "curation", "sovereign", "culture")


def category(i: Column, names: tuple[str, ...] = CATEGORIES) -> Column:
    return F.element_at(F.array(*map(F.lit, names)), (F.pmod(i, F.lit(len(names))) + 1).cast("int"))


def category_sql(i: str, names: tuple[str, ...] = CATEGORIES) -> str:
    return f"([{', '.join(repr(n) for n in names)}])[CAST({i} % {len(names)} AS INTEGER) + 1]"


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as feed items: the title is the whole first line, one source in twenty is
    the paper source. Their scores are ``scores``."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("ordinal"),
        F.when(F.col("source") == "src3", "arxiv").otherwise(F.col("source")).alias("source"),
        F.substring_index("text", "\n", 1).alias("title"), F.col("text").alias("summary"),
        F.when(F.col("source") == "src3", F.transform(F.sequence(F.lit(1), (F.col("doc_id") % 5 + 1).cast("int")), lambda i: F.concat(F.lit("A. Author "), i.cast("string")))).alias("authors"),
    )


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and comments of the items that have a label."""
    labels = table(spark, sf_dir, "labels")
    return labels.select(F.col("doc_id").alias("ordinal"), (F.col("quality") * F.col("doc_id")).alias("score"), (F.col("doc_id") % 7).alias("comments"))


ITEMS_SQL = """items AS (
  SELECT d.doc_id AS ordinal, CASE WHEN source = 'src3' THEN 'arxiv' ELSE source END AS source,
    split_part(text, chr(10), 1) AS title, text AS summary, l.quality * d.doc_id AS score,
    CASE WHEN l.doc_id IS NOT NULL THEN d.doc_id % 7 END AS comments,
    CASE WHEN source = 'src3' THEN list_transform(range(1, d.doc_id % 5 + 2), lambda i: 'A. Author ' || i) END AS authors
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
)"""


def chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id and its messages in order. A conversation is one row, as in a chat file;
    unbounded ones belong to the token-level formatter."""
    from ..operators.render import messages_of

    return messages_of(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")


CHATS_SQL = """chats AS (
  SELECT conv_id, list({'role': role, 'content': text} ORDER BY turn) AS messages FROM conversations GROUP BY conv_id
)"""


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user turn with the assistant turn that follows, as a contract line. Pairs
    of unlabelled conversations have no score, some have an extra field."""
    turns = table(spark, sf_dir, "conversations")
    after = Window.partitionBy("conv_id").orderBy("turn")
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("conv_id"), F.col("quality").cast("double").alias("score"))
    told = turns.select(
        "conv_id", "turn", "role", F.col("text").alias("instruction"),
        F.lead("role").over(after).alias("next_role"), F.lead("text").over(after).alias("response"),
    ).where("role = 'user' AND next_role = 'assistant'").join(labels, "conv_id", "left")
    extra = F.when(F.col("conv_id") % 10 == 3, F.lit("x"))
    record = F.struct("instruction", "response", "score", F.lit("test").alias("domain"), extra.alias("note"))
    return told.select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("pair_id"), "conv_id", "instruction", "response", "score",
        F.to_json(record).alias("line"),
    )


PAIRS_SQL = """told AS (
  SELECT conv_id, turn, role, text AS instruction, lead(role) OVER w AS next_role, lead(text) OVER w AS response
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)
), pairs AS (
  SELECT conv_id * 1000 + turn AS pair_id, conv_id, instruction, response, CAST(quality AS DOUBLE) AS score, conv_id % 10 = 3 AS extra
  FROM told LEFT JOIN labels ON doc_id = conv_id WHERE role = 'user' AND next_role = 'assistant'
), judged AS (
  SELECT *, list_sort(list_filter([
    CASE WHEN length(instruction) < 10 THEN 'Field ''instruction'': length ' || length(instruction) || ' < minLength 10' END,
    CASE WHEN length(response) < 50 THEN 'Field ''response'': length ' || length(response) || ' < minLength 50' END,
    CASE WHEN score IS NULL THEN 'Missing required field: score' END,
    CASE WHEN extra THEN 'Unexpected field: note' END], lambda x: x IS NOT NULL)) AS errors
  FROM pairs
)"""

#: DuckDB's word boundary is ASCII only; letters beyond it become a letter-like mark.
ASCII_WORDS = r"regexp_replace(text, '[^\x00-\x7F\p{Z}\p{P}\p{S}\p{C}\p{M}]', '_', 'g')"
