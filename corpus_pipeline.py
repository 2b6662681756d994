"""Corpus pipeline: language ID, near duplicates, decontamination, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's ``docs``; a lost executor costs at most
the stage at work. All stages but the last keep the columns of ``documents`` and any
others, whatever their names.

Rows, defined: documents without an id take part in every stage and are never
removed as a copy; documents that repeat an id are each judged by their own text,
and of a group's documents that share its smallest id the first by text stays;
empty tables give no rows; otherwise the operators' own rules hold.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomsift.llm import bpe, decontaminate, jaccard_join, language
from loomsift.llm.common import fetched, marked
from loomsift.session import table, written

#: Shingles of five words, similar at 0.8 or more.
WORDS, PERCENT = 5, 80
VOCABULARY = "byte_bpe_50k.tiktoken"

#: Learned models and token ids are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def _apart(docs: DataFrame) -> DataFrame:
    """``docs`` under names that no operator uses."""
    return docs.toDF(*(f"in_{place}" for place in range(len(docs.columns))))


def _named(docs: DataFrame, column: str) -> str:
    return f"in_{docs.columns.index(column)}"


def _back(found: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, as they were."""
    return found.select(*(F.col(f"in_{place}").alias(name) for place, name in enumerate(docs.columns)))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the classifier, learned from the labelled ones,
    accepts. Texts that are null, empty or without letters are rejected."""
    model = language.fit(docs)
    return _back(language.predict(_apart(docs), model, text=_named(docs, "text")).where("NOT rejected"), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of linked ones. Rows are
    removed by id and text, so documents that share an id are each judged by their
    own text; of a group's rows that share its smallest id the first by text stays.
    Documents without an id, and texts without words, always stay."""
    classes = written(jaccard_join.join(docs, words=WORDS, percent=PERCENT, sets=True), "classes")
    grouped = classes.where("class_key IS NOT NULL AND doc_id IS NOT NULL")
    tied = grouped.where("doc_id = component_id").groupBy("class_key").agg(F.count("*").alias("n")).where("n > 1").select("class_key")
    tied = written(grouped.where("doc_id = component_id").join(tied, "class_key").select("doc_id", "text_key", "class_key").distinct(), "tied")
    gone = grouped.where("doc_id <> component_id").select("doc_id", "text_key").union(tied.select("doc_id", "text_key"))
    inner, key, text = _apart(docs), _named(docs, "doc_id"), _named(docs, "text")
    inner = inner.select("*", F.col(key).cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("text_key"))
    on = ["doc_id", "text_key"]
    # No text is shuffled but those of the few rows that the map is wrong about.
    judged = marked(inner, gone, on, "may_go").withColumn("may_go", F.col("may_go") & F.col("doc_id").isNotNull())
    wrong = written(judged.where("may_go").select(*on).distinct().join(gone.distinct(), on, "left_anti"), "wrong")
    kept = _back(judged.where("NOT may_go"), docs)
    if not wrong.isEmpty():
        kept = kept.union(_back(fetched(inner, wrong, on), docs))
    if tied.isEmpty():
        return kept
    order = Window.partitionBy("class_key").orderBy(text, *(c for c in inner.columns if c.startswith("in_") and c != text))
    first = inner.join(tied, on).withColumn("place", F.row_number().over(order)).where("place = 1")
    return kept.union(_back(first, docs))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark passages make up less than a twentieth; null and
    empty texts hold none."""
    found = decontaminate.find(_apart(docs), table(spark, sf_dir, "benchmark"), text_col=_named(docs, "text"))
    return _back(found.where(~decontaminate.contaminated("n_hit", "n_words")), docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the digest of what they decode to; a null text
    counts as empty."""
    vocabulary = bpe.load_vocabulary(public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    coded = bpe.round_trip(docs.select("doc_id", "text"), vocabulary, keep=["doc_id"])
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("byte_bpe", byte_bpe),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
