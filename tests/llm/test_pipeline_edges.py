"""Every stage of the pipeline on nulls, odd texts, repeats, ties, clashing columns."""

import hashlib
from collections import Counter

import corpus_pipeline as C
import pytest
from pyspark.sql import functions as F

CLASHES = {"lang_pred": "zz", "score": -5.0, "rejected": True, "n_words": 6, "n_hit": 77, "items": "i", "spans": "s", "_place": 9, "place": 8, "text_key": 3, "class_key": 4, "component_id": 5, "may_go": False, "in_0": 1}
PASSAGE = " ".join(f"passage{i} of the benchmark" for i in range(12))
PROSE = "the quick brown fox jumps over the lazy dog and then runs home through the old wet barn at night "


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("sf")
    spark.createDataFrame([(1, PASSAGE), (2, None)], "item_id long, text string").coalesce(1).write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def odd(spark):
    texts = [
        (0, PROSE * 3, "en"), (1, PROSE * 3, "en"), (2, None, "en"), (3, "", None), (4, "  \n", "en"), (5, "12 34 !", "en"),
        (6, "le chat dort sur la grande table pres de la fenetre ouverte", "fr"), (6, "le chien court dans le jardin avec son vieux maitre fatigue", "fr"),
        (6, "le chat dort sur la grande table pres de la fenetre ouverte", "fr"), (None, PROSE * 3, "en"), (None, None, None), (7, PASSAGE, "en"),
        (8, " ".join(f"long{i % 7919}er and" for i in range(9000)), "en"), (9, PROSE * 2 + PASSAGE, "en"), (10, "wort " * 50, "en"),
    ]
    rows = spark.createDataFrame(texts, "doc_id long, text string, lang string")
    return rows.select(*(F.lit(v).alias(k) for k, v in list(CLASHES.items())[:5]), "*", *(F.lit(v).alias(k) for k, v in list(CLASHES.items())[5:]))


def told(frame):
    return Counter((r.doc_id, r.text) for r in frame.collect())


def untouched(frame, docs):
    assert frame.columns == docs.columns
    for r in frame.collect():
        assert {k: r[k] for k in CLASHES} == CLASHES


def test_language_id(spark, odd, sf):
    kept = C.language_id(spark, odd, sf)
    untouched(kept, odd)
    lettered = Counter({k: n for k, n in told(odd).items() if k[1] and any(c.isalpha() for c in k[1])})
    assert told(kept) <= lettered and sum(told(kept).values()) >= sum(lettered.values()) - 1


def test_near_duplicates(spark, odd, sf):
    kept = C.near_duplicates(spark, odd, sf)
    untouched(kept, odd)
    chat = "le chat dort sur la grande table pres de la fenetre ouverte"
    assert told(odd) - told(kept) == Counter({(1, PROSE * 3): 1, (6, chat): 1})


def test_decontamination(spark, odd, sf):
    kept = C.decontamination(spark, odd, sf)
    untouched(kept, odd)
    assert told(odd) - told(kept) == Counter({(7, PASSAGE): 1, (9, PROSE * 2 + PASSAGE): 1})


def test_byte_bpe(spark, odd, sf):
    rows = C.byte_bpe(spark, odd, sf).collect()
    wanted = Counter((i, hashlib.sha256((t or "").encode()).hexdigest()) for i, t in told(odd).elements())
    assert Counter((r.doc_id, r.decoded_sha256) for r in rows) == wanted and all(r.n_tokens == len(r.ids) for r in rows)


@pytest.mark.parametrize("stage", [f for _, f in C.STAGES])
def test_empty_tables(spark, odd, sf, stage):
    assert stage(spark, odd.limit(0), sf).count() == 0


def test_order_of_rows_and_files_does_not_matter(spark, odd, sf):
    for _, stage in C.STAGES[1:3]:
        assert told(stage(spark, odd.repartition(5).orderBy(F.desc("text")), sf)) == told(stage(spark, odd, sf))
