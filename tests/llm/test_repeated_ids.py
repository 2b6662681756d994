"""The pipeline's near-duplicate stage where documents share an id."""

from collections import Counter

import corpus_pipeline as C


def _text(name, n=40):
    return " ".join(f"{name}{i}" for i in range(n))


def test_near_duplicates_judge_rows_by_their_text(spark):
    a, b, c, d = map(_text, "abcd")
    rows = [
        (1, a), (2, a), (2, b),  # 2 names a copy of 1 and a text of its own
        (3, c), (3, d), (3, _text("e")),  # three clean texts
        (4, _text("f")), (5, _text("f")), (5, _text("g")), (6, _text("g")),  # 5 is least in one group, not in another
        (7, _text("h")), (7, _text("h")), (7, _text("h") + " more"),  # one group, one id
        (7, _text("m")), (8, _text("m")), (7, _text("n")), (9, _text("n")),  # and least in two further groups
        (10, ""), (10, None), (10, _text("p")), (None, a), (None, _text("q")),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = C.near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    gone = Counter([(2, a), (5, _text("f")), (6, _text("g")), (7, _text("h")), (7, _text("h") + " more"), (8, _text("m")), (9, _text("n"))])
    assert Counter(map(tuple, kept.collect())) == Counter(rows) - gone
