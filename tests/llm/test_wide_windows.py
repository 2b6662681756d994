"""Benchmark windows that masses of items share."""

import pytest
from pyspark.sql import functions as F

from loomsift.llm import decontaminate

COMMON = "read the following passage and answer the question that follows in one word only please"


@pytest.mark.parametrize("items", [16, 17, 20_000])
def test_many_items_of_one_window(spark, monkeypatch, items):
    monkeypatch.setattr(decontaminate, "NODES", 1 << 18)
    benchmark = spark.range(items).select(F.col("id").alias("item_id"), F.concat(F.lit(COMMON + " about item"), F.col("id")).alias("text"))
    benchmark = benchmark.union(spark.createDataFrame([(10**6, "rare words")], benchmark.schema))
    docs = spark.createDataFrame([(0, f"so {COMMON} now"), (1, f"{COMMON} about item3 and rare words"), (2, "nothing"), (3, None), (2, "nothing"), (None, COMMON)], "doc_id long, text string")
    docs = docs.withColumn("at", F.lit("mine")).withColumn("number", F.lit(1)).withColumn("listed", F.lit(2))
    found = decontaminate.find(docs, benchmark)
    assert found.columns == ["doc_id", "text", "at", "number", "listed", "n_words", "n_hit", "items", "spans"]
    rows = found.collect()
    every = sorted(str(i) for i in range(items))
    want = {0: every, 1: sorted([*every, str(10**6)]), 2: [], 3: [], None: every}
    assert len(rows) == 6 and all(r["items"] == want[r.doc_id] and r["at"] == "mine" for r in rows)
    assert {r.doc_id: r.n_hit for r in rows} == {0: 15, 1: 19, 2: 0, 3: 0, None: 15}
