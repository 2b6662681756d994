"""Copies in masses, with and without ids: what the Jaccard join gathers in one group."""

import numpy as np
from pyspark.sql import functions as F

from loomsift.llm import jaccard_join

NEAR = [" ".join(f"w{i}" for i in range(60)), " ".join(f"w{i}" for i in range(60)) + " w60"]


def crowd(spark, n):
    """Two near texts without ids, empty texts, and a text of one id, n rows each."""
    rows = spark.range(4 * n).select(
        F.when(F.col("id") < 2 * n, F.lit(None)).when(F.col("id") < 3 * n, 7).otherwise(F.col("id")).cast("long").alias("doc_id"),
        F.when(F.col("id") < n, NEAR[0]).when(F.col("id") < 2 * n, NEAR[1]).when(F.col("id") < 3 * n, NEAR[0]).otherwise("").alias("text"),
    )
    return rows.repartition(8)


def test_documents_are_dealt_evenly(spark):
    docs = crowd(spark, 25_000).select(F.coalesce("doc_id", F.lit(-1)).alias("id"), "text", F.xxhash64("text").alias("h"))
    packed = jaccard_join._signed(docs, 4, jaccard_join.Rule(85), 64)
    held = packed.groupBy("slice").agg(F.sum(F.when(F.col("kind") == 0, F.octet_length("a") / 8)).alias("docs"), F.count_if(F.col("kind") != 0).alias("others")).collect()
    assert sum(r.docs or 0 for r in held) == 100_000
    assert max(r.docs or 0 for r in held) < 4000 and max(r.others for r in held) < 100


def test_a_set_is_shipped_once(spark):
    docs = crowd(spark, 500).select(F.coalesce("doc_id", F.lit(jaccard_join._NO_ID)).alias("id"), "text", F.xxhash64("text").alias("h"))
    own = docs.where("text <> ''").groupBy("h").agg(F.min("id").alias("id")).collect()
    sets = {jaccard_join.set_key(jaccard_join.shingles(t.encode(), 4)): F for t in NEAR}
    rows = [(r.id, r.h, key, 1, 1, 1) for r in own for key in sets]
    wanted = spark.createDataFrame(rows, "id long, h long, key long, component long, blocks int, copies long")
    assert jaccard_join._once(docs, wanted).count() == len(rows)
    assert jaccard_join._contents(docs, wanted, 4).count() == 2


def test_crowds_are_linked(spark):
    found = jaccard_join.join(crowd(spark, 3000), words=4, percent=85)
    assert found.where("n_shingles = 0 AND component_id = doc_id AND n_links = 0").count() == 3000
    told = {(r.doc_id if r.doc_id == 7 or r.doc_id is None else 0, r.n_shingles, r.component_id if r.n_shingles else None, r.n_links): r["count"] for r in found.groupBy("doc_id", "n_shingles", "component_id", "n_links").count().collect()}
    assert told == {(None, 57, 7, 8999): 3000, (None, 58, 7, 8999): 3000, (7, 57, 7, 8999): 3000, (0, 0, None, 0): 1} and found.count() == 12_000


def test_hot_signatures_send_few(spark):
    """Many near copies in one task: each signature goes out with a few keys."""
    base = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join([*base, f"own{i}"])) for i in range(2500)]
    docs = spark.createDataFrame(rows, "id long, text string").coalesce(1).withColumn("h", F.xxhash64("text"))
    packed = jaccard_join._signed(docs, 4, jaccard_join.Rule(85), 64).where("kind = 1").collect()
    signature = np.concatenate([np.frombuffer(r.a, np.uint32) for r in packed])
    assert np.unique(signature, return_counts=True)[1].max() <= jaccard_join.FEW + 1
    found = jaccard_join.join(docs.select(F.col("id").alias("doc_id"), "text"), words=4, percent=85)
    assert [tuple(r) for r in found.groupBy("component_id", "n_links").count().collect()] == [(0, 2499, 2500)]
