"""State stores, listeners, commit logs, hashed files, stopped runs and own scorers."""

import hashlib
import os
import threading
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomsift.operators import evaluate, generate
from loomsift.plans.catalogue import ORACLES, QUERIES
from loomsift.sources import hashed, jsonl
from loomsift.sources.commit_log import CommitLog
from loomsift.streaming.stateful import run_stateful

KEYED = T.StructType([T.StructField("k", T.LongType()), T.StructField("i", T.LongType()), T.StructField("at", T.TimestampType())])


def keyed(spark, rows):
    return spark.createDataFrame([(k, i) for k, i in rows], "k long, i long").withColumn("at", F.timestamp_micros(F.col("i") % 1_000_003 * 1_000_003))


def test_keys_in_a_state_store(spark, tmp_path):
    """Null and hot keys, repeated files, a failing run that is run again, and no scan of
    what was kept."""
    source, out, state = (f"{tmp_path}/{n}" for n in ("in", "out", "state"))
    told = []
    run = lambda keep=lambda df: df: run_stateful(spark, source, KEYED, out, state, F.col("k"), [F.col("i")], keep, tell=told.append)
    keyed(spark, [(1, 9), (1, 5), (None, 7), (None, 6), (2, 2**53 + 1)] + [(3, 100 + i) for i in range(5000)]).write.mode("append").parquet(source)
    run()
    keyed(spark, [(1, 1), (None, 1), (4, 4), (4, 3)]).write.mode("append").parquet(source)
    with pytest.raises(Exception, match="broken"):
        run(lambda df: df.where(F.raise_error(F.lit("broken")).cast("boolean")))
    run()
    run()  # nothing new
    found = spark.read.parquet(f"{out}/rows").drop("batch")
    assert sorted(map(str, (tuple(r)[:2] for r in found.collect()))) == sorted(map(str, [(1, 5), (None, 6), (2, 2**53 + 1), (3, 100), (4, 3)]))
    assert found.where(F.col("at") != F.timestamp_micros(F.col("i") % 1_000_003 * 1_000_003)).count() == 0
    assert sum(t["read"] for t in told) >= 5009 and sum(t["kept"] for t in told) == 5
    assert not os.path.exists(f"{out}/keys") and os.listdir(f"{state}/state")


def test_writers_at_once(spark, tmp_path):
    """Four writers with common keys, in threads: each key once, no key lost."""
    schema = keyed(spark, [(1, 1)]).schema
    rows = lambda w: keyed(spark, [(k, w * 100 + k) for k in range(w, w + 12)] + [(None, w)])
    failed = []

    def write(w):
        try:
            CommitLog(spark, f"{tmp_path}/t", schema).append(rows(w), F.col("k"), [F.col("i")])
        except Exception as error:
            failed.append(error)

    threads = [threading.Thread(target=write, args=(w,)) for w in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    log = CommitLog(spark, f"{tmp_path}/t", schema)
    found = log.read().collect()
    assert not failed and sorted(str(r.k) for r in found) == sorted([*map(str, range(15)), "None"])
    assert [e["number"] for e in log.entries()] == list(range(1, log.head() + 1)) and sum(e["rows"] for e in log.entries()) == 16
    assert log.vacuum() == 0


def test_a_draft_is_judged_again(spark, tmp_path):
    log = CommitLog(spark, f"{tmp_path}/t", keyed(spark, [(1, 1)]).schema)
    assert log.read().count() == 0 and log.head() == 0 and log.vacuum() == 0
    drafts = [log.draft(keyed(spark, rows), F.col("k"), [F.col("i")]) for rows in ([(1, 1), (1, 0), (2, 2)], [(1, 5)], [(2, 7), (3, 8)], [])]
    assert [log.commit(d) for d in drafts] == [1, None, 2, None]
    assert sorted((r.k, r.i, r.entry) for r in log.read().collect()) == [(1, 0, 1), (2, 2, 1), (3, 8, 2)]
    abandoned = log.draft(keyed(spark, [(9, 9)]), F.col("k"), [F.col("i")])
    assert log.vacuum([abandoned]) == 0 and log.vacuum() == 1


def test_hashed_files(spark, tmp_path):
    path = f"{tmp_path}/h"
    rows = [("a/b c", 2, "two"), ("a/b c", 1, "öne"), (None, 1, "x"), ("ü", 1, None), ("ü", 2, "")] + [("hot", i, f"line {i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "name string, at long, line string")
    told = {r.name: r for r in hashed.write_by(df, path, F.col("name"), F.col("line"), ["at"]).collect()}
    want = {"a/b c": "öne\ntwo\n", None: "x\n", "ü": "\n\n", "hot": "".join(f"line {i}\n" for i in range(3000))}
    assert set(told) == set(want)
    for name, text in want.items():
        r = told[name]
        content = open(f"{path}/{r.file}", "rb").read()
        assert content == text.encode() and r.sha256 == hashlib.sha256(content).hexdigest() and r.bytes == len(content) and r.rows == text.count("\n")
    hashed.write_by(df.where("name = 'hot' AND at < 2"), path, F.col("name"), F.col("line"), ["at"])  # written over
    assert sorted(os.listdir(path)) == sorted(["hot.jsonl", hashed.MANIFEST]) or {f for f in os.listdir(path) if not f.startswith(".")} == {"hot.jsonl", hashed.MANIFEST}
    assert hashed.write_by(df.limit(0), path, F.col("name"), F.col("line"), ["at"]).count() == 0


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    path = f"{tmp_path}/h"
    df = spark.range(4).select(F.lit("f").alias("file"), F.when(F.col("id") == 3, F.raise_error(F.lit("broken"))).otherwise("x").alias("line"))
    with pytest.raises(Exception, match="broken"):
        hashed.save(df, path)
    # A task that is killed late may leave a draft, which readers don't see.
    assert not os.path.exists(path) or not [f for f in os.listdir(path) if not f.startswith("_drafts")]
    hashed.save(spark.createDataFrame([("a", "1")], "file string, line string"), path)
    assert sorted(f for f in os.listdir(path) if not f.startswith(".")) == [hashed.MANIFEST, "a.jsonl"]
    with pytest.raises(Exception, match="more than one run"):
        hashed.save(spark.createDataFrame([("a", "1"), ("b", "2"), ("a", "3")], "file string, line string").coalesce(1), path)


@pytest.mark.parametrize("files", [1, 3])
def test_hashed_lines_of_one_and_of_several_files(spark, tmp_path, files):
    rows = spark.range(500).select(((F.col("id") * 7) % 500).alias("at"), F.concat(F.lit("l"), (F.col("id") * 7) % 500).alias("line"))
    told = jsonl.write_hashed(rows, f"{tmp_path}/o", "at", F.col("line"), files=files)
    assert told.sha256 == hashlib.sha256("".join(f"l{i}\n" for i in range(500)).encode()).hexdigest() and told.n == 500
    back = sorted((r.place, r.line) for r in jsonl.in_order(spark, f"{tmp_path}/o").collect())
    assert back == [(i + 1, f"l{i}") for i in range(500)]
    none = jsonl.write_hashed(rows.limit(0), f"{tmp_path}/e", "at", F.col("line"), files=files)
    assert none.n == 0 and none.sha256 == hashlib.sha256().hexdigest()


def counting(folder, refuses):
    """A stub that tells of its calls by files, and refuses one prompt. (Made here, so that
    workers needn't import this module.)"""

    class Counting:
        def complete(self, prompt, max_tokens):
            open(f"{folder}/{uuid.uuid4().hex}", "w").close()
            if prompt == refuses:
                raise generate.GenerationError(403, "no credit")
            return f"to {prompt}"

    return Counting()


def test_a_fatal_answer_ends_the_run(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()
    rows = spark.range(2000).select(F.concat(F.lit("p"), F.col("id") % 1000).alias("prompt"), F.lit(5).alias("max_tokens"), F.lit(0).alias("min_len"))
    rows = rows.union(spark.createDataFrame([(None, 5, 0)], rows.schema)).repartition(4)
    store = f"{tmp_path}/store"
    with pytest.raises(generate.Stopped, match="no credit") as told:
        generate.generate(rows, counting(str(calls), "p7"), store=store)
    asked = len(os.listdir(calls))
    assert told.value.answered + told.value.cancelled == 1000 and told.value.cancelled > 0 and told.value.answered < asked
    found = generate.generate(rows, counting(str(calls), None), store=store).collect()
    assert len(os.listdir(calls)) == asked + told.value.cancelled
    assert len(found) == 2001 and all(r.text == (r.prompt and f"to {r.prompt}") for r in found)
    assert generate.generate(rows, counting(str(calls), "p7"), store=store).count() == 2001  # nothing is left to ask
    assert len(os.listdir(calls)) == asked + told.value.cancelled
    assert generate.generate(rows.limit(0), counting(str(calls), None)).count() == 0


def odd(short=False):
    class Odd:
        def score(self, predictions, references):
            out = [{} if p is None else {"n": None if r is None else len(r), **({"x": 1} if p == r else {})} for p, r in zip(predictions, references, strict=True)]
            return out[1:] if short else out

    return Odd()


def test_own_scorer(spark):
    rows = spark.createDataFrame([(1, "a", "a", "m"), (2, None, "b", "m"), (3, "c", None, "m"), (None, "", "", "m")], "id long, p string, r string, metric_of string")
    found = evaluate.scored(rows, odd(), "p", "r", ["id", "metric_of"])
    assert found.columns == ["id", "metric_of", "metric", "score"]
    assert sorted(map(str, (tuple(r) for r in found.collect()))) == sorted(map(str, [(1, "m", "n", 1.0), (1, "m", "x", 1.0), (3, "m", "n", None), (None, "m", "n", 0.0), (None, "m", "x", 1.0)]))
    assert evaluate.scored(rows.limit(0), odd(), "p", "r").count() == 0
    with pytest.raises(Exception, match="results for"):
        evaluate.scored(rows, odd(True), "p", "r").collect()


def test_files_with_equal_and_blank_lines(spark, tmp_path):
    """Conversations whose pairs are equal to the letter, and documents without words."""
    import duckdb
    from twins import same_rows

    con = duckdb.connect()
    turn = lambda c: [(c, 0, "user", "the same question " * 9), (c, 1, "assistant", "the same answer " * 9)]
    spark.createDataFrame([t for c in range(3) for t in turn(c)], "conv_id long, turn long, role string, text string").coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    spark.createDataFrame([(c, 1) for c in range(3)], "doc_id long, quality int").coalesce(1).write.parquet(f"{tmp_path}/labels.parquet")
    docs = [(0, "", "s"), (1, " ", "s"), (2, None, "s"), (3, "a\nb", None), (4, "a\nb", None)]
    spark.createDataFrame(docs, "doc_id long, text string, source string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("conversations", "labels", "documents"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    assert QUERIES["split_files"](spark, str(tmp_path)).count() == 3
    for name in ("split_files", "jsonl_round_trip"):
        same_rows(QUERIES[name](spark, str(tmp_path)), con, ORACLES[name])
