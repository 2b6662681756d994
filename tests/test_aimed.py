"""Cases by hand of what the queries over feeds, contracts, policies and work lists show."""

import random
import re

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from payloads import ATOM, PAPERS, RSS
from pyspark.sql import functions as F

from loomsift.operators import gates, scenarios
from loomsift.operators.contracts import EVAL, MANIFEST, errors
from loomsift.operators.policy import config_issues, protected
from loomsift.plans.catalogue import ORACLES, QUERIES
from loomsift.sources import feeds

def test_payloads_of_each_kind(spark):
    rows = lambda *r: spark.createDataFrame(list(r), "source string, body string")
    frames = [feeds.rss(rows(("a", RSS), ("broken", "<rss><channel>"), ("none", None))), feeds.atom(rows(("b", ATOM))), feeds.papers(rows(("p", PAPERS)))]
    found = feeds.union_in_order(frames).select("source_ord", "source", "place", "title", "url", "summary", "published", F.array_join("authors", ",").alias("authors"))
    assert sorted(map(tuple, found.collect())) == [
        (0, "a", 0, "First", "http://a/1", "Hi there", "Mon", None), (0, "a", 1, "Second", "http://a/2", "neural nets", "", None),
        (1, "b", 0, "One", "http://b/1", "s", "2024", None), (2, "arxiv", 0, "A paper", "http://p/1.html", "On neural things", "2024", "X,Y"),
    ]


@pytest.mark.parametrize("contract,line,found", [
    (MANIFEST, '{"name":"a","version":"v1","vertical":"signal","pair_count":3,"splits":{"train":{"path":"p","count":3,"sha256":"' + "a" * 64 + '"}}}', []),
    (MANIFEST, '{"name":"a","version":"1","vertical":"other","pair_count":0,"splits":{}}', [
        "Field 'pair_count': below minimum 1", "Field 'version': does not match the pattern", "Field 'vertical': not one of the allowed values", "Missing required field: splits.train"]),
    (MANIFEST, '{"name":5,"version":"v2","vertical":"core","pair_count":1,"splits":{"train":{"path":"p","count":1,"sha256":"zz"},"more":1},"format_distribution":{"x":1.5}}', [
        "Field 'format_distribution.x': out of bounds", "Field 'name': expected string", "Field 'splits.train.sha256': does not match the pattern", "Unexpected field: splits.more"]),
    (MANIFEST, "not json", ["malformed"]),
    (EVAL, '{"run_id":"r","model":"m","metric":"loss","score":0.5}', []),
    (EVAL, '{"run_id":"r","model":"m","metric":"length_ratio","score":"x","samples":0}', [
        "Field 'metric': not one of the allowed values", "Field 'samples': below minimum 1", "Field 'score': expected number"]),
])
def test_contracts(contract, line, found, spark):
    rows = spark.createDataFrame([(line,)], "line string")
    assert sorted(rows.select(errors(F.col("line"), contract).alias("e")).first().e) == found


def test_policies_over_rows(spark):
    paths = spark.createDataFrame([(p,) for p in ("core/a.py", "docs/core/x", "tests/t.py", "./core/x", "contracts/p.json", "src/a", "core", None)], "path string")
    assert [r.x for r in paths.select(protected(F.col("path")).alias("x")).collect()] == [True, False, True, False, True, False, False, None]
    rows = spark.createDataFrame([(0, True, 64, 5e-5, 4), (1, False, 8, 0.5, 1), (2, True, 4, 1e-2, 0)], "i int, there boolean, r int, lr double, b int")
    issues = rows.orderBy("i").select(config_issues(F.col("there"), F.col("r"), F.col("lr"), F.col("b")).alias("x")).collect()
    assert [r.x for r in issues] == [[], ["dataset not found", "learning_rate out of range"], ["lora_r out of range", "batch_size below 1"]]


def test_keys_are_dealt_to_categories_in_turn(spark):
    branches = [scenarios.Branch("f", c, i, ("BRIEFING",), "{x}") for c in "abc" for i in range(2)]
    keys = spark.createDataFrame([(k,) for k in (0, 1, 2, 3, 3, 10**18 + 1, -1, None)], "key long")
    work = scenarios.dealt(keys, F.col("key"), branches)
    told = [(r.category, r.idx) for r in work.collect()]
    big = 10**18 + 1
    assert told == [("a", 0), ("b", 0), ("c", 0), ("a", 1), ("a", 1), ("abc"[big % 3], big // 3), ("c", -1), (None, None)]
    made = scenarios.scenarios(spark, work, branches=branches, pools={"x": ("p", "q")})
    assert made.count() == 7 and made.where("idx = 1").select("prompt", "sub").distinct().collect() == [made.where("idx = 1").select("prompt", "sub").first()]
    assert scenarios.scenarios(spark, work.where("false"), branches=branches).count() == 0
    strange = work.limit(1).withColumn("category", F.lit("z"))
    assert scenarios.scenarios(spark, strange, branches=branches).count() == 0
    with pytest.raises(ValueError):
        scenarios.dealt(keys, F.col("key"), [])


def test_every_scenario_is_the_numbered_one(spark):
    """A work list makes what numbering every category makes."""
    numbered = scenarios.scenarios(spark, 4, families=["themed"])
    listed = scenarios.scenarios(spark, numbered.select("family", "category", "idx"), families=["themed"])
    assert sorted(map(tuple, numbered.collect())) == sorted(map(tuple, listed.collect()))


def test_feeds_of_awkward_documents(spark, tmp_path):
    texts = [(0, ""), (1, None), (2, "x"), (3, "a & b <i>c</i> > d"), (4, "t\n t \n\nu"), (5, "\n".join(f"l{i}" for i in range(30))), (9, "cut off"), (12, "\n".join(f"l{i}" for i in range(30)))]
    spark.createDataFrame(texts, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    rows = QUERIES["xml_feed_parse"](spark, str(tmp_path)).collect()
    by_url = {r.url: r for r in rows}
    assert by_url["http://a/3/0"].title == "a & b <i>c</i> > d" and by_url["http://a/3/0"].summary == "Of a & b c > d"
    assert [u for u in sorted(by_url) if u.startswith("http://b/4/")] == ["http://b/4/0", "http://b/4/3"]  # first of a title, none without
    assert len([u for u in by_url if u.startswith("http://a/12/")]) == 20 == len([u for u in by_url if u.startswith("http://p/5/")])
    assert not [u for u in by_url if "/9/" in u or "/1/" in u and "//b" in u] and by_url["http://a/0/0"].title == ""


_UNIT = st.text(alphabet="abé", min_size=1, max_size=90)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.lists(st.builds(lambda head, unit, times, tail: head + unit * times + tail, st.text("ab\n", max_size=50), _UNIT, st.integers(1, 50), st.text("ab", max_size=50)), max_size=3).map("\n".join)), max_size=6))
def test_whole_batches_are_degenerate_where_the_pattern_matches(texts):
    assert gates.degenerate_texts(texts) == [bool(re.search(r"(.{40,})\1{2,}", t or "")) for t in texts]


def test_batches_are_cut_between_texts(monkeypatch):
    rng = random.Random(3)
    words = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    texts = [words(rng.randrange(400)) + (words(60) * 3 if i % 4 == 0 else "") + "\n" * (i % 3) for i in range(60)] + ["", None, "\ud800" * 130]
    found = gates.degenerate_texts(texts)
    assert found == [i % 4 == 0 for i in range(60)] + [False, False, True]
    for size in (1, 100, 5000):
        monkeypatch.setattr(gates, "AT_ONCE", size)
        assert gates.degenerate_texts(texts) == found
    shared = words(200)
    assert gates.degenerate_texts([shared, shared + "\n" + shared, shared, shared]) == [False] * 4  # equal lines are no repetition
    assert gates.degenerate_texts([]) == []


def test_the_quick_twin_is_the_pattern():
    rng = random.Random(5)
    words = lambda n: "".join(rng.choice("abé") for _ in range(n))
    texts = [words(rng.randrange(300)) + words(rng.choice([1, 7, 39, 40, 41, 79, 90, 300])) * rng.choice([2, 3, 4, 60]) + words(rng.randrange(9)) for _ in range(300)]
    inner = words(50)
    texts += [(inner + words(30) + inner + words(20)) * n for n in (2, 3)] + ["x" * 119, "x" * 120, "", None, words(60) * 3 + "\n" + words(60)]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents AS SELECT * FROM (SELECT unnest($1::BIGINT[]) AS doc_id, unnest($2::VARCHAR[]) AS text)", [list(range(len(texts))), texts])
    found = dict(con.execute(ORACLES["gate_degenerate"]).fetchall())
    assert [found[i] for i in range(len(texts))] == [bool(re.search(r"(.{40,})\1{2,}", t or "")) for t in texts] == gates.degenerate_texts(texts)
