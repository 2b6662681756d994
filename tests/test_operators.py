"""Small hand-computed cases of the engine's own operators."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomsift.functions import score, text
from loomsift import runtime, transforms
from loomsift.operators import contracts, gates, generate, policy, profile, render, scenarios, split
from loomsift.operators.dedup import against_ledger, first_wins
from loomsift.operators.evaluate import predicted, results
from loomsift.sources import feeds, jsonl
from loomsift.streaming import incremental


def one(spark, column, **values):
    names = list(values)
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{n} {t}" for n, t in _types(values))).select(column.alias("x")).first().x if names else None


def _types(values):
    return [(k, {str: "string", int: "long", float: "double", bool: "boolean", type(None): "string"}[type(v)]) for k, v in values.items()]


def test_dedup_precedes_filters(spark):
    rows = spark.createDataFrame([(0, "k", 10), (1, "k", 900), (2, "m", 900)], "i long, key string, n long")
    kept = first_wins(rows, [F.col("key")], [F.col("i")]).where("n >= 300")
    assert [r.i for r in kept.collect()] == [2]


def test_title_keys(spark):
    assert one(spark, text.title_key(F.col("a")), a="Hello, World! 42") == "helloworld42"
    assert one(spark, text.title_key(F.col("a")), a="日本語") == ""
    assert one(spark, text.title_key(F.col("a")), a="x" * 60) == "x" * 50


def test_fingerprint_falls_back(spark):
    made = one(spark, text.fingerprint(F.col("f"), F.col("c")), f="", c="a" * 300)
    assert len(made) == 16 and made == one(spark, text.fingerprint(F.col("f"), F.col("c")), f=None, c="a" * 200)
    assert one(spark, text.fingerprint(F.col("f"), F.col("c")), f="given", c="a") == "given"


def test_words_do_not_match_inflections(spark):
    assert one(spark, text.holds_any(F.col("a"), ["fine[- ]tun", "LLM"]), a="fine-tuning LLMs") is False
    assert one(spark, text.holds_any(F.col("a"), ["llm"]), a="an LLM.") is True


def test_thinking_and_drafts(spark):
    assert one(spark, text.drop_thinking(F.col("a")), a="<think>x\ny</think>  ok<think>z</think> go") == "okgo"
    assert one(spark, gates.draft_accepted(F.col("a"), F.lit(7)), a="abc") is False
    assert one(spark, gates.draft_accepted(F.col("a"), F.lit(7)), a="abcd") is True


@settings(max_examples=150, deadline=None)
@given(st.text("ab ", min_size=1, max_size=60), st.integers(1, 5), st.text("abc", max_size=20), st.text("abc", max_size=20))
def test_degenerate_is_the_pattern(unit, times, head, tail):
    line = head + unit * times + tail
    assert gates.degenerate_line(line) == bool(re.search(r"(.{40,})\1{2,}", line))


@pytest.mark.parametrize(("unit", "hit"), [(39, False), (40, True)])
def test_degenerate_bounds(unit, hit):
    assert gates.degenerate_line("".join(chr(200 + i) for i in range(unit)) * 3) is hit


def test_degenerate_where_windows_recur_within_a_unit():
    x, y = "".join(chr(300 + i) for i in range(25)) * 1, "".join(chr(400 + i) for i in range(45))
    unit = "".join({"x": x + "!", "y": y}[c] for c in "xxyyxy")
    assert gates.degenerate_line("a" + unit * 3 + "b") and not gates.degenerate_line(unit * 2 + unit[:-1])


def test_degenerate_takes_long_lines():
    import random
    import time

    draw = random.Random(5)
    passage, rest = ("".join(chr(draw.randint(97, 122)) for _ in range(n)) for n in (60, 330_000))
    began = time.process_time()
    assert not gates.degenerate_line(rest + passage + rest[::-1] + passage + rest[::2] * 2 + passage)
    assert time.process_time() - began < 10


def test_first_failing_gate_wins(spark):
    rows = spark.createDataFrame([("short",), ("a" * 700,), ("Some Name 12% of 1999, $5M. " * 30,)], "t string")
    reasons = [r.reason for r in gates.gated(rows, F.col("t"), F.lit("company"), gates.FIRST).collect()]
    assert reasons == ["too_short_5/600", "degenerate", "degenerate"]


def test_banned_counts(spark):
    body = " ".join(f"Word Name{i}x at {i}{i}% in {1990 + i}." for i in range(60))
    for n, passed in ((2, True), (3, False)):
        rows = spark.createDataFrame([(body + " boundless synergy;" * n,)], "t string")
        assert gates.gated(rows, F.col("t"), F.lit("market"), gates.FIRST).first().passed is passed


def errors_of(spark, line):
    return contracts.validated(spark.createDataFrame([(line,)], "line string"), "line").first().errors


GOOD = '"instruction":"0123456789","response":"' + "r" * 50 + '","domain":"d"'


@pytest.mark.parametrize(("line", "found"), [
    ("{" + GOOD + ',"score":0.5}', []),
    ("{" + GOOD + ',"score":true}', []),
    ("{" + GOOD + ',"score":1,"metadata":{"a":1}}', []),
    ("{" + GOOD + "}", ["Missing required field: score"]),
    ("{" + GOOD + ',"score":"x"}', ["Field 'score': expected number"]),
    ("{" + GOOD + ',"score":null}', ["Field 'score': expected number"]),
    ("{" + GOOD + ',"score":1.5}', ["Field 'score': above maximum 1.0"]),
    ("{" + GOOD + ',"score":-0.5,"x":1}', ["Field 'score': below minimum 0.0", "Unexpected field: x"]),
    ('{"instruction":5,"response":"r","score":0,"domain":""}', ["Field 'domain': length 0 < minLength 1", "Field 'instruction': expected string", "Field 'response': length 1 < minLength 50"]),
    ("[1]", ["malformed"]), ("{", ["malformed"]),
])
def test_pair_contract(spark, line, found):
    assert errors_of(spark, line) == found


def test_malformed_may_fail(spark):
    rows = spark.createDataFrame([("{",)], "line string")
    with pytest.raises(Exception, match="malformed"):
        contracts.validated(rows, "line", on_malformed="fail").collect()


@pytest.mark.parametrize(("n", "total", "good"), [(99, 199, False), (100, 200, True), (16000, 32000, True), (16000, 32001, False)])
def test_pair_lengths(spark, n, total, good):
    column = contracts.good_pair(F.repeat(F.lit("a"), n), F.repeat(F.lit("b"), total - n), F.lit(0.7), F.array().cast("array<string>"))
    assert spark.range(1).select(column.alias("x")).first().x is good


@pytest.mark.parametrize(("n", "train", "evaluated"), [(0, 0, 0), (1, 1, 0), (100, 95, 5)])
def test_factory_split(spark, n, train, evaluated):
    counts = {r.split: r["count"] for r in split.factory_split(spark.range(n), "id").groupBy("split").count().collect()}
    assert (counts.get("train", 0), counts.get("eval", 0)) == (train, evaluated)


@pytest.mark.parametrize(("n", "train"), [(400, 0), (500, 0), (501, 1), (20000, 19000)])
def test_assembler_split(spark, n, train):
    assert split.assembler_split(spark.range(n), "id").where("split = 'train'").count() == train


def test_ranks_are_global(spark):
    rows = split.ranked(spark.range(3000), split.seeded(1, F.col("id"))).orderBy("rank").collect()
    import hashlib

    assert [r["rank"] for r in rows] == list(range(1, 3001))
    assert [r.id for r in rows] == sorted(range(3000), key=lambda i: hashlib.sha256(f"1:{i}".encode()).hexdigest())


@pytest.mark.parametrize("n", [1, 4095, 4096, 4097, 20_000])
def test_file_digest_is_that_of_the_file(spark, tmp_path, n):
    import hashlib

    rows = spark.range(1, n + 1).repartition(3).select(F.col("id").alias("rank"), F.concat(F.lit("é"), F.col("id").cast("string")).alias("line"), F.when(F.col("id") > 0, "x").alias("part"))
    whole = "".join(f"é{i}\n" for i in range(1, n + 1)).encode()
    assert [tuple(r) for r in profile.file_digest(rows, "rank", F.col("line")).collect()] == [(n, hashlib.sha256(whole).hexdigest())]
    found = profile.file_digest(rows.union(spark.createDataFrame([(5, "b", None), (2, "a", None)], "rank long, line string, part string")), "rank", F.col("line"), ["part"])
    assert {r.part: (r.n, r.sha256) for r in found.collect()} == {"x": (n, hashlib.sha256(whole).hexdigest()), None: (2, hashlib.sha256(b"a\nb\n").hexdigest())}
    told = jsonl.write_hashed(rows, f"{tmp_path}/o", "rank", F.col("line"), files=3)
    parts = sorted((tmp_path / "o").glob("part-*"))
    assert (told.n, told.sha256) == (n, hashlib.sha256(whole).hexdigest()) and b"".join(p.read_bytes() for p in parts) == whole
    assert profile.file_digest(rows.limit(0), "rank", F.col("line")).count() == 0


def test_tree_digest(spark):
    import hashlib

    sha = lambda level, *parts: hashlib.sha256("".join([f"level {level}\n", *parts]).encode()).hexdigest()
    lines = [f"é{i}\n" for i in range(1, 11)]
    rows = spark.range(1, 11).select(F.col("id").alias("rank"), F.concat(F.lit("é"), F.col("id").cast("string")).alias("line"))
    assert tuple(profile.tree_digest(rows, "rank", F.col("line")).first()) == (10, sha(1, *lines))
    tree = profile.tree_digest(rows, "rank", F.col("line"), block=4).first()
    assert (tree.n, tree.tree_sha256) == (10, sha(2, *(sha(1, *lines[i : i + 4]) for i in (0, 4, 8))))


def test_policies(spark):
    assert one(spark, policy.protected(F.col("a")), a="core/x") and not one(spark, policy.protected(F.col("a")), a="x/core/")
    with pytest.raises(PermissionError):
        policy.check_paths(["src/a", "tests/b"])


def test_scores(spark):
    assert one(spark, score.length_ratio(F.col("a"), F.col("b")), a="", b="") == 0.0
    assert one(spark, score.exact_match(F.col("a"), F.col("b")), a=" x\n", b="x") == 1.0
    rows = predicted(spark.createDataFrame([("ab", "AB")], "instruction string, response string"), str.upper, "instruction")
    assert predicted(rows.select("instruction"), lambda texts: texts.str.upper(), "instruction", batched=True).first().prediction == "AB"
    found = {r.metric: r.score for r in results(rows, F.col("prediction"), F.col("response"), "r", "m", "t").collect()}
    assert found == {"length_ratio": 1.0, "exact_match": 1.0}


def test_retries():
    waits, replies = [], iter([generate.GenerationError(429), "short", "long enough"])

    def call():
        reply = next(replies)
        if isinstance(reply, Exception):
            raise reply
        return reply

    assert generate.attempt(call, 5, sleep=waits.append) == ("long enough", 3, None) and waits == [2]

    def refuse():
        raise generate.GenerationError(403)

    assert generate.attempt(refuse, 5, sleep=waits.append)[1:] == (1, "fatal: 403")


def test_thinking_goes_before_the_length_test():
    replies = iter(["<think>" + "long " * 50 + "</think>  tiny", "<think>x</think> an answer"])
    assert generate.attempt(lambda: next(replies), 5) == ("an answer", 2, None)


@pytest.fixture()
def server():
    """A local stand-in for either kind of server; what it was asked."""
    import json
    import threading
    from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):
            payload = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            asked.append((self.path, self.headers.get("Authorization"), payload))
            text = f" <think>hm</think> re: {payload['messages'][-1]['content']} "
            body = {"/chat": {"choices": [{"message": {"content": text}}]}, "/ollama": {"message": {"content": text}}}.get(self.path)
            self.send_response(200 if body or self.path == "/odd" else 403)
            self.end_headers()
            self.wfile.write(json.dumps(body).encode())

        def log_message(self, *args):
            pass

    asked: list = []
    web = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=web.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{web.server_port}", asked
    web.shutdown()


def test_http_generators(server, monkeypatch):
    url, asked = server
    monkeypatch.setenv("MODEL_KEY", "k")
    chat = generate.Http(f"{url}/chat", "m", system="be brief", key_variable="MODEL_KEY")
    assert generate.attempt(lambda: chat.complete("hello there", 9), 5) == ("re: hello there", 1, None)
    assert asked[-1] == ("/chat", "Bearer k", {"model": "m", "messages": [{"role": "system", "content": "be brief"}, {"role": "user", "content": "hello there"}], "max_tokens": 9, "temperature": 0.7})
    local = generate.Http(f"{url}/ollama", "m", generate.OLLAMA_CHAT, sampling={"top_p": 0.9})
    assert local.complete("x", 7).endswith("re: x")
    assert asked[-1][1:] == (None, {"model": "m", "messages": [{"role": "user", "content": "x"}], "stream": False, "options": {"num_predict": 7, "top_p": 0.9}})
    for path, status in (("/none", 403), ("/odd", 0)):
        with pytest.raises(generate.GenerationError) as caught:
            generate.Http(f"{url}{path}", "m").complete("x", 1)
        assert caught.value.status == status
    with pytest.raises(generate.GenerationError):
        generate.Http("http://127.0.0.1:9/none", "m").complete("x", 1)


def test_each_prompt_is_asked_for_once(spark, server):
    url, asked = server
    rows = spark.createDataFrame([(i, p, 64, 4) for i, p in enumerate(["one", "two", "one", None])], "i long, prompt string, max_tokens int, min_len int")
    done = generate.generate(rows, generate.Http(f"{url}/chat", "m"))
    wanted = {0: ("re: one", 1), 1: ("re: two", 1), 2: ("re: one", 1), 3: (None, None)}
    for _ in range(2):
        assert {r.i: (r.text, r.attempts) for r in done.collect()} == wanted
    assert len(asked) == 2
    tiers = generate.two_tier(rows.where("prompt IS NOT NULL"), lambda d: d.withColumn("text", F.lit(None).cast("string")).withColumn("attempts", F.lit(1)).withColumn("error", F.lit("e")), lambda d: generate.generate(d, generate.Http(f"{url}/chat", "m")), F.length("text") > 3)
    assert tiers.count() == 3 and {r.tier for r in tiers.collect()} == {"rewrite"} and len(asked) == 4
    assert tuple(generate.calls_by_kind(done).first()) == (3, 0, 3)


def test_two_tiers_recheck(spark):
    rows = spark.createDataFrame([("ok long",), ("bad",)], "prompt string")
    run = lambda recheck: {r.prompt: r.tier for r in generate.two_tier(rows, lambda d: d.withColumn("text", F.col("prompt")), lambda d: d.withColumn("text", F.lit("tiny")), F.length("text") > 5, recheck).collect()}
    assert run(False) == {"ok long": "gen", "bad": "rewrite"} and run(True)["bad"] == "failed"


def test_briefing_hides_what_is_missing(spark):
    items = spark.createDataFrame([(0, "a", "T", "", 0, None, None), (1, "arxiv", "P", "s", None, None, ["x", "y", "z", "w"])], "ordinal long, source string, title string, summary string, score long, comments long, authors array<string>")
    lines = {r.section: r.line for r in render.briefing_lines(items, "ordinal").collect()}
    assert lines == {"news": "- T", "papers": "- P (x, y, z)\n  s"}
    empty = render.briefing_prompt(items.where("ordinal = 0"), "ordinal", "d").first().prompt
    assert "## Papers" not in empty and "(1 from 1 sources)" in empty


def test_feeds(spark):
    from payloads import ATOM, PAPERS, RSS

    rows = lambda body: spark.createDataFrame([("s", body)], "source string, body string")
    assert [(r.title, r.summary) for r in feeds.rss(rows(RSS)).orderBy("place").collect()] == [("First", "Hi there"), ("Second", "neural nets")]
    assert [(r.title, r.url, r.published) for r in feeds.atom(rows(ATOM)).collect()] == [("One", "http://b/1", "2024")]
    paper = feeds.papers(rows(PAPERS)).first()
    assert (paper.title, paper.summary, paper.url, paper.authors, paper.categories) == ("A paper", "On neural things", "http://p/1.html", ["X", "Y"], ["cs.AI", "cs.CL"])
    assert feeds.rss(rows("<rss")).count() == feeds.rss(rows(None)).count() == 0


def test_http_source_reads_what_it_can(spark, tmp_path):
    (tmp_path / "f.xml").write_text("<rss/>")
    feeds.register(spark)
    urls = f"a=file://{tmp_path}/f.xml\nb=file://{tmp_path}/none.xml"
    assert {r.source: r.body for r in spark.read.format("http_payloads").option("urls", urls).load().collect()} == {"a": "<rss/>", "b": None}


def test_jsonl_and_latest(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"a":1}\n\n  \n{"a":2}\n')
    rows = jsonl.lines(spark, [f"{tmp_path}/none.jsonl", f"{tmp_path}/a.jsonl"])
    assert sorted((r.source_ord, r.record.a) for r in jsonl.parsed(rows, "a int").collect()) == [(1, 1), (1, 2)]
    for name in ("signals_2024-01-02.json", "signals_2024-01-10.json"):
        (tmp_path / name).write_text("{}")
    assert jsonl.latest(spark, str(tmp_path)).endswith("signals_2024-01-10.json")
    assert jsonl.latest(spark, str(tmp_path / "none")) is None
    jsonl.write_json(spark, f"{tmp_path}/out.json", {"é": 1})
    assert jsonl.document(spark, f"{tmp_path}/out.json") == {"é": 1}


def test_documents_are_replaced_whole(spark, tmp_path):
    for n in range(2):
        jsonl.write_json(spark, f"file://{tmp_path}/d.json", {"n": n})
        assert jsonl.document(spark, f"file://{tmp_path}/d.json") == {"n": n}
    assert [p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")] == ["d.json"]


def test_ledgers_hold_null_keys(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, None), (3, None), (4, "b")], "i long, k string")
    assert [r.i for r in against_ledger(rows, rows.where("i < 3"), "k").collect()] == [4]
    out = f"{tmp_path}/out"
    added = lambda *ids: sorted(r.i for r in incremental.append_new(rows.where(F.col("i").isin(*ids)), out, F.col("k"), [F.col("i")]).collect())
    assert added(1, 2, 3) == [1, 2] and added(3, 4) == [4] and added(1, 2, 3, 4) == []
    assert sorted((r.i, r.k) for r in incremental.appended(spark, out, rows.schema).collect()) == [(1, "a"), (2, None), (4, "b")]
    (tmp_path / "out/keys/batch=2/_SUCCESS").unlink()  # an unfinished batch doesn't count and is written over
    assert incremental.appended(spark, out, rows.schema).count() == 3 and added(1) == []


def test_incremental_runs_tell_their_progress(spark, tmp_path):
    seen = []
    run = lambda: incremental.run_once(spark, f"{tmp_path}/in", rows.schema, f"{tmp_path}/out", f"{tmp_path}/state", F.col("k"), [F.col("i")], lambda df: df.where("i <> 4"), snapshot=seen.append)
    rows = spark.createDataFrame([(1, "a"), (2, None), (3, None), (4, "b")], "i long, k string")
    rows.write.parquet(f"{tmp_path}/in")
    run()
    spark.createDataFrame([(5, None), (6, "c")], rows.schema).write.mode("append").parquet(f"{tmp_path}/in")
    run()
    assert seen == [{"batch": 0, "read": 4, "new": 3, "kept": 2}, {"batch": 1, "read": 2, "new": 1, "kept": 1}]
    assert sorted(r.i for r in incremental.result(spark, f"{tmp_path}/out").collect()) == [1, 2, 6]


def test_runtime(spark):
    from loomsift import runtime as R

    @R.step("double", rows="x bigint")
    def double(rows):
        return {"out": rows.select((F.col("x") * 2).alias("x"))}

    steps, seen = R.catalogue(double), []
    rows = spark.createDataFrame([(2,)], "x bigint")
    assert R.watched(steps["double"], "r1", seen.append)(rows=rows)["out"].first().x == 4
    assert [(e.kind, e.transform, e.run) for e in seen] == [("start", "double", "r1"), ("end", "double", "r1")]
    with pytest.raises(R.BadInput, match="rows: missing"):
        R.watched(double, "r2", seen.append)()
    with pytest.raises(R.BadInput, match="rows.x: string, not bigint"):
        double(rows=rows.select(F.col("x").cast("string")))
    assert [e.kind for e in seen] == ["start", "end", "start"]  # no end after an error
    with pytest.raises(TypeError, match="DataFrames"):
        R.step("none", rows="")(lambda rows: {"out": 5})(rows=rows)
    with pytest.raises(TypeError):
        R.step("none")(5)
    with pytest.raises(ValueError, match="taken: double"):
        steps | R.catalogue(double)
    with pytest.raises(KeyError, match="double"):
        steps["other"]
    assert list(steps) == ["double"] and len(steps.without("double")) == 0 and "double" in steps
    with pytest.raises(KeyError):
        steps.without("other")


def test_scenarios(spark):
    assert scenarios.cut("a {x} b {y+z} {1..28}{x:2}{x*3}{x=y*2}\n{outline}") == (
        ["a ", " b ", " ", "", "", "", "\n", ""],
        [scenarios.Slot("one", "x"), scenarios.Slot("one", "y", "z"), scenarios.Slot("number", n=28, low=1), scenarios.Slot("row", "x", n=2),
         scenarios.Slot("lines", "x", n=3), scenarios.Slot("pairs", "x", "y", 2), scenarios.Slot("outline")],
    )
    branches = [scenarios.Branch("f", "c", 0, ("BRIEFING",), "{x} {none}|{x:9}|{x=y*3}"), scenarios.Branch("f", "c", 1, ("JOURNAL",), "{5..5} {y+x} {{x}}")]
    pools = {"x": ("a{y}", "b"), "y": ("q",)}
    rows = scenarios.scenarios(spark, 6, branches=branches, pools=pools).orderBy("idx").collect()
    assert [(r.sub, r.format, r.min_len, r.max_tokens) for r in rows] == [(i % 2, *(("BRIEFING", 600, 2048), ("JOURNAL", 1500, 4096))[i % 2]) for i in range(6)]
    for r in rows[::2]:
        one, row, lines = r.prompt.split("|")
        assert one in ("a{y} ", "b ") and sorted(row.split("; ")) == ["a{y}", "b"] and lines in ("- a{y}: q", "- b: q")
    assert all(r.prompt.startswith("5 ") and r.prompt.split()[1] in ("q", "a{y}", "b") for r in rows[1::2])
    assert scenarios.head(scenarios.scenarios(spark, 6, branches=branches, pools=pools), most=5, dry_run=2).count() == 2
    used = {p for b in scenarios.BRANCHES for s in scenarios.cut(b.template)[1] for p in (s.pool, s.also) if p}
    assert used <= set(scenarios.POOLS) and {f for b in scenarios.BRANCHES for f in b.formats} == set(scenarios.FORMAT_LIMITS) == set(scenarios.OUTLINES)
    turns = {}
    for b in scenarios.BRANCHES:
        turns.setdefault((b.family, b.category), []).append(b.sub)
    assert all(subs == list(range(len(subs))) for subs in turns.values())


def test_built_in_transforms(spark, tmp_path):
    steps = transforms.built_in()
    assert list(steps) == ["assemble", "collect", "cook", "evaluate", "factory"]
    line = lambda i, score=0.9, n=150: '{"instruction":"%s","response":"%s","score":%s,"domain":"d"}' % ("i" * n, f"r{i} " * 100, score)
    lines = spark.createDataFrame([(i, line(i)) for i in range(100)] + [(100, line(1, 0.1)), (101, "{"), (102, line(2, n=5)), (103, None)], "ordinal bigint, line string")
    paths = {"train": f"{tmp_path}/train", "eval": f"{tmp_path}/eval"}
    made = transforms.manufacturing("set", paths=paths)(lines=lines)
    told = made["manifest"].first()
    assert (told.pair_count, told.train_count, told.eval_count, told.rejected, told.train_path) == (100, 95, 5, 4, paths["train"])
    import hashlib

    for split in paths:
        whole = b"".join(p.read_bytes() for p in sorted((tmp_path / split).glob("part-*")))
        assert hashlib.sha256(whole).hexdigest() == told[f"{split}_sha256"] and whole.count(b"\n") == told[f"{split}_count"]
    said = [("user", "q"), ("user", "q"), ("assistant", "a" * 300)]
    records = spark.createDataFrame([(0, "k", None, said[1:]), (1, "k", "x", said), (2, "m", "x", said), (3, "n", "x", said[:2])], steps["assemble"].inputs["records"])
    made = steps["assemble"](records=records)
    assert [r.ordinal for r in made["eval"].collect()] == [2] and made["train"].count() == 0  # 0 hides 1, and then fails
    for _ in range(2):
        transforms.evaluating(str.upper, "r", path=f"{tmp_path}/log")(pairs=spark.createDataFrame([("ab", "AB")], "instruction string, response string"))
    log = spark.read.json(f"{tmp_path}/log")
    assert log.count() == 4 and set(log.columns) == {"run_id", "model", "metric", "score", "samples", "timestamp"}
    with pytest.raises(runtime.BadInput):
        steps["factory"](lines=lines.select("line"))


def test_null_texts_fail_gates(spark):
    rows = spark.createDataFrame([(None,)], "t string")
    assert gates.gated(rows, F.col("t"), F.lit("company"), gates.FIRST).first().reason == "too_short_0/600"


def test_folders(monkeypatch):
    from loomsift.runtime import Folders

    monkeypatch.setenv("LOOMSIFT_DATA_DIR", "/d")
    assert Folders().data == "/d" and Folders(output="/o").output == "/o"
