"""Nulls, empty and long texts, ties, repeats, empty tables, clashing columns."""

import hashlib
import struct

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomsift.llm import bpe, chat, decontaminate, jaccard_join, language, ngram_lm, shards, token_files, topk, url_filter


def test_language(spark, odd_docs, no_docs):
    model = language.fit(odd_docs)
    rows = {r.doc_id: r for r in language.predict(odd_docs, model).collect()}
    assert rows[2].lang_pred == rows[1].lang_pred == rows[4].lang_pred == "und" and rows[4].score == 0 and rows[4].rejected
    assert rows[5].lang_pred == "en" and rows[5].score == 1
    numbers = spark.createDataFrame([(0, "½ ² Ⅷ 12 _")], "doc_id long, text string")  # numbers, no letters
    assert language.predict(numbers, model).first().lang_pred == "und"
    assert language.predict(odd_docs, model).count() == odd_docs.count()
    assert language.fit(no_docs) is None
    assert {r.lang_pred for r in language.predict(odd_docs, None).collect()} == {"und"}
    assert language.predict(no_docs, model).count() == 0


def test_language_rejects_labels_beyond_the_bound(spark):
    rows = spark.range(9).select("id", F.lit("a b").alias("text"), F.col("id").cast("string").alias("lang"))
    with pytest.raises(ValueError, match="labels"):
        language.fit(rows, "id", settings=language.Settings(labels=8))


def test_language_sample_is_bounded_by_key_and_text(spark, monkeypatch):
    """One key for a whole label, and a label of copies alone."""
    seen = []
    monkeypatch.setattr(language, "train", lambda bags, settings: seen.append(bags))
    word = F.translate(F.format_string("%04d", F.col("id").cast("int")), "0123456789", "abcdefghij")
    rows = spark.range(900).select(F.when(F.col("id") < 300, 7).otherwise(F.col("id")).alias("doc_id"), F.when(F.col("id") < 600, word).otherwise("the same").alias("text"), (F.col("id") / 300).cast("int").cast("string").alias("lang"))
    copies = spark.range(3000).select(F.lit(5).cast("long").alias("doc_id"), F.lit("one text").alias("text"), F.lit("copies").alias("lang"))
    settings = language.Settings(per_label=20, sample=2000, room=20 * 4 * 16)
    language.fit(rows.union(copies), settings=settings)
    (bags,) = seen
    count = {label: sum(b[0] == label for b in bags) for label in ("0", "1", "2", "copies")}
    assert count == {"0": 20, "1": 20, "2": 1, "copies": 1} and max(len(b[1]) for b in bags) == 26
    language.fit(rows.union(copies), settings=language.Settings(per_label=20, sample=2000, room=4 * 7 * 16))
    count = {label: sum(b[0] == label for b in seen[1]) for label in ("0", "1", "2", "copies")}
    assert 7 <= count["0"] <= 9 and 7 <= count["1"] <= 9 and count["2"] == count["copies"] == 1  # fewer rows, none of them cut
    assert {(b[0], bytes(b[1])) for b in seen[1]} <= {(b[0], bytes(b[1])) for b in bags}
    language.fit(rows, settings=language.Settings(per_label=20, sample=2000, room=1))
    assert len(seen[2]) == 3 and all(len(b[1]) >= 10 for b in seen[2])


def test_token_files(spark, odd_docs, no_docs, json_vocabulary):
    rows = token_files.round_trip(odd_docs, json_vocabulary, 2).collect()
    assert len(rows) == odd_docs.count()
    rows.sort(key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted((r.doc_id for r in rows), key=lambda i: (i is not None, i))
    assert all(a.start + len(a.ids) // 4 == b.start for a, b in zip(rows, rows[1:]))
    assert [bytes(r.ids) for r in rows if r.doc_id == 2] == [struct.pack("<I", 2)]
    assert token_files.round_trip(no_docs, json_vocabulary, 2).count() == 0


def test_token_files_ascend_by_name(spark, json_vocabulary, tmp_path):
    """A reader that takes the files by their names meets the documents in order, also
    where most of them share an id."""
    docs = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 500).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.col("id")).alias("doc_id"), F.concat(F.lit("some words "), F.col("id") % 40).alias("text"))
    token_files.write(docs.repartition(6), json_vocabulary, f"{tmp_path}/f", 2, partitions=12)
    table = spark.read.parquet(f"{tmp_path}/f/table").first()["content"]
    coder = token_files.Coder(bytes(table))
    files = sorted(p for p in (tmp_path / "f" / "chunks").rglob("*.parquet"))
    keys, sizes, content = [], [], []
    for file in files:
        for row in pq.read_table(file, partitioning=None).to_pylist():
            keys += row["ids"]
            sizes.append(len(row["ids"]))
            content.append(coder.decode(row["payload"]))
    assert len(files) > 6 and max(sizes) < 1500  # the hot id lies in several ranges
    assert keys == sorted(keys, key=lambda k: (k is not None, k)) and len(keys) == 3000
    found = sorted(token_files.read(spark, f"{tmp_path}/f").collect(), key=lambda r: r.start)
    assert b"".join(bytes(r.ids) for r in found) == np.concatenate(content).astype("<u4").tobytes()
    assert [r.doc_id for r in found] == keys


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 300), max_size=400), st.integers(0, 60_000))
def test_coder(head, repeat):
    ids = np.array([*head, *([7] * repeat)], np.uint32)
    coder = token_files.Coder(token_files.pack_table(token_files.scaled(np.bincount(ids, minlength=301))))
    packed = coder.encode(ids)
    assert np.array_equal(coder.decode(packed), ids)
    if len(ids) > token_files.BLOCK:
        assert np.array_equal(coder.decode(packed, slice(1, 2)), ids[token_files.BLOCK : 2 * token_files.BLOCK])


def test_coder_refuses_damage():
    ids = np.arange(20_000, dtype=np.uint32) % 50
    table = token_files.pack_table(token_files.scaled(np.bincount(ids)))
    packed = bytearray(token_files.Coder(table).encode(ids))
    packed[-3] ^= 4
    with pytest.raises(token_files.Damaged):
        token_files.Coder(table).decode(bytes(packed))
    with pytest.raises(token_files.Damaged):
        token_files.Coder(table[:-1] + b"x")
    sparse = token_files.Coder(token_files.pack_table(token_files.scaled(np.array([1, 0, 1]))))
    with pytest.raises(ValueError, match="symbol"):
        sparse.encode(np.array([0, 1], np.uint32))


def test_url_filter(spark):
    rules = spark.createDataFrame([("net", "/", "block"), ("b.net", "/x", "allow"), ("B.net", "", "block"), ("b.net", "/x", "block"), ("", "/", "block")], "host string, path string, verdict string")
    urls = ["http://A.b.NET/xyz?q", "http://b.net", "http://xb.net/x", "b.net/x", None, "", "http://b.net/y#/x", "s://b.net" + "/a" * 5000, "http://b.net"]
    pages = spark.createDataFrame([(i, u, "z") for i, u in enumerate(urls)] + [(None, urls[0], "z")], "page_id long, url string, size string")
    rows = url_filter.judge(pages, rules, "page_id", "url").collect()
    found = {r.page_id: (r.host, r.rule, r.verdict) for r in rows}
    assert len(rows) == len(urls) + 1
    assert found[0] == found[None] == ("a.b.net", "b.net/x", "block")
    assert found[1] == found[8] == ("b.net", "b.net", "block") and found[2] == ("xb.net", "net/", "block")
    assert found[3] == found[4] == found[5] == ("", None, "allow") and found[6][1] == found[7][1] == "b.net"
    assert url_filter.judge(pages, rules.limit(0), "page_id", "url").where("rule IS NOT NULL OR verdict <> 'allow'").count() == 0
    assert url_filter.judge(pages.limit(0), rules, "page_id", "url").count() == 0


def test_ngram_lm(spark, odd_docs, no_docs, monkeypatch):
    model = ngram_lm.fit(odd_docs)
    rows = [r.asDict() for r in ngram_lm.score(odd_docs, model).orderBy("doc_id", "n_tokens").collect()]
    assert len(rows) == odd_docs.count() and all(np.isfinite(r["score"]) and r["train_tokens"] == model.n for r in rows)
    assert [r["n_tokens"] for r in rows if r["doc_id"] in (1, 2)] == [1, 1]
    total = sum(len(r.bits) + len(r.known) + len(r["count"]) for r in model.rows.collect())
    monkeypatch.setattr(ngram_lm, "GROUP_BYTES", total // 2)  # several groups: counts travel with the texts
    assert len(model.groups()) in (2, 3)
    assert [r.asDict() for r in ngram_lm.score(odd_docs, model).orderBy("doc_id", "n_tokens").collect()] == rows
    none = ngram_lm.fit(no_docs)
    assert (none.n, none.v) == (0, 0)
    assert {r.n_known for r in ngram_lm.score(odd_docs, none).collect()} == {0}
    assert ngram_lm.score(no_docs, model).count() == 0


def test_filter_reads_back_counts():
    h = ngram_lm.mix(np.arange(1, 20_001, dtype=np.uint64))
    count = np.arange(1, 20_001) % 300 + 1
    bits = ngram_lm.build_filter(h, count)
    held = ngram_lm.Slices(63, np.zeros(2, np.int64), np.full(2, len(bits)), bits, np.sort(h), count)
    level = held.levels(h)
    assert (level >= ngram_lm.level_of(count)).all() and (level == ngram_lm.level_of(count)).mean() > 0.9
    assert (held.levels(ngram_lm.mix(np.arange(10**6, 10**6 + 20_000, dtype=np.uint64))) == 0).mean() > 0.9


def test_decontaminate(spark, odd_docs, no_docs, monkeypatch):
    words = [f"w{i}" for i in range(40)]
    items = spark.createDataFrame([(1, " ".join(words[:20])), (2, "Short ITEM"), (2, "other words"), (None, "word"), (4, None), (5, "...")], "item_id long, text string")
    texts = ["x " * 9 + "W0, w1; " + " ".join(words[2:15]) + " é", "a short-item b other words", "shortitem", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("items", F.lit(1))
    rows = {r.doc_id: r for r in decontaminate.find(docs, items).collect()}
    assert (rows[0].n_words, rows[0].n_hit, rows[0].items) == (25, 15, ["1"])
    start, end = rows[0].spans[0]
    assert texts[0][start:end].startswith("W0") and texts[0][start:end].endswith("w14")
    assert (rows[1].n_hit, rows[1].items, [texts[1][s:e] for s, e in rows[1].spans]) == (4, ["2"], ["short-item", "other words"])
    assert [rows[i].n_hit for i in (2, 3, 4)] == [0, 0, 0] and rows[3].n_words == 0
    monkeypatch.setattr(decontaminate, "NODES", 30)  # several automata, hits carried along
    assert {r.doc_id: r for r in decontaminate.find(docs, items).collect()} == rows
    assert decontaminate.find(odd_docs, items.limit(0)).agg(F.sum("n_hit")).first()[0] == 0
    assert decontaminate.find(no_docs, items).count() == 0


def test_bpe(spark, odd_docs, no_docs, ranks):
    coded, table = bpe.encode(odd_docs, ranks, offsets=True), bpe.token_bytes(ranks)
    for r in bpe.decode(coded, ranks).collect():
        text = r.text or ""
        assert bytes(r.decoded).decode() == text and len(r.ids) == len(r.ids_starts)
        assert not text or (r.ids_starts[0] == 0 and r.ids_ends[-1] == len(text))
        assert all(a <= b for a, b in zip(r.ids_starts, r.ids_ends))
        assert "".join(bpe.readable(table[i] for i in r.ids)) == text
    both = bpe.round_trip(odd_docs, ranks)
    assert both.columns == [c for c in odd_docs.columns if c not in ("ids", "decoded")] + ["ids", "decoded"]
    assert both.count() == odd_docs.count() and bpe.round_trip(no_docs, ranks).count() == 0


@settings(max_examples=120, deadline=None)
@given(st.lists(st.text(" \n\t'stlréçabz09.*-\x1c\xa0日😀", max_size=30), max_size=4))
def test_pieces_give_whole_texts(ranks, texts):
    import base64

    import public_tokenizers as P
    import tiktoken

    global _CODER
    if "_CODER" not in globals():
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
        _CODER = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=table, special_tokens={}), bpe.Encoder(ranks)
    assert [np.frombuffer(x, "<u4").tolist() for x in _CODER[1].encode(texts)] == [_CODER[0].encode_ordinary(t) for t in texts]


@given(st.text("<|\\>im_endx\n%", max_size=20))
def test_escapes_are_reversible(text):
    assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)
    assert chat.unescape_role(chat.escape_role(text)) == text and "\n" not in chat.escape_role(text)


def test_chat(spark, json_vocabulary):
    told = [(1, 0, "user", "<|im_start|>"), (1, 1, "assistant", None), (1, 2, "assistant", "<\\|im_end|>\n"), (None, 0, None, "x"), (2, 0, "a\nb", ""), (1, 2, "assistant", "<\\|im_end|>\n"), (2, None, "assistant", "é😀")]
    rows = spark.createDataFrame(told, "conv_id long, turn long, role string, text string").withColumn("ids", F.lit(1)).withColumn("start", F.lit(2))
    formatted = chat.format_turns(rows, json_vocabulary)
    turns = chat.read_turns(formatted, json_vocabulary).collect()
    read = {c: [(t.role, t.text) for t in sorted((t for t in turns if t.conv == c), key=lambda t: t.position)] for c in (1, 2, None)}
    assert read == {1: [("user", "<|im_start|>"), ("assistant", ""), ("assistant", "<\\|im_end|>\n"), ("assistant", "<\\|im_end|>\n")], 2: [("assistant", "é😀"), ("a\nb", "")], None: [("", "x")]}
    for f in formatted.collect():
        assert len(f.ids) == len(f.loss)
    digest = {r.conv: r for r in chat.digests(formatted, json_vocabulary).collect()}
    assert digest[2].loss_chars == 2 and digest[2].loss_sha256 == hashlib.sha256("é😀".encode()).hexdigest()
    assert (digest[1].n_turns, digest[1].loss_chars) == (4, 24)
    assert digest[None].n_turns == 1 and set(digest) == {1, 2, None}
    assert chat.digests(chat.format_turns(rows.limit(0), json_vocabulary), json_vocabulary).count() == 0
    plan = chat.digests(formatted, json_vocabulary)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1  # by conversation, of ids, once
    with pytest.raises(Exception, match="comes in place"):
        chat.digests(formatted.withColumn("position", F.lit(1)), json_vocabulary).collect()


def test_long_conversations_are_streamed(spark, json_vocabulary):
    told = spark.range(5000).select(F.lit(3).alias("conv_id"), "id", F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("t"), "id").alias("text"))
    found = chat.digests(chat.format_turns(told, json_vocabulary, turn_col="id"), json_vocabulary).collect()
    whole = hashlib.sha256("".join(f"{('user', 'assistant')[i % 2]}\nt{i}\n" for i in range(5000)).encode()).hexdigest()
    assert [(r.n_turns, r.turns_sha256) for r in found] == [(5000, whole)]


def brute_topk(rows, asked, k):
    usable = [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    whole = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in usable]
    out = []
    for q, v in sorted({i: v for i, v in whole if asked(i)}.items()):
        scores = sorted((-max(min(sum(a * b for a, b in zip(v, w, strict=True)), 2**63 - 1), 1 - 2**63), i) for i, w in whole if i != q and len(w) == len(v))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return out


def test_topk(spark, monkeypatch):
    random = np.random.default_rng(3)
    rows = [(i, [float(x) for x in np.round(random.normal(size=4), 1)]) for i in range(300)]
    rows += [(i, rows[5][1]) for i in range(300, 360)]  # ties
    rows += [(400, None), (401, [None, 1.0, 1.0, 1.0]), (402, [float("nan")] * 4), (None, rows[0][1]), (500, [1.0, 2.0]), (501, [2.0, 1.0]), (600, [1e9] * 3), (601, [-1e9, 1e9, 1e9]), (700, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit(1)).withColumn("id", F.lit("x"))
    wanted = brute_topk(rows, lambda i: i % 100 == 0, 10)
    assert sorted(map(tuple, topk.search(df, F.col("id") % 100 == 0).collect())) == sorted(wanted)
    for name, value in (("BLOCK_BYTES", 100), ("TILE", 7), ("FAN", 2)):  # many blocks, tiles and tree levels
        monkeypatch.setattr(topk, name, value)
    assert sorted(map(tuple, topk.search(df.repartition(5), F.col("id") % 100 == 0).collect())) == sorted(wanted)
    assert topk.search(df.limit(0), F.col("id") % 100 == 0).count() == 0


def test_shards(spark, odd_docs, no_docs, tmp_path):
    store = shards.ShardStore(spark, f"file://{tmp_path}/s", odd_docs.schema, fan=3, least=1 << 12)
    assert store.read().count() == 0
    for n in range(1, 8):
        store.append(odd_docs.withColumn("n_chars", F.lit(n).cast("long")))
    runs = store.manifest()["runs"]
    assert len(runs) == 3 and sum(r["rows"] for r in runs) == 7 * odd_docs.count()
    rows = lambda df: sorted(map(repr, df.collect()))
    wanted = [r for n in range(1, 8) for r in odd_docs.withColumn("n_chars", F.lit(n).cast("long")).collect()]
    assert rows(store.read()) == sorted(map(repr, wanted))
    assert store.read(1).count() == odd_docs.count()  # older versions stay readable until a vacuum
    version = store.version()
    store.append(no_docs)
    assert store.version() == version + 1 and rows(store.read()) == sorted(map(repr, wanted))
    stale = store.manifest(version)
    with pytest.raises(shards.Conflict):
        store._commit(stale, [])
    assert store.vacuum() > 0 and rows(store.read()) == sorted(map(repr, wanted))
    store.append(odd_docs.withColumn("part", F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(2))), by="part")
    assert store.read().count() == 8 * odd_docs.count() and store.read().columns == odd_docs.columns


def test_shards_keep_a_column_named_arrival(spark, odd_docs, tmp_path):
    from loomsift.llm.catalogue import QUERIES

    odd_docs.withColumn("Arrival", F.lit(3)).withColumn("arrival_", F.lit("x")).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    rows = QUERIES["op9_shards"](spark, str(tmp_path)).collect()
    assert sorted(repr(r.doc_id) for r in rows) == sorted(repr(r.doc_id) for r in odd_docs.collect())


def test_shards_do_not_list_files(spark, odd_docs, tmp_path):
    store = shards.ShardStore(spark, f"file://{tmp_path}/s", odd_docs.schema, fan=3)
    store.append(odd_docs.repartition(7))
    (run,) = store.manifest()["runs"]
    assert run["files"] > 1 and set(run) == {"run", "files", "bytes", "rows"} and run["rows"] == odd_docs.count()
    store.append(odd_docs, compact=False)
    assert store.vacuum() == 0 and store.read().count() == 2 * odd_docs.count()


def test_jaccard_edges(spark, odd_docs, no_docs):
    rows = {}
    for r in jaccard_join.join(odd_docs).collect():
        rows.setdefault(r.doc_id, []).append((r.n_shingles, r.component_id, r.n_links))
    assert rows[1] == rows[2] == [(0, 1, 0)] or rows[1] == [(0, 1, 0)] and rows[2] == [(0, 2, 0)]
    assert sorted(rows[3]) == [(0, 3, 0), (0, 3, 0)] and rows[5] == [(1, 5, 0)]
    assert rows[0] == [(13, 0, 2)] * 2 and rows[10] == [(13, 0, 2)]
    assert sum(map(len, rows.values())) == odd_docs.count()
    assert jaccard_join.join(no_docs).count() == 0


def near_copies(random, n, size, words=4000):
    base = [f"w{random.integers(words)}" for _ in range(size)]
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(random.integers(0, max(2, size // 25))):
            copy[random.integers(len(copy))] = f"n{random.integers(10**6)}"
        out.append(" ".join(copy[: len(copy) - random.integers(0, max(1, size // 12))]))
    return out


@pytest.mark.parametrize(("words", "percent", "block", "few"), [(4, 85, 256, 32), (5, 80, 7, 3), (1, 70, 7, 2), (4, 85, 5, 1)])
def test_jaccard_near_copies(spark, monkeypatch, words, percent, block, few):
    """Sizes from one shingle to hundreds, small blocks and buckets, against all pairs."""
    from test_catalogue import brute_components

    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    monkeypatch.setattr(jaccard_join, "FEW", few)
    monkeypatch.setattr(jaccard_join, "SKETCHES", block)
    random = np.random.default_rng(words)
    texts = [t for size in (1, 3, 5, 8, 12, 20, 33, 50, 90, 160, 300) for t in near_copies(random, 14, size)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in jaccard_join.join(df, words=words, percent=percent).collect()}
    assert found == brute_components(list(enumerate(texts)), words, percent)


@pytest.mark.parametrize("percent", [70, 80, 85, 95])
def test_linked_sets_share_a_signature(percent):
    random, rule = np.random.default_rng(percent), jaccard_join.Rule(percent)
    for _ in range(500):
        size = int(random.integers(1, 220))
        common = random.integers(0, 2**64, size, dtype=np.uint64)
        most = size * (100 - percent) // percent  # different elements that keep the pair linked
        extra = random.integers(0, 2**64, most, dtype=np.uint64)
        cut = random.integers(0, most + 1)
        a, b = np.unique(np.concatenate([common, extra[:cut]])), np.unique(np.concatenate([common, extra[cut:]]))
        assert 100 * size >= percent * (size + most)
        for number in range(len(jaccard_join.ROUNDS)):
            assert np.intersect1d(jaccard_join.signatures(a, rule, number), jaccard_join.signatures(b, rule, number)).size
        assert jaccard_join.may_link([jaccard_join.sketch(a, rule)], [jaccard_join.sketch(b, rule)], np.array([len(a)]), np.array([len(b)]), rule).all()


def test_sketches_tell_most_sets_apart():
    random, rule = np.random.default_rng(1), jaccard_join.Rule(80)
    sets = [np.unique(np.concatenate([random.integers(0, 2**64, 250, dtype=np.uint64), np.arange(70, dtype=np.uint64) << np.uint64(57)])) for _ in range(60)]
    drawn = [jaccard_join.sketch(s, rule) for s in sets]
    size = np.array([len(s) for s in sets])
    assert not jaccard_join.may_link(drawn[:-1], drawn[1:], size[:-1], size[1:], rule).any()
    small = jaccard_join.sketch(sets[0][:40], rule)
    assert not jaccard_join.may_link([small], drawn[:1], np.array([40]), size[:1], rule).any()


def test_sketch_cells_miss_no_link(monkeypatch):
    """Blocks of mixed sizes: every linked pair of a cell is in one tree."""
    import pyarrow as pa

    random, rule = np.random.default_rng(2), jaccard_join.Rule(80)
    sets = [np.unique(random.integers(0, 2**64, n, dtype=np.uint64)) for n in (3, 9, 30, 31, 64, 65, 130)]
    sets += [np.unique(np.append(s[: len(s) - len(s) // 12], random.integers(0, 2**64, len(s) // 12, dtype=np.uint64))) for s in sets for _ in range(4)]
    names = [jaccard_join.set_key(s) for s in sets]
    for i, j in ((0, 0), (0, 1)):
        block = [(k % 2) * j for k in range(len(sets))]
        table = pa.table({"key": names, "n": [len(s) for s in sets], "block": block, "sketch": [jaccard_join.sketch(s, rule) for s in sets], "i": [i] * len(sets), "j": [j] * len(sets)})
        found = jaccard_join._sketched(rule)(table)
        root = {n: n for n in names}
        for a, b in zip(found.column("a").to_pylist(), found.column("b").to_pylist()):
            root[b] = a
        for x, a in enumerate(sets):
            for y, b in enumerate(sets[:x]):
                common = len(np.intersect1d(a, b))
                if (not j or block[x] != block[y]) and 100 * common >= 80 * (len(a) + len(b) - common):
                    assert root[names[x]] == root[names[y]]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=40))
def test_rooted_forests_keep_components(edges):
    edges = np.array([e for e in edges if e[0] != e[1]], np.int64).reshape(-1, 2)
    root = {i: i for i in range(31)}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges.tolist():
        low, high = sorted((find(a), find(b)))
        root[high] = low
    assert sorted(map(tuple, jaccard_join.rooted(edges).tolist())) == sorted((find(i), i) for i in range(31) if find(i) != i)


def test_maps_pass_every_wanted_row(spark, monkeypatch):
    from loomsift.llm import common

    rows = spark.range(5000).select("id", (F.col("id") % 7).alias("h"))
    wanted = rows.where("id % 50 = 3").withColumn("key", F.col("id") + 1)
    for bits in (26, 16):
        monkeypatch.setattr(common, "MAP_BITS", bits)
        assert common.marked(rows, wanted, ["id", "h"], "may").where("may").count() in range(100, 700)
        assert common.fetched(rows, wanted, ["id", "h"]).agg(F.count("*"), F.sum(F.col("key") - F.col("id"))).first() == (100, 100)
    assert common.fetched(rows, wanted.limit(0), ["id", "h"]).count() == 0


def test_jaccard_repeated_and_missing_ids(spark):
    """Many rows under one id or none: each is fetched by its own text."""
    near = lambda n: " ".join(f"t{n // 2}x{i}" for i in range(40 + n % 2))
    rows = [(None, near(n)) for n in range(2000)] + [(7, near(n)) for n in range(2000, 4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = jaccard_join.join(docs, sets=True).collect()
    assert len(found) == 4000 and {r.n_links for r in found} == {1}
    assert {r.component_id for r in found if r.doc_id == 7} == {7} and {r.component_id for r in found if r.doc_id is None} == {None}
    assert len({r.class_key for r in found}) == 2000
