"""The registered queries: twins, and brute force where SQL has none."""

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import regex
from pyspark.sql import functions as F
from twins import same_rows

from loomsift.llm.catalogue import ORACLES, QUERIES
from loomsift.llm.common import ASCII_LOWER


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_twin(name, spark, sf_dir, duck):
    same_rows(QUERIES[name](spark, sf_dir), duck, ORACLES[name])


@pytest.fixture(scope="module")
def docs(duck):
    return duck.execute("SELECT doc_id, text, lang FROM documents ORDER BY doc_id").fetchall()


def test_language_accuracy(spark, sf_dir, docs):
    rows = {r.doc_id: r for r in QUERIES["op1_language"](spark, sf_dir).collect()}
    assert len(rows) == len(docs)
    held = [(i, lang) for i, _, lang in docs if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(rows[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= rows[i].score <= 1 for i, _, _ in docs)
    assert sum(rows[i].lang_pred == lang for i, lang in held) >= 0.9 * len(held)


def plain_prediction(model, text):
    """Label and probability by loops over letters, without any memory or batch."""
    s, runs = model.settings, []
    run = ""
    for c in (text or "").lower() + " ":
        if regex.match(r"\p{L}", c):
            run += c
        elif run:
            runs.append(f"<{run}>")
            run = ""
    grams = [r[i : i + n] for r in runs for n in range(1, s.longest + 1) for i in range(len(r) - n + 1) if r[i : i + n] not in "<>"]
    if not grams:
        return "und", 0.0
    total = np.zeros(len(model.labels))
    for gram in grams:
        h = 0
        for c in gram:
            h = (h * 1_000_003 + ord(c)) % 2**64
        h = (h + len(gram)) % 2**64
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            h = (h ^ (h >> shift)) * factor % 2**64
        total += model.scores[(h ^ (h >> 31)) % s.buckets]
    raised = np.exp((total / len(grams) + model.bias) / model.temperature)
    return model.labels[int(raised.argmax())], float(raised.max() / raised.sum())


def test_language_is_the_plain_forward_pass(spark, sf_dir, docs):
    from loomsift.llm import language
    from loomsift.session import table

    model = language.fit(table(spark, sf_dir, "documents"))
    some = sorted(docs, key=lambda d: len(d[1] or ""))[:120]
    rows = {r.doc_id: r for r in language.predict(spark.createDataFrame(some, "doc_id long, text string, lang string"), model).collect()}
    for i, text, _ in some:
        label, sure = plain_prediction(model, text)
        assert rows[i].lang_pred == label and abs(rows[i].score - sure) < 1e-4
        assert rows[i].rejected == (label == "und" or rows[i].score < model.threshold)


def test_token_files(spark, sf_dir, docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    at, wanted = 0, []
    for i, text, _ in docs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        wanted.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(map(tuple, QUERIES["op2_token_files"](spark, sf_dir).collect())) == wanted


def test_ngram_base(spark, sf_dir, docs):
    rows = {r.doc_id: r for r in QUERIES["op4_ngram_lm"](spark, sf_dir).collect()}
    words = {i: [*(text or "").encode().translate(ASCII_LOWER).split(), None] for i, text, _ in docs}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in words}
    counts = Counter(w for i, ws in words.items() if not held[i] for w in ws)
    n, v = sum(counts.values()), len(counts)
    for i, ws in words.items():
        r = rows[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(ws), sum(counts[w] > 0 for w in ws), n)
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws))
        assert -math.inf < r.score <= 0
    assert sum(rows[i].score for i in words if held[i]) > sum(rows[i].base_score for i in words if held[i])


def test_ngram_score_by_exact_counts(spark, sf_dir, docs):
    """The same formula over dictionaries; the filter may only read a count too high."""
    from loomsift.llm import ngram_lm

    rows = {r.doc_id: r for r in QUERIES["op4_ngram_lm"](spark, sf_dir).collect()}
    words = {i: [*(text or "").encode().translate(ASCII_LOWER).split(), None] for i, text, _ in docs}
    taught = [ws for i, ws in words.items() if zlib.crc32(str(i).encode()) % 7 != 2]
    single, double = Counter(w for ws in taught for w in ws), Counter(x for ws in taught for x in zip(["start", *ws], ws))
    n, v = sum(single.values()), len(single)
    read = {c: float(ngram_lm.count_of(ngram_lm.level_of(np.array([c])))[0]) for c in {*single.values(), *double.values()}} | {0: 0.0}
    off = []
    for i, ws in words.items():
        score = 0.0
        for before, word in zip([None, *ws], ws):
            held, context = min(read[single[word]], n), min(read[single[before]], n)
            together = min(read[double[(before if before is not None else "start"), word]], context)
            score += math.log10((together + ngram_lm.MASS * (held + 1) / (n + v + 1)) / (context + ngram_lm.MASS))
        assert rows[i].score <= 0
        off.append(abs(rows[i].score - score) / len(ws))
    assert np.mean(off) < 0.02 and max(off) < 0.5


def test_ngram_scores_follow_rows_not_files(spark, sf_dir):
    from loomsift.llm import ngram_lm
    from loomsift.session import table

    frame = table(spark, sf_dir, "documents").select("doc_id", "text")
    scores = lambda rows: sorted((r.doc_id, r.score) for r in ngram_lm.score(rows, ngram_lm.fit(rows)).collect())
    a, b = scores(frame), scores(frame.repartition(7, "doc_id").sortWithinPartitions(F.desc("doc_id")))
    assert [i for i, _ in a] == [i for i, _ in b] and np.allclose([s for _, s in a], [s for _, s in b])


def test_byte_bpe(spark, sf_dir, docs):
    import base64

    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    coder = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    wanted = []
    for i, text, _ in docs:
        ids = coder.encode_ordinary(text or "")
        wanted.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, QUERIES["op6_byte_bpe"](spark, sf_dir).collect())) == wanted


def brute_components(texts, n, percent):
    """Set sizes, components and links by comparing all pairs."""
    def shingled(text):
        words = (text or "").encode().translate(ASCII_LOWER).split()
        return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()

    sets = {i: shingled(t) for i, t in texts}
    root, links = {i: i for i in sets}, Counter()

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[:x]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                links[a] += 1
                links[b] += 1
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {i: (len(sets[i]), find(i), links[i]) for i in ids}


def test_jaccard_join(spark, sf_dir, docs):
    wanted = brute_components([(i, t) for i, t, _ in docs], 4, 85)
    found = {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in QUERIES["op10_jaccard_join"](spark, sf_dir).collect()}
    assert found == wanted and any(i != c for i, (_, c, _) in found.items())


def test_pipeline(spark, sf_dir, docs, duck):
    """Stage by stage against brute force on what the stage before kept."""
    import corpus_pipeline as C

    from loomsift.session import table

    frame, kept = table(spark, sf_dir, "documents"), {i: t for i, t, _ in docs}
    columns = frame.columns
    out = {}
    for name, stage in C.STAGES:
        frame = stage(spark, frame, sf_dir)
        out[name] = {r.doc_id: r for r in frame.collect()}
        assert name == "byte_bpe" or frame.columns == columns
    after = out["language_id"]
    assert len(after) >= 0.97 * sum(any(c.isalpha() for c in t or "") for t in kept.values())
    classes = brute_components([(i, r.text) for i, r in after.items()], C.WORDS, C.PERCENT)
    assert set(out["near_duplicates"]) == {i for i, (_, c, _) in classes.items() if i == c}
    judged = {r[0]: r[-1] for r in duck.execute(ORACLES["op5_decontaminate"]).fetchall()}
    assert set(out["decontamination"]) == {i for i in out["near_duplicates"] if not judged[i]}
    assert set(out["byte_bpe"]) == set(out["decontamination"])
    for i, r in out["byte_bpe"].items():
        assert r.n_tokens == len(r.ids) and r.decoded_sha256 == hashlib.sha256((kept[i] or "").encode()).hexdigest()
    assert sorted(r.doc_id for r in C.run(spark, sf_dir).select("doc_id").collect()) == sorted(out["byte_bpe"])
