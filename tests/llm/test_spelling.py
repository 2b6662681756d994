"""Spelling variants against all pairs and by hand."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomsift.llm import spelling_variants
from loomsift.llm.catalogue import QUERIES

COLUMNS = ["word", "n", "n_near", "form", "form_n", "root"]


def plain(rows, letters=5, least=3, times=2):
    """The same by dictionaries of words that lack one letter."""
    count = Counter()
    for key, text in rows:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for run in re.findall("[a-zA-ZÀ-ÿ]+", lower):
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= letters:
                count[run] += 1
    words = {w: n for w, n in count.items() if n >= least}
    gaps, near = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            gaps[w[:i], w[i + 1 :]].add(w)
            shorter = w[:i] + w[i + 1 :]
            if shorter in words:
                near[w].add(shorter)
                near[shorter].add(w)
    for group in gaps.values():
        for w in group:
            near[w] |= group - {w}
    form = {w: min(near[w], key=lambda x: (-words[x], x)) for w in words if near[w]}
    form = {w: f for w, f in form.items() if words[f] >= times * words[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted((w, n, len(near[w]), form.get(w) or "", words[form[w]] if w in form else 0, root(w)) for w, n in words.items())


def ours(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).fillna({"form": "", "form_n": 0}).collect())


def test_query_equals_all_pairs(spark, sf_dir, duck):
    rows = duck.execute("SELECT doc_id, text FROM documents").fetchall()
    assert ours(QUERIES["op12_spelling_variants"](spark, sf_dir)) == plain(rows)


def test_dense_words(spark):
    """Runs of one letter, words that are prefixes of others, letters beyond ASCII."""
    draw = random.Random(7)
    texts = [" ".join("".join(draw.choices("aabé÷ÿ", k=draw.randint(4, 8))) for _ in range(300)) for _ in range(30)]
    texts += ["aaaaa aaaaaa aaaaaaa " * 3, "abcde abcdef xabcde " * 4, "Äpfel äpfel ÄPFEL Apfel " * 3]
    rows = [(i, t) for i, t in enumerate(texts)]
    found = ours(spelling_variants.variants(spark.createDataFrame(rows, "doc_id long, text string")))
    assert found == plain(rows) and sum(r[2] for r in found) > 500


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    assert ours(spelling_variants.variants(odd_docs, least=1)) == plain(rows, least=1)
    assert spelling_variants.variants(no_docs).count() == 0
    nothing = spark.createDataFrame([(1, None), (2, ""), (None, "123 !")], "doc_id long, text string")
    assert spelling_variants.variants(nothing).count() == 0
    long = spark.createDataFrame([(i, w) for i in range(3) for w in ("z" * 50_000, "z" * 50_001, "z" * 50_003)], "doc_id long, text string")
    assert [r.n_near for r in spelling_variants.variants(long, least=1).orderBy(F.length("word")).collect()][:2] == [1, 1]


def test_a_word_in_many_copies(spark):
    """One word makes up most rows, and repeated rows count each."""
    rows = spark.range(30_000).select(F.lit(1).cast("long").alias("doc_id"), F.when(F.col("id") % 3 == 0, "letters").when(F.col("id") % 1000 == 1, "lettres").otherwise("letter").alias("text"))
    found = {r.word: r for r in spelling_variants.variants(rows).collect()}
    assert found["letters"].n == 10_000 and found["letter"].n_near == 1 and found["letter"].n == 19_980 and found["lettres"].n == 20
    assert found["letter"].root == "letter" and found["letters"].form is None


def test_chains_end_at_their_root(spark):
    words = {"abcdefg": 3, "abcdefh": 7, "abcdeih": 15, "abcjeih": 40, "abcjeix": 79}
    rows = [(i, w) for w, n in words.items() for i in range(n)]
    rows = [(i, w) for i, w in rows if zlib.crc32(f"{i}:{w}".encode()) % 97]
    found = {r.word: r for r in spelling_variants.variants(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found["abcdefg"].root == "abcjeih" and found["abcdefg"].form == "abcdefh" and found["abcjeix"].form is None and found["abcjeih"].form is None


@pytest.mark.parametrize("words", [["a"], ["abc", "abd", "b"], ["zz", "z" * 9]])
def test_nodes(words):
    rows = spelling_variants.passed(words)
    assert len(rows["node"]) == sum(map(len, words)) + len(words) and rows["end"].sum() == len(words)
    alone = {w: spelling_variants.passed([w]) for w in words}
    assert np.array_equal(rows["h"][rows["end"]], [alone[w]["h"][0] for w in words])
    whole = lambda w: spelling_variants.passed([w])["h"][0]
    for w, own in alone.items():
        for i in range(len(w)):
            assert own["node"][i] == (whole(w[:i]) if i else 0)
            assert own["skip"][i] == (whole(w[:i] + w[i + 1 :]) if len(w) > 1 else 0)
            inserted = spelling_variants._letter(np.array([ord("q")]), np.array([i]))[0]
            assert own["gap"][i] ^ inserted == whole(w[:i] + "q" + w[i:])
