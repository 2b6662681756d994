"""Spelling variants: words one edit apart, by merging the subtrees of an errata trie.

1. Words are counted per task and then in all; those of at least ``letters`` letters that
   occur ``least`` times are the dictionary. Its trie is never built as objects: a node
   is a prefix, named by a 64-bit hash, and a word passes one node for each letter.
2. A node's heavy child is the one below which most words lie. So a word leaves heavy
   paths at most log2(words) times, and only there, and where it ends, it is merged:
   its subtree, the light one, goes into its neighbours', never the other way round.
3. At a node where a word goes on by a light letter, the rest of the word behind that
   letter is merged three ways: with the letter skipped, into all that lies below the
   node; with the letter replaced by the heavy one, into the heavy subtree; and with the
   heavy letter put before it, for words that have that letter more. Merged into what the
   dictionary holds, a terminal is the hash of a whole word, so a merge is an equi-join.
   Light subtrees of one node meet each other by the hash of the word without its
   letter; a group of these has a member for each letter of the alphabet at most.
4. Coinciding terminals are pairs. Each is confirmed on the words themselves, so neither a
   collision nor an unluckily chosen heavy child changes the result.
5. A word's form is its near word of largest count, if that is at least ``times`` its own;
   roots follow forms by pointer jumping, as counts double at each step.

The nodes of the first ``SHALLOW`` + 1 levels, which most words share, are broadcast: the
alphabet of 90 letters allows 8,191 of them. Deeper ones are joined by their hash.

Rows, defined: null, empty and letterless texts have no words; a null id counts as the
empty text where it is hashed; repeated rows count each; ties go to the word that is
smaller by code points; empty tables give no rows. Only the id and text columns are read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from .bpe import forget
from .common import ASCII_LOWER, bounded_batches, mix, raw_texts, small_batches

#: Depth of the nodes that are broadcast.
SHALLOW = 2
#: Words that a task counts before it sends them on.
COUNTED = 300_000
#: Letters of words whose nodes are made at once.
LETTERS = 1 << 18
#: One run in so many loses a letter, as if mistyped.
SLIPS = 97

_U = np.uint64
# Lower-cased, what counts as a letter: a to z and the letters of Latin-1.
_RUN = re.compile("[a-zÀ-ÿ]+")


def words_of(text: bytes | None, key: bytes, letters: int) -> Iterator[tuple[str, int]]:
    """Words of a text with their counts, slips included."""
    start = zlib.crc32(key + b":")
    for run, n in Counter(_RUN.findall(text.translate(ASCII_LOWER).decode())).items() if text else ():
        if len(run) < letters:
            continue
        h = zlib.crc32(run.encode(), start)
        if h % SLIPS == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < letters:
                continue
        yield run, n


def counted(docs: DataFrame, id_col: str, text_col: str, letters: int, least: int) -> DataFrame:
    """The dictionary: (word, n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        total: Counter[str] = Counter()
        flushed = lambda: pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])
        for batch in small_batches(batches, 100):
            for key, text in zip(raw_texts(batch.column(0)), raw_texts(batch.column(1)), strict=True):
                for word, n in words_of(text, key, letters):
                    total[word] += n
                if len(total) > COUNTED:
                    yield flushed()
                    total.clear()
        yield flushed()

    key = F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("key")
    found = bounded_batches(docs).select(key, F.col(text_col).alias("text")).mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _letter(code: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The hash of a letter at a place; a word's is the exclusive or of its letters'."""
    return mix((code.astype(_U) + _U(1)) * _U(0x9E3779B97F4A7C15) + (place.astype(_U) + _U(1)) * _U(0xD6E8FEB86659FD93))


def passed(words: list[str]) -> dict[str, np.ndarray]:
    """The nodes that words pass, their ends included: ``node``, ``depth``, ``end``, the
    hash ``letter`` of the one that follows, that of the word (``h``), of the word without
    that letter (``skip``), and of the word parted there by one place (``gap``), to which
    an inserted letter's hash is added."""
    size = np.array([len(w) for w in words], np.int64)
    code = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
    first = np.cumsum(size) - size
    place = np.arange(len(code)) - np.repeat(first, size)
    total = lambda x: np.concatenate([np.zeros(1, _U), np.bitwise_xor.accumulate(x)])
    letter = _letter(code, place)
    own, back, on = total(letter), total(_letter(code, place - 1)), total(_letter(code, place + 1))
    # One row for each place of a word, 0 to its size.
    start, end = np.repeat(first, size + 1), np.repeat(first + size, size + 1)
    depth = np.arange(len(start)) - np.repeat(np.cumsum(size + 1) - size - 1, size + 1)
    at = start + depth
    ends = at == end
    node = own[at] ^ own[start]
    behind = np.minimum(at + 1, end)
    return {
        "node": node, "depth": depth.astype(np.int32), "end": ends, "letter": np.append(letter, _U(0))[np.where(ends, len(letter), at)],
        "h": own[end] ^ own[start], "skip": node ^ back[end] ^ back[behind], "gap": node ^ on[end] ^ on[at],
    }


_NODES = {"node": "long", "depth": "int", "end": "boolean", "letter": "long", "h": "long", "skip": "long", "gap": "long"}


def _nodes(words: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list[str] = []
            room = LETTERS
            for word in [*batch.column(0).to_pylist(), None]:
                if held and (word is None or room < len(word)):
                    rows = passed(held)
                    yield pa.RecordBatch.from_arrays([pa.array(rows[c].view(np.int64) if rows[c].dtype == _U else rows[c]) for c in _NODES], list(_NODES))
                    held, room = [], LETTERS
                if word is not None:
                    held.append(word)
                    room -= len(word)

    return words.select("word").mapInArrow(run, ", ".join(f"{n} {t}" for n, t in _NODES.items()))


def _hashed(words: DataFrame) -> DataFrame:
    """The dictionary with each word's hash, as its end has it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rows = passed(batch.column(0).to_pylist())
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows["h"][rows["end"]].view(np.int64))], ["word", "n", "h"])

    return words.mapInArrow(run, "word string, n long, h long")


def _pairs(words: DataFrame) -> DataFrame:
    """Hashes of words that may be one edit apart, each pair once."""
    nodes = _nodes(words)
    below = nodes.groupBy("node", "end", "letter").agg(F.count("*").alias("n"), F.first("depth").alias("depth"))
    heavy = below.groupBy("node").agg(
        F.max_by(F.when(~F.col("end"), F.col("letter")), F.when(~F.col("end"), F.struct("n", "letter"))).alias("heavy"),
        F.count("*").alias("ways"), F.first("depth").alias("level"),
    )
    # Where there is one way on, nothing is merged.
    heavy = written(heavy.where("ways > 1 AND heavy IS NOT NULL").drop("ways"), "heavy")
    top = nodes.where(F.col("depth") <= SHALLOW).join(F.broadcast(heavy.where(F.col("level") <= SHALLOW)), "node")
    deep = nodes.where(F.col("depth") > SHALLOW).join(heavy.where(F.col("level") > SHALLOW), "node")
    light = written(top.union(deep).where("end OR letter <> heavy").select("node", "end", "letter", "heavy", "h", "skip", "gap"), "light")

    rest, inserted = F.col("h").bitwiseXOR(F.col("letter")), F.col("gap").bitwiseXOR(F.col("heavy"))
    ways = F.when(F.col("end"), F.array(inserted)).otherwise(F.array("skip", rest.bitwiseXOR(F.col("heavy")), inserted))
    merged = light.select("h", F.explode(ways).alias("key")).join(words.select(F.col("h").alias("key")), "key").select(F.col("h").alias("a"), F.col("key").alias("b"))
    group = light.where("NOT end").groupBy("node", rest.alias("rest")).agg(F.collect_set("h").alias("held"))  # a member for each letter at most
    group = group.where(F.size("held") > 1).select(F.explode("held").alias("a"), "held").select("a", F.explode("held").alias("b")).where("a < b")
    both = merged.union(group)
    return both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _near(words: DataFrame) -> DataFrame:
    """(word, n, other, other_n) for near words, in both directions."""
    pairs = written(_pairs(words), "pairs")
    for side in ("a", "b"):
        known = words.select(F.col("h").alias(side), F.col("word").alias(f"word_{side}"), F.col("n").alias(f"n_{side}"))
        pairs = pairs.join(known, side)
    pairs = pairs.where(F.levenshtein("word_a", "word_b", 1) == 1)
    way = lambda x, y: F.struct(F.col(f"word_{x}").alias("word"), F.col(f"n_{x}").alias("n"), F.col(f"word_{y}").alias("other"), F.col(f"n_{y}").alias("other_n"))
    return pairs.select(F.explode(F.array(way("a", "b"), way("b", "a"))).alias("r")).select("r.*")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for each word of (word, form): forms followed to the last."""
    at = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = written(at.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        at = moved.drop("moved")
        if moved.where("moved").isEmpty():
            return at


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", letters: int = 5, least: int = 3, times: int = 2) -> DataFrame:
    """One row per word of the dictionary: word, n, n_near, form, form_n and root."""
    words = written(_hashed(counted(docs, id_col, text_col, letters, least)), "words")
    best = F.min(F.struct((-F.col("other_n")).alias("n"), F.col("other").alias("word"))).alias("best")
    near = _near(words).groupBy("word").agg(F.first("n").alias("own"), F.count("*").alias("n_near"), best)
    kept = F.col("best.n") * -1 >= F.col("own") * times
    near = written(near.select("word", "n_near", F.when(kept, F.col("best.word")).alias("form"), F.when(kept, -F.col("best.n")).alias("form_n")), "near")
    last = roots(near.where("form IS NOT NULL"))
    return (
        words.join(near, "word", "left").join(last, "word", "left")
        .select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form", "form_n", F.coalesce("root", "word").alias("root"))
    )
