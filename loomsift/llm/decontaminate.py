"""Benchmark decontamination with one Aho-Corasick automaton.

Words are runs of digits, a-z (after lower-casing A-Z) and non-ASCII characters.
A window is 13 consecutive words of a benchmark item (its question and answer
text); an item with fewer words, but some, is one window. All windows form one
automaton over normalised text; each document is scanned once, and the words that
any occurrence covers are mapped back to character offsets of the original.

The windows are measured before they are collected. An automaton has a node for each
of their bytes at most, and takes some 50 bytes a node in a worker, so above ``NODES``
distinct windows are dealt by hash into groups of that many bytes, each with its own
automaton, and the documents are scanned once per group with the hits carried along.
The ids of a window's items lie in the automaton where there are at most ``NAMED`` of
them. A window that more items share has a number there; the items of such windows are
joined to the documents that hold them afterwards, so no list of items is broadcast or
gathered for its window.

Rows, defined: a null or empty text has no words and no hits; an item without an
id or without words takes no part; items that repeat an id count once; repeated
documents are judged one by one; empty tables give no rows or no hits. Other
columns pass through unchanged, except those named like an output, which are
replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import written
from .bpe import once
from .common import binaries, bounded_batches, free_name, raw_texts, small_batches

WINDOW = 13
#: Nodes of one automaton: distinct windows are dealt into groups of so many bytes.
NODES = 6_000_000
#: Items of a window whose ids are broadcast with it.
NAMED = 16

_KEPT = b"0123456789abcdefghijklmnopqrstuvwxyz"
#: Byte to its normal form: A-Z to a-z, other ASCII that isn't a word to a space.
NORMAL = bytes(
    b if b >= 0x80 or b in _KEPT else b + 32 if 65 <= b <= 90 else 32 for b in range(256)
)

STATE = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
])
_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])


def words_of(text: bytes) -> list[bytes]:
    return text.translate(NORMAL).split()


def windows_of(text: bytes, size: int) -> set[bytes]:
    words = words_of(text)
    return {b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


class Automaton:
    """Windows to find; a byte of UTF-8 is one character of the automaton."""

    def __init__(self, windows: list[tuple[bytes, list[str]]]):
        self.found = ahocorasick.Automaton()
        for window, names in windows:
            shown = f" {window.decode('latin-1')} "
            self.found.add_word(shown, (len(shown), shown.count(" ") - 1, names))
        self.empty = not windows
        if windows:
            self.found.make_automaton()

    def hits(self, words: list[bytes]) -> tuple[set[str], np.ndarray]:
        """The items found, and a mask over the words that are hit."""
        items: set[str] = set()
        if self.empty or not words:
            return items, np.zeros(0, bool)
        text = f" {b' '.join(words).decode('latin-1')} "
        starts, counts = [], []
        for end, (length, n, names) in self.found.iter(text):
            starts.append(end - length + 1)
            counts.append(n)
            items.update(names)
        if not starts:
            return items, np.zeros(0, bool)
        spaces = np.flatnonzero(np.frombuffer(text.encode("latin-1"), np.uint8) == 32)
        first = np.searchsorted(spaces, starts)
        change = np.zeros(len(words) + 1, np.int64)
        np.add.at(change, first, 1)
        np.add.at(change, first + np.array(counts), -1)
        return items, np.cumsum(change[:-1]) > 0


def runs_of(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and one past the last index of each run of true values."""
    edge = np.diff(np.concatenate([[0], mask.view(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def word_offsets(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Character offsets, start and end, of each word in the original text."""
    first, last = runs_of(np.frombuffer(text.translate(NORMAL), np.uint8) != 32)
    chars = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
    return chars[first], chars[last]


def find(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` with n_words, n_hit, items (ids found, sorted as strings) and
    spans (character offsets of each run of hit words)."""
    spark = docs.sparkSession
    known = items.select(F.col(item_col).cast("string").alias("item"), F.col(item_text).alias("text")).where("item IS NOT NULL AND text IS NOT NULL")
    pairs = _windows(known, window).distinct()
    place = F.row_number().over(Window.partitionBy("window").orderBy("item"))
    named = pairs.withColumn("place", place).where(F.col("place") <= NAMED + 1)  # a limit before the shuffle, too
    windows = named.groupBy("window").agg(F.array_sort(F.collect_list("item")).alias("items")).withColumn("wide", F.size("items") > NAMED)
    windows = windows.withColumn("items", F.when(F.col("wide"), F.array(F.concat(F.lit(WIDE), F.sha2("window", 256)))).otherwise(F.col("items")))
    names = F.aggregate("items", F.lit(0), lambda total, item: total + F.octet_length(item))
    told = windows.agg(F.sum(F.octet_length("window") + 2 + names).alias("size"), F.count_if("wide").alias("wide")).first()
    groups = -(-(told["size"] or 0) // NODES) or 1
    if groups > 1:
        windows = written(windows.withColumn("group", F.pmod(F.xxhash64("window"), F.lit(groups))), "windows", by="group")
    kept = [c for c in docs.columns if c not in STATE.names]
    out = bounded_batches(docs).select(*kept)
    for group in range(groups):
        own = (windows.where(F.col("group") == group) if groups > 1 else windows).collect()  # windows and names of about NODES bytes
        shared = spark.sparkContext.broadcast([(bytes(r.window), r["items"]) for r in own])
        out = _scan(out, shared, text_col, kept, group > 0)
        if group + 1 < groups:  # one automaton at a time in a worker
            out = written(out, "decontaminate")
    return _widened(out, pairs, kept) if told.wide else out


#: What a number in the place of items begins with; no id of an item holds it.
WIDE = "\x00window:"


def _widened(found: DataFrame, pairs: DataFrame, kept: list[str]) -> DataFrame:
    """The items of windows that many share, in the place of the windows' numbers."""
    number = F.concat(F.lit(WIDE), F.sha2("window", 256)).alias("number")
    at = free_name("at", [*found.columns, "item", "number"])
    listing = free_name("listed", [*found.columns, at])
    found = written(found.withColumn(at, F.monotonically_increasing_id()), "wide")  # the numbers stay as written
    is_wide = lambda x: F.startswith(x, F.lit(WIDE))
    some = found.where(F.exists("items", is_wide))
    links = some.select(at, F.explode(F.filter("items", is_wide)).alias("number")).join(pairs.select(number, "item"), "number").select(at, "item")
    links = links.union(some.select(at, F.explode(F.filter("items", lambda x: ~is_wide(x))).alias("item"))).distinct()
    listed = links.groupBy(at).agg(F.array_sort(F.collect_list("item")).alias(listing))  # the items of one document, as its result has them
    out = found.join(listed, at, "left").withColumn("items", F.coalesce(listing, "items"))
    return out.select(*kept, *STATE.names)


def _windows(items: DataFrame, size: int) -> DataFrame:
    """(item, window) of each item's windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 100):
            for item, text in zip(batch.column("item").to_pylist(), raw_texts(batch.column("text")), strict=True):
                found = list(windows_of(text, size))
                yield pa.RecordBatch.from_arrays([pa.array([item] * len(found), pa.string()), binaries(found)], ["item", "window"])

    return items.mapInArrow(run, "item string, window binary")


def _scan(df: DataFrame, shared: Broadcast, text_col: str, kept: list[str], carried: bool) -> DataFrame:
    schema = T.StructType([*(df.schema[c] for c in kept), *STATE.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = once(shared, Automaton)
        for batch in small_batches(batches):
            before = batch.select(["items", "spans"]).to_pylist() if carried else None
            n_words, n_hit, items, spans = [], [], [], []
            for i, text in enumerate(raw_texts(batch.column(text_col))):
                words = words_of(text or b"")
                names, mask = automaton.hits(words)
                span: list[dict] = []
                if carried and before[i]["spans"]:
                    names |= set(before[i]["items"])
                    first, _ = word_offsets(text)
                    mask = mask if len(mask) else np.zeros(len(words), bool)
                    for s in before[i]["spans"]:
                        mask |= (first >= s["start"]) & (first < s["end"])
                if len(mask):
                    first, last = word_offsets(text)
                    a, b = runs_of(mask)
                    span = [{"start": s, "end": e} for s, e in zip(first[a].tolist(), last[b - 1].tolist(), strict=True)]
                n_words.append(len(words))
                n_hit.append(int(mask.sum()))
                items.append(sorted(names))
                spans.append(span)
            made = [pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(items, pa.list_(pa.string())), pa.array(spans, pa.list_(_SPAN))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *made], schema.names)

    return df.mapInArrow(run, schema)


def contaminated(n_hit: str = "n_hit", n_words: str = "n_words"):
    """At least one hit word and at least a twentieth of all words."""
    return (F.col(n_hit) > 0) & (20 * F.col(n_hit) >= F.col(n_words))
