"""Bigram language model in a log-frequency Bloom filter.

Training counts n-grams in three steps: a task counts within its batches (numpy,
64-bit hashes), packs the counts by slice of the hash space, and one task per
slice merges them. A slice becomes a Bloom filter of its own size: an n-gram with
count c is entered at levels 1 to q, q = 1 + floor(2 log2 c), so its quantised
count is read back by probing level after level until a probe fails. Next to the
filter, a slice keeps the exact counts of its distinct words; those give the base
score and the number of known tokens.

Scoring broadcasts filters in groups of slices of at most ``GROUP_BYTES``. Above
that size the texts are scanned once per group, and the counts found so far travel
with each text, so the model may be any size while a worker holds one group.

The probability of a word after its predecessor is the Dirichlet-smoothed
(c2 + mass * p1) / (c1 + mass) with p1 = (c + 1) / (N + V + 1), all c from the
filter; a word's count that is read as more than N, or a bigram's as more than its
context's, is held down to that, so no probability is above 1. The filter's shape
follows the training texts' bytes, never the files they lie in, so equal rows give
equal scores. A text's tokens are its words, then one end; the first word follows a
start mark.

Rows, defined: a null or empty text is the single token end; repeated rows count
and score one by one; a null key is scored, never learned from; without training
rows N and V are 0, every token unknown; empty tables give no rows. Only the key
and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import written
from .bpe import forget, once
from .common import ASCII_LOWER, binaries, bounded_batches, mix, raw_texts, slices_for, text_bytes

#: Bits per entered level, and bits set for one entry within its 64-bit word.
BITS, PROBES = 9, 4
#: Most bytes of filters and word counts that are broadcast together.
GROUP_BYTES = 224 << 20
#: Bytes of training text per slice of the hash space.
SLICE_BYTES = 8 << 20
#: Words of texts counted at once, and texts scored at once.
CHUNK, ROWS = 1_200_000, 250
#: Weight of the unigram estimate, in counts.
MASS = 30.0

_U = np.uint64
_digest = xxhash.xxh64_intdigest
END, START = (_U(xxhash.xxh64_intdigest(x)) for x in (b"\n end", b"\n start"))  # no word holds white space
_PAIR, _LEVEL = _U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F)


def tokens(text: bytes | None) -> np.ndarray:
    """Hashes of the words, then the end."""
    words = text.translate(ASCII_LOWER).split() if text else []
    out = np.empty(len(words) + 1, _U)
    out[:-1] = np.fromiter(map(_digest, words), _U, len(words))
    out[-1] = END
    return out


def pair(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(before * _PAIR + word)


def before(hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The predecessor of each token; ``ends`` are the texts' last positions."""
    out = np.empty_like(hashes)
    out[1:] = hashes[:-1]
    out[0] = START
    out[ends[:-1] + 1] = START
    return out


def level_of(count: np.ndarray) -> np.ndarray:
    """Quantised count, from 1: its steps are a factor of the square root of 2."""
    return 1 + np.floor(2 * np.log2(count) + 1e-9).astype(np.int64)


def count_of(level: np.ndarray) -> np.ndarray:
    """The count that a level stands for, 0 for level 0."""
    low, high = np.ceil(2.0 ** ((level - 1) / 2) - 1e-9), np.ceil(2.0 ** (level / 2) - 1e-9) - 1
    return np.where(level > 0, (low + np.maximum(high, low)) / 2, 0.0)


def _bits(h: np.ndarray, level: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
    """A second hash that picks the word, and the mask of bits within it."""
    g = mix(h + np.asarray(level).astype(_U) * _LEVEL)
    r = mix(g)
    mask = np.zeros(len(h), _U)
    for i in range(PROBES):
        mask |= _U(1) << ((r >> _U(6 * i)) & _U(63))
    return g >> _U(32), mask


def build_filter(h: np.ndarray, count: np.ndarray) -> np.ndarray:
    level = level_of(count)
    entries = int(level.sum())
    words = np.zeros(max(1, -(-entries * BITS // 64)), _U)
    for now in range(1, int(level.max(initial=0)) + 1):
        at, mask = _bits(h[level >= now], now)
        np.bitwise_or.at(words, ((at * _U(len(words))) >> _U(32)).astype(np.int64), mask)
    return words


@dataclass
class Slices:
    """Filters and word counts of some slices, concatenated."""

    shift: int
    start: np.ndarray  #: first filter word of each slice; -1 where it isn't held
    size: np.ndarray
    words: np.ndarray
    known: np.ndarray  #: sorted hashes of words
    count: np.ndarray

    def levels(self, h: np.ndarray) -> np.ndarray:
        """Quantised counts by repeated membership probes; 0 if not held."""
        out = np.zeros(len(h), np.int64)
        number = (h >> _U(self.shift)).astype(np.int64)
        live = np.flatnonzero(self.start[number] >= 0)
        level = 1
        while len(live):
            at, mask = _bits(h[live], level)
            own = number[live]
            word = self.words[self.start[own] + ((at * self.size[own].astype(_U)) >> _U(32)).astype(np.int64)]
            live = live[(word & mask) == mask]
            out[live] = level
            level += 1
            if level > 140:  # beyond any 64-bit count
                break
        return out

    def counts(self, h: np.ndarray) -> np.ndarray:
        """Exact counts of words; 0 if unknown or not held."""
        if not len(self.known):
            return np.zeros(len(h), np.int64)
        at = np.minimum(np.searchsorted(self.known, h), len(self.known) - 1)
        return np.where(self.known[at] == h, self.count[at], 0)


def _tally(h: np.ndarray, count: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    if count is None:
        return np.unique(h, return_counts=True)
    order = np.argsort(h)
    h, count = h[order], count[order]
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
    return h[first], np.add.reduceat(count, first) if len(h) else count


def _count(texts: DataFrame, slices: int) -> DataFrame:
    shift = 64 - slices.bit_length() + 1

    def packed(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        hashes = np.concatenate(held)
        ends = np.cumsum([len(x) for x in held]) - 1
        previous = before(hashes, ends)
        rows = []
        # The start mark is a context only: a bigram's first part, no token.
        for kind, (h, n) in enumerate((_tally(hashes), _tally(pair(previous, hashes)))):
            cuts = np.searchsorted(h, np.arange(slices, dtype=_U) << _U(shift))
            for i, (s, e) in enumerate(zip(cuts, [*cuts[1:], len(h)], strict=True)):
                if e > s:
                    part = n[s:e]
                    narrow = part.astype("<u1") if part.max() < 256 else part
                    rows.append((i, kind, h[s:e].tobytes(), narrow.tobytes()))
        columns = list(zip(*rows, strict=True))
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), binaries(columns[2]), binaries(columns[3])], ["slice", "kind", "h", "n"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        held, size = [], 0
        for batch in batches:
            for text in raw_texts(batch.column(0)):
                held.append(tokens(text))
                size += len(held[-1])
                if size >= CHUNK:
                    yield from packed(held)
                    held, size = [], 0
        if held:
            yield from packed(held)

    return texts.mapInArrow(run, "slice int, kind int, h binary, n binary")


def _merge(table: pa.Table) -> pa.Table:
    """One slice: its filter, and the exact counts of its words."""
    kind = table.column("kind").to_pylist()
    merged = []
    for k in (0, 1):
        hs, ns = [], []
        for own, h, n in zip(kind, table.column("h").to_pylist(), table.column("n").to_pylist(), strict=True):
            if own == k:
                hs.append(np.frombuffer(h, _U))
                ns.append(np.frombuffer(n, "<u1" if len(n) * 8 == len(h) else "<i8").astype(np.int64))
        merged.append(_tally(np.concatenate(hs), np.concatenate(ns)) if hs else (np.zeros(0, _U), np.zeros(0, np.int64)))
    (word, n1), (bigram, n2) = merged
    bits = build_filter(np.concatenate([word, bigram]), np.concatenate([n1, n2]))
    return pa.table({
        "slice": pa.array([table.column("slice")[0].as_py()], pa.int32()),
        "bits": binaries([bits.tobytes()]), "known": binaries([word.tobytes()]), "count": binaries([n1.astype("<i8").tobytes()]),
        "n": pa.array([int(n1.sum())], pa.int64()), "v": pa.array([len(word)], pa.int64()),
    })


@dataclass
class Model:
    """A written table, one row per slice, and its totals."""

    rows: DataFrame
    slices: int
    n: int  #: training tokens
    v: int  #: distinct ones

    def groups(self) -> list[list[int]]:
        """Slices by group of at most GROUP_BYTES (one slice at least)."""
        sizes = self.rows.select("slice", (F.octet_length("bits") + F.octet_length("known") + F.octet_length("count")).alias("size")).orderBy("slice").collect()
        out, held = [[]], 0
        for r in sizes:
            if out[-1] and held + r.size > GROUP_BYTES:
                out.append([])
                held = 0
            out[-1].append(r.slice)
            held += r.size
        return out

    def load(self, group: list[int]) -> Slices:
        rows = self.rows.where(F.col("slice").isin(group) if len(group) < self.slices else F.lit(True)).orderBy("slice")
        start, size = np.full(self.slices, -1, np.int64), np.ones(self.slices, np.int64)
        total = rows.agg(F.sum(F.octet_length("bits")).alias("bits"), F.sum("v").alias("v")).first()
        words = np.empty((total.bits or 0) // 8, _U)
        known, count = np.empty(total.v or 0, _U), np.empty(total.v or 0, np.uint32 if self.n < 1 << 32 else np.int64)
        at = seen = 0
        for r in rows.toLocalIterator():
            bits, names = np.frombuffer(r.bits, _U), np.frombuffer(r.known, _U)
            start[r.slice], size[r.slice] = at, len(bits)
            words[at : at + len(bits)] = bits
            known[seen : seen + len(names)], count[seen : seen + len(names)] = names, np.frombuffer(r["count"], "<i8")
            at, seen = at + len(bits), seen + len(names)
        return Slices(64 - self.slices.bit_length() + 1, start, size, words, known, count)


def fit(docs: DataFrame, text: str = "text", usable: Column | None = None) -> Model:
    rows = bounded_batches(docs) if usable is None else bounded_batches(docs).where(usable)
    texts = rows.select(F.col(text).alias("text"))
    slices = slices_for(text_bytes(texts, "text"), SLICE_BYTES)
    table = written(_count(texts, slices).groupBy("slice").applyInArrow(_merge, "slice int, bits binary, known binary, count binary, n long, v long"), "ngrams")
    totals = table.agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first()
    return Model(table, slices, totals.n or 0, totals.v or 0)


_FIELDS = [("n_tokens", T.LongType()), ("n_known", T.LongType()), ("train_tokens", T.LongType()), ("base_score", T.DoubleType()), ("score", T.DoubleType())]


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` without its text, with n_tokens, n_known, train_tokens, base_score
    and score; same-named columns are replaced."""
    kept = [c for c in docs.columns if c not in {text, "counts", "levels", *(n for n, _ in _FIELDS)}]
    context = bounded_batches(docs).sparkSession.sparkContext
    out = docs.select(*kept, F.col(text).alias("text"))
    groups = model.groups()
    for i, group in enumerate(groups):
        shared = context.broadcast(model.load(group))
        last = i + 1 == len(groups)
        out = _scan(out, shared, kept, i > 0, last, model)
        if not last:
            out = written(out, "scored")
    return out


def _scan(df: DataFrame, shared: Broadcast, kept: list[str], carried: bool, last: bool, model: Model) -> DataFrame:
    added = [T.StructField(n, t) for n, t in _FIELDS] if last else [T.StructField(n, T.BinaryType()) for n in ("text", "counts", "levels")]
    if not last:
        added[0] = T.StructField("text", T.StringType())
    schema = T.StructType([*(df.schema[c] for c in kept), *added])
    n, v = model.n, model.v

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = once(shared, _same)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                texts = [tokens(t) for t in raw_texts(batch.column("text"))]
                ends = np.cumsum([len(t) for t in texts]) - 1
                h = np.concatenate(texts)
                previous = before(h, ends)
                # What is frequent is looked up once, whatever its level.
                word, of = np.unique(h, return_inverse=True)
                count, single = held.counts(word).astype(np.int64)[of], held.levels(word)[of]
                bigram, of = np.unique(pair(previous, h), return_inverse=True)
                double = held.levels(bigram)[of]
                if carried:
                    count += np.frombuffer(b"".join(batch.column("counts").to_pylist()), "<i8")
                    levels = np.frombuffer(b"".join(batch.column("levels").to_pylist()), "<u1").reshape(-1, 2)
                    single, double = single + levels[:, 0], double + levels[:, 1]
                first = np.concatenate([[0], ends[:-1] + 1])
                columns = [batch.column(c) for c in kept]
                if last:
                    made = _scored(h, previous, first, ends, count, single, double, n, v)
                else:
                    levels = np.stack([single, double], axis=1).astype("<u1")
                    cut = [slice(s, e + 1) for s, e in zip(first, ends, strict=True)]
                    made = [batch.column("text"), binaries([count[c].astype("<i8").tobytes() for c in cut]), binaries([levels[c].tobytes() for c in cut])]
                yield pa.RecordBatch.from_arrays([*columns, *made], schema.names)

    return df.mapInArrow(run, schema)


def _same(value: Slices) -> Slices:
    return value


def _scored(h, previous, first, ends, count, single, double, n: int, v: int) -> list[pa.Array]:
    total = n + v + 1
    base = np.log10((count + 1) / total)
    # The context's count: that of the token before, of the end at a text's start.
    held = np.minimum(count_of(single), n)
    context = np.empty(len(h))
    context[1:] = held[:-1]
    context[first] = held[ends]
    together = np.minimum(count_of(double), context)
    smooth = np.log10((together + MASS * (held + 1) / total) / (context + MASS))
    sizes = ends - first + 1
    return [
        pa.array(sizes.astype(np.int64)),
        pa.array(np.add.reduceat((count > 0).astype(np.int64), first)),
        pa.array(np.full(len(first), n, np.int64)),
        pa.array(np.add.reduceat(base, first)),
        pa.array(np.add.reduceat(smooth, first)),
    ]
