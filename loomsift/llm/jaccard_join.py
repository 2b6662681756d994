"""Jaccard self-join of shingle sets by PartEnum signatures, and its components.

1. A document becomes the set of its distinct n-word shingles (64-bit hashes);
   equal sets are one set from here on, so exact copies cost one row. A set is signed
   once a task, and the rows of documents are dealt evenly, whatever they hold.
2. Sizes fall into bands of ratio 1/threshold; sets that can link lie in the same
   band or neighbouring ones, so a set signs for its own band and the one below.
   Linked sets of such a pair of bands differ in at most k shingles. The hash
   domain is cut into n1 first-level parts of n2 second-level parts each, and the
   enumerated subsets leave k2 second-level parts out. As n1 * (k2 + 1) > k, some
   first-level parts hold at most k2 differences, and there two linked sets agree
   on one of the subsets (``Plan``). A subset that is empty signs nothing, or it
   would meet every set of the band: n1 is larger than needed by ``slack``, so that
   ``slack`` + 1 first-level parts must agree, and only a set with so many parts
   that have empty subsets signs those, too. Either one of two linked sets has
   fewer, and a filled subset agrees, or both sign the empty ones: no link is lost.
3. A bucket of equal signatures that holds at most ``FEW`` sets gives its pairs. The
   sets of fuller buckets (families of copies, passages that many texts share) sign
   again by the next, more selective entry of ``ROUNDS``, which is complete in itself;
   buckets that are still full after the last one are chained, never paired. No task
   sees all of a hot bucket: one sends on ``FEW`` + 1 of its sets, which tell that it is
   full, and chains the others to the first.
4. Each set has a sketch: its hashes added up in parts, half a byte each. Two sets differ
   in as many hashes at least as their sketches do in parts, so sets whose sketches
   differ too much have no link. That rules out most pairs; and the sets that chains
   connect are compared by their sketches, in blocks, into spanning forests of what
   is left. The components of both hold every linked pair.
5. Within a candidate component, sets are compared exactly. Components above
   ``BLOCK`` sets are cut into blocks by hash, one task for each pair of blocks,
   and each task returns a spanning forest of the links it finds: no pairs are
   emitted, and no task holds more than two blocks.
6. Components of those forests, joined back to all documents, give each one the
   smallest id that links reach.

Rows, defined: null, empty and word-less texts have an empty set, linked with
nothing (n_shingles 0, the component is the own id); with fewer words than n, the
whole sequence is the one shingle; repeated ids and rows are rows of their own
that share sets; a null id never names a component unless all ids of it are null;
empty tables give no rows. Only the id and text columns are read.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from .bpe import forget
from .common import ASCII_LOWER, binaries, bounded_batches, input_bytes, marked, mix, raw_texts, slices_for, small_batches
from .components import components

#: How sets sign, round by round: second-level parts, how many of them a subset leaves
#: out, and how many parts a subset keeps where so few differences are allowed that
#: one first-level part will do.
ROUNDS = ((3, 1, 2), (5, 2, 4))
#: Differences up to which one first-level part will do.
ONE_PART = 6
#: Most sets of a bucket that is paired.
FEW = 8
#: Most sketches that one block holds, and bytes of them compared at once.
SKETCHES, COMPARED = 1024, 1 << 24
#: Most sets of a candidate component that one block holds.
BLOCK = 256
#: Shingle columns compared at once, and rows of other small sets beside them.
COLUMNS = 4096
#: Input bytes for each slice of the signature space.
SLICE_BYTES = 4 << 20
#: Documents that travel together.
PIECE = 100
#: Hot signatures that a task remembers.
HOT = 1 << 16
#: Bytes to count for each shingle that signs again, which makes two or three signatures.
SIGNED_BYTES = 10

_U = np.uint64
_NO_ID = np.iinfo(np.int64).min
_digest = xxhash.xxh64_intdigest


def shingles(text: bytes | None, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-word shingles."""
    words = text.translate(ASCII_LOWER).split() if text else []
    if not words:
        return np.zeros(0, _U)
    h = np.fromiter(map(_digest, words), _U, len(words))
    n = min(n, len(words))
    total = np.zeros(len(h) - n + 1, _U)
    for j in range(n):
        total = mix(total + h[j : len(h) - n + 1 + j])
    return np.unique(total)


def set_key(hashes: np.ndarray) -> int:
    """A 64-bit name of a set, as a signed integer."""
    return int.from_bytes(xxhash.xxh64_digest(hashes.tobytes()), "little", signed=True)


@dataclass(frozen=True)
class Plan:
    """How sets sign for the pair of bands ``band`` and ``band`` + 1."""

    band: int
    k: int
    n1: int
    n2: int
    k2: int
    slack: int


@dataclass(frozen=True)
class Rule:
    """Sets link when 100 * intersection >= percent * union."""

    percent: int

    def limit(self, band: int) -> int:
        """Least size of a band. A size's largest partner, size * 100 // percent,
        lies in the same band or the next one."""
        return _limits(self.percent, band)

    def band(self, size: int) -> int:
        band = 0
        while self.limit(band + 1) <= size:
            band += 1
        return band

    def differences(self, sizes: int | np.ndarray) -> int | np.ndarray:
        """Most hashes in which two linked sets differ whose sizes add up to ``sizes``."""
        return sizes * (100 - self.percent) // (100 + self.percent)

    def plan(self, band: int, number: int = 0) -> Plan:
        return _plan(self, band, ROUNDS[number])


@lru_cache(None)
def _limits(percent: int, band: int) -> int:
    return 1 if band == 0 else _limits(percent, band - 1) * 100 // percent + 1


@lru_cache(None)
def _plan(rule: Rule, band: int, entry: tuple[int, int, int]) -> Plan:
    # The smaller of two linked sets is at most b, the larger at most a.
    b = rule.limit(band + 1) - 1
    a = b * 100 // rule.percent
    k = rule.differences(a + b)
    n2, k2, kept = entry
    if k <= ONE_PART:
        return Plan(band, k, 1, k + kept, k, 0)
    least, slack, base = rule.limit(band), 0, k // (k2 + 1) + 1
    for _ in range(4):  # parts with an empty subset that a set has, and a margin
        n1 = base + slack
        mean = n1 * min(1.0, math.comb(n2, k2) * math.exp(-(n2 - k2) * least / n1 / n2))
        slack = math.ceil(mean + 2.5 * math.sqrt(mean))
        slack = min(slack, base // 2)
    return Plan(band, k, base + slack, n2, k2, slack)


@lru_cache(None)
def _subsets(plan: Plan) -> tuple[np.ndarray, np.ndarray]:
    """The second-level parts each subset keeps, and a salt for each subset."""
    kept = np.array(list(itertools.combinations(range(plan.n2), plan.n2 - plan.k2)))
    name = (plan.band + 1) * 0xC2B2AE3D27D4EB4F + (plan.n2 * 64 + plan.k2) * 0x9FB21C651E98DF25
    return kept, np.array([((number + 1) * 0x9E3779B97F4A7C15 + name) % (1 << 64) for number in range(len(kept))], _U)


def signatures(hashes: np.ndarray, rule: Rule, number: int = 0) -> np.ndarray:
    """The signatures of a non-empty sorted set in a round."""
    own = rule.band(len(hashes))
    sums = np.concatenate([np.zeros(1, _U), np.cumsum(mix(hashes), dtype=_U)])
    top = hashes >> _U(32)
    out = []
    for band in (own - 1, own):
        if band < 0:
            continue
        plan = rule.plan(band, number)
        parts = plan.n1 * plan.n2
        # A hash h lies in part top(h) * parts >> 32; parts are runs of the sorted set.
        part_of = (top * _U(parts)) >> _U(32)
        at = np.searchsorted(part_of, np.arange(parts + 1, dtype=_U))
        size = np.diff(at).reshape(plan.n1, plan.n2)
        value = mix(sums[at[1:]] - sums[at[:-1]] + np.arange(1, parts + 1, dtype=_U)).reshape(plan.n1, plan.n2)
        kept, salt = _subsets(plan)
        values = mix(value[:, kept].sum(axis=2, dtype=_U) + (np.arange(plan.n1, dtype=_U) * _U(0xD6E8FEB86659FD93))[:, None] + salt)
        filled = size[:, kept].sum(axis=2) > 0
        gaps = plan.n1 - np.count_nonzero(filled.all(axis=1))
        out.append(values.ravel() if gaps > plan.slack else values[filled])
    return np.concatenate(out)


def sketch(hashes: np.ndarray, rule: Rule) -> bytes:
    """Half a byte for each of 2**n runs of the hash domain: the sum of its hashes."""
    bits = max(1, int(2 * rule.differences(2 * len(hashes)) - 1).bit_length())
    run = (hashes >> _U(64 - bits)).astype(np.int64)
    sums = np.bincount(run, mix(hashes) & _U(15), 1 << bits).astype(np.int64) & 15  # exact in doubles
    return (sums[::2] | sums[1::2] << 4).astype(np.uint8).tobytes()


def _folded(sketches: list[bytes], length: int) -> np.ndarray:
    """Sketches as rows, neighbouring runs added up until ``length`` are left."""
    rows = np.frombuffer(b"".join(sketches), np.uint8).reshape(len(sketches), -1)
    runs = np.stack([rows & 15, rows >> 4], axis=2).reshape(len(sketches), length, -1)
    return runs.sum(axis=2, dtype=np.uint8) & 15


def may_link(a: list[bytes], b: list[bytes], size_a: np.ndarray, size_b: np.ndarray, rule: Rule) -> np.ndarray:
    """Whether pairs may link, by their sizes and sketches."""
    out = 100 * np.minimum(size_a, size_b) >= rule.percent * np.maximum(size_a, size_b)
    shape = np.array([[2 * len(x), 2 * len(y)] for x, y in zip(a, b, strict=True)]).reshape(-1, 2)
    for x, y in np.unique(shape[out], axis=0):
        rows = np.flatnonzero((shape == (x, y)).all(axis=1) & out)
        length = min(x, y)
        differ = (_folded([a[r] for r in rows], length) != _folded([b[r] for r in rows], length)).sum(axis=1)
        out[rows] = differ <= rule.differences(size_a[rows] + size_b[rows])
    return out


def _sketched(rule: Rule):
    def run(table: pa.Table) -> pa.Table:
        """A spanning forest of the sets of a block pair that may link."""
        rows = {k: (b, n, s) for k, b, n, s in zip(*(table.column(c).to_pylist() for c in ("key", "block", "n", "sketch")), strict=True)}
        first, last = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        keys = sorted(rows, key=lambda k: (len(rows[k][2]), k))
        block, sizes = np.array([rows[k][0] for k in keys]), np.array([rows[k][1] for k in keys])
        length = np.array([2 * len(rows[k][2]) for k in keys])
        may = np.zeros((len(keys), len(keys)), bool)
        for x in np.unique(length):
            for y in np.unique(length[length >= x]):
                left, right = np.flatnonzero((length == x) & (block == first)), np.flatnonzero((length == y) & (block == last))
                may[np.ix_(left, right)] = _near(left, right, keys, rows, sizes, x, rule)
                if x != y and first != last:
                    left, right = np.flatnonzero((length == x) & (block == last)), np.flatnonzero((length == y) & (block == first))
                    may[np.ix_(left, right)] = _near(left, right, keys, rows, sizes, x, rule)
        may |= may.T
        np.fill_diagonal(may, False)
        root = forest(may)
        edges = np.flatnonzero(root != np.arange(len(keys)))
        names = np.array(keys, np.int64)
        return pa.table({"a": names[root[edges]], "b": names[edges]})

    return run


def _near(left: np.ndarray, right: np.ndarray, keys: list[int], rows: dict, sizes: np.ndarray, length: int, rule: Rule) -> np.ndarray:
    """Whether sets may link, left by right, by sketches of at least ``length`` runs."""
    out = np.zeros((len(left), len(right)), bool)
    if not out.size:
        return out
    small, large = np.minimum(sizes[left][:, None], sizes[right]), np.maximum(sizes[left][:, None], sizes[right])
    like = 100 * small >= rule.percent * large
    if not like.any():
        return out
    a, b = (_folded([rows[keys[r]][2] for r in part], length) for part in (left, right))
    most = rule.differences(small + large)
    step = max(1, COMPARED // b.size)
    for at in range(0, len(left), step):
        out[at : at + step] = (a[at : at + step, None, :] != b).sum(axis=2) <= most[at : at + step]
    return out & like


#: Of kind 0: ids, set keys, sizes, hashes of the texts. Of kind 1: low halves of
#: signatures, places of their sets among the keys, keys. Of kind 2: keys, sizes,
#: lengths of sketches, sketches. Of kind 3: edges of chains, as two lists of keys.
_PACKED = "slice int, kind int, a binary, b binary, c binary, d binary"
#: Of kind 0: id, set key, size, hash of the text. Of kind 1 a pair, of kind 2 an edge
#: of a chain, as set keys. Of kind 3: set key, size, sketch.
_FOUND = "kind int, a long, b long, n long, h long, sketch binary"


def _cuts(slices: int, where: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """An order by slice of the top bits of ``where``, and (slice, from, to) in it."""
    number = (where >> _U(64 - slices.bit_length() + 1)).astype(np.int64)
    order = np.argsort(number, kind="stable")
    number = number[order]
    starts = np.flatnonzero(np.diff(number, prepend=-1))
    return order, [(int(number[s]), int(s), int(e)) for s, e in zip(starts, [*starts[1:], len(number)], strict=True)]


def thinned(signature: np.ndarray, key: np.ndarray, few: int, hot: dict[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signatures and keys, each signature with at most ``few`` + 1 keys, which tell that
    its bucket is full, and edges that chain the other keys to the first of it. ``hot``
    remembers such signatures for the task's later batches, which send none of them."""
    order = np.lexsort((key, signature))
    signature, key = signature[order], key[order]
    new = np.append(True, (signature[1:] != signature[:-1]) | (key[1:] != key[:-1])) if len(key) else np.zeros(0, bool)
    signature, key = signature[new], key[new]
    start = np.flatnonzero(np.append(True, signature[1:] != signature[:-1])) if len(key) else np.zeros(0, np.int64)
    size = np.diff(np.append(start, len(key)))
    first, most = key[start].copy(), np.full(len(start), few + 1)
    if hot:
        names = np.array(list(hot), _U)
        for at in np.flatnonzero(np.isin(signature[start], names)).tolist():
            first[at], most[at] = hot[int(signature[start[at]])], 0
    for at in np.flatnonzero((size > most) & (most > 0)).tolist():
        if len(hot) < HOT:
            hot[int(signature[start[at]])] = int(first[at])
    place = np.arange(len(key)) - np.repeat(start, size)
    rest = place >= np.repeat(most, size)
    edges = np.stack([np.repeat(first, size)[rest], key[rest]], axis=1)
    return signature[~rest], key[~rest], np.unique(edges[edges[:, 0] != edges[:, 1]], axis=0)


def _pack_signatures(signed: list[np.ndarray], keys: list[int], slices: int, hot: dict[int, int]) -> list[tuple]:
    """Rows for the slices: one with each one's signatures, and one with edges of chains."""
    every, owner = np.concatenate(signed), np.repeat(np.array(keys, np.int64), [len(s) for s in signed])
    every, owner, edges = thinned(every, owner, FEW, hot)
    order, cuts = _cuts(slices, every) if len(every) else (None, [])
    out = []
    for number, s, e in cuts:
        table, place = np.unique(owner[order[s:e]], return_inverse=True)
        out.append((number, 1, every[order[s:e]].astype(np.uint32).tobytes(), place.astype(np.uint16).tobytes(), table.tobytes(), b""))
    order, cuts = _cuts(slices, mix(edges[:, 1].astype(_U))) if len(edges) else (None, [])
    return out + [(number, 3, edges[order[s:e], 0].tobytes(), edges[order[s:e], 1].tobytes(), b"", b"") for number, s, e in cuts]


def _packed_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int32()) for c in columns[:2]), *map(binaries, columns[2:])], ["slice", "kind", "a", "b", "c", "d"])


def _signed(docs: DataFrame, n: int, rule: Rule, slices: int) -> DataFrame:
    """Documents, sketches and first-round signatures, packed by slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        turn = itertools.count(TaskContext.get().partitionId() * 7919)
        hot: dict[int, int] = {}
        done: set[int] = set()  # sets that this task has signed, so that copies sign once
        for rows in small_batches(batches):
            if not rows.num_rows:
                continue
            ids = rows.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            texts = rows.column(2).to_numpy(zero_copy_only=False).astype(np.int64)
            sets = [shingles(t, n) for t in raw_texts(rows.column(1))]
            keys = [set_key(s) for s in sets]
            fresh = []
            if len(done) > 200_000:
                done.clear()
            for at, (key, hashes) in enumerate(zip(keys, sets, strict=True)):
                if key not in done and len(hashes):
                    done.add(key)
                    fresh.append(at)
            key_array, sizes = np.array(keys, np.int64), np.array([len(s) for s in sets], np.int64)
            sketches = {at: sketch(sets[at], rule) for at in fresh}
            packed = []
            for at in range(0, len(ids), PIECE):  # only passed on, so any slice will do
                own = slice(at, at + PIECE)
                packed.append((next(turn) % slices, 0, *(c[own].tobytes() for c in (ids, key_array, sizes, texts))))
            order, cuts = _cuts(slices, key_array[fresh].view(_U)) if fresh else (None, [])
            for number, s, e in cuts:
                drawn = [fresh[i] for i in order[s:e].tolist()]
                lengths = np.array([len(sketches[at]) for at in drawn], np.int64)
                packed.append((number, 2, key_array[drawn].tobytes(), sizes[drawn].tobytes(), lengths.tobytes(), b"".join(sketches[at] for at in drawn)))
            if fresh:
                packed += _pack_signatures([signatures(sets[at], rule) for at in fresh], [keys[at] for at in fresh], slices, hot)
            yield _packed_batch(packed)

    return docs.mapInArrow(run, _PACKED)


def _signed_again(texts: DataFrame, n: int, rule: Rule, number: int, slices: int) -> DataFrame:
    """Signatures of a later round, of texts that come with their set's key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        hot: dict[int, int] = {}
        for rows in small_batches(batches, 100):
            sets = zip(rows.column("key").to_pylist(), (shingles(t, n) for t in raw_texts(rows.column("text"))), strict=True)
            known = {key: hashes for key, hashes in sets if set_key(hashes) == key}
            if known:
                yield _packed_batch(_pack_signatures([signatures(s, rule, number) for s in known.values()], list(known), slices, hot))

    return texts.mapInArrow(run, _PACKED)


def _long(parts: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(parts), np.int64)


def paired(signature: np.ndarray, key: np.ndarray, few: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of the sets in buckets of at most ``few``, and for the fuller ones a forest
    that connects the sets of each (rows of two keys, each row once)."""
    pairs, chains = [np.zeros((0, 2), np.int64)], np.zeros((0, 2), np.int64)
    order = np.argsort(signature)
    signature, key = signature[order], key[order]
    same = signature[1:] == signature[:-1]
    if not same.any():
        return pairs[0], chains
    shared = np.append(same, False) | np.insert(same, 0, False)
    signature, key = signature[shared], key[shared]
    order = np.lexsort((key, signature))  # a set that several tasks signed counts once
    signature, key = signature[order], key[order]
    new = np.append(True, (signature[1:] != signature[:-1]) | (key[1:] != key[:-1]))
    signature, key = signature[new], key[new]
    start = np.flatnonzero(np.append(True, signature[1:] != signature[:-1]))
    size = np.diff(np.append(start, len(key)))
    full = np.repeat(size > few, size)
    couple = lambda left, lag: np.unique(np.stack([key[left], key[left + lag]], axis=1), axis=0)
    for lag in range(1, min(few, len(key))):
        pairs.append(couple(np.flatnonzero((signature[lag:] == signature[:-lag]) & ~full[lag:]), lag))
    chains = couple(np.flatnonzero((signature[1:] == signature[:-1]) & full[1:]), 1)
    return np.unique(np.concatenate(pairs), axis=0), rooted(chains)


def rooted(edges: np.ndarray) -> np.ndarray:
    """A forest with the same components: edges from the least node of each."""
    nodes, place = np.unique(edges, return_inverse=True)
    a, b = place.reshape(edges.shape).T
    least = np.arange(len(nodes))
    while True:
        low = np.minimum(least[a], least[b])
        after = least.copy()
        np.minimum.at(after, a, low)
        np.minimum.at(after, b, low)
        after = after[after]
        if (after == least).all():
            break
        least = after
    below = np.flatnonzero(least != np.arange(len(nodes)))
    return np.stack([nodes[least[below]], nodes[below]], axis=1)


def _meeting(few: int):
    def run(table: pa.Table) -> pa.Table:
        """Of one slice: its documents, sketches, pairs and chains."""
        kind = table.column("kind").to_pylist()
        a, b, c, d = (table.column(x).to_pylist() for x in "abcd")
        pick = lambda column, k: [x for x, y in zip(column, kind, strict=True) if y == k]
        docs = [_long(pick(x, 0)) for x in (a, b, c, d)]
        signature = np.frombuffer(b"".join(pick(a, 1)), np.uint32)
        keys = [np.frombuffer(t, np.int64)[np.frombuffer(p, np.uint16)] for p, t in zip(pick(b, 1), pick(c, 1), strict=True)]
        pairs, chains = paired(signature, np.concatenate(keys) if keys else np.zeros(0, np.int64), few)
        sent = np.stack([_long(pick(a, 3)), _long(pick(b, 3))], axis=1)
        if len(sent):
            chains = rooted(np.concatenate([chains, sent]))
        drawn_keys, first = np.unique(_long(pick(a, 2)), return_index=True)
        sizes, lengths, drawn = _long(pick(b, 2))[first], _long(pick(c, 2)), b"".join(pick(d, 2))
        ends = np.cumsum(lengths)
        sketches = [drawn[ends[i] - lengths[i] : ends[i]] for i in first.tolist()]
        counts = [len(docs[0]), len(pairs), len(chains), len(drawn_keys)]
        none = lambda n: np.zeros(n, np.int64)
        return pa.table({
            "kind": pa.array(np.repeat([0, 1, 2, 3], counts), pa.int32()),
            "a": np.concatenate([docs[0], pairs[:, 0], chains[:, 0], drawn_keys]),
            "b": np.concatenate([docs[1], pairs[:, 1], chains[:, 1], drawn_keys]),
            "n": np.concatenate([docs[2], none(counts[1] + counts[2]), sizes]),
            "h": np.concatenate([docs[3], none(sum(counts[1:]))]),
            "sketch": pa.array([*[None] * sum(counts[:3]), *sketches], pa.binary()),
        })

    return run


def _drawn(sketches: DataFrame, edges: DataFrame) -> DataFrame:
    """Sketches that the edges may need; the others aren't shuffled."""
    keys = edges.select("a").union(edges.select("b"))
    return marked(sketches, keys, ["a"], "may").where("may").drop("may")


def _promising(pairs: DataFrame, sketches: DataFrame, rule: Rule) -> DataFrame:
    """The pairs that their sketches don't rule out."""
    pairs = written(pairs, "pairs")
    sketches = _drawn(sketches, pairs)
    both = pairs
    for side in ("a", "b"):
        both = both.join(sketches.select(F.col("a").alias(side), F.col("n").alias(f"n_{side}"), F.col("sketch").alias(f"s_{side}")), side)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            if batch.num_rows:
                sizes = (batch.column(c).to_numpy() for c in ("n_a", "n_b"))
                keep = may_link(batch.column("s_a").to_pylist(), batch.column("s_b").to_pylist(), *sizes, rule)
                yield batch.select(["a", "b"]).filter(pa.array(keep))

    return both.select("a", "b", "n_a", "n_b", "s_a", "s_b").mapInArrow(run, "a long, b long")


def _forests(chains: DataFrame, sketches: DataFrame, rule: Rule) -> DataFrame:
    """Edges between the sets that chains connect and whose sketches allow a link."""
    held = written(components(chains), "held")
    sketches = _drawn(sketches, held.select(F.col("node").alias("a"), F.col("node").alias("b")))
    blocks = held.groupBy("component").agg(F.ceil(F.count("*") / SKETCHES).cast("int").alias("blocks"))
    drawn = sketches.select(F.col("a").alias("node"), "n", "sketch")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    rows = held.join(blocks, "component").join(drawn, "node").select(F.col("node").alias("key"), "component", own.alias("block"), "n", "sketch", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    rows = rows.select("key", "component", "block", "n", "sketch", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    return rows.groupBy("component", "i", "j").applyInArrow(_sketched(rule), "a long, b long")


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of sorted sets, left by right."""
    flat = np.concatenate([*left, *right])
    row = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in (*left, *right)])
    values, column, count = np.unique(flat, return_inverse=True, return_counts=True)
    shared = np.cumsum(count > 1) - 1
    keep = count[column] > 1
    row, column = row[keep], shared[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(left), len(right)), np.float32)
    last = int(column[-1]) + 1 if len(column) else 0
    for start in range(0, last, COLUMNS):
        s, e = np.searchsorted(column, [start, start + COLUMNS])
        tile = np.zeros((len(left) + len(right), min(COLUMNS, last - start)), np.float32)
        tile[row[s:e], column[s:e] - start] = 1
        out += tile[: len(left)] @ tile[len(left) :].T
    return out


def forest(linked: np.ndarray) -> np.ndarray:
    """The root of each node's component, from a symmetric adjacency matrix."""
    root = np.full(len(linked), -1)
    for start in range(len(linked)):
        if root[start] >= 0:
            continue
        root[start] = start
        front = np.array([start])
        while len(front):
            reached = linked[front].any(axis=0) & (root < 0)
            root[reached] = start
            front = np.flatnonzero(reached)
    return root


def _verifier(rule: Rule):
    def run(table: pa.Table) -> pa.Table:
        """Each set of a block pair: the root of its component and its links."""
        rows = {}
        for key, block, copies, hashes in zip(*(table.column(c).to_pylist() for c in ("key", "block", "copies", "hashes")), strict=True):
            rows[key] = (block, copies, np.frombuffer(hashes, _U))
        keys = sorted(rows, key=lambda k: (rows[k][0], k))
        first, last = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        sets = [rows[k][2] for k in keys]
        size, copies = np.array([len(s) for s in sets], np.float64), np.array([rows[k][1] for k in keys], np.int64)
        cut = sum(rows[k][0] == first for k in keys) if first != last else len(keys)
        a, b = (slice(0, cut), slice(cut, None)) if first != last else (slice(None), slice(None))
        common = common_counts(sets[a], sets[b]).astype(np.float64)
        near = 100 * common >= rule.percent * (size[a, None] + size[None, b] - common)
        linked = np.zeros((len(keys), len(keys)), bool)
        linked[a, b] |= near
        linked[b, a] |= near.T
        np.fill_diagonal(linked, False)
        root = forest(linked)
        return pa.table({
            "key": pa.array(keys, pa.int64()), "root": pa.array([keys[r] for r in root], pa.int64()), "links": pa.array(linked @ copies, pa.int64()),
        })

    return run


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, percent: int = 85, sets: bool = False) -> DataFrame:
    """One row per document: id, n_shingles, component_id and n_links, the number
    of other documents that it links with directly. With ``sets`` also text_key, the
    xxhash64 of the text, which tells documents apart that share an id, and class_key,
    which a component's documents have in common (null for an empty set)."""
    rule = Rule(percent)
    own_id = F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("id")
    docs = bounded_batches(docs).select(own_id, F.col(text_col).alias("text"), F.xxhash64(F.col(text_col)).alias("h"))
    slices = slices_for(input_bytes(docs, "text"), SLICE_BYTES)
    packed = _signed(docs, words, rule, slices)
    met = written(packed.groupBy("slice").applyInArrow(_meeting(FEW), _FOUND), "met")
    ids = met.where("kind = 0").select(F.col("a").alias("id"), F.col("b").alias("key"), F.col("n").alias("n_shingles"), "h")
    # A set's first document by id stands for it; without any id, the first by text.
    named_sets = ids.where("n_shingles > 0").groupBy("key").agg(
        F.min(F.when(F.col("id") != _NO_ID, F.col("id"))).alias("least"), F.min(F.struct("id", "h")).alias("row"),
        F.first("n_shingles").alias("size"), F.count("*").alias("copies"),
    )
    named_sets = written(named_sets.select("key", "least", "row.id", "row.h", "size", "copies"), "sets")
    pairs, chains = met.where("kind = 1"), met.where("kind = 2")
    for number in range(1, len(ROUNDS)):
        again = chains.select(F.col("a").alias("key")).union(chains.select("b")).distinct().join(named_sets, "key").select("id", "h", "key", "size")
        again = written(again, "again")
        total = again.agg(F.sum("size")).first()[0]
        if not total:
            break
        texts = _once(docs, again).select("key", "text")
        found = _signed_again(texts, words, rule, number, slices_for(total * SIGNED_BYTES, SLICE_BYTES))
        found = written(found.groupBy("slice").applyInArrow(_meeting(FEW), _FOUND), "met-again")
        pairs, chains = pairs.union(found.where("kind = 1")), found.where("kind = 2")
    promising = _promising(pairs.select("a", "b").distinct(), met.where("kind = 3"), rule)
    candidates = components(promising.union(_forests(chains.select("a", "b").distinct(), met.where("kind = 3"), rule)).distinct())
    blocks = candidates.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    # One row of each candidate set is fetched again.
    wanted = candidates.join(blocks, "component").join(named_sets, F.col("node") == F.col("key")).select("id", "h", "key", "component", "blocks", "copies")
    wanted = written(wanted, "wanted")
    compared = _contents(docs, wanted, words).groupBy("component", "i", "j").applyInArrow(_verifier(rule), "key long, root long, links long")
    compared = written(compared, "compared")
    classes = components(compared.select(F.col("key").alias("a"), F.col("root").alias("b")).distinct())
    links = compared.groupBy("key").agg(F.sum("links").alias("links"))
    known = (
        named_sets.join(classes, F.col("key") == F.col("node"), "left")
        .join(links, "key", "left")
        .select("key", "least", F.coalesce("component", "key").alias("class"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    )
    named = known.groupBy("class").agg(F.min("least").alias("component_id"))
    extra = ["class"] if sets else []
    result = ids.join(known.join(named, "class").select("key", "component_id", "n_links", *extra), "key", "left")
    own = F.when(F.col("id") != _NO_ID, F.col("id"))
    return result.select(
        own.alias(id_col), "n_shingles",
        F.when(F.col("n_shingles") == 0, own).otherwise(F.col("component_id")).alias("component_id"),
        F.when(F.col("n_shingles") == 0, F.lit(0)).otherwise(F.col("n_links")).cast("long").alias("n_links"),
        *([F.col("h").alias("text_key"), F.col("class").alias("class_key")] if sets else []),
    )


def _once(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Texts of the wanted rows, one for all rows that repeat an id and a text: a task drops
    repeats before anything is shuffled."""
    may = marked(docs, wanted, ["id", "h"], "may").where("may").select("id", "h", "text")
    return may.withColumn("h2", F.xxhash64(F.lit(1), "text")).dropDuplicates(["id", "h", "h2"]).join(wanted, ["id", "h"])


def _contents(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """The hashes of the wanted sets, once for each block pair they take part in."""
    texts = _once(docs, wanted).select("key", "component", "blocks", "copies", "text")
    names = ["key", "component", "i", "j", "block", "copies", "hashes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                rows = batch.slice(at, 200)
                out = []
                key, component, blocks, copies = (rows.column(i).to_pylist() for i in range(4))
                for k, c, m, n, text in zip(key, component, blocks, copies, raw_texts(rows.column(4)), strict=True):
                    hashes = shingles(text, words)
                    if set_key(hashes) != k:  # another text of the same 64-bit hash
                        continue
                    own = int(mix(np.array([k], np.int64).view(_U))[0] % _U(m))
                    content = hashes.tobytes()
                    out += [(k, c, min(own, x), max(own, x), own, n, content) for x in range(m)]
                if out:
                    cols = list(zip(*out, strict=True))
                    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names)

    return texts.mapInArrow(run, "key long, component long, i int, j int, block int, copies long, hashes binary")
