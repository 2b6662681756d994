"""Near-duplicate embeddings by Euclidean p-stable hashing and exact cosine checks.

1. Vectors are scaled to length one; equal ones (by a 128-bit digest) are one class from
   here on, so a class of copies, however large, costs one row.
2. A table hashes a vector by ``Plan.projections`` random projections, each shifted and
   cut into cells of ``WIDTH``; equal cells of all of them are one bucket. Two vectors at
   cosine c lie sqrt(2 - 2c) apart, which gives the chance that one projection agrees
   (``agreement``). The number of projections grows with the logarithm of the number of
   vectors, so that unrelated ones meet about once in all tables, and the number of
   tables follows from the recall wanted at the threshold itself (``RECALL``; pairs
   that are nearer are found more surely): ``Plan``. Tables are met in rounds, so that the
   signatures of all of them are never on disk together.
3. A bucket of at most ``FEW`` classes gives its pairs, which are compared exactly.
   The classes of fuller buckets are chained, never paired: already in the map pass a
   batch sends on ``FEW`` + 1 members of a bucket and chains the others to the first, so
   no task sees all members of a hot bucket.
4. What chains connect is cut into blocks of ``BLOCK`` classes by hash, and one task for
   each pair of blocks compares them by a matrix product, returning a spanning forest
   of the links and the number of links of each class: no pairs are emitted. A pair of
   small buckets that lies in one such component is left to it, so it counts once.
5. Components of links, joined back to all vectors by their digests, give each one the
   smallest id that links reach.

Cosines are computed in double precision, and nothing below the threshold is linked.

Rows, defined: vectors that are null, empty, zero, or hold a null or non-finite component
link with nothing (no links, the component is the own id); vectors of different lengths
don't link; repeated rows and ids are rows of their own; a null id never names a component
unless all ids of it are null, and a row without an id is kept only there; empty tables
give no rows. Only the id and vector columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from .bpe import forget
from .common import binaries, mix, slices_for
from .components import components
from .jaccard_join import _cuts, forest, paired, rooted, thinned

#: Cells of a projection, in lengths of the vectors.
WIDTH = 2.0
#: Chance that a pair at the threshold meets in some table.
RECALL = 0.99
#: Unrelated vectors that a vector is let meet in all tables, on average.
MET = 1.0
#: Most classes of a bucket that is paired.
FEW = 8
#: Most classes of a connected group that one block holds.
BLOCK = 1024
#: Vectors hashed or compared at once.
ROWS = 1000
#: Most tables whose signatures are on disk at a time.
TABLES_AT_ONCE = 64
#: Bytes of signatures for each slice of the hash space.
SLICE_BYTES = 4 << 20

_U = np.uint64
_SEED = 20240501


def agreement(cosine: float, width: float = WIDTH) -> float:
    """The chance that one projection puts two vectors at this cosine in one cell."""
    t = width / math.sqrt(2 - 2 * cosine)
    return math.erf(t / math.sqrt(2)) - math.sqrt(2 / math.pi) / t * (1 - math.exp(-t * t / 2))


@dataclass(frozen=True)
class Plan:
    projections: int
    tables: int

    @classmethod
    def of(cls, vectors: int, cosine: float, recall: float = RECALL) -> Plan:
        """Projections and tables for so many vectors. Unrelated ones are at right angles."""
        tables = 1
        for _ in range(8):  # either number asks for more of the other
            projections = max(1, math.ceil(math.log(max(2, vectors * tables / MET)) / -math.log(agreement(0))))
            tables = math.ceil(math.log(1 - recall) / math.log1p(-(agreement(cosine) ** projections)))
        return cls(projections, tables)

    def rounds(self) -> list[range]:
        """The tables in rounds of about equal size."""
        n = -(-self.tables // TABLES_AT_ONCE)
        return [range(self.tables * i // n, self.tables * (i + 1) // n) for i in range(n)]


@lru_cache(4)
def _directions(length: int, plan: Plan) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gaussian directions, shifts, and odd factors that make a cell's hash."""
    random = np.random.default_rng([_SEED, length, plan.projections, plan.tables])
    size = plan.tables * plan.projections
    return random.standard_normal((length, size)), random.uniform(0, WIDTH, size), random.integers(0, 2**63, size, np.uint64) * _U(2) + _U(1)


def buckets(unit: np.ndarray, plan: Plan, tables: range) -> np.ndarray:
    """The bucket of each vector of length one in some tables, as 64-bit hashes."""
    own = slice(tables.start * plan.projections, tables.stop * plan.projections)
    directions, shift, factor = (x[..., own] for x in _directions(unit.shape[1], plan))
    cell = np.floor((unit @ directions + shift) / WIDTH).astype(np.int64).view(_U)
    parts = mix(cell * factor + factor).reshape(len(unit), len(tables), plan.projections)
    return mix(parts.sum(axis=2, dtype=_U) + (np.array(tables, _U) + _U(1)) * _U(0xD6E8FEB86659FD93) + _U(unit.shape[1]))


def unit(vector: np.ndarray) -> np.ndarray | None:
    """The vector at length one; None for one that has no direction."""
    if not len(vector) or not np.isfinite(vector).all():
        return None
    largest = np.abs(vector).max()
    if largest == 0:
        return None
    scaled = vector / largest + 0.0  # neither squares nor the length leave the range, and -0 is 0
    return scaled / math.sqrt(scaled @ scaled)


def _read(vectors: DataFrame) -> DataFrame:
    """Ids, digests and scaled vectors; both null for a vector that takes no part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                digests, contents = [], []
                for vector in part.column(1).to_pylist():
                    raw = None if vector is None or None in vector else np.array(vector, np.float64)
                    scaled = None if raw is None else unit(raw)
                    digests.append(None if scaled is None else xxhash.xxh3_128_digest((raw + 0.0).tobytes()))
                    contents.append(None if scaled is None else scaled.tobytes())
                yield pa.RecordBatch.from_arrays([part.column(0), binaries(digests), binaries(contents)], ["id", "digest", "v"])

    return vectors.mapInArrow(run, "id long, digest binary, v binary")


def _rows(contents: list[bytes]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Places and vectors, by the vectors' length."""
    size = np.array([len(c) // 8 for c in contents], np.int64)
    return {int(n): (own := np.flatnonzero(size == n), np.frombuffer(b"".join(contents[i] for i in own), np.float64).reshape(len(own), n)) for n in np.unique(size)}


#: Of kind 0: low halves of signatures, places of their classes among the keys, keys. Of
#: kind 1: edges of chains.
_PACKED = "slice int, kind int, a binary, b binary, c binary"


def _signed(classes: DataFrame, plan: Plan, tables: range, slices: int) -> DataFrame:
    """Signatures of some tables, and chains of what a batch holds too much of, by slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot: dict[int, int] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                keys = part.column(0).to_numpy()
                signature, key = [], []
                for own, rows in _rows(part.column(1).to_pylist()).values():
                    signature.append(buckets(rows, plan, tables).ravel())
                    key.append(np.repeat(keys[own], len(tables)))
                signature, key, edges = thinned(np.concatenate(signature), np.concatenate(key), FEW, hot)
                order, cuts = _cuts(slices, signature) if len(signature) else (None, [])
                packed = []
                for number, s, e in cuts:
                    known, place = np.unique(key[order[s:e]], return_inverse=True)
                    packed.append((number, 0, signature[order[s:e]].astype(np.uint32).tobytes(), place.astype(np.uint16).tobytes(), known.tobytes()))
                if len(edges):
                    order, cuts = _cuts(slices, mix(edges[:, 1].astype(_U)))
                    packed += [(number, 1, edges[order[s:e], 0].tobytes(), edges[order[s:e], 1].tobytes(), b"") for number, s, e in cuts]
                if not packed:
                    continue
                columns = list(zip(*packed, strict=True))
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int32()) for c in columns[:2]), *map(binaries, columns[2:])], ["slice", "kind", "a", "b", "c"])

    return classes.select("key", "v").mapInArrow(run, _PACKED)


def _meeting(table: pa.Table) -> pa.Table:
    """Of one slice: pairs of small buckets, and chains of full ones."""
    kind = table.column("kind").to_numpy()
    a, b, c = (table.column(x).to_pylist() for x in "abc")
    signed, chained = np.flatnonzero(kind == 0), np.flatnonzero(kind == 1)
    none = np.zeros(0, np.int64)
    signature = np.frombuffer(b"".join(a[i] for i in signed), np.uint32)
    key = np.concatenate([none, *(np.frombuffer(c[i], np.int64)[np.frombuffer(b[i], np.uint16)] for i in signed)])
    pairs, chains = paired(signature, key, FEW)
    sent = np.stack([np.concatenate([none, *(np.frombuffer(x[i], np.int64) for i in chained)]) for x in (a, b)], axis=1)
    chains = rooted(np.concatenate([chains, sent]))
    both = np.concatenate([pairs, chains])
    return pa.table({"full": np.repeat([False, True], [len(pairs), len(chains)]), "a": both[:, 0], "b": both[:, 1]})


def _linked(cosine: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The pairs whose vectors link."""
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                left, right = part.column("v_a").to_pylist(), part.column("v_b").to_pylist()
                near = np.zeros(part.num_rows, bool)
                like = np.array([len(x) == len(y) for x, y in zip(left, right, strict=True)])
                for own, rows in _rows(left).values():
                    own_like = like[own]
                    if own_like.any():
                        other = np.frombuffer(b"".join(right[i] for i in own[own_like]), np.float64).reshape(-1, rows.shape[1])
                        near[own[own_like]] = np.einsum("ij,ij->i", rows[own_like], other) >= cosine
                yield part.select(["a", "b", "copies_a", "copies_b"]).filter(pa.array(near))

    return run


def _compared(cosine: float):
    def run(table: pa.Table) -> pa.Table:
        """Each class of a block pair: the root of its component, and its links."""
        rows = {k: (b, n, v) for k, b, n, v in zip(*(table.column(c).to_pylist() for c in ("key", "block", "copies", "v")), strict=True)}
        first, last = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        keys = sorted(rows)
        block, copies = (np.array([rows[k][x] for k in keys], np.int64) for x in (0, 1))
        near = np.zeros((len(keys), len(keys)), bool)
        for own, vectors in _rows([rows[k][2] for k in keys]).values():
            near[np.ix_(own, own)] = vectors @ vectors.T >= cosine
        if first != last:  # links within a block are found by the block's own task
            near &= block[:, None] != block
        np.fill_diagonal(near, False)
        root = forest(near | near.T)
        links = np.array([copies[row].sum() for row in near], np.int64)
        return pa.table({"key": pa.array(keys, pa.int64()), "root": pa.array([keys[r] for r in root], pa.int64()), "links": pa.array(links)})

    return run


def link(vectors: DataFrame, cosine: float = 0.95, id_col: str = "vec_id", vec_col: str = "embedding", recall: float = RECALL) -> DataFrame:
    """One row per vector: the id, n_links (other vectors linked directly), component_id
    (the smallest id reachable by links) and kept (whether it is that one)."""
    rows = _read(vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v")))
    grouped = rows.where("digest IS NOT NULL").groupBy("digest").agg(F.min("id").alias("least"), F.count("*").alias("copies"), F.first("v").alias("v"))
    # The number is unique, and final once it is written.
    classes = written(grouped.withColumn("key", F.monotonically_increasing_id()), "classes")
    count = classes.count()
    plan = Plan.of(count, cosine, recall)
    met = None
    for tables in plan.rounds():
        packed = _signed(classes, plan, tables, slices_for(count * len(tables) * 10, SLICE_BYTES))
        found = written(packed.groupBy("slice").applyInArrow(_meeting, "full boolean, a long, b long"), "met")
        met = found if met is None else met.union(found)

    chained = written(components(met.where("full").select("a", "b").distinct()), "chained")
    pairs = met.where("NOT full").select("a", "b").distinct()
    for side in ("a", "b"):
        held = chained.select(F.col("node").alias(side), F.col("component").alias(f"held_{side}"))
        pairs = pairs.join(held, side, "left")
    pairs = written(pairs.where("NOT held_a <=> held_b OR held_a IS NULL").select("a", "b"), "pairs")
    for side in ("a", "b"):
        pairs = pairs.join(classes.select(F.col("key").alias(side), F.col("v").alias(f"v_{side}"), F.col("copies").alias(f"copies_{side}")), side)
    near = written(pairs.mapInArrow(_linked(cosine), "a long, b long, copies_a long, copies_b long"), "near")

    blocks = chained.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = chained.join(blocks, "component").select("node", "component", "blocks", own.alias("block"))
    dealt = dealt.join(classes.select(F.col("key").alias("node"), "copies", "v"), "node")
    dealt = dealt.select(F.col("node").alias("key"), "component", "block", "copies", "v", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    dealt = dealt.select("key", "component", "block", "copies", "v", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    compared = written(dealt.groupBy("component", "i", "j").applyInArrow(_compared(cosine), "key long, root long, links long"), "compared")

    edges = near.select("a", "b").union(compared.select("key", "root")).distinct()
    linked = components(edges)
    counted = near.select(F.col("a").alias("key"), F.col("copies_b").alias("links")).union(near.select("b", "copies_a")).union(compared.select("key", "links"))
    counted = counted.groupBy("key").agg(F.sum("links").alias("links"))
    known = classes.select("digest", "key", "least", "copies").join(linked.withColumnRenamed("node", "key"), "key", "left").join(counted, "key", "left")
    known = known.withColumn("component", F.coalesce("component", "key"))
    named = known.groupBy("component").agg(F.min("least").alias("component_id"))
    known = written(known.join(named, "component").select("digest", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "known")
    result = rows.select("id", "digest").join(known, "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return result.select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"),
    )
