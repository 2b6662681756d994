"""Hard negatives by a full score sort of each anchor's candidates.

Two scans of the candidates for each group of anchors. The first finds an anchor's
positives: each task keeps the best rows of the anchor's label, and the tasks' lists
merge in a tree. A positive's score sets the limits of its negatives, so the second
scan has them at hand: a task sorts a tile's integer scores by score and id, anchor by
anchor, drops the rows of the anchor's label, finds the upper limit of each positive by
binary search, and reads the next ``k`` rows down to the lower limit. The lists merge in
a tree as well. Anchors are dealt into groups of at most ``GROUP_BYTES`` of quantised
vectors, which are what a task holds besides a tile and its lists; no row of the
candidates is ever gathered by anchor.

Scores are exact: tiles whose products fit 53 bits use floating point, others Python
integers (scores beyond 64 bits are held at the ends of that range).

Rows, defined: rows without an id or a label, and vectors that are null, empty or hold a
null or non-finite component, take no part; an anchor meets vectors of its own length;
rows with the anchor's id are its own and never positives or negatives of it; an id
repeated among the anchors asks once, by its least vector and label; other repeated rows
count each; ties go to the smaller id; an anchor without positives, or a positive without
negatives, gives no rows; empty tables give no rows. Only id, vector and label are read,
and labels are whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from .bpe import once
from .topk import _NONE, FAN, _merged, _ranked

#: Most bytes of quantised anchors that are broadcast together.
GROUP_BYTES = 32 << 20
#: Candidates and anchors of one product.
TILE, ANCHORS_AT_ONCE = 4096, 256
#: Scores that are worth a task of their own, and most tasks for each core.
SCORES, TASKS = 1 << 25, 3
SCALE = 256

_BIGGEST = np.finfo(np.float64).max


def quantised(vectors: np.ndarray) -> np.ndarray:
    """floor(SCALE * x), x as double; whole numbers in floating point."""
    with np.errstate(over="ignore"):
        return np.floor(np.clip(SCALE * vectors.astype(np.float64), -_BIGGEST, _BIGGEST))


def products(anchors: np.ndarray, tile: np.ndarray) -> np.ndarray:
    """Integer inner products, anchors by tile."""
    limit = float(np.abs(anchors).max(initial=0)) * float(np.abs(tile).max(initial=0)) * tile.shape[1]
    if limit < 2**53:
        return (anchors @ tile.T).astype(np.int64)
    big = np.vectorize(int, otypes=[object])
    return np.clip(big(anchors) @ big(tile).T, _NONE + 1, 2**63 - 1).astype(np.int64)


def limits(score: int, low: int, high: int) -> tuple[int, int]:
    """The least and the greatest whole number that lie between ``low`` and ``high``
    percent of a score; the first is the larger one if there is none."""
    return -(-low * score // 100), high * score // 100


def best_of(scores: np.ndarray, ids: np.ndarray, fit: np.ndarray, k: int) -> np.ndarray:
    """Places of the best ``k`` fitting rows of a tile sorted by id, best first."""
    where = np.flatnonzero(fit)
    return where[np.lexsort((ids[where], -1 - scores[where]))[:k]]


def between(scores: np.ndarray, ids: np.ndarray, fit: np.ndarray, edges: list[tuple[int, int]], k: int) -> list[np.ndarray]:
    """For each pair of limits, places of the best ``k`` fitting rows within them."""
    where = np.flatnonzero(fit)
    order = where[np.lexsort((ids[where], -1 - scores[where]))]
    falling = -1 - scores[order]  # ascends, and never overflows
    out = []
    for least, most in edges:
        if most < least or not len(order):
            out.append(order[:0])
            continue
        first = np.searchsorted(falling, -1 - min(most, 2**63 - 1), "left")
        last = np.searchsorted(falling, -1 - max(least, -(2**63)), "right")
        out.append(order[first : min(last, first + k)])
    return out


class Anchors:
    """Anchors by vector length: places, ids, labels and quantised vectors."""

    def __init__(self, rows: list[tuple[int, int, list[float]]]):
        self.ids, self.labels = (np.array([r[i] for r in rows], np.int64) for i in (0, 1))
        length = np.array([len(r[2]) for r in rows], np.int64)
        self.by_length = {int(n): (own := np.flatnonzero(length == n), quantised(np.array([rows[i][2] for i in own]).reshape(len(own), n))) for n in np.unique(length)}


def _tiles(batches: Iterable[pa.RecordBatch], lengths: Iterable[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(length, ids, labels, quantised vectors) of at most ``TILE`` rows, by id."""
    for batch in batches:
        for at in range(0, batch.num_rows, TILE):
            part = batch.slice(at, TILE)
            ids, labels = (part.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            column = part.column(2)
            size = np.diff(column.offsets.to_numpy())
            flat = column.flatten().to_numpy(zero_copy_only=False)
            starts = np.cumsum(size) - size
            for n in lengths:
                same = np.flatnonzero(size == n)
                if len(same):
                    same = same[np.argsort(ids[same], kind="stable")]
                    yield n, ids[same], labels[same], quantised(flat[starts[same][:, None] + np.arange(n)])


def _kept(found: list[tuple[np.ndarray, ...]], k: int) -> list[tuple[np.ndarray, ...]]:
    """The best ``k`` of each slot out of lists of (slot, score, id)."""
    if not found:
        return []
    slot, score, name = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((name, -1 - score, slot))
    slot, score, name = slot[order], score[order], name[order]
    first = np.flatnonzero(np.append(True, slot[1:] != slot[:-1])) if len(slot) else np.zeros(0, np.int64)
    place = np.arange(len(slot)) - np.repeat(first, np.diff(np.append(first, len(slot))))
    return [(slot[place < k], score[place < k], name[place < k])]


#: Rows of lists that a task gathers before it cuts them to the best again.
_GATHERED = 1 << 20
_LISTS = "slot long, vec_id long, score long, shard int"


def _scan(rows: DataFrame, shared: Broadcast, slots: Broadcast | None, positives: int, k: int) -> DataFrame:
    """Lists of a task: of each anchor's best of its label (slot: the anchor's place in
    the group), or, given the limits by anchor, of each positive's negatives (slot: the
    anchor's place * ``positives`` + the positive's)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = once(shared, Anchors)
        edges = None if slots is None else slots.value
        found, held = [], 0
        for n, ids, labels, tile in _tiles(batches, anchors.by_length):
            own, vectors = anchors.by_length[n]
            for at in range(0, len(own), ANCHORS_AT_ONCE):
                scores = products(vectors[at : at + ANCHORS_AT_ONCE], tile)
                for anchor, score in zip(own[at : at + ANCHORS_AT_ONCE].tolist(), scores, strict=True):
                    other, same = ids != anchors.ids[anchor], labels == anchors.labels[anchor]
                    if edges is None:
                        lists = [(anchor, best_of(score, ids, other & same, positives))]
                    else:
                        of = between(score, ids, other & ~same, edges.get(anchor, []), k)
                        lists = [(anchor * positives + place, picked) for place, picked in enumerate(of)]
                    for slot, picked in lists:
                        if len(picked):
                            found.append((np.full(len(picked), slot), score[picked], ids[picked]))
                            held += len(picked)
            if held > _GATHERED:
                found = _kept(found, positives if edges is None else k)
                held = len(found[0][0]) // 2
        for slot, score, name in _kept(found, positives if edges is None else k):
            shard = np.full(len(slot), TaskContext.get().partitionId(), np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(name), pa.array(score), pa.array(shard)], ["slot", "vec_id", "score", "shard"])

    return rows.mapInArrow(run, _LISTS)


def _usable(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vec_col).cast("array<double>").alias("v"))
    fit = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size("v") > 0) & fit)


def _dealt(rows: DataFrame, anchors: int) -> DataFrame:
    """Few files may mean much work, so rows are dealt to as many tasks as it is worth."""
    wanted = min(-(-rows.count() * anchors // SCORES), TASKS * rows.sparkSession.sparkContext.defaultParallelism)
    return rows.repartition(wanted) if wanted > rows.rdd.getNumPartitions() else rows


def mine(vectors: DataFrame, asked: Column, positives: int = 5, k: int = 3, low: int = 50, high: int = 95, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """For the rows that ``asked`` (on the column ``id``) picks as anchors and each one's
    ``positives`` best rows of its label: the best ``k`` rows of other labels whose score
    is ``low`` to ``high`` percent of the positive's. anchor_id, positive_rank,
    positive_id, rank, negative_id, positive_score, negative_score."""
    rows = _usable(vectors, id_col, vec_col, label_col)
    chosen = rows.where(asked).groupBy("id").agg(F.min(F.struct("v", "label")).alias("row")).select("id", "row.label", "row.v")
    told = chosen.agg(F.count("*").alias("n"), F.sum(8 * F.size("v") + 32).alias("size")).first()
    groups = -(-(told.size or 0) // GROUP_BYTES) or 1
    rows = _dealt(rows, told.n)
    if groups > 1:  # each group is then read from its own folder
        chosen = written(chosen.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(groups))), "anchors", by="part")
    out = None
    for part in range(groups):
        own = (chosen.where(F.col("part") == part) if groups > 1 else chosen).select("id", "label", "v").collect()  # about GROUP_BYTES
        found = _group(rows, [tuple(r) for r in own], positives, k, low, high)
        found = written(found, "negatives") if groups > 1 else found
        out = found if out is None else out.union(found)
    return out


def _group(rows: DataFrame, own: list[tuple], positives: int, k: int, low: int, high: int) -> DataFrame:
    spark = rows.sparkSession
    shared, shards = spark.sparkContext.broadcast(own), rows.rdd.getNumPartitions()
    best = written(_merged(_scan(rows, shared, None, positives, k).withColumnRenamed("slot", "query_id"), shards, positives), "positives")
    edges: dict[int, list] = {}
    for r in best.orderBy("query_id", "rank").collect():  # a few numbers for each of the group's anchors
        edges.setdefault(r.query_id, []).append(limits(r.score, low, high))
    lists = _scan(rows, shared, spark.sparkContext.broadcast(edges), positives, k)
    while shards > FAN:
        shards = -(-shards // FAN)
        lists = _ranked(lists.withColumn("shard", F.floor(F.col("shard") / FAN).cast("int")), ["slot", "shard"], k).drop("rank")
    negatives = _ranked(lists, ["slot"], k)
    names = spark.createDataFrame([(place, row[0]) for place, row in enumerate(own)], "query_id long, anchor_id long")
    known = best.join(F.broadcast(names), "query_id").select(  # no more rows than the group's anchors have positives
        (F.col("query_id") * positives + F.col("rank") - 1).alias("slot"), "anchor_id",
        F.col("rank").alias("positive_rank"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"),
    )
    return negatives.withColumnRenamed("score", "negative_score").join(known, "slot").select(
        "anchor_id", "positive_rank", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", "negative_score"
    )
