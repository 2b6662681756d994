"""Exact top-k search by tiled matrix products.

Each task reads its shard of the candidates in tiles, multiplies a tile with the
broadcast queries, selects the best of each tile, and merges them into the
running list of every query; the lists of the tasks then merge in a tree of
``FAN`` shards at a time. Queries are broadcast in blocks of at most
``BLOCK_BYTES``, some blocks at a time; the candidates are scanned once per block. Scores are exact: tiles
whose products fit 53 bits use floating point, others Python integers (scores
beyond 64 bits are held at the ends of that range).

Rows, defined: vectors that are null or hold a null or non-finite component, and
rows without an id, take no part; a query meets vectors of its own length; ties go
to the smaller id; candidates with the query's id are its own and left out;
repeated candidate rows count each; an id repeated among the queries asks once,
with its least vector; empty tables give no rows. Only id and vector are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from .bpe import once

#: Most bytes of quantised queries that are broadcast together.
BLOCK_BYTES = 8 << 20
#: Blocks that are broadcast at a time; their lists are written before the next ones.
BLOCKS_AT_ONCE = 16
#: Candidates and queries of one product.
TILE, QUERIES_AT_ONCE = 4096, 512
#: Lists merged at one node of the tree.
FAN = 64
SCALE = 1024

_NONE = np.iinfo(np.int64).min


def quantised(vectors: np.ndarray) -> np.ndarray:
    """floor(SCALE * x), x as double; whole numbers in floating point."""
    return np.floor(SCALE * vectors.astype(np.float64))


def tile_best(queries: np.ndarray, own: np.ndarray, tile: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Scores and ids of each query's best k of a tile (``_NONE``: fewer)."""
    by_id = np.argsort(ids, kind="stable")
    tile, ids = tile[by_id], ids[by_id]
    n = len(ids)
    limit = np.abs(queries).max(initial=0) * np.abs(tile).max(initial=0) * max(1, tile.shape[1])
    if limit * n < 2**51:
        # One number holds score and place: unique, so a partial selection is exact.
        key = (queries @ tile.T) * n + (n - 1 - np.arange(n))
        key[own[:, None] == ids[None, :]] = -np.inf
        pick = np.argpartition(-key, min(k, n) - 1, axis=1)[:, :k] if n > k else np.broadcast_to(np.arange(n), key.shape)
        found = np.take_along_axis(key, pick, 1)
        absent = np.isinf(found)
        whole = np.where(absent, 0, found).astype(np.int64)
        scores = np.where(absent, _NONE, np.floor_divide(whole, n))
        return scores, ids[pick]
    big = np.vectorize(int, otypes=[object])
    products = big(queries) @ big(tile).T
    scores = np.clip(products, _NONE + 1, 2**63 - 1).astype(np.int64)
    scores[own[:, None] == ids[None, :]] = _NONE
    every = np.broadcast_to(ids, scores.shape)
    order = np.lexsort((every, ~scores), axis=1)[:, :k]
    return np.take_along_axis(scores, order, 1), np.take_along_axis(every, order, 1)


class Block:
    """Queries by vector length, and their running best."""

    def __init__(self, rows: list[tuple[int, list[float]]]):
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for length in {len(v) for _, v in rows}:
            own = [(i, v) for i, v in rows if len(v) == length]
            self.by_length[length] = np.array([i for i, _ in own], np.int64), quantised(np.array([v for _, v in own]).reshape(len(own), length))


def _usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    fit = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("id").isNotNull() & F.col("v").isNotNull() & fit)


def search(vectors: DataFrame, asked: Column, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score for the rows that ``asked`` (on the
    column ``id``) picks as queries, against all rows."""
    spark = vectors.sparkSession
    rows = _usable(vectors, id_col, vec_col)
    queries = rows.where(asked).groupBy("id").agg(F.min("v").alias("v"))
    size = queries.agg(F.sum(8 * F.size("v") + 16)).first()[0] or 0
    blocks = -(-size // BLOCK_BYTES) or 1
    shards = rows.rdd.getNumPartitions()
    if blocks > 1:  # each block is then read from its own folder
        block = F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block")
        queries = written(queries.select("id", "v", block), "queries", by="block")
    merged = None
    for first in range(0, blocks, BLOCKS_AT_ONCE):
        found, held = None, []
        for b in range(first, min(blocks, first + BLOCKS_AT_ONCE)):
            own = (queries.where(F.col("block") == b) if blocks > 1 else queries).select("id", "v").collect()  # about BLOCK_BYTES
            held.append(spark.sparkContext.broadcast([(r.id, r.v) for r in own]))
            lists = _scan(rows, held[-1], k)
            found = lists if found is None else found.union(lists)
        best = _merged(found, shards, k)
        if blocks > BLOCKS_AT_ONCE:  # these blocks are done, so their broadcasts may go
            best = written(best, "best")
            for shared in held:
                shared.destroy()
        merged = best if merged is None else merged.union(best)
    return merged


def _scan(rows: DataFrame, shared, k: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = once(shared, Block)
        best = {n: (np.full((len(own), k), _NONE), np.full((len(own), k), _NONE)) for n, (own, _) in block.by_length.items()}
        for batch in batches:
            for at in range(0, batch.num_rows, TILE):
                part = batch.slice(at, TILE)
                ids, column = part.column(0).to_numpy(zero_copy_only=False), part.column(1)
                lengths = np.diff(column.offsets.to_numpy())
                flat = column.flatten().to_numpy(zero_copy_only=False)
                starts = np.cumsum(lengths) - lengths
                for n, (own, query) in block.by_length.items():
                    same = np.flatnonzero(lengths == n)
                    if not len(same):
                        continue
                    tile = quantised(flat[starts[same][:, None] + np.arange(n)])
                    for q in range(0, len(own), QUERIES_AT_ONCE):
                        cut = slice(q, q + QUERIES_AT_ONCE)
                        scores, names = tile_best(query[cut], own[cut], tile, ids[same], k)
                        both = np.concatenate([best[n][0][cut], scores], axis=1), np.concatenate([best[n][1][cut], names], axis=1)
                        order = np.lexsort((both[1], ~both[0]), axis=1)[:, :k]
                        best[n][0][cut], best[n][1][cut] = (np.take_along_axis(x, order, 1) for x in both)
        shard = TaskContext.get().partitionId()
        for n, (own, _) in block.by_length.items():
            scores, names = best[n]
            real = scores != _NONE
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(own, real.sum(axis=1))), pa.array(names[real]), pa.array(scores[real]), pa.array(np.full(real.sum(), shard, np.int32))],
                ["query_id", "vec_id", "score", "shard"],
            )

    return rows.mapInArrow(run, "query_id long, vec_id long, score long, shard int")


def _merged(lists: DataFrame, shards: int, k: int) -> DataFrame:
    """Merge the shards' lists, FAN at a time, down to one list per query."""
    while shards > FAN:
        node = F.floor(F.col("shard") / FAN).cast("int")
        shards = -(-shards // FAN)
        lists = _ranked(lists.withColumn("shard", node), ["query_id", "shard"], k).drop("rank")
    return _ranked(lists, ["query_id"], k).select("query_id", "rank", "vec_id", "score")


def _ranked(lists: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id")
    return lists.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
