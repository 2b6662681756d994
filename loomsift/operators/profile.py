"""Counts, statistics and roll-ups of a dataset."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def count_by(df: DataFrame, key: Column, name: str, default: str = "unknown") -> DataFrame:
    """Rows by key, most first; a missing key counts as the default."""
    return df.groupBy(F.coalesce(key, F.lit(default)).alias(name)).agg(F.count("*").alias("n")).orderBy(F.desc("n"), name)


def as_map(counts: DataFrame, key: str, n: str = "n") -> DataFrame:
    """One row: the counts as a map. For keys few enough to fit a row."""
    return counts.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(key, n)))).alias("counts"))


def length_stats(df: DataFrame, text: Column) -> DataFrame:
    size = F.length(text).cast("long")
    return df.agg(F.avg(size).alias("avg_len"), F.min(size).alias("min_len"), F.max(size).alias("max_len"))


def tier_pivot(df: DataFrame, group: str, tier: Column, tiers: Sequence[str]) -> DataFrame:
    """Per group the rows of each tier and all; a row of totals under ``all``."""
    counts = [F.count_if(tier == t).alias(f"n_{t}") for t in tiers]
    return df.rollup(group).agg(*counts, F.count("*").alias("n_all")).select(F.coalesce(group, F.lit("all")).alias(group), *[f"n_{t}" for t in tiers], "n_all")


def progress(df: DataFrame, elapsed_s: Column) -> DataFrame:
    """Roll-up of per-category (written, target, gen_pass, rewritten) rows."""
    total = df.agg(*[F.sum(c).cast("long").alias(f"total_{c}") for c in ("written", "target", "gen_pass", "rewritten")], F.max(elapsed_s).alias("elapsed_s"))
    rate = F.col("total_written") / F.greatest(F.col("elapsed_s") / 60, F.lit(0.1))
    left = F.col("total_target") - F.col("total_written")
    return total.select(
        "total_written", "total_target", "total_gen_pass", "total_rewritten",
        F.round(F.col("total_rewritten") / F.greatest(F.col("total_gen_pass") + F.col("total_rewritten"), F.lit(1)) * 100, 1).alias("rewrite_rate"),
        F.round(rate, 1).alias("rate_per_min"),
        F.round(F.col("elapsed_s") / 60, 1).alias("elapsed_min"),
        F.round(left / F.greatest(rate, F.lit(1.0)) / 60, 1).alias("eta_hours"),
    )


def file_digest(df: DataFrame, rank: str, line: Column, by: Sequence[str] = ()) -> DataFrame:
    """Per ``by`` group: rows and the SHA-256 of the file that holds the group's lines in
    rank order, each closed by a newline, whatever their number.

    The hash runs through a file from its start to its end, so the lines of one file
    pass through one task: sorted by Spark, which spills, and streamed, never held.
    ``tree_digest`` is for sets too large for that.
    """
    rows = df.select(*by, F.col(rank).alias("_at"), F.encode(F.concat(line, F.lit("\n")), "utf-8").alias("_line"))
    dealt = rows.repartition(*by) if by else rows.repartition(1)
    schema = T.StructType([*(rows.schema[c] for c in by), T.StructField("n", T.LongType()), T.StructField("sha256", T.StringType())])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def closed() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([dict(zip(names, (*group, n, seen.hexdigest()), strict=True))], schema=to_arrow_schema(schema))

        group, n, seen = None, 0, hashlib.sha256()
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in by), strict=True)) if by else [()] * batch.num_rows
            for key, text in zip(keys, batch.column("_line").to_pylist(), strict=True):
                if key != group:
                    if n:
                        yield closed()
                    group, n, seen = key, 0, hashlib.sha256()
                n += 1
                seen.update(text)
        if n:
            yield closed()

    return dealt.sortWithinPartitions(*by, "_at").mapInArrow(run, schema)


#: Rows of one block of a tree digest.
BLOCK = 4096


def tree_digest(df: DataFrame, rank: str, line: Column, by: Sequence[str] = (), block: int = BLOCK) -> DataFrame:
    """Per ``by`` group: rows and ``tree_sha256``, for sets of any size, with no task that
    sees more than ``block`` lines: lines are hashed block by block in rank order, the
    block hashes again, level by level, until one is left. Ranks start at 1 without
    gaps. This is never the hash of a file, not even of a single block's."""
    rows = df.select(*by, (F.col(rank) - 1).alias("_at"), F.concat(line, F.lit("\n")).alias("_line"), F.lit(1).cast("long").alias("_n"))
    size, level = df.agg(F.max(rank)).first()[0] or 0, 0
    while True:
        size, level = -(-size // block), level + 1
        gathered = rows.groupBy(*by, F.floor(F.col("_at") / block).alias("_block")).agg(
            F.sum("_n").alias("_n"), F.array_sort(F.collect_list(F.struct("_at", "_line"))).alias("_lines")
        )
        text = F.concat(F.lit(f"level {level}\n"), F.array_join(F.transform("_lines", lambda s: s["_line"]), ""))
        rows = gathered.select(*by, F.col("_block").alias("_at"), "_n", F.sha2(text, 256).alias("_line"))
        if size <= 1:
            return rows.select(*by, F.col("_n").alias("n"), F.col("_line").alias("tree_sha256"))


def manifest(valid: DataFrame, line: Column, name: str, rejected: Column, all_pairs: DataFrame, paths: Mapping[str, str] | None = None, digests: DataFrame | None = None) -> DataFrame:
    """One row: name, pair_count, count and file digest of either split, rejected, and
    the splits' paths if they are given. ``valid`` has split and, within it, ``place``.
    ``digests`` (split, n, sha256) are those of files that have been written."""
    digests = file_digest(valid, "place", line, ["split"]) if digests is None else digests
    of = lambda split, what: F.max(F.when(F.col("split") == split, F.col(what)))
    sides = digests.agg(*[of(s, c).alias(f"{s}_{c}") for s in ("train", "eval") for c in ("n", "sha256")])
    empty = F.sha2(F.lit(""), 256)
    counts = all_pairs.agg(F.count_if(rejected).alias("rejected"), F.count_if(~rejected).alias("pair_count"))
    return sides.crossJoin(counts).select(  # one row by one row
        F.lit(name).alias("name"), "pair_count",
        *[F.coalesce(f"{s}_n", F.lit(0)).alias(f"{s}_count") for s in ("train", "eval")],
        *[F.coalesce(f"{s}_sha256", empty).alias(f"{s}_sha256") for s in ("train", "eval")],
        *[F.lit(paths[s]).alias(f"{s}_path") for s in ("train", "eval") if paths],
        "rejected",
    )
