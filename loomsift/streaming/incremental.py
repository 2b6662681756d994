"""Incremental runs: new files only, keys not seen before, resumable.

``availableNow`` processes what has arrived since the checkpoint and stops. First-wins
across runs needs every key ever kept, so keys live in a ledger table next to the
output; a batch joins it anti, removes its own duplicates, and appends to both. A
batch that is run again after a crash finds its number in the output and writes the
same folder over, so it leaves no duplicates.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dedup import against_ledger, first_wins
from ..session import written
from ..sources.jsonl import exists, listed, write_jsonl


def _counted(df: DataFrame, seen: Observation) -> DataFrame:
    return df.observe(seen, F.count(F.lit(1)).alias("rows"))


def run_once(spark: SparkSession, source: str, schema: T.StructType, output: str, checkpoint: str, key: Column, order: Sequence[Column], keep: Callable[[DataFrame], DataFrame] = lambda df: df, file_format: str = "parquet", snapshot: Callable[[dict[str, int]], None] | None = None) -> None:
    """Process the files that are new in ``source``. ``keep`` filters survivors after
    duplicates have gone. ``snapshot`` is told of each batch's progress: its number,
    rows read, rows with a new key, and rows kept, counted while they are written."""

    def batch(df: DataFrame, number: int) -> None:
        read, new, kept = (Observation() for _ in range(3))
        rows = _counted(df, read).withColumn("_key", key)
        earlier = _ledger(spark, output, number)
        if earlier is not None:
            rows = against_ledger(rows, earlier, "_key")
        first = written(first_wins(rows, [F.col("_key")], order), "batch")
        _counted(first.select("_key"), new).write.mode("overwrite").parquet(f"{output}/keys/batch={number}")
        _counted(keep(first.drop("_key")), kept).write.mode("overwrite").parquet(f"{output}/rows/batch={number}")
        if snapshot is not None:
            snapshot({"batch": number, **{name: seen.get["rows"] for name, seen in (("read", read), ("new", new), ("kept", kept))}})

    stream = spark.readStream.schema(schema).format(file_format).load(source)
    query = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def _ledger(spark: SparkSession, output: str, number: int) -> DataFrame | None:
    """Keys of earlier batches; those of this one don't count if it is run again."""
    if number == 0 or not exists(spark, f"{output}/keys"):
        return None
    return spark.read.option("basePath", f"{output}/keys").parquet(f"{output}/keys").where(F.col("batch") < number).select("_key")


def append_new(rows: DataFrame, output: str, key: Column, order: Sequence[Column]) -> DataFrame:
    """Append as JSONL the rows whose key was never appended; returns them.

    A batch is its lines first, its keys after; only batches that have keys count, and
    an unfinished one is written over by the next call. For one writer at a time.
    """
    spark = rows.sparkSession
    done = _numbers(spark, f"{output}/keys")
    number = max(done, default=-1) + 1
    fresh = rows.withColumn("_key", key)
    earlier = _ledger(spark, output, number)
    if earlier is not None:
        fresh = against_ledger(fresh, earlier, "_key")
    first = written(first_wins(fresh, [F.col("_key")], order), "append")
    write_jsonl(first.drop("_key"), f"{output}/rows/batch={number}")
    first.select("_key").write.mode("overwrite").parquet(f"{output}/keys/batch={number}")
    return first.drop("_key")


def appended(spark: SparkSession, output: str, schema: T.StructType | str) -> DataFrame:
    """The rows of all finished batches."""
    paths = [f"{output}/rows/batch={n}" for n in sorted(_numbers(spark, f"{output}/keys"))]
    return spark.read.schema(schema).json(paths) if paths else spark.createDataFrame([], schema)


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    """Finished batches below a folder: those whose write has been committed."""
    return [int(name.partition("=")[2]) for name in listed(spark, folder) if name.startswith("batch=") and exists(spark, f"{folder}/{name}/_SUCCESS")]


def result(spark: SparkSession, output: str) -> DataFrame:
    return spark.read.parquet(f"{output}/rows")


def resume_counts(spark: SparkSession, paths: dict[str, str]) -> dict[str, int]:
    """Non-blank lines already written for each category, by one job over all their files."""
    rows = None
    for category, path in paths.items():
        if exists(spark, path):
            own = spark.read.text(path).where(F.trim("value") != "").select(F.lit(category).alias("category"))
            rows = own if rows is None else rows.union(own)
    found = {r.category: r["n"] for r in rows.groupBy("category").agg(F.count("*").alias("n")).collect()} if rows is not None else {}
    return {category: found.get(category, 0) for category in paths}
