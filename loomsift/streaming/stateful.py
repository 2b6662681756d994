"""First row of each key over a growing folder, with the keys in a state store.

A streaming aggregation holds, for each key, its first row and when it was first and
last seen; a batch emits the keys whose first time is its own. So a batch costs its own
rows and the lookups of their keys, never a scan of all keys, and rows of a hot key are
combined before they are shuffled. State lies in RocksDB and is kept in the checkpoint;
a batch that is run again finds the state as it was before, has the same time, and
writes its folder over.

The time of a batch is the one Spark logs for it before it runs. It only has to differ
between batches, which take longer than the millisecond that it is told in.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

Snapshot = dict[str, Any]


class Progress(StreamingQueryListener):
    """Hears of each trigger of one stream: its number, and the rows that passed each
    named observation. ``tell`` is called while the stream runs, once a trigger."""

    def __init__(self, tell: Callable[[Snapshot], None], names: Sequence[str]):
        self.tell, self.names, self.run, self.failed = tell, names, None, None
        self.early: list = []
        self.over = threading.Event()

    def watch(self, run: str) -> None:
        """The stream to hear of; what came before its name was known is told now."""
        self.run = run
        early, self.early = self.early, []
        for event in early:
            self.onQueryProgress(event)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if self.run is None:
            self.early.append(event)
        elif str(progress.runId) == self.run and progress.observedMetrics:
            counts = {name: progress.observedMetrics[name]["rows"] for name in self.names if name in progress.observedMetrics}
            if any(counts.values()):
                self.tell({"batch": progress.batchId, **counts})

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if self.run is None or str(event.runId) == self.run:
            self.over.set()


@contextmanager
def told(spark: SparkSession, tell: Callable[[Snapshot], None] | None, names: Sequence[str]) -> Iterator[Progress | None]:
    """A listener for the time of one stream; it ends when all has been heard."""
    if tell is None:
        yield None
        return
    listener = Progress(tell, names)
    spark.streams.addListener(listener)
    try:
        yield listener
        listener.over.wait(60)
    finally:
        spark.streams.removeListener(listener)


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def first_of_keys(rows: DataFrame, key: Column, order: Sequence[Column]) -> DataFrame:
    """The rows of a stream whose key no earlier batch has had, the first by ``order`` of
    each. A null key is one key."""
    sorting = F.struct(F.col("_now"), *(o.alias(f"o{i}") for i, o in enumerate(order))).alias("_order")
    keyed = rows.withColumn("_now", F.current_timestamp()).select(key.alias("_key"), "_now", F.struct(*map(F.col, rows.columns)).alias("_row"), sorting)
    held = keyed.groupBy("_key").agg(F.min("_now").alias("_first"), F.max("_now").alias("_last"), F.min_by("_row", "_order").alias("_row"))
    return held.where("_first = _last").select("_row.*")


def run_stateful(
    spark: SparkSession, source: str, schema: T.StructType, output: str, checkpoint: str, key: Column, order: Sequence[Column],
    keep: Callable[[DataFrame], DataFrame] = lambda df: df, file_format: str = "parquet", files: int | None = None, tell: Callable[[Snapshot], None] | None = None,
) -> None:
    """Process the files that are new in ``source``, at most ``files`` of them a trigger,
    and append each key's first row to ``output``, if ``keep`` keeps it. ``tell`` hears
    of each trigger: its number, rows read, rows with a new key, and rows kept."""
    options = {} if files is None else {"maxFilesPerTrigger": str(files)}
    counted = lambda df, name: df.observe(name, F.count(F.lit(1)).alias("rows"))
    stream = counted(spark.readStream.schema(schema).format(file_format).options(**options).load(source), "read")
    kept = counted(keep(counted(first_of_keys(stream, key, order), "new")), "kept")

    def batch(df: DataFrame, number: int) -> None:
        df.write.mode("overwrite").parquet(f"{output}/rows/batch={number}")

    with told(spark, tell, ("read", "new", "kept")) as listener, _setting(spark, _PROVIDER, ROCKSDB):
        query = kept.writeStream.outputMode("update").foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        if listener is not None:
            listener.watch(str(query.runId))
        query.awaitTermination()
