"""Sharding by size-tiered compaction with an atomic, versioned manifest (native).

Arrivals are appended as small immutable runs of Parquet files. A run's tier is the
power of ``fan`` of its bytes; once a tier holds ``fan`` runs, they are merged into
one run of files of about ``target`` bytes, and so on up the tiers, so a row is
rewritten once per tier. Runs of ``target`` bytes times ``fan`` or more are left
alone. A run is a folder that is written once and never changed, and a manifest lists
a version's runs with their bytes and rows; committing renames a finished manifest to
the next version's name, which fails if somebody else was first, so readers see
whole versions only and writers never lose each other's.

Rows move only through Spark's Parquet reader and writer; merging reads the runs of
a tier and coalesces them, without a shuffle. The driver handles runs alone, of which
there are fewer than ``fan`` in each tier, and those that have grown full.

Rows, defined: all rows are kept as they are, nulls, copies and long texts alike; an
empty arrival commits a version with no new files; a store without a version reads
as an empty table of the given schema; any columns are stored under their own names.
"""

from __future__ import annotations

import json
import math
import uuid
from collections import defaultdict
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Conflict(RuntimeError):
    """Another writer committed the version first."""


@dataclass
class ShardStore:
    spark: SparkSession
    path: str
    schema: T.StructType
    target: int = 128 << 20  #: bytes of a full file
    fan: int = 4  #: runs of a tier that are merged
    least: int = 1 << 16  #: bytes up to which a run is in tier 0
    _fs: object = field(init=False, repr=False, default=None)

    def __post_init__(self) -> None:
        self._fs = self._hadoop(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _hadoop(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    # Manifest

    def version(self) -> int:
        folder = self._hadoop(f"{self.path}/manifest")
        if not self._fs.exists(folder):
            return 0
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return max((int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json")), default=0)

    def manifest(self, version: int | None = None) -> dict:
        """{version, runs: [{run, files, bytes, rows}]}; a run is named by its folder"""
        version = self.version() if version is None else version
        if not version:
            return {"version": 0, "runs": []}
        lines = self.spark.read.text(f"{self.path}/manifest/v{version:020d}.json", wholetext=True).first()
        return json.loads(lines[0])

    def _commit(self, before: dict, runs: list[dict]) -> dict:
        after = {"version": before["version"] + 1, "runs": runs}
        draft = self._hadoop(f"{self.path}/draft/{uuid.uuid4().hex}.json")
        out = self._fs.create(draft, False)
        out.write(bytearray(json.dumps(after).encode()))
        out.close()
        name = self._hadoop(f"{self.path}/manifest/v{after['version']:020d}.json")
        self._fs.mkdirs(name.getParent())
        jvm = self.spark._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self.spark._jsc.hadoopConfiguration())
        none = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(draft, name, none)  # without OVERWRITE it fails if the name exists
        except Exception as error:
            if self._fs.exists(name):
                raise Conflict(f"version {after['version']} of {self.path}") from error
            raise
        return after

    # Writing

    def _described(self, folder: str) -> list[dict]:
        """One run per written folder that holds Parquet files."""
        path = F.col("_metadata.file_path")
        files = (
            self.spark.read.schema(self.schema).option("recursiveFileLookup", "true").parquet(folder)
            .groupBy(path.alias("path"), F.col("_metadata.file_size").alias("bytes")).agg(F.count("*").alias("rows"))
        )
        run = F.regexp_extract("path", r".*/runs/(.*)/[^/]*$", 1).alias("run")
        found = files.groupBy(run).agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))
        return [r.asDict() for r in found.orderBy("run").collect()]  # one row per run

    def _write(self, df: DataFrame, by: str | None = None) -> list[dict]:
        folder = f"{self.path}/runs/{uuid.uuid4().hex}"
        writer = df.select(*self.schema.names, *([by] if by else [])).write.option("compression", "zstd")
        (writer.partitionBy(by) if by else writer).parquet(folder)
        return self._described(folder)

    def append(self, df: DataFrame, by: str | None = None, compact: bool = True) -> dict:
        """Append an arrival as one immutable run, or, with ``by``, one for each of
        that column's values, written in one pass and committed one after another;
        after each, full tiers are merged. ``by`` itself isn't stored; it must not be
        a column of the store."""
        state = self.manifest()
        for run in self._write(df, by) or [None]:
            state = self._add(state, run)
            state = self.compact() if compact else state
        return state

    def _add(self, state: dict, run: dict | None) -> dict:
        while True:
            try:
                return self._commit(state, state["runs"] + ([run] if run else []))
            except Conflict:
                state = self.manifest()

    # Compaction

    def tier(self, size: int) -> int:
        return max(0, math.floor(math.log(max(1, size / self.least), self.fan) + 1e-9))

    def _full(self, runs: list[dict]) -> list[dict]:
        tiers = defaultdict(list)
        for run in runs:
            if run["bytes"] < self.target * self.fan:
                tiers[self.tier(run["bytes"])].append(run)
        return next((tiers[t] for t in sorted(tiers) if len(tiers[t]) >= self.fan), [])

    def compact(self) -> dict:
        """Merge full tiers, smallest first, until none is left."""
        state = self.manifest()
        while merged := self._full(state["runs"]):
            files = math.ceil(sum(r["bytes"] for r in merged) / self.target)
            new = self._write(self._scan(merged).coalesce(files))
            while True:
                gone = {r["run"] for r in merged}
                if not gone <= {r["run"] for r in state["runs"]}:
                    break  # somebody else merged these; what was written is left to vacuum
                try:
                    state = self._commit(state, [r for r in state["runs"] if r["run"] not in gone] + new)
                    break
                except Conflict:
                    state = self.manifest()
        return state

    # Reading

    def _scan(self, runs: list[dict]) -> DataFrame:
        if not runs:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*(f"{self.path}/runs/{r['run']}" for r in runs))

    def read(self, version: int | None = None) -> DataFrame:
        return self._scan(self.manifest(version)["runs"])

    def vacuum(self) -> int:
        """Delete runs that the current version doesn't list; older versions can't be
        read afterwards. For times without other writers. Returns how many folders."""
        held = {r["run"] for r in self.manifest()["runs"]}
        above = {name.partition("/")[0] for name in held if "/" in name}
        gone = []
        for name in self._folders("runs"):
            if name in above:
                gone += [f"{name}/{x}" for x in self._folders(f"runs/{name}") if f"{name}/{x}" not in held]
            elif name not in held:
                gone.append(name)
        for name in gone:
            self._fs.delete(self._hadoop(f"{self.path}/runs/{name}"), True)
        return len(gone)

    def _folders(self, name: str) -> list[str]:
        folder = self._hadoop(f"{self.path}/{name}")
        return [s.getPath().getName() for s in self._fs.listStatus(folder) if s.isDirectory()] if self._fs.exists(folder) else []
