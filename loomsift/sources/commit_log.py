"""A table that several writers append to at once, with each key in it once.

Rows are written to a folder of their own and count from the moment that a numbered
entry of the log names it. An entry is made in one step that fails if its number
exists, so of two writers one comes first; the other judges its rows again, against the
entries made since, and tries the next number. Readers see whole entries only.

Entry files are small; the step is a hard link on local disks and elsewhere a rename
without overwriting, which file systems like HDFS do atomically. (Object stores without
such a rename need a locking committer of their own.)

Rows, defined: of rows with one key the first by ``order`` counts, whoever commits first
wins between writers, and a null key is one key; empty drafts make no entry.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dedup import against_ledger, first_wins
from .jsonl import exists, listed


@dataclass(frozen=True)
class Draft:
    """Rows that are written but don't count yet, judged against entries up to ``base``."""

    folder: str
    base: int
    rows: int


class CommitLog:
    """``path`` holds ``log`` (entries by number) and ``data`` (a folder for each draft)."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path, schema

    def _hadoop(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self, path: str):
        return self._hadoop(path).getFileSystem(self.spark._jsc.hadoopConfiguration())

    # Entries

    def head(self) -> int:
        """The greatest number of an entry; 0 if there is none."""
        return max((int(name[:-5]) for name in listed(self.spark, f"{self.path}/log") if name.endswith(".json")), default=0)

    def _name(self, number: int) -> str:
        return f"{self.path}/log/{number:020d}.json"

    def entries(self, after: int = 0, upto: int | None = None) -> list[dict]:
        """Entries by number: {number, folder, rows}."""
        numbers = range(after + 1, (self.head() if upto is None else upto) + 1)
        if not numbers:
            return []
        found = self.spark.read.text([self._name(n) for n in numbers], wholetext=True).collect()  # one short line an entry
        return sorted((json.loads(r[0]) for r in found), key=lambda entry: entry["number"])

    def _put(self, entry: dict) -> bool:
        """Make an entry, unless its number is taken."""
        jvm, name = self.spark._jvm, self._hadoop(self._name(entry["number"]))
        fs = self._fs(self.path)
        draft = self._hadoop(f"{self.path}/drafts/{uuid.uuid4().hex}")
        fs.mkdirs(name.getParent())
        out = fs.create(draft, False)
        out.write(bytearray(json.dumps(entry).encode()))
        out.close()
        draft, name = fs.makeQualified(draft), fs.makeQualified(name)
        try:
            if name.toUri().getScheme() == "file":
                local = lambda p: jvm.java.nio.file.Paths.get(jvm.java.net.URI.create("file://" + p.toUri().getRawPath()))
                jvm.java.nio.file.Files.createLink(local(name), local(draft))
            else:
                context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self.spark._jsc.hadoopConfiguration())
                context.rename(draft, name, self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
        except Exception:
            if fs.exists(name):
                return False
            raise
        finally:
            fs.delete(draft, False)
        return True

    # Reading

    def _data(self, entries: Sequence[dict]) -> DataFrame | None:
        folders = [e["folder"] for e in entries]
        if not folders:
            return None
        keyed = T.StructType([*self.schema, self.spark.read.parquet(folders[0]).schema["_key"]])
        return self.spark.read.schema(keyed).parquet(*folders)

    def read(self) -> DataFrame:
        """The rows of all entries, with the number of theirs in ``entry``."""
        entries = self.entries()
        rows = self._data(entries)
        if rows is None:
            return self.spark.createDataFrame([], T.StructType([*self.schema, T.StructField("entry", T.LongType())]))
        number = F.create_map(*[x for e in entries for x in (F.lit(e["folder"].rsplit("/", 1)[1]), F.lit(e["number"]).cast("long"))])
        folder = F.element_at(F.split("_metadata.file_path", "/"), -2)
        return rows.select(*self.schema.names, F.element_at(number, folder).alias("entry"))

    # Writing

    def _unknown(self, rows: DataFrame, after: int, upto: int) -> DataFrame:
        """Rows whose key no entry of a range of numbers has."""
        known = self._data(self.entries(after, upto))
        return rows if known is None else against_ledger(rows, known, "_key")

    def _written(self, rows: DataFrame, base: int) -> Draft:
        folder = f"{self.path}/data/{uuid.uuid4().hex}"
        rows.select(*self.schema.names, "_key").write.parquet(folder)
        return Draft(folder, base, self.spark.read.parquet(folder).count())

    def draft(self, rows: DataFrame, key: Column, order: Sequence[Column]) -> Draft:
        """Write the rows whose key is new."""
        base = self.head()
        first = first_wins(rows.withColumn("_key", key), [F.col("_key")], order)
        return self._written(self._unknown(first, 0, base), base)

    def commit(self, draft: Draft) -> int | None:
        """Make a draft count; its number, or None if nothing of it is new any more."""
        while draft.rows:
            number = draft.base + 1
            if self._put({"number": number, "folder": draft.folder, "rows": draft.rows}):
                return number
            head = self.head()  # others were first: judge again, against what is new since
            left = self._unknown(self.spark.read.parquet(draft.folder), draft.base, head)
            again = self._written(left, head)
            self._drop(draft)
            draft = again
        self._drop(draft)
        return None

    def _drop(self, draft: Draft) -> None:
        self._fs(self.path).delete(self._hadoop(draft.folder), True)

    def append(self, rows: DataFrame, key: Column, order: Sequence[Column]) -> int | None:
        return self.commit(self.draft(rows, key, order))

    def vacuum(self, drafts: Sequence[Draft] = ()) -> int:
        """Delete folders that neither an entry nor one of ``drafts`` names, left by writers
        that ended; how many. Not to be run while others write."""
        if not exists(self.spark, f"{self.path}/data"):
            return 0
        used = {e["folder"].rsplit("/", 1)[1] for e in self.entries()} | {d.folder.rsplit("/", 1)[1] for d in drafts}
        loose = [name for name in listed(self.spark, f"{self.path}/data") if name not in used]
        for name in loose:
            self._fs(self.path).delete(self._hadoop(f"{self.path}/data/{name}"), True)
        return len(loose)
