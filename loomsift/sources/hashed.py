"""Files of lines that are hashed while they are written.

A Python data source: each task appends the lines of its rows to the files they name and
takes the SHA-256 of the bytes as they go out. A file is written by one task, one after
another, since a SHA-256 runs from a file's start to its end. Tasks return what they
wrote; only then does ``commit`` move the files of the tasks that count to their names
and write the manifest, and drafts of failed or repeated tasks go. A job that fails
leaves no file: at most a draft of a task that was killed late, in a folder that readers
don't see and the next write deletes.

Paths are URIs that ``pyarrow.fs`` knows; on a cluster they must be shared.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator
from dataclasses import asdict, dataclass
from urllib.parse import quote

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

MANIFEST = "_manifest.json"
#: Where null names its file, as partition folders have it.
NO_NAME = "__HIVE_DEFAULT_PARTITION__"


@dataclass
class Written:
    """One file: its name, its place among the files of its job, and what is in it."""

    file: str
    name: str | None
    rows: int
    bytes: int
    sha256: str


@dataclass
class Done(WriterCommitMessage):
    files: list[dict]


def file_system(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    found, inner = pyarrow.fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))
    return found, inner.rstrip("/")


class HashedLines(DataSource):
    """``df.write.format("hashed_lines").option("path", ...)`` for rows of (file, line), the
    rows of a file together and in order in one partition."""

    @classmethod
    def name(cls) -> str:
        return "hashed_lines"

    def schema(self) -> str:
        return "file string, line string"

    def writer(self, schema: StructType, overwrite: bool) -> HashedWriter:
        if [f.dataType.simpleString() for f in schema] != ["string", "string"]:
            raise ValueError("hashed_lines takes two string columns, file and line")
        return HashedWriter(self.options["path"], self.options.get("suffix", ".jsonl"), overwrite)


class HashedWriter(DataSourceArrowWriter):
    def __init__(self, path: str, suffix: str, overwrite: bool):
        self.path, self.suffix, self.overwrite, self.job = path, suffix, overwrite, uuid.uuid4().hex

    def _draft(self) -> str:
        return f"_drafts-{self.job}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Done:
        files, folder = file_system(self.path)
        files.create_dir(f"{folder}/{self._draft()}")
        done: list[dict] = []
        out = name = seen = None
        rows = size = 0

        def closed() -> None:
            out.close()
            done.append(asdict(Written(out_name, name, rows, size, seen.hexdigest())))

        try:
            for batch in iterator:
                names, lines = batch.column(0), pc.fill_null(batch.column(1), "")
                texts = pc.binary_join_element_wise(lines, pa.scalar("\n", lines.type), pa.scalar("", lines.type))
                for start, end, key in _runs(names):
                    if out is None or key != name:
                        if out is not None:
                            closed()
                        name, rows, size, seen = key, 0, 0, hashlib.sha256()
                        out_name = f"{self._draft()}/{uuid.uuid4().hex}"
                        out = files.open_output_stream(f"{folder}/{out_name}")
                    content = "".join(texts.slice(start, end - start).to_pylist()).encode()
                    out.write(content)
                    seen.update(content)
                    rows, size = rows + end - start, size + len(content)
            if out is not None:
                closed()
        except BaseException:
            if out is not None and not out.closed:
                out.close()
            raise
        return Done(done)

    def commit(self, messages: list[Done | None]) -> None:
        files, folder = file_system(self.path)
        if self.overwrite:
            for old in files.get_file_info(pyarrow.fs.FileSelector(folder)):
                if old.base_name != self._draft():
                    (files.delete_dir if old.type == pyarrow.fs.FileType.Directory else files.delete_file)(old.path)
        found, taken = [], set()
        for told in (f for m in messages if m is not None for f in m.files):
            name = NO_NAME if told["name"] is None else quote(told["name"], safe=" ")
            if name in taken:
                raise ValueError(f"the lines of {told['name']!r} came in more than one run")
            taken.add(name)
            files.move(f"{folder}/{told['file']}", f"{folder}/{name}{self.suffix}")
            found.append(told | {"file": f"{name}{self.suffix}"})
        with files.open_output_stream(f"{folder}/{self._draft()}/manifest") as out:
            out.write(json.dumps({"files": sorted(found, key=lambda f: f["file"])}, indent=2).encode())
        files.move(f"{folder}/{self._draft()}/manifest", f"{folder}/{MANIFEST}")
        files.delete_dir(f"{folder}/{self._draft()}")

    def abort(self, messages: list[Done | None]) -> None:
        files, folder = file_system(self.path)
        if files.get_file_info(f"{folder}/{self._draft()}").type == pyarrow.fs.FileType.Directory:
            files.delete_dir(f"{folder}/{self._draft()}")


def _runs(names: pa.Array) -> Iterator[tuple[int, int, str | None]]:
    """(from, to, name) for each run of equal names."""
    values = names.to_pylist()
    start = 0
    for at in range(1, len(values) + 1):
        if at == len(values) or values[at] != values[start]:
            yield start, at, values[start]
            start = at


def write_by(df: DataFrame, path: str, name: Column, line: Column, order: list[Column | str]) -> DataFrame:
    """A file of lines for each ``name``, in ``order``, and their manifest: file, name,
    rows, bytes, sha256. One shuffle and one sort; each line is hashed as it is written.
    Null lines are empty lines, and null names have a file of their own."""
    spark = df.sparkSession
    rows = df.select(name.cast("string").alias("_file"), line.alias("_line"), *[(F.col(o) if isinstance(o, str) else o).alias(f"_o{i}") for i, o in enumerate(order)])
    dealt = rows.repartition("_file").sortWithinPartitions("_file", *[f"_o{i}" for i in range(len(order))])
    save(dealt.select(F.col("_file").alias("file"), F.col("_line").alias("line")), path)
    return manifest(spark, path)


def save(lines: DataFrame, path: str) -> None:
    """Write (file, line) rows as they lie."""
    lines.sparkSession.dataSource.register(HashedLines)
    lines.write.format("hashed_lines").option("path", path).mode("overwrite").save()


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """The files of a folder, as its manifest has them: a row for each."""
    files, folder = file_system(path)
    with files.open_input_stream(f"{folder}/{MANIFEST}") as told:
        found = json.load(told)["files"]  # a short entry a file
    return spark.createDataFrame([tuple(f[c] for c in ("file", "name", "rows", "bytes", "sha256")) for f in found], "file string, name string, rows long, bytes long, sha256 string")
