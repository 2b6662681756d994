"""JSONL, multi-file and latest-file sources; JSONL, Markdown and JSON sinks."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import strip
from ..operators.profile import file_digest
from . import hashed


def _fs(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop = _fs(spark, path)
    return fs.exists(hadoop)


def listed(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none if it doesn't exist."""
    fs, hadoop = _fs(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(hadoop)) if fs.exists(hadoop) else []


def lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(source_ord, file, line) of all non-blank lines; missing files are skipped.
    ``source_ord`` is the place of the file in ``paths``. Text files are split at
    line ends by Spark, so a file of any size is read in parallel; arrival order
    within a file is kept by ``block`` and ``row``."""
    found = [(i, p) for i, p in enumerate(paths) if exists(spark, p)]
    out = None
    for i, path in found:
        part = spark.read.text(path).select(
            F.lit(i).alias("source_ord"), F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"), F.col("value").alias("line"),
        )
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], "source_ord int, file string, block long, row long, line string")
    return out.where(strip(F.col("line")) != "")


def in_order(spark: SparkSession, path: str) -> DataFrame:
    """(place, line) of a folder of part files, joined by name; places start at 1. Lines
    are counted by file and block, a row for each, and numbered within them."""
    read = spark.read.text(path).select(
        F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"), F.col("value").alias("line"),
    )
    sizes = read.groupBy("file", "block").agg(F.count("*").alias("n"), F.min("row").alias("first"))
    before = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)  # one row a block
    bases = sizes.select("file", "block", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return read.join(F.broadcast(bases), ["file", "block"]).select((F.col("base") + F.col("row") - F.col("first") + 1).alias("place"), "line")


def parsed(rows: DataFrame, schema: T.StructType | str, on_malformed: str = "fail") -> DataFrame:
    """Adds ``record``; a line that doesn't parse fails the job, or stays with a null
    record under ``on_malformed='quarantine'``."""
    record = F.from_json("line", schema)
    if on_malformed == "fail":
        whole = F.try_parse_json("line").isNotNull()
        stop = F.raise_error(F.concat(F.lit("malformed JSON line: "), F.col("line")))
        return rows.where(F.when(whole, F.lit(True)).otherwise(stop.cast("boolean"))).withColumn("record", record)
    return rows.withColumn("record", F.when(F.try_parse_json("line").isNotNull(), record))


def latest(spark: SparkSession, folder: str, prefix: str = "signals_", suffix: str = ".json", explicit: str | None = None) -> str | None:
    """An explicit path if it exists, else the greatest matching name, else None."""
    if explicit is not None and exists(spark, explicit):
        return explicit
    found = max((n for n in listed(spark, folder) if n.startswith(prefix) and n.endswith(suffix)), default=None)
    return f"{folder}/{found}" if found else None


def document(spark: SparkSession, path: str) -> dict | None:
    """A small JSON document (checkpoint, progress, contract), or None."""
    if not exists(spark, path):
        return None
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


ENVELOPE = (
    "date string, collected_at string, total_signals long, sources map<string,long>, signals array<struct<"
    "source:string,title:string,url:string,summary:string,published:string,authors:array<string>,categories:array<string>,score:long,comments:long>>"
)


def envelope(spark: SparkSession, path: str) -> DataFrame:
    """The items of a collected envelope, with their place in it."""
    return spark.read.schema(ENVELOPE).json(path, multiLine=True).select("date", F.posexplode("signals").alias("ordinal", "item")).select("date", "ordinal", "item.*")


# Sinks


def write_jsonl(df: DataFrame, path: str, line: Column | None = None, order: Sequence[Column | str] = (), mode: str = "overwrite") -> None:
    """One JSON object per line, not ASCII-escaped, in ``order`` across part files."""
    text = line if line is not None else F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    rows = df.orderBy(*order) if order else df
    rows.select(text.alias("value")).write.mode(mode).text(path)


def write_parts(df: DataFrame, folder: str, by: str, line: Column, order: Sequence[str]) -> dict[str, str]:
    """Lines in a folder for each value of ``by``, in ``order`` when its files are taken by
    name, in one pass; the folders by value. Values must be few."""
    rows = df.select(by, line.alias("value"), *(F.col(o).alias(f"_o{i}") for i, o in enumerate(order)))
    keys = [by, *(f"_o{i}" for i in range(len(order)))]
    rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select(by, "value").write.mode("overwrite").partitionBy(by).text(folder)
    return {unquote(name.partition("=")[2]): f"{folder}/{name}" for name in listed(df.sparkSession, folder) if name.startswith(f"{by}=")}


def write_hashed(df: DataFrame, path: str, rank: str, line: Column, files: int = 1) -> Row:
    """Lines in rank order, as ``files`` part files that make up one JSONL file when they
    are joined by name; (n, sha256, path) of that file. One file is hashed as it is
    written; what several hold is read back, since a SHA-256 can't be joined."""
    spark = df.sparkSession
    rows = df.select(F.col(rank).alias("rank"), line.alias("line")).repartitionByRange(files, "rank").sortWithinPartitions("rank")
    hashed.save(rows.select(F.format_string("part-%05d", F.spark_partition_id()).alias("file"), "line"), path)
    told = hashed.manifest(spark, path).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n"), F.count("*").alias("files"), F.first("sha256").alias("sha256")).first()
    if told.files == 1:
        return Row(n=told.n, sha256=told.sha256, path=path)
    found = file_digest(in_order(spark, path), "place", F.col("line")).first() if told.files else None
    return Row(n=told.n, sha256=found.sha256 if found else hashlib.sha256().hexdigest(), path=path)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small driver-side document, written whole or not at all: a finished draft takes
    the path over in one step, so a reader finds the old document or the new one."""
    fs, hadoop = _fs(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(path + ".draft")
    out = fs.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    jvm = spark._jvm
    options = jvm.org.apache.hadoop.fs.Options.Rename
    over = spark.sparkContext._gateway.new_array(options, 1)
    over[0] = options.OVERWRITE
    whole = fs.makeQualified(draft)
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(whole.toUri(), spark._jsc.hadoopConfiguration()).rename(whole, fs.makeQualified(hadoop), over)


def write_json(spark: SparkSession, path: str, content: dict) -> None:
    write_text(spark, path, json.dumps(content, indent=2, ensure_ascii=False))


def merge_in_order(frames: Sequence[DataFrame], path: str, order: Sequence[str]) -> None:
    """Lines of several frames, one frame after another, each in its order."""
    numbered = [f.withColumn("source_ord", F.lit(i)) for i, f in enumerate(frames)]
    out = numbered[0]
    for frame in numbered[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    out.orderBy("source_ord", *order).select("line").write.mode("overwrite").text(path)
