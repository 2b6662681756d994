"""Pieces shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Byte table that lower-cases A-Z and leaves every other byte of UTF-8 alone.
ASCII_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())


def ascii_lower(column: Column) -> Column:
    return F.translate(column, UPPER, LOWER)


def crc_fold(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``; null for a null key."""
    return F.crc32(key.cast("string")) % folds


def raw_texts(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column."""
    return column.cast(pa.binary()).to_pylist()


def small_batches(batches: Iterable[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Cut batches so that one holds few long texts."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def sized_batches(batches: Iterable[pa.RecordBatch], column: int, size: int) -> Iterator[pa.RecordBatch]:
    """Cut batches so that one holds ``size`` bytes of this column of texts, or one row."""
    for batch in batches:
        ends = np.cumsum([0, *pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)], dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            stop = max(at + 1, int(np.searchsorted(ends, ends[at] + size, "right")) - 1)
            yield batch.slice(at, stop - at)
            at = stop


def binaries(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary())


#: Rows that Spark hands to Python at once; texts may be long.
ARROW_ROWS = 1000
_ROWS_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def bounded_batches(df: DataFrame) -> DataFrame:
    """Lower the session's Arrow batches to ``ARROW_ROWS`` if they are larger."""
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(_ROWS_SETTING)) <= ARROW_ROWS:
        conf.set(_ROWS_SETTING, str(ARROW_ROWS))
    return df


def input_bytes(df: DataFrame, text_col: str) -> int:
    """The plan's own estimate (files: their size); where there is none, the texts
    are measured."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size >= 1 << 60:
        size = df.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    return size


def text_bytes(df: DataFrame, text_col: str) -> int:
    """Bytes of all texts, whatever files they lie in."""
    return df.agg(F.sum(F.octet_length(text_col))).first()[0] or 0


#: Bits of the maps that tell which rows a join may want: 8 MB of them at most.
MAP_BITS = 26
_PAGE_BITS = 15  # of one page, as ``bitmap_construct_agg`` makes them


def marked(df: DataFrame, keys: DataFrame, on: list[str], out: str) -> DataFrame:
    """``df`` with ``out``: false where no row of ``keys`` has its ``on`` columns (none
    of them null), true where one may. A bitmap of hashes is broadcast, never more than
    2 ** ``MAP_BITS`` bits of it, however many keys there are; the fuller it is, the more
    rows are true."""
    at = F.pmod(F.xxhash64(*on), F.lit(1 << MAP_BITS))
    page, place = F.shiftright(at, _PAGE_BITS).cast("int"), at.bitwiseAND(F.lit((1 << _PAGE_BITS) - 1))
    pages = keys.select(page.alias("_page"), place.alias("_place")).repartition("_page").groupBy("_page").agg(F.bitmap_construct_agg("_place").alias("_map"))
    byte = F.conv(F.hex(F.substring("_map", (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(F.getbit(byte, place.bitwiseAND(F.lit(7)).cast("int")) == 1, F.lit(False))
    return df.withColumn("_page", page).join(F.broadcast(pages), "_page", "left").withColumn(out, hit).drop("_page", "_map")


def fetched(df: DataFrame, wanted: DataFrame, on: list[str]) -> DataFrame:
    """The inner join on ``on``; rows of ``df`` that can't take part aren't shuffled."""
    return marked(df, wanted, on, "_may").where("_may").drop("_may").join(wanted, on)


def free_name(name: str, taken: Iterable[str]) -> str:
    """``name``, with marks behind it until no column has it in any case."""
    lower = {t.lower() for t in taken}
    while name.lower() in lower:
        name += "_"
    return name


def slices_for(size: int, each: int) -> int:
    """A power of two of slices of about ``each`` bytes of input, 64 at least."""
    return 1 << max(6, min(30, (size // each).bit_length()))


_U = np.uint64


def mix(h: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of SplitMix64, element by element."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> _U(27))
    h = h * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))
