"""Token ids in binary files, coded by a static range asymmetric numeral system.

Documents are dealt by ranges of their id and ordered within; a partition's token
stream is cut, at document ends, into chunks of about ``CHUNK`` ids. One table of
symbol frequencies, counted over all ids, is shared by all chunks. A chunk is a
list of independent blocks of ``BLOCK`` ids; a block interleaves ``LANES`` coder
states over one stream of 32-bit words.

The format, little-endian. Table: ``RNT1``, scale bits, symbol count, then the
frequencies (u32), and a CRC-32 of all before. Chunk: ``RNC1``, ids, blocks, then
per block a checkpoint (first word u64, ids u32, CRC-32 of the block's content
u32), then per block its lane states (u64) and words (u32). A reader may decode any
block from its checkpoint alone, checks it before it decodes, and refuses damaged
data. Files are Parquet containers of chunks, so that Spark's committers make them
whole or absent; ``chunks`` also lists each document's id and length.

Ids are those of the library's ``encode`` without its post-processor: an added token
of the vocabulary file that a text holds is that token, not ordinary text.

A folder of ``chunks`` holds one range; its name ascends with the ids, so a reader who
takes the files by name meets the documents in order. Rows that share an id may fill
several ranges.

Rows, defined: a null or empty text has only the end id; repeated rows and ids are
written one by one, equal ids in the order of their texts' hashes; null ids come first;
empty tables give no rows. Only the id and text columns are read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import work_path, written
from .bpe import ColumnEncoder, once, token_bytes
from .common import binaries, bounded_batches, input_bytes, sized_batches, small_batches

CHUNK, BLOCK, LANES = 1 << 20, 1 << 14, 64
#: Input bytes of a range of ids, which one task encodes and one base stands for.
RANGE_BYTES = 64 << 20
#: Bytes of text that are encoded at a time.
TEXTS = 8 << 20
#: Frequencies sum to 2 ** SCALE.
SCALE = 20
_U = np.uint64
_LOW = _U(1 << 31)  #: states lie in [2 ** 31, 2 ** 63)


class Damaged(ValueError):
    """A checksum or a magic number doesn't fit."""


def scaled(counts: np.ndarray) -> np.ndarray:
    """Frequencies in proportion to the counts that sum to 2 ** SCALE, 1 or more
    for each symbol that occurs."""
    total = 1 << SCALE
    if not counts.sum():
        return np.zeros(len(counts), np.uint32)
    share = np.maximum(counts * (total / counts.sum()), 1) * (counts > 0)
    out = np.maximum(np.floor(share), counts > 0).astype(np.int64)
    while (gap := total - int(out.sum())) != 0:  # settle the rounding on the largest
        order = np.argsort(-out, kind="stable")
        if gap > 0:
            out[order[0]] += gap
        else:
            room = out[order] - 1
            cut = np.minimum(room, np.maximum(1, (-gap * out[order] / out.sum()).astype(np.int64)))
            cut = np.minimum(cut, np.maximum(0, -gap - (np.cumsum(cut) - cut)))
            out[order] -= cut
    return out.astype(np.uint32)


def pack_table(frequencies: np.ndarray) -> bytes:
    body = struct.pack("<4sII", b"RNT1", SCALE, len(frequencies)) + frequencies.astype("<u4").tobytes()
    return body + struct.pack("<I", zlib.crc32(body))


def _live(blocks: int, lanes: int) -> list[tuple[slice, slice]]:
    """The blocks and lanes that have an id at a step, where the last block has
    ``lanes`` more."""
    if lanes >= LANES:
        return [(slice(blocks), slice(LANES))]
    return [(slice(first, last), slice(n)) for first, last, n in ((0, blocks - 1, LANES), (blocks - 1, blocks, lanes)) if first < last and n > 0]


class Coder:
    """Encodes and decodes chunks by a packed table."""

    def __init__(self, table: bytes):
        if table[:4] != b"RNT1" or zlib.crc32(table[:-4]) != struct.unpack("<I", table[-4:])[0]:
            raise Damaged("frequency table")
        scale, n = struct.unpack("<II", table[4:12])
        self.scale = _U(scale)
        self.frequency = np.frombuffer(table[12:-4], "<u4").astype(np.uint64)
        self.first = np.concatenate([[0], np.cumsum(self.frequency)[:-1]]).astype(np.uint64) if n else self.frequency
        self.both = (self.frequency << _U(32)) | self.first
        self.symbol = np.repeat(np.arange(n, dtype=np.uint32), self.frequency.astype(np.int64))

    def encode(self, ids: np.ndarray) -> bytes:
        if not self.frequency[ids].all():
            raise ValueError("a symbol that the table doesn't have")
        blocks = -(-len(ids) // BLOCK)
        steps = BLOCK // LANES
        padded = np.zeros(blocks * BLOCK, ids.dtype)
        padded[: len(ids)] = ids
        padded = padded.reshape(blocks, steps, LANES)
        state = np.full((blocks, LANES), _LOW)
        spilled = np.zeros((blocks, steps, LANES), bool)
        words = np.zeros((blocks, steps, LANES), np.uint32)
        for t in range(steps - 1, -1, -1):  # a decoder goes the other way
            for part in _live(blocks, len(ids) - (blocks - 1) * BLOCK - t * LANES):
                own, both = state[part], self.both[padded[part[0], t, part[1]]]
                f, start = both >> _U(32), both & _U(0xFFFFFFFF)
                over = own >= (f << _U(63 - int(self.scale)))
                spilled[part[0], t, part[1]], words[part[0], t, part[1]] = over, own
                own = np.where(over, own >> _U(32), own)
                state[part] = own + own // f * (_U(1 << int(self.scale)) - f) + start
        index, contents, at = [], [], 0
        for b in range(blocks):
            stream = words[b][spilled[b]]
            content = state[b].astype("<u8").tobytes() + stream.astype("<u4").tobytes()
            index.append(struct.pack("<QII", at, min(BLOCK, len(ids) - b * BLOCK), zlib.crc32(content)))
            contents.append(content)
            at += len(stream)
        return b"".join([struct.pack("<4sII", b"RNC1", len(ids), blocks), *index, *contents])

    def decode(self, chunk: bytes, only: slice = slice(None)) -> np.ndarray:
        """The ids of a chunk, or of some of its blocks."""
        magic, total, blocks = struct.unpack_from("<4sII", chunk)
        if magic != b"RNC1" or len(chunk) < 12 + 16 * blocks:
            raise Damaged("chunk header")
        index = np.frombuffer(chunk, [("at", "<u8"), ("ids", "<u4"), ("crc", "<u4")], blocks, 12)
        base = 12 + 16 * blocks
        starts = base + np.arange(blocks) * LANES * 8 + index["at"].astype(np.int64) * 4
        ends = np.append(starts[1:], len(chunk))
        chosen = range(blocks)[only]
        states, streams = [], []
        for b in chosen:
            content = chunk[starts[b] : ends[b]]
            if zlib.crc32(content) != index["crc"][b]:
                raise Damaged(f"block {b}")
            states.append(np.frombuffer(content, "<u8", LANES))
            streams.append(np.frombuffer(content, "<u4", offset=LANES * 8))
        if not states:
            return np.zeros(0, np.uint32)
        state = np.stack(states).astype(np.uint64)
        stream = np.concatenate([*streams, np.zeros(1, "<u4")]).astype(np.uint64)
        read = np.concatenate([[0], np.cumsum([len(s) for s in streams])[:-1]]).astype(np.int64)[:, None]
        ids = index["ids"][list(chosen)].astype(np.int64)
        if (ids[:-1] != BLOCK).any():
            raise Damaged("block sizes")
        steps = BLOCK // LANES
        out = np.zeros((len(ids), steps, LANES), np.uint32)
        mask = _U((1 << int(self.scale)) - 1)
        for t in range(-(-int(ids.max()) // LANES)):
            for part in _live(len(ids), int(ids[-1]) - t * LANES):
                own = state[part]
                slot = own & mask
                symbol = self.symbol[slot.astype(np.int64)]
                out[part[0], t, part[1]] = symbol
                both = self.both[symbol]
                moved = (both >> _U(32)) * (own >> self.scale) + slot - (both & _U(0xFFFFFFFF))
                short = moved < _LOW
                taken = np.cumsum(short, axis=1)
                refilled = (moved << _U(32)) | stream[read[part[0]] + taken - 1]
                state[part] = np.where(short, refilled, moved)
                read[part[0]] += taken[:, -1:]
        flat = out.reshape(len(ids), -1)
        return np.concatenate([flat[i, :n] for i, n in enumerate(ids.tolist())])


_CHUNKS = "shard int, chunk int, first long, total long, ids array<long>, lengths array<long>, payload binary"
#: Before the coder; a range's last chunk has the counts of all its ids.
_PLAIN = f"{_CHUNKS}, tally binary"


def added(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """The sum of two counts, of which one may know fewer symbols."""
    out = np.zeros(max(len(one), len(other)), np.int64)
    out[: len(one)] += one
    out[: len(other)] += other
    return out


def write(docs: DataFrame, vocabulary: str, path: str, end: int, id_col: str = "doc_id", text_col: str = "text", partitions: int | None = None) -> None:
    """Encode the documents' texts, each closed by ``end``, and write ``path``/table
    and ``path``/chunks."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(vocabulary)
    narrow = "<u2" if max(end, len(token_bytes(vocabulary)) - 1) < 1 << 16 else "<u4"
    rows = bounded_batches(docs).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    size = input_bytes(rows, "text")
    # Ranges of the id: few enough for full chunks, many enough to spread.
    n = partitions or max(spark.sparkContext.defaultParallelism * 4, -(-size // RANGE_BYTES))
    # An id, or none, that most rows have is split by the texts' hashes, and copies by turn.
    rows = rows.withColumns({"h": F.xxhash64("text"), "turn": F.monotonically_increasing_id()})
    order = [F.col("id").asc_nulls_first(), F.col("h"), F.col("turn")]
    dealt = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).select("id", "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard = once(shared, ColumnEncoder), TaskContext.get().partitionId()
        keys, sizes, parts, held, first, chunk = [], [], [], 0, 0, 0
        total = np.zeros(0, np.int64)

        def flush(last: bool) -> pa.RecordBatch:
            nonlocal keys, sizes, parts, held, first, chunk, total
            payload = np.concatenate(parts)
            total = added(total, np.bincount(payload))
            numbers = {"shard": pa.int32(), "chunk": pa.int32(), "first": pa.int64(), "total": pa.int64()}
            columns = [pa.array([v], t) for v, t in zip((shard, chunk, first, held), numbers.values(), strict=True)]
            for values in (pa.concat_arrays(keys), pa.array(np.concatenate(sizes), pa.int64())):
                columns.append(pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values))
            columns += [binaries([payload.tobytes()]), binaries([total.astype("<i8").tobytes() if last else None])]
            keys, sizes, parts, first, held, chunk = [], [], [], first + held, 0, chunk + 1
            return pa.RecordBatch.from_arrays(columns, [*numbers, "ids", "lengths", "payload", "tally"])

        for batch in sized_batches(batches, 1, TEXTS):
            ids, lengths = encoder.flat(batch.column(1))
            lengths = lengths + 1
            ends = np.cumsum(lengths)
            closed = np.full(ends[-1], end, narrow)
            own = np.ones(ends[-1], bool)
            own[ends - 1] = False
            closed[own] = ids
            key, at = batch.column(0), 0
            while at < len(lengths):
                if held >= CHUNK:
                    yield flush(False)
                before = int(ends[at] - lengths[at])
                stop = min(int(np.searchsorted(ends, before + CHUNK - held)) + 1, len(lengths))
                keys.append(key.slice(at, stop - at))
                sizes.append(lengths[at:stop])
                parts.append(closed[before : ends[stop - 1]])
                held, at = held + len(parts[-1]), stop
        if parts:
            yield flush(True)

    plain = written(dealt.mapInArrow(cut, _PLAIN), "tokens", compression="zstd")

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for content in batch.column(0).to_pylist():
                total = added(total, np.frombuffer(content, "<i8"))
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(total[found], pa.int64())], ["symbol", "n"])

    counted = plain.where("tally IS NOT NULL").select("tally").mapInArrow(tally, "symbol long, n long").groupBy("symbol").agg(F.sum("n").alias("n")).collect()  # one row per symbol
    counts = np.zeros(max((r.symbol for r in counted), default=-1) + 1, np.int64)
    for r in counted:
        counts[r.symbol] = r.n
    table = pack_table(scaled(counts))
    spark.createDataFrame([(bytearray(table),)], "content binary").coalesce(1).write.parquet(f"{path}/table")
    coder_of = spark.sparkContext.broadcast(table)

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = once(coder_of, Coder)
        for batch in small_batches(batches, 1):
            payload = [coder.encode(np.frombuffer(x, narrow)) for x in batch.column("payload").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], binaries(payload)], batch.schema.names)

    coded = plain.drop("tally").mapInArrow(compress, _CHUNKS).withColumn("range", F.format_string("%08d", "shard"))
    coded.sortWithinPartitions("range", "chunk").write.option("compression", "none").partitionBy("range").parquet(f"{path}/chunks")
    folder = spark._jvm.org.apache.hadoop.fs.Path(plain.inputFiles()[0]).getParent() if plain.inputFiles() else None
    if folder is not None:  # the plain ids have served
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def read(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """One row per document, from the files: id, start (ids of all documents
    before), ids (little-endian u32, binary)."""
    table = spark.read.parquet(f"{path}/table").first()["content"]
    shared = spark.sparkContext.broadcast(bytes(table))
    chunks = spark.read.schema(_CHUNKS).parquet(f"{path}/chunks").drop("range")
    # One row for each range of RANGE_BYTES: few enough for one window, and to broadcast.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = chunks.groupBy("shard").agg(F.sum("total").alias("total")).select("shard", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    placed = chunks.join(F.broadcast(bases), "shard")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = once(shared, Coder)
        for batch in small_batches(batches, 1):
            for row in batch.to_pylist():
                content = coder.decode(row["payload"]).astype("<u4").tobytes()
                lengths = np.array(row["lengths"], np.int64)
                ends = np.cumsum(lengths)
                starts = ends - lengths + row["first"] + row["base"]
                parts = [content[4 * (e - n) : 4 * e] for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(row["ids"], pa.int64()), pa.array(starts, pa.int64()), binaries(parts)], [id_col, "start", "ids"])

    return placed.mapInArrow(run, f"`{id_col}` long, start long, ids binary")


def round_trip(docs: DataFrame, vocabulary: str, end: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write to a fresh folder in the shared space and read back."""
    path = work_path(docs.sparkSession, "token-files")
    write(docs, vocabulary, path, end, id_col, text_col)
    return read(docs.sparkSession, path, id_col)
