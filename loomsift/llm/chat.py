"""Chat formatting at token level, with a loss mask, and reading it back.

A turn becomes start mark, role, newline, content, end mark, newline. Role and
content are encoded separately and the marks are reserved ids that no text encodes
to; in the rendered text, control strings that occur inside a role or content are
escaped reversibly (a backslash after each ``<`` that backslashes and a ``|``
follow). The loss mask covers the content of the chosen roles: +1 where such a
segment begins and -1 where it ends, summed along the tokens.

Output keeps one row per turn with its token offset in the conversation, so that no
conversation, however long, must fit one row; digests stream over a conversation's
turns where they lie, with constant memory. A digest of one conversation is
sequential by nature: its turns pass through one task.

Rows, defined: null roles and texts are empty; a null conversation id is one
conversation; turns that tie are ordered by their tokens, repeated rows stay; null
turns come first; an empty table gives no rows. Only the four named columns are
read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import Encoder, int_lists, once, token_bytes
from .common import bounded_batches, small_batches

#: The marks as they show in rendered text.
START_MARK, END_MARK = "<|im_start|>", "<|im_end|>"
LOSS_ROLES = ("assistant",)

_CONTROL = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<(\\*)\\\|")


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    """A role also must not hold the newline that ends it."""
    return escape(role.replace("%", "%25").replace("\n", "%0A"))


def unescape_role(role: str) -> str:
    return unescape(role).replace("%0A", "\n").replace("%25", "%")


class Template:
    """The vocabulary with two reserved ids behind its last one."""

    def __init__(self, vocabulary: str):
        self.encoder = Encoder(vocabulary)
        self.bytes = token_bytes(vocabulary)
        self.start, self.end = len(self.bytes), len(self.bytes) + 1
        (self.newline,) = np.frombuffer(self.encoder.encode(["\n"])[0], "<u4").tolist()

    def assemble(self, roles: list[str], texts: list[str], loss_roles: tuple[str, ...]) -> tuple[list[bytes], list[np.ndarray]]:
        """Ids (little-endian u32) and loss mask of each turn."""
        coded_roles = self.encoder.encode([escape_role(r) for r in roles])
        contents = self.encoder.encode([escape(t) for t in texts])
        mark = lambda i: np.uint32(i).tobytes()
        head, tail = mark(self.start), mark(self.end) + mark(self.newline)
        turns = [head + r + mark(self.newline) + c + tail for r, c in zip(coded_roles, contents, strict=True)]
        size = np.array([len(t) // 4 for t in turns])
        first = np.cumsum(size) - size
        begin = first + 2 + np.array([len(r) // 4 for r in coded_roles])
        end = begin + np.array([len(c) // 4 for c in contents])
        lossy = np.isin(roles, loss_roles)
        change = np.zeros(size.sum() + 1, np.int64)
        np.add.at(change, begin[lossy], 1)
        np.add.at(change, end[lossy], -1)
        mask = np.cumsum(change[:-1]) > 0
        return turns, np.split(mask, np.cumsum(size)[:-1])

    def text(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes.__getitem__, ids)).decode()

    def parse(self, ids: list[int]) -> tuple[str, str]:
        """Role and content, still escaped, of one turn."""
        cut = ids.index(self.newline)
        if ids[0] != self.start or ids[-2:] != [self.end, self.newline]:
            raise ValueError("not a turn of this template")
        return self.text(ids[1:cut]), self.text(ids[cut + 1 : -2])

    def render(self, ids: list[int]) -> str:
        """The formatted text of ids that may hold the marks."""
        shown = {self.start: START_MARK.encode(), self.end: END_MARK.encode()}
        return b"".join(shown.get(i) or self.bytes[i] for i in ids).decode()


def format_turns(
    conversations: DataFrame, vocabulary: str, conv_col: str = "conv_id", turn_col: str = "turn",
    role_col: str = "role", text_col: str = "text", loss_roles: tuple[str, ...] = LOSS_ROLES,
) -> DataFrame:
    """One row per turn: conv, position (from 0), start (token offset), ids, loss."""
    shared = conversations.sparkSession.sparkContext.broadcast(vocabulary)
    rows = bounded_batches(conversations).select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    kind, order = rows.schema["conv"].dataType.simpleString(), rows.schema["turn"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template = once(shared, Template)
        for batch in small_batches(batches):
            if batch.num_rows:
                turns, masks = template.assemble(batch.column(2).to_pylist(), batch.column(3).to_pylist(), loss_roles)
                ids = int_lists(turns)
                loss = pa.ListArray.from_arrays(ids.offsets, pa.array(np.concatenate(masks)))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), ids, loss], ["conv", "turn", "ids", "loss"])

    tokens = rows.mapInArrow(run, f"conv {kind}, turn {order}, ids array<int>, loss array<boolean>")
    ordered = Window.partitionBy("conv").orderBy("turn", "ids")
    ahead = ordered.rowsBetween(Window.unboundedPreceding, -1)
    return tokens.select(
        "conv", (F.row_number().over(ordered) - 1).alias("position"),
        F.coalesce(F.sum(F.size("ids").cast("long")).over(ahead), F.lit(0).cast("long")).alias("start"), "ids", "loss",
    )


def _read(template: Template, ids: list[int], loss: list[bool]) -> tuple[str, str, str, str]:
    """Role, text, text under the mask, and formatted text of one turn."""
    role, text = template.parse(ids)
    covered = template.text([i for i, x in zip(ids, loss, strict=True) if x])
    return unescape_role(role), unescape(text), unescape(covered), template.render(ids)


def read_turns(formatted: DataFrame, vocabulary: str) -> DataFrame:
    """From ids and mask alone: conv, position, role, text, loss_text, rendered."""
    shared = formatted.sparkSession.sparkContext.broadcast(vocabulary)
    kind = formatted.schema["conv"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template = once(shared, Template)
        for batch in small_batches(batches):
            out = [_read(template, ids, loss) for ids, loss in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            texts = [pa.array(c, pa.string()) for c in zip(*out, strict=True)] if out else [pa.array([], pa.string())] * 4
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *texts], ["conv", "position", "role", "text", "loss_text", "rendered"])

    return formatted.select("conv", "position", "ids", "loss").mapInArrow(
        run, f"conv {kind}, position int, role string, text string, loss_text string, rendered string"
    )


def digests(formatted: DataFrame, vocabulary: str) -> DataFrame:
    """Per conversation, read back from ids and mask: counts and SHA-256 digests over its
    turns in order.

    The turns of ``format_turns`` lie by conversation and in order already, so they are
    grouped without another shuffle and streamed batch by batch; a group holds the states
    of two hashes, never a conversation. The hashes run through a conversation from its
    start to its end, which is why one task reads all of it. Turns out of order fail.
    """
    shared = formatted.sparkSession.sparkContext.broadcast(vocabulary)
    kind = formatted.schema["conv"].dataType.simpleString()
    names = ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template = once(shared, Template)
        conv, n, loss_chars, formatted_chars = None, 0, 0, 0
        turns, covered = hashlib.sha256(), hashlib.sha256()
        for batch in small_batches(batches):
            conv = batch.column(0).slice(0, 1) if batch.num_rows else conv
            for position, ids, loss in zip(*(batch.column(c).to_pylist() for c in (1, 2, 3)), strict=True):
                if position != n:
                    raise ValueError(f"turn {position} comes in place {n}")
                n += 1
                role, text, under, rendered = _read(template, ids, loss)
                turns.update(f"{role}\n{text}\n".encode())
                covered.update(under.encode())
                loss_chars += len(under)
                formatted_chars += len(rendered)
        if n:
            row = [pa.array([n], pa.int64()), pa.array([turns.hexdigest()]), pa.array([loss_chars], pa.int64()), pa.array([covered.hexdigest()]), pa.array([formatted_chars], pa.int64())]
            yield pa.RecordBatch.from_arrays([conv, *row], names)

    return formatted.select("conv", "position", "ids", "loss").groupBy("conv").applyInArrow(
        run, f"conv {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
