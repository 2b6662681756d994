"""Byte-level BPE encoding and decoding over Arrow batches.

The vocabulary comes as a rank file (base64 token, rank) or as a file of the
tokenizers library; it is read on the driver and shipped as one broadcast, whose
size is that of the vocabulary. Texts are cut where the splitting pattern always
cuts (before a space that follows a non-space), so each distinct word is
encoded once per worker and looked up afterwards, and other pieces are put together
from their parts; the result is that of encoding the whole text.

Rows, defined: a null text counts as empty and gives an empty list; repeated
rows and ties are encoded one by one; an empty table gives an empty table; other
columns pass through unchanged, and a column named like the output is replaced.
Texts may be of any length.
"""

from __future__ import annotations

import base64
import codecs
import contextlib
import ctypes
import gc
import itertools
import json
import os
import re
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import binaries, bounded_batches, raw_texts, small_batches

#: Words a worker remembers; beyond that it forgets all but short ones.
MEMORY = 300_000
SHORT_WORD = 7
#: Pieces with punctuation that are remembered besides, before all are forgotten.
COMPOUNDS = 80_000
#: Texts encoded at a time.
ROWS = 500
#: Longer words are not remembered.
LONG_WORD = 64

# Fixed value: the splitting pattern for which texts may be cut into pieces.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# End of fixed values.

#: The same, for texts of ASCII and Latin letters only, where its classes are short.
_LATIN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_ONLY_LATIN = re.compile(rf"[\x00-\x7f{_LATIN}]*").fullmatch
_PARTS = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LATIN}]+| ?[0-9]+| ?[^\s{_LATIN}0-9]+|\s+(?!\S)|\s+", re.ASCII
).findall

_UNSAFE = re.compile(r"\s ")
_CUT = re.compile(r"(?<=\S)(?= )")


def byte_characters() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: bytes that
    print stand for themselves, the others follow from U+0100 on, in order."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in prints else chr(next(spare)) for b in range(256)]


def tokenizer_from_ranks(lines: bytes, pattern: str) -> str:
    """The tokenizers library's JSON for a rank file.

    The merges of a token are all its splits into two known tokens, in order of
    the token's rank, so that any neighbours that make a known token may merge.
    """
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines.splitlines()) if a}
    shown = byte_characters()
    text = {token: "".join(shown[b] for b in token) for token in ranks}
    merges = [
        (text[token[:i]], text[token[i:]])
        for token in sorted(ranks, key=ranks.__getitem__)
        for i in range(1, len(token))
        if token[:i] in ranks and token[i:] in ranks
    ]
    made = Tokenizer(models.BPE({text[t]: r for t, r in ranks.items()}, merges, ignore_merges=True))
    made.pre_tokenizer = pre_tokenizers.Sequence(
        [pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
    )
    return made.to_str()


def load_vocabulary(path: str, pattern: str | None = None) -> str:
    """JSON of the tokenizers library, from its own file or from a rank file."""
    with open(path, "rb") as f:
        content = f.read()
    return content.decode() if path.endswith(".json") else tokenizer_from_ranks(content, pattern)


def token_bytes(vocabulary: str) -> list[bytes]:
    """The bytes of each id; reverses the byte table."""
    content = json.loads(vocabulary)
    value = {c: b for b, c in enumerate(byte_characters())}
    table: dict[int, bytes] = {i: bytes(value[c] for c in t) for t, i in content["model"]["vocab"].items()}
    for extra in content["added_tokens"]:
        table[extra["id"]] = extra["content"].encode()
    return [table.get(i, b"") for i in range(max(table, default=-1) + 1)]


class Encoder:
    """Texts to little-endian unsigned 32-bit ids, with a memory of pieces."""

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        # Added tokens are left out: their strings in a text are ordinary text.
        self.model, self.splitter = self.tokenizer.model, self.tokenizer.pre_tokenizer
        splitter = json.loads(vocabulary)["pre_tokenizer"]
        steps = splitter.get("pretokenizers", [splitter])
        #: Whether pieces may be encoded one by one.
        self.cut = any(x.get("pattern") == {"Regex": PATTERN} or (x["type"] == "ByteLevel" and x["use_regex"]) for x in steps)
        self.shown = {b: c for b, c in enumerate(byte_characters()) if chr(b) != c}
        self.characters = byte_characters()
        self.words: dict[str, bytes] = {}  #: ids of a space and a word, by the word
        self.parts: dict[str, bytes] = {}  #: ids of other parts
        self.compounds: list[str] = []  #: those of ``words`` that aren't words

    def _ids(self, text: str) -> bytes:
        """Ids of a text without the library's per-call wrapping: the pattern and the
        byte table, then the library's BPE model on each part."""
        if self.cut and text.isascii():
            if text[:1] == " " and text[1:].isalpha():
                return array("I", [t.id for t in self.model.tokenize("\u0120" + text[1:])]).tobytes()
            parts = [part if part.isprintable() and part[0] != " " else part.translate(self.shown) for part in _PARTS(text)]
        elif self.cut and _ONLY_LATIN(text):
            of = self.characters.__getitem__
            parts = ["".join(map(of, part.encode())) for part in _PARTS(text)]
        else:
            parts = [part for part, _ in self.splitter.pre_tokenize_str(text)] if text else []
        tokenize = self.model.tokenize
        return array("I", [t.id for part in parts for t in tokenize(part)]).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.cut:
            return [self._ids(text) for text in texts]
        split = []
        for text in texts:
            if _UNSAFE.search(text):
                first, *rest = _CUT.split(text)
                split.append([first, *(piece[1:] for piece in rest)])
            else:
                split.append(text.split(" "))
        wanted: set[str] = set()
        for pieces in split:
            wanted.update(pieces[1:])
        known = self.words
        if len(known) > MEMORY + COMPOUNDS:  # short words are the frequent ones
            kept = {k: v for k, v in known.items() if len(k) <= SHORT_WORD}
            self.words = known = kept if len(kept) < MEMORY // 2 else {}
            self.compounds.clear()
        if len(self.parts) > MEMORY:
            self.parts.clear()
        new = wanted.difference(known)
        compound = [piece for piece in new if not piece.isalpha() or len(piece) > LONG_WORD]
        new.difference_update(compound)
        ids = self._ids
        for word in new:
            known[word] = ids(" " + word)
        for piece in compound:
            known[piece] = self._compound(" " + piece)
        self.compounds += compound
        first = [self._compound(pieces[0]) for pieces in split]
        out = [b"".join([start, *map(known.__getitem__, pieces[1:])]) for start, pieces in zip(first, split, strict=True)]
        if len(self.compounds) > COMPOUNDS:
            for piece in self.compounds:
                known.pop(piece, None)
            self.compounds.clear()
        return out

    def _compound(self, text: str) -> bytes:
        """Ids of a piece that isn't a plain word: those of its parts, in order."""
        if not _ONLY_LATIN(text):
            return self._ids(text)
        out = []
        for part in _PARTS(text):
            found = self.words.get(part[1:]) if part[:1] == " " else self.parts.get(part)
            if found is None:
                found = self._ids(part)
                if len(part) > LONG_WORD:
                    pass
                elif part[:1] != " ":
                    self.parts[part] = found
                elif part[1:].isalpha():
                    self.words[part[1:]] = found
            out.append(found)
        return b"".join(out)


class MarkedEncoder(Encoder):
    """An encoder for which the file's added tokens in a text are those tokens, as in
    the library's ``encode``: texts are cut there and the parts encoded one by one."""

    def __init__(self, vocabulary: str):
        super().__init__(vocabulary)
        added = [t for t in json.loads(vocabulary)["added_tokens"] if t["content"]]
        #: The longest of those that start at a place counts.
        self.marks = re.compile("|".join(re.escape(t["content"]) for t in sorted(added, key=lambda t: -len(t["content"])))) if added else None
        self.mark_ids = {t["content"]: array("I", [t["id"]]).tobytes() for t in added}
        #: Whether no token takes spaces beside it or has to stand alone.
        self.plain = not any(t.get(k) for t in added for k in ("lstrip", "rstrip", "single_word"))

    def encode(self, texts: list[str]) -> list[bytes]:
        held = [i for i, text in enumerate(texts) if self.marks.search(text)] if self.marks else []
        if not held:
            return super().encode(texts)
        if not self.plain:
            out = super().encode([text if not self.marks.search(text) else "" for text in texts])
            for i in held:
                out[i] = array("I", self.tokenizer.encode(texts[i], add_special_tokens=False).ids).tobytes()
            return out
        parts = [self.marks.split(text) for text in texts]
        coded = iter(super().encode([part for own in parts for part in own]))
        out = []
        for text, own in zip(texts, parts, strict=True):
            marks = [self.mark_ids[m] for m in self.marks.findall(text)] if len(own) > 1 else []
            out.append(b"".join(x for part, mark in zip(own, [*marks, b""], strict=True) for x in (next(coded), mark)))
        return out


#: Pieces that a ``ColumnEncoder`` remembers between batches, and bytes of their ids;
#: beyond that it forgets all but those met again.
PIECES, STORE = 200_000, 32 << 20
#: The parts of Latin texts as bytes, where what is not of ASCII is a letter.
_BYTE_PARTS = re.compile(
    rb"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z\x80-\xff]+| ?[0-9]+| ?[^\sA-Za-z0-9\x80-\xff]+|\s+(?!\S)|\s+"
).findall
_LATIN_BYTES = re.compile(rb"(?:[\x00-\x7f]+|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]|[\xc4-\xc8][\x80-\xbf]|\xc9[\x80-\x8f])*+").fullmatch
#: Pieces that are one part.
_SINGLE = re.compile(
    rb" ?(?:(?:[A-Za-z]+|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]|[\xc4-\xc8][\x80-\xbf])++|[0-9]++|[^\sA-Za-z0-9'\x80-\xff]++)|[\t-\r]"
).fullmatch
_SPACES = b" \t\n\r\x0b\x0c"
#: Classes of bytes: of a character beyond ASCII or a separator, letter, digit, mark,
#: apostrophe, white space, space.
_ELSE, _LETTER, _DIGIT, _MARK, _QUOTE, _WHITE, _SPACE = range(7)
_CLASS = np.full(256, _MARK, np.uint8)
for _kind, _own in {
    _ELSE: [*range(28, 32), *range(128, 256)], _LETTER: [*range(65, 91), *range(97, 123)], _DIGIT: range(48, 58), _QUOTE: [39], _WHITE: range(9, 14), _SPACE: [32],
}.items():
    _CLASS[list(_own)] = _kind
#: Where a part ends for certain between two classes; behind white space only if it is
#: one character, and a space behind ``_ELSE`` is looked at more closely.
_BETWEEN = np.zeros((8, 8), np.uint8)
for _before, _behind in {
    _LETTER: [_DIGIT, _MARK, _QUOTE, _WHITE, _SPACE], _DIGIT: [_LETTER, _MARK, _QUOTE, _WHITE, _SPACE], _MARK: [_LETTER, _DIGIT, _WHITE, _SPACE],
    _QUOTE: [_DIGIT, _WHITE, _SPACE], _WHITE: [_LETTER, _DIGIT, _MARK, _QUOTE], _ELSE: [_SPACE],
}.items():
    _BETWEEN[_before, _behind] = {_WHITE: 2, _ELSE: 3}.get(_before, 1)


def cuts(data: np.ndarray, valid: bool = True) -> np.ndarray:
    """Places in UTF-8 where a text may be cut, so that its pieces, encoded one by one,
    give its ids. Not all such places; only those before a space, unless ``valid``."""
    kind = _CLASS[data]
    if valid:
        lead = np.flatnonzero((data >= 0xC3) & (data <= 0xC8))  # letters, but for two signs
        lead = lead[(data[lead] != 0xC3) | ((data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7))]
        kind[lead] = kind[lead + 1] = _LETTER
    rule = _BETWEEN.ravel()[(kind[:-1] << 3) | kind[1:]]
    if not valid:
        rule[kind[1:] != _SPACE] = 0
    at = np.flatnonzero(rule) + 1
    rule = rule[at - 1]
    white = np.flatnonzero(rule == 2)
    two = kind[np.maximum(at[white] - 2, 0)]
    several = white[(at[white] < 2) | (two == _ELSE) | (two >= _WHITE)]
    doubtful = np.flatnonzero(rule == 3)
    one, two, three = (data[np.maximum(at[doubtful] - n, 0)] for n in (1, 2, 3))
    blank = (one < 0x80) | ((two == 0xC2) & ((one == 0x85) | (one == 0xA0))) | ((three >= 0xE1) & (three <= 0xE3) & ((two == 0x9A) | (two == 0x80) | (two == 0x81)))
    return np.delete(at, np.concatenate([several, doubtful[blank]]))


def _buffers(texts: pa.BinaryArray) -> tuple[np.ndarray, memoryview]:
    """Offsets of the texts, and the bytes between the first and the last of them."""
    _, offsets, content = texts.buffers()
    bounds = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1] if offsets else np.zeros(1, np.int32)
    return bounds, memoryview(content or b"")[bounds[0] : bounds[-1]]


class ColumnEncoder(MarkedEncoder):
    """A marked encoder of whole columns: their pieces are told apart and the ids of all
    put together by array operations, and the parts that are new go to the library's
    model at once. Ids of remembered pieces lie one behind another in one array."""

    def __init__(self, vocabulary: str):
        super().__init__(vocabulary)
        from tokenizers import Tokenizer, pre_tokenizers

        self.bare = Tokenizer(self.model)
        self.bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()  # between parts; none has a space in its printable form
        vocab = self.tokenizer.get_vocab(with_added_tokens=False)
        self.widths = np.zeros(max(vocab.values(), default=-1) + 1, np.int64)  #: bytes of each id
        for token, i in vocab.items():
            self.widths[i] = len(token)
        self.printable = "".join(self.characters[:255]) + " "  # UTF-8 has no byte 255, so it stands between parts
        self.mark_bytes = [m.encode() for m in self.mark_ids]
        self._clear()

    def _clear(self) -> None:
        self.slots: dict[bytes, int] = {}  #: place of a piece in ``starts`` and ``counts``
        self.starts, self.counts = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.met = np.zeros(1 << 16, np.int64)  #: batches that had the piece, lately
        self.used = 0
        self.store, self.filled = np.zeros(1 << 18, np.uint32), 0

    def _add(self, pieces: list[bytes], ids: np.ndarray, counts: np.ndarray) -> None:
        """Remember new pieces, whose ids follow each other."""
        while self.used + len(pieces) > len(self.starts):
            self.starts, self.counts, self.met = (np.concatenate([x] * 2) for x in (self.starts, self.counts, self.met))
        while self.filled + len(ids) > len(self.store):
            self.store = np.concatenate([self.store] * 2)
        own = slice(self.used, self.used + len(pieces))
        self.starts[own], self.counts[own], self.met[own] = self.filled + np.cumsum(counts) - counts, counts, 0
        self.store[self.filled : self.filled + len(ids)] = ids
        self.slots.update(zip(pieces, range(own.start, own.stop)))
        self.used, self.filled = own.stop, self.filled + len(ids)

    def _gather(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these slots in a row, and how many each has."""
        counts = self.counts[slots]
        ends = np.cumsum(counts)
        places = np.repeat(self.starts[slots] - ends + counts, counts)
        places += np.arange(len(places))
        return self.store[places], counts

    def _forget(self) -> None:
        """Above the limits, keep the pieces that most batches had, at most half as many."""
        if len(self.slots) <= PIECES and self.filled * 4 <= STORE:
            return
        slots = np.fromiter(self.slots.values(), np.int64, len(self.slots))
        met, sizes = self.met[slots], self.counts[slots]
        least = next(n for n in range(2, met.max(initial=0) + 3) if (m := met >= n).sum() <= PIECES // 2 and sizes[m].sum() * 8 <= STORE)
        chosen = met >= least
        kept = list(itertools.compress(self.slots, chosen))
        ids, counts = self._gather(slots[chosen])
        self._clear()
        self._add(kept, ids, counts)
        self.met[: len(kept)] = met[chosen] // 2

    def _model(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of parts of Latin texts by the library's model."""
        shown = [codecs.charmap_decode(b"\xff".join(parts[i : i + 1000]), "strict", self.printable)[0] for i in range(0, len(parts), 1000)]
        found = [x.ids for x in self.bare.encode_batch_fast(shown, add_special_tokens=False)]
        ids = np.fromiter(itertools.chain.from_iterable(found), np.uint32, sum(map(len, found)))
        ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))
        reached = np.cumsum(self.widths[ids])
        last = np.searchsorted(reached, ends)
        if not len(ids) or last[-1] != len(ids) - 1 or not np.array_equal(reached[last], ends):  # a vocabulary without some bytes
            each = [self._ids(part.decode()) for part in parts]
            return np.frombuffer(b"".join(each), np.uint32), np.array([len(x) // 4 for x in each])
        return ids, np.diff(last, prepend=-1)

    def _learn(self, pieces: list[bytes]) -> list[bytes]:
        """Remember pieces that aren't known, and their parts, which are returned."""
        known = self.slots
        single, easy, other = [], [], []
        for piece in pieces:
            if _SINGLE(piece):
                single.append(piece)
            elif piece[0] == 32 and piece[-1] not in _SPACES and _LATIN_BYTES(piece):
                easy.append(piece)
            else:
                other.append(piece)
        if single:
            self._add(single, *self._model(single))
        parts = _BYTE_PARTS(b"".join(easy))  # no part goes beyond its piece, as each begins with a space
        new = [part for part in dict.fromkeys(parts) if part not in known]
        if new:
            self._add(new, *self._model(new))
        slots = np.fromiter(map(known.__getitem__, parts), np.int64, len(parts))
        self.met[slots] += 1
        ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))
        last = np.searchsorted(ends, np.cumsum(np.fromiter(map(len, easy), np.int64, len(easy))))
        n = np.diff(last, prepend=-1)
        several = n > 1
        ids, counts = self._gather(slots[np.repeat(several, n)])
        ends, last = np.append(0, np.cumsum(counts)), np.append(0, np.cumsum(n[several]))
        self._add(list(itertools.compress(easy, several)), ids, np.diff(ends[last]))
        each = [self._ids(piece.decode("utf-8", "replace")) for piece in other]
        self._add(other, np.frombuffer(b"".join(each), np.uint32), np.array([len(x) // 4 for x in each], np.int64))
        return new

    def _unmarked(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        bounds, content = _buffers(texts)
        if not len(content):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        try:
            valid = texts.cast(pa.string()) is not None
        except pa.ArrowInvalid:
            valid = False
        data, starts = np.frombuffer(content, np.uint8), bounds[:-1] - bounds[0]
        begins = np.zeros(len(data) + 1, bool)
        begins[cuts(data, valid)] = True
        begins[starts] = True
        begins[-1] = True
        places = np.flatnonzero(begins)
        pieces = pa.Array.from_buffers(pa.binary(), len(places) - 1, [None, pa.py_buffer(places.astype(np.int32)), pa.py_buffer(content)]).dictionary_encode()
        distinct = pieces.dictionary.to_pylist()
        self._forget()
        slots = np.fromiter(map(self.slots.get, distinct, itertools.repeat(-1)), np.int64, len(distinct))
        self.met[slots[slots >= 0]] += 1
        unknown = slots < 0
        new = list(itertools.compress(distinct, unknown))
        parts = self._learn(new)
        slots[unknown] = np.fromiter(map(self.slots.__getitem__, new), np.int64, len(new))
        for piece in itertools.chain(new, parts):
            if len(piece) > LONG_WORD:
                self.slots.pop(piece, None)
        ids, counts = self._gather(slots[pieces.indices.to_numpy()])
        ends = np.append(0, np.cumsum(counts))[np.searchsorted(places, np.append(starts, len(data)))]
        return ids, np.diff(ends)

    def flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and how many each has; null is empty."""
        texts = texts.cast(pa.binary()).fill_null(b"")
        content = bytes(_buffers(texts)[1])
        if self.cut and not any(mark in content for mark in self.mark_bytes):
            return self._unmarked(texts)
        raw = texts.to_pylist()
        held = np.array([not self.cut or any(mark in text for mark in self.mark_bytes) for text in raw], bool)
        ids, counts = self._unmarked(pc.if_else(pa.array(held), pa.scalar(b"", pa.binary()), texts))
        own = np.split(ids, np.cumsum(counts)[:-1])
        chosen = np.flatnonzero(held).tolist()
        for i, found in zip(chosen, self.encode([raw[i].decode("utf-8", "replace") for i in chosen]), strict=True):
            own[i] = np.frombuffer(found, np.uint32)
        return np.concatenate([ids[:0], *own]), np.array([len(x) for x in own], np.int64)


_LOADED: dict[object, object] = {}


def once(shared: Broadcast, make: Callable) -> object:
    """``make(shared.value)``, made once per worker and broadcast."""
    key = (shared._path, make.__qualname__)
    if key not in _LOADED:
        forget()
        _LOADED[key] = make(shared.value)
    return _LOADED[key]


def forget() -> None:
    """Drop what an earlier task of this worker has loaded, and give the memory back."""
    if _LOADED:
        _LOADED.clear()
        gc.collect()
        with contextlib.suppress(OSError, AttributeError):  # another C library
            ctypes.CDLL(None).malloc_trim(0)


def int_lists(parts: list[bytes]) -> pa.Array:
    """Lists of ids as one array, whose offsets have 32 bits."""
    ends = np.cumsum([0, *(len(p) // 4 for p in parts)], dtype=np.int64)
    if ends[-1] >= 1 << 31:
        raise OverflowError(f"{ends[-1]} ids in one batch of {len(parts)} texts")
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.frombuffer(b"".join(parts), "<i4")))


def character_spans(text: bytes, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and one past the last character that tokens of these byte lengths
    touch in a UTF-8 text. Tokens that share a character both span it."""
    char = np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
    ends = np.cumsum(lengths)
    return char[ends - lengths] - 1, char[ends - 1]


def _with_column(batch: pa.RecordBatch, names: list[str], new: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([new[n] if n in new else batch.column(n) for n in names], names)


def _schema(df: DataFrame, **new: T.DataType) -> T.StructType:
    kept = [f for f in df.schema.fields if f.name not in new]
    return T.StructType([*kept, *(T.StructField(n, t) for n, t in new.items())])


def encode(
    df: DataFrame, vocabulary: str, text_col: str = "text", out: str = "ids", offsets: bool = False, keep: Iterable[str] | None = None
) -> DataFrame:
    """Add ``out`` (array of ids) and, with ``offsets``, ``<out>_starts`` and
    ``<out>_ends``: each token's character span in the text. ``keep`` names the
    other columns that stay (all, if not given)."""
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)
    ints = T.ArrayType(T.IntegerType())
    new = {out: ints} | ({f"{out}_starts": ints, f"{out}_ends": ints} if offsets else {})
    kept = bounded_batches(df) if keep is None else bounded_batches(df).select(*dict.fromkeys([*keep, text_col]))
    schema = _schema(kept if keep is None else kept.select(*keep), **new)
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = once(shared, Encoder)
        lengths = np.array([len(t) for t in token_bytes(shared.value)]) if offsets else None
        for batch in small_batches(batches, ROWS):
            raw = [t or b"" for t in raw_texts(batch.column(text_col))]
            ids = encoder.encode([t.decode("utf-8", "replace") for t in raw])
            made = {out: int_lists(ids)}
            if offsets:
                spans = [character_spans(t, lengths[np.frombuffer(i, "<u4")]) for t, i in zip(raw, ids, strict=True)]
                for k, what in enumerate(("starts", "ends")):
                    made[f"{out}_{what}"] = int_lists([s[k].astype("<i4").tobytes() for s in spans])
            yield _with_column(batch, names, made)

    return kept.mapInArrow(run, schema)


def decode(df: DataFrame, vocabulary: str, ids_col: str = "ids", out: str = "decoded", keep: Iterable[str] | None = None) -> DataFrame:
    """Add ``out`` (binary): the bytes of the ids, joined. Characters that are
    split over tokens come together again, as bytes are joined before anything
    reads them as text. A null list gives no bytes; an unknown id fails."""
    shared = df.sparkSession.sparkContext.broadcast(token_bytes(vocabulary))
    kept = bounded_batches(df) if keep is None else bounded_batches(df).select(*dict.fromkeys([*keep, ids_col]))
    schema = _schema(kept if keep is None else kept.select(*keep), **{out: T.BinaryType()})
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = shared.value.__getitem__
        for batch in small_batches(batches, ROWS):
            parts = [b"".join(map(of, ids.values.to_numpy().tolist())) if ids.is_valid else b"" for ids in batch.column(ids_col)]
            yield _with_column(batch, names, {out: binaries(parts)})

    return kept.mapInArrow(run, schema)


def round_trip(df: DataFrame, vocabulary: str, text_col: str = "text", out: str = "ids", decoded: str = "decoded", keep: Iterable[str] | None = None) -> DataFrame:
    """``encode`` and ``decode`` in one pass, so that a task needs one Python worker
    and ids cross to it once: adds ``out`` and, read back from those ids,
    ``decoded``."""
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)
    kept = bounded_batches(df) if keep is None else bounded_batches(df).select(*dict.fromkeys([*keep, text_col]))
    schema = _schema(kept if keep is None else kept.select(*keep), **{out: T.ArrayType(T.IntegerType()), decoded: T.BinaryType()})
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = once(shared, Codec)
        for batch in small_batches(batches, ROWS):
            ids = both.encoder.encode([(t or b"").decode("utf-8", "replace") for t in raw_texts(batch.column(text_col))])
            yield _with_column(batch, names, {out: int_lists(ids), decoded: binaries([both.decode(i) for i in ids])})

    return kept.mapInArrow(run, schema)


class Codec:
    """An encoder and the table that reverses it."""

    def __init__(self, vocabulary: str):
        self.encoder, self.table = Encoder(vocabulary), token_bytes(vocabulary)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.table.__getitem__, array("I", ids)))


def readable(parts: Iterable[bytes]) -> Iterator[str]:
    """Decode a stream of token bytes to text piece by piece: bytes of a
    character that isn't complete yet wait for the next token."""
    reader = codecs.getincrementaldecoder("utf-8")("replace")
    for part in parts:
        yield reader.decode(part)
    yield reader.decode(b"", True)
