"""op2 encodes whole columns: the library's ids, and new words of a batch in one call."""

import json

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from loomsift.llm import bpe
from loomsift.llm.common import sized_batches

PIECES = [
    " ", " ", " ", "  ", "\n", "\n", "\t", "\r\n", "\x0b", "\x1c", "\x85", "\u00a0", "\u1680", "\u2003", "\u2028", "\u202f", "\u3000", "'", "'s", "'re", "'ll", "''", "'S", ",", ".", "!'", "_", "\0",
    "a", "Word", "the", "s", "12", "7", "½", "é", "ñandú", "ÿ", "×", "÷", "\u023f", "\u0243", "µ", "ª", "İ", "\u01c5", "\u0301", "日本",
    "\U0001f600", "—", "’", "«", "<|endoftext|>", "<|end",
]
_MADE: list = []


def _both() -> tuple[bpe.ColumnEncoder, Tokenizer]:
    if not _MADE:
        import public_tokenizers as P

        vocabulary = bpe.load_vocabulary(P.path("byte_bpe_50k.json"))
        _MADE.extend([bpe.ColumnEncoder(vocabulary), Tokenizer.from_str(vocabulary)])
    return _MADE[0], _MADE[1]


def _lists(encoder, texts, kind):
    ids, counts = encoder.flat(pa.array(texts, kind))
    at = [0, *counts.cumsum().tolist()]
    assert len(ids) == at[-1]
    return [ids[a:b].tolist() for a, b in zip(at, at[1:])]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.none() | st.lists(st.sampled_from(PIECES), max_size=12).map("".join), max_size=6))
def test_columns_are_the_library(texts):
    encoder, library = _both()
    assert _lists(encoder, texts, pa.string()) == [library.encode(t or "", add_special_tokens=False).ids for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"\xc3", b"\xe2\x80", b"\x85", b"\xff", b"\xa0", b" ", b"a", b"'s", b"\n", "é".encode()]), max_size=8).map(b"".join), max_size=4))
def test_bytes_that_are_no_utf8(texts):
    encoder, library = _both()
    assert _lists(encoder, texts, pa.binary()) == [library.encode(t.decode("utf-8", "replace"), add_special_tokens=False).ids for t in texts]


def test_slices_and_forgetting(monkeypatch):
    """A memory of few pieces, texts of all lengths and slices of a column change nothing."""
    _, library = _both()
    encoder = bpe.ColumnEncoder(library.to_str())
    monkeypatch.setattr(bpe, "PIECES", 60)
    texts = [" ".join(f"w{'abcdefghij'[i % 10]}ord{i * j % 97} x{j},\nY" for j in range(i % 40)) + "z" * (i % 200) + " ;" + "y" * (i % 90) for i in range(300)]
    column = pa.array(["skipped", *texts])
    for at in range(0, 300, 50):
        ids, counts = encoder.flat(column.slice(1 + at, 50))
        wanted = [library.encode(t).ids for t in texts[at : at + 50]]
        assert ids.tolist() == [i for x in wanted for i in x] and counts.tolist() == [len(x) for x in wanted]
    assert max(map(len, encoder.slots)) <= bpe.LONG_WORD
    encoder._forget()
    assert len(encoder.slots) <= 60


def test_new_words_go_to_the_library_at_once(monkeypatch):
    """One call a batch, however many words are new: one for each took most of op2's CPU."""
    _, library = _both()
    encoder = bpe.ColumnEncoder(library.to_str())
    calls, single = [], []
    model = encoder._model
    monkeypatch.setattr(encoder, "_model", lambda parts: calls.append(len(parts)) or model(parts))
    monkeypatch.setattr(encoder, "_ids", lambda text: single.append(text) or bpe.Encoder._ids(encoder, text))
    letters = "abcdefghijklmnopqrstuvwxyzé"
    words = [a + b + c for a in letters for b in letters for c in letters]
    texts = [" ".join(words[i : i + 50]) + ".\nEnd" for i in range(0, len(words), 50)]
    assert _lists(encoder, texts, pa.string()) == [library.encode(t).ids for t in texts]
    assert len(calls) <= 2 and sum(calls) > len(words) * 0.9 and not single
    assert _lists(encoder, texts, pa.string())[0] == library.encode(texts[0]).ids and len(calls) <= 2


def test_vocabularies_of_other_kinds():
    """One that lacks a byte, and one whose texts can't be cut, go part by part."""
    content = json.loads(_both()[1].to_str())
    model = content["model"]
    model["vocab"] = {t: i for t, i in model["vocab"].items() if "q" not in t}
    model["merges"] = [m for m in model["merges"] if "q" not in "".join(m)]
    texts = ["a quick, quiet quote", "qqq", None, "no such letter"]
    for splitter in (content["pre_tokenizer"], {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}):
        vocabulary = json.dumps(content | {"pre_tokenizer": splitter})
        library = Tokenizer.from_str(vocabulary)
        assert _lists(bpe.ColumnEncoder(vocabulary), texts, pa.string()) == [library.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_batches_by_size():
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(["a" * 5, None, "b" * 30, "", "c" * 4, "d" * 6])], ["id", "text"])
    cut = list(sized_batches([batch.slice(0, 0), batch, batch.slice(3)], 1, 10))
    assert [b.column(0).to_pylist() for b in cut] == [[0, 1], [2], [3, 4, 5], [3, 4, 5]]
