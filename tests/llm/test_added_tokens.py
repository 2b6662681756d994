"""Added tokens of the vocabulary file in the texts of op2's token files."""

import json

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from loomsift.llm import bpe, token_files

MARK = "<|endoftext|>"


def test_token_files_hold_added_tokens(spark, json_vocabulary):
    library = Tokenizer.from_str(json_vocabulary)
    texts = [f"a {MARK} b", "plain text", MARK, f"{MARK}{MARK}x  {MARK}\n", None, "", f"café {MARK[:-1]} {MARK}>", "the end"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    at, wanted = 0, []
    for i, text in enumerate(texts):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        wanted.append((i, at, ids))
        at += len(ids)
    rows = token_files.round_trip(docs, json_vocabulary, 2).collect()
    assert sorted((r.doc_id, r.start, np.frombuffer(r.ids, "<u4").tolist()) for r in rows) == wanted
    assert wanted[0][2] == [64, 220, 50256, 275, 2]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from([MARK, MARK[:5], " ", "  ", "\n", "word", "'s", "é", "日", "9", "<", "<<m>>", "<<m>>!"])).map("".join), max_size=4), st.booleans())
def test_marked_encoder_is_the_library(texts, stripping):
    """Also with overlapping tokens and one that takes the spaces before it."""
    content = json.loads(_vocabulary())
    flags = {"single_word": False, "rstrip": False, "normalized": False, "special": True}
    content["added_tokens"] += [{"id": 50257 + i, "content": c, "lstrip": stripping, **flags} for i, c in enumerate(("<<m>>", "<<m>>!"))]
    vocabulary = json.dumps(content)
    key = (stripping,)
    if key not in _MADE:
        _MADE[key] = bpe.MarkedEncoder(vocabulary), Tokenizer.from_str(vocabulary)
    encoder, library = _MADE[key]
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]


_MADE: dict = {}


def _vocabulary() -> str:
    import public_tokenizers as P

    return bpe.load_vocabulary(P.path("byte_bpe_50k.json"))
