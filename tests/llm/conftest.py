import pytest
from pyspark.sql import functions as F

TEXTS = [
    "The quick brown fox jumps over the lazy dog and runs away from the old barn",
    "", None, " ", "!!! 123 ???", "word", "le chat et la souris",
    "日本語 テキスト 😀😀 mixed  spaces\n \n and\ttabs  ", "a" * 3000, "x y " * 2000,
    "The quick brown fox jumps over the lazy dog and runs away from the old barn",
    "it's we'll don't I'M <|endoftext|> <|im_start|>", "\x1c\x85\xa0 odd　spaces ",
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls anywhere, empty and long texts, repeated rows, clashing extra columns."""
    rows = [(i, t, "en" if i % 2 else None) for i, t in enumerate(TEXTS)] + [(None, "no id here at all", "en"), (3, " ", "en"), (0, TEXTS[0], "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for clash in ("ids", "score", "key", "n_words", "items", "start", "decoded", "levels", "component_id", "source", "n_chars"):
        df = df.withColumn(clash, F.lit(7).cast("long"))
    return df


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def ranks():
    import public_tokenizers as P

    from loomsift.llm import bpe

    return bpe.load_vocabulary(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)


@pytest.fixture(scope="session")
def json_vocabulary():
    import public_tokenizers as P

    from loomsift.llm import bpe

    return bpe.load_vocabulary(P.path("byte_bpe_50k.json"))
