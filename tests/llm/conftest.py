import importlib.util

import pytest

missing = [n for n in ("public_tokenizers", "tiktoken", "sentencepiece") if not importlib.util.find_spec(n)]
if missing:
    pytest.skip(f"needs {missing}", allow_module_level=True)

# Awkward documents: nulls in every column, empty and very long texts, ties,
# repeated rows, and extra columns named like the operators' own.
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long,"
    " body string, size long, key string, score double, place long, row string, words long,"
    " `a.b` int, identity string, mix_size string, language int"
)
EXTRA = ("x", 1, "k", 0.5, 7, "r", 3, 1, "i", "m", 2)


@pytest.fixture(scope="session")
def awkward(spark):
    long_text = " ".join(f"word{i % 977} and" for i in range(30_000))
    plain = [
        (1, "the quick brown fox jumps over the lazy dog", "en", "b", 9),
        (2, "the quick brown fox jumps over the lazy dog", "en", "b", 9),
        (2, "the quick brown fox jumps over the lazy dog", "en", "b", 9),
        (3, None, "en", "a", None),
        (4, "", "de", "a", 0),
        (5, "12345 !!! ...", None, None, 13),
        (None, "der schnelle braune fuchs springt", "de", "a", 4),
        (None, "der schnelle braune fuchs springt", "de", "a", 4),
        (6, long_text, "en", "c", len(long_text)),
        (7, "x" * 300_000, "de", "c", 300_000),
        (8, "\t\n \x0b", "en", "c", 4),
        (9, "Größe ß Straße über 日本語 \U0001f600 <|endoftext|> <s>", "de", None, 30),
        (10, "DER SCHNELLE BRAUNE FUCHS SPRINGT", None, "b", 4),
    ]
    return spark.createDataFrame([row + EXTRA for row in plain], SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sample(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
