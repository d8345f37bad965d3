import re

import pytest

from refsync.llm.common import _SPAN, hashed_words


def plain(text):
    return re.findall(rb"[0-9a-z\x80-\xff]+", text.lower().encode())


@pytest.mark.parametrize(
    "text",
    [
        "abcd," * 50_000,
        "ab " * 100_000,
        "x" * 2_000_000,
        " " * 2_000_000,
        "a," + "y" * 300_000 + " b c",
        "z" * _SPAN,
        "z" * (_SPAN + 1),
        "z" * (_SPAN + 1) + " q " + "z" * (_SPAN + 1),
        ("w" * (_SPAN - 1) + " ") * 3,
        "éè," * 90_000,
        "a b " * 40_000 + "r" * 140_000 + " a b",
        "",
        ",",
    ],
)
def test_words_of_any_length_are_whole(text):
    found, words = hashed_words(text).tolist(), plain(text)
    assert len(found) == len(words)
    by_word = dict(zip(words, found))
    assert [by_word[w] for w in words] == found and len(set(by_word.values())) == len(by_word)
    for word in list(by_word)[:50]:
        assert hashed_words(word.decode()).tolist() == [by_word[word]]
