import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from refsync.llm import packing
from refsync.llm.common import tokenizer_path

PATH = tokenizer_path("byte_bpe_50k.json")
RANKS = tokenizer_path("byte_bpe_50k.tiktoken")


def check(docs, rows, capacity=1024):
    """Every token once, pieces as agreed, sequences gapless; returns the number of sequences."""
    whole = Tokenizer.from_file(PATH)
    expected = defaultdict(int)
    for doc_id, text in docs:
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        first = (len(ids) - 1) % capacity + 1
        bounds = [0, *range(first, len(ids) + 1, capacity)]
        for piece, (a, b) in enumerate(zip(bounds, bounds[1:])):
            expected[doc_id, piece, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    found = defaultdict(int)
    sequences = defaultdict(list)
    for r in rows:
        found[r.doc_id, r.piece, r.start, r.length, r.ids_crc32] += 1
        sequences[r.sequence_id].append((r.offset, r.length))
    assert found == expected
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences)


def test_awkward_documents(spark, awkward):
    docs = [(r.doc_id, r.text) for r in awkward.collect()]
    check(docs, packing.packed_documents(awkward).collect())


def test_empty_table(spark, nothing):
    assert packing.packed_documents(nothing).collect() == []


def test_real_documents_close_to_the_bound(spark, sample):
    rows = packing.packed_documents(sample).collect()
    count = check([(r.doc_id, r.text) for r in sample.collect()], rows)
    assert count <= 1.02 * sum(r.length for r in rows) / 1024 + 1


def test_rounds_over_several_tasks(spark, sample):
    cut = packing.pieces(sample)
    rows = packing.pack(cut, pieces_per_task=40).collect()
    count = check([(r.doc_id, r.text) for r in sample.collect()], rows)
    assert count <= 1.05 * sum(r.length for r in rows) / 1024 + 1


def test_reruns_agree(spark, sample):
    first, second = (sorted(packing.packed_documents(sample).collect()) for _ in range(2))
    assert first == second


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=200), st.integers(1, 8))
def test_bins_against_a_plain_search(lengths, limit):
    bins, closed = packing.Bins(64, limit), []
    plain, plain_closed = [], []  # sums of open bins, the last touched last
    for length in lengths:
        done = bins.add(length, length)
        closed += [done] if done else []
        fitting = [64 - b for b in plain if 64 - b >= length]
        filled = length
        if fitting:
            filled += plain.pop(plain.index(64 - min(fitting)))
        if filled == 64:
            plain_closed.append(filled)
        else:
            plain.append(filled)
            if len(plain) > limit:
                plain_closed.append(plain.pop(plain.index(max(plain))))
    assert sorted(map(sum, closed)) == sorted(plain_closed)
    assert sum(map(sum, closed)) + sum(sum(b) for _, b in bins.rest()) == sum(lengths)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.text(st.characters(max_codepoint=255), max_size=60))
def test_both_libraries_give_the_same_ids(text):
    whole = Tokenizer.from_file(PATH)
    assert packing.token_ids(text, PATH, RANKS).tolist() == whole.encode(
        text, add_special_tokens=False
    ).ids


@pytest.mark.parametrize("text", [" " * 1_500_000, "\n" * 1_000_000, "x" * 300_000, "-" * 400_000])
def test_very_long_runs_have_ids(text):
    found = packing.token_ids(text, PATH, RANKS)
    assert found.tolist() == Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids


def test_equal_short_pieces_are_packed_in_many_tasks(spark):
    """Nothing is left over for one task where no piece closes a bin."""
    cut = spark.range(4000).selectExpr(
        "id as doc_id", "id as place", "0L as piece", "0L as start", "19L as length",
        "1L as ids_crc32",
    )
    found = packing.pack(cut, pieces_per_task=1000).collect()
    assert len(found) == 4000
    sequences = {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append(r.offset)
    # 53 pieces fill a sequence; each of four tasks leaves one unfilled.
    assert len(sequences) <= -(-4000 // 53) + 4
    assert all(sorted(o) == [19 * i for i in range(len(o))] for o in sequences.values())
