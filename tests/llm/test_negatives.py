import math

import numpy as np
import pytest

from refsync.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label int, anchor long, score long, key string"


def rows_of(seed=0):
    draw = np.random.default_rng(seed)
    rows = [
        (i, (draw.normal(0.15, 0.3, 8)).tolist(), int(draw.integers(0, 4))) for i in range(420)
    ]
    rows += [rows[i] for i in (0, 100, 33)]  # repeated rows, anchors among them
    rows += [(500 + i, rows[40][1], i % 3) for i in range(90)]  # copies, of several labels
    rows += [(700, [0.0] * 8, 1), (701, [0.0] * 8, 2), (702, [0.0] * 8, 1)]  # scores of zero
    rows += [
        (800, None, 1),
        (900, [math.nan] + [0.1] * 7, 1),
        (1000, [math.inf] + [0.1] * 7, 1),
        (1100, [None] + [0.1] * 7, 1),
        (1200, [0.2] * 8, None),
        (None, [0.2] * 8, 1),
        (1300, [0.5, 0.5], 1),
        (1301, [0.5, 0.5], 1),
        (1302, [0.3, 0.3], 2),
        (1500, [], 1),
        (1600, [0.3] * 8, 77),  # an anchor alone with its label
    ]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "k") for r in rows], SCHEMA)


LONGEST = (1 << 63) - 1


def brute(rows, k=10, positives=5, every=100):
    kept = []
    for i, v, label in rows:
        if i is None or label is None or v is None:
            continue
        if any(x is None or not math.isfinite(x) for x in v):
            continue
        whole = [max(-LONGEST - 1, min(LONGEST, math.floor(256 * x))) for x in v]
        kept.append((i, whole, (label + 1) % 10 if i % 7 == 0 else label))
    out = []
    for at, (anchor, a, own) in enumerate(kept):
        if anchor % every:
            continue
        scored = []
        for other, (i, b, label) in enumerate(kept):
            if other != at and len(a) == len(b):
                score = max(-LONGEST, min(LONGEST, sum(x * y for x, y in zip(a, b))))
                scored.append((-score, i, label))
        scored.sort(key=lambda s: s[:2])
        for p, positive, _ in [s for s in scored if s[2] == own][:positives]:
            hard = [
                s for s in scored if s[2] != own and 30 * -p <= 100 * -s[0] <= 90 * -p
            ]
            for rank, (n, negative, _) in enumerate(hard[:k], 1):
                out.append((anchor, positive, rank, negative, -p, -n))
    return sorted(out)


def found(df, **options):
    return sorted(map(tuple, negatives.hard_negatives(df, **options).collect()))


def test_equals_brute_force(spark):
    rows = rows_of()
    assert found(frame(spark, rows)) == brute(rows)


def test_many_small_blocks(spark, monkeypatch):
    rows = rows_of(1)
    monkeypatch.setattr(negatives, "ROW_BLOCK", 70 * 64)
    monkeypatch.setattr(negatives, "ANCHOR_BLOCK", 10 * 64)
    monkeypatch.setattr(negatives, "TILE", 3)
    assert found(frame(spark, rows), every=10) == brute(rows, every=10)


@pytest.mark.parametrize("size", [1e5, 1e7, 1e18, 1e300])
def test_large_components(spark, size):
    draw = np.random.default_rng(2)
    rows = [(i * 10, draw.normal(size, size, 8).tolist(), i % 2) for i in range(60)]
    assert found(frame(spark, rows)) == brute(rows)


def test_empty_table_and_single_label(spark):
    assert found(frame(spark, [])) == []
    assert found(frame(spark, [(i, [0.1] * 8, 1) for i in (100, 101, 102)])) == []


def test_keys_sort_as_they_should():
    draw = np.random.default_rng(3)
    edge = [-(1 << 63), -1, 0, 1, (1 << 63) - 1]
    parts = [
        (int(draw.choice(edge)), int(draw.integers(-9, 9)), bool(draw.integers(0, 2)),
         int(draw.choice(edge)), int(draw.integers(0, 3)))
        for _ in range(500)
    ] + [(0, -LONGEST, True, 0, 0), (0, LONGEST, False, 0, 0)]
    by_bytes = sorted(parts, key=lambda p: negatives.key_of(*p))
    assert by_bytes == sorted(parts, key=lambda p: (p[0], -p[1], p[2], p[3], p[4]))
    assert [negatives.parts_of(negatives.key_of(*p)) for p in parts] == [p[:4] for p in parts]


def test_windows_are_exact():
    for score in [-7, -1, 0, 1, 3, 10, 33, LONGEST]:
        least, most = negatives.window(score)
        for value in {least - 1, least, most, most + 1}:
            inside = 30 * score <= 100 * value <= 90 * score
            assert inside == (least <= value <= most)


def test_stream_keeps_windows_only(spark):
    """Keys are read one by one; a long anchor is never held."""
    def keys():
        yield negatives.key_of(1, 100, False, 5, 5), 1
        for n in range(200_000):
            yield negatives.key_of(1, 80, True, n, n), 1

    rows = list(negatives.streamed(keys(), 3, 30, 90))
    assert rows == [(1, 5, n + 1, n, 100, 80) for n in range(3)]
