import math

import numpy as np
import pytest

from refsync.llm import neighbours, topk

SCHEMA = "vec_id long, embedding array<float>, label int, id long, score double, vec string"


def vectors(spark, seed=0):
    draw = np.random.default_rng(seed)
    rows = [(i, draw.normal(0, 0.2, 8).astype(np.float32).tolist()) for i in range(300)]
    rows += [(i, rows[i][1]) for i in (0, 20, 33)]  # the same id and vector again
    rows += [(400 + i, rows[40][1]) for i in range(60)]  # a group of ties
    rows += [
        (1000, None),
        (1020, [0.0] * 8),
        (1040, [math.nan] + [0.1] * 7),
        (1060, [math.inf] + [0.1] * 7),
        (1080, [None] + [0.1] * 7),
        (None, rows[3][1]),
        (1100, [0.5, 0.5]),
        (1101, [1.5, -0.5]),
        (1120, []),
    ]
    return rows, spark.createDataFrame([(*r, 1, 2, 0.5, "v") for r in rows], SCHEMA)


def usable(rows, zero):
    return [
        (i, v)
        for i, v in rows
        if i is not None
        and v is not None
        and all(x is not None and math.isfinite(x) for x in v)
        and (zero or any(v))
    ]


def brute(rows, transform, k=20):
    out = []
    values = [(i, transform(v)) for i, v in rows]
    for q, (query, a) in enumerate(values):
        if query % 20:
            continue
        scored = []
        for c, (vec, b) in enumerate(values):
            if c != q and len(a) == len(b):
                total = 0 if not a else a[0] * 0
                for x, y in zip(a, b):
                    total += x * y
                scored.append((-total, vec))
        for rank, (score, vec) in enumerate(sorted(scored)[:k], 1):
            out.append((query, rank, vec, -score))
    return sorted(out)


def integers(v):
    return [math.floor(64 * x) for x in v]


def test_top_k(spark):
    rows, df = vectors(spark)
    found = sorted(map(tuple, topk.top_k(df).collect()))
    assert found == brute(usable(rows, True), integers)


def test_nearest(spark):
    rows, df = vectors(spark)
    found = sorted(map(tuple, neighbours.nearest(df).collect()))
    assert found == brute(usable(rows, False), lambda v: [float(x) for x in v])


def test_several_blocks(spark, monkeypatch):
    rows, df = vectors(spark, 1)
    for module in (topk, neighbours):
        monkeypatch.setattr(module, "ROW_BLOCK", 70)
        monkeypatch.setattr(module, "QUERY_BLOCK", (4, 1, 5))
    monkeypatch.setattr(neighbours, "TILE", 32)
    assert sorted(map(tuple, topk.top_k(df).collect())) == brute(usable(rows, True), integers)
    found = sorted(map(tuple, neighbours.nearest(df).collect()))
    assert found == brute(usable(rows, False), lambda v: [float(x) for x in v])


@pytest.mark.parametrize("search", [topk.top_k, neighbours.nearest])
def test_empty_table(spark, search):
    assert search(spark.createDataFrame([], SCHEMA)).collect() == []


def test_slices_add_up():
    draw = np.random.default_rng(3)
    adder, total = topk.Adder(4), np.zeros(256, np.int64)
    for _ in range(200):
        bits = draw.integers(0, 2, 256).astype(np.uint8)
        weight = int(draw.integers(0, 5))
        adder.add(weight, np.packbits(bits, bitorder="little").view(np.uint64))
        total += bits.astype(np.int64) << weight
    summed = np.zeros(256, np.int64)
    for weight, bitmap in enumerate(adder.digits()):
        summed += np.unpackbits(bitmap.view(np.uint8), bitorder="little").astype(np.int64) << weight
    assert (summed == total).all()


def test_quantisation_bound_holds():
    draw = np.random.default_rng(4)
    x, q = draw.normal(size=(200, 16)) * 3, draw.normal(size=(50, 16))
    x8, xs, _, x_cut = neighbours.quantise(x)
    q8, qs, q_length, q_cut = neighbours.quantise(q)
    near = neighbours.products(q8, x8) * qs[:, None] * xs
    error = q_cut[:, None] * np.linalg.norm(x, axis=1) + q_length[:, None] * x_cut
    assert (np.abs(near - q @ x.T) <= error + 1e-9).all()


@pytest.mark.parametrize("size", [3e5, 1e9, 1e17, 1e300])
def test_top_k_of_large_components(spark, size):
    """Nothing is left out; what leaves 64 bits counts as the nearest long."""
    draw = np.random.default_rng(6)
    rows = [(i * 10, [float(np.float32(x)) for x in draw.normal(0, 0.2, 8)]) for i in range(40)]
    rows += [(401 + i, draw.normal(0, size, 8).tolist()) for i in range(12)]
    rows += [(0, [size, 1.0] + [0.0] * 6), (20, [1.0] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    longest = (1 << 63) - 1

    def long(x):
        return max(-longest - 1, min(longest, x))

    whole = [(i, [long(math.floor(64 * x)) for x in v]) for i, v in rows]
    expected = []
    for q, (query, a) in enumerate(whole):
        if query % 20 == 0:
            scored = sorted(
                (-long(sum(x * y for x, y in zip(a, b))), i)
                for c, (i, b) in enumerate(whole)
                if c != q
            )
            expected += [(query, rank, i, -n) for rank, (n, i) in enumerate(scored[:20], 1)]
    # Within a block the order is exact even beyond 64 bits, so ties there may be broken by it.
    found = sorted(map(tuple, topk.top_k(df).collect()))
    assert sorted((q, r, n) for q, r, _, n in found) == sorted((q, r, n) for q, r, _, n in expected)
    if size < 1e9:
        assert found == sorted(expected)
