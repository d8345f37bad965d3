import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from refsync.llm import centroids

SCHEMA = "vec_id long, embedding array<double>, label int, cluster int, distance long, q string"
LONGEST = (1 << 63) - 1


def rows_of(seed=0, dims=8):
    draw = np.random.default_rng(seed)
    rows = [(i, draw.normal(0, 0.3, dims).tolist()) for i in range(200)]
    rows += [(i, rows[i][1]) for i in (0, 20, 33)]  # the same id and vector again
    rows += [(300 + i, rows[40][1]) for i in range(60)]  # copies
    rows += [(400 + i, [(-1.0) ** i * 0.5] * dims) for i in range(10)]  # ties between centroids
    rows += [
        (1000, None),
        (1001, [0.0] * dims),
        (1002, [math.nan] + [0.1] * (dims - 1)),
        (1003, [math.inf] + [0.1] * (dims - 1)),
        (1004, [None] + [0.1] * (dims - 1)),
        (1005, [0.1] * (dims - 1)),
        (1006, []),
        (None, rows[3][1]),
    ]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, "q") for r in rows], SCHEMA)


def whole(v):
    return [max(-LONGEST - 1, min(LONGEST, math.floor(64 * x))) for x in v]


def brute(rows, k=16, rounds=3, dims=8):
    kept = [
        (i, whole(v))
        for i, v in rows
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
    ]

    def place(row):
        digest = None if row[0] is None else hashlib.sha256(f"1:{row[0]}".encode()).hexdigest()
        return digest is None, digest or "", row[1]

    centres = [v for _, v in sorted(kept, key=place)[:k]]

    def assign():
        return [
            min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centres))
            for _, v in kept
        ]

    for _ in range(rounds if kept else 0):
        mine = assign()
        for n in range(len(centres)):
            inside = [v for (_, v), (_, m) in zip(kept, mine) if m == n]
            if inside:
                centres[n] = [sum(column) // len(inside) for column in zip(*inside)]
    out = []
    if kept:
        mine = [(min(d, LONGEST), n) for d, n in assign()]
        whole_sum = min(LONGEST, sum(d for d, _ in mine))
        for (i, _), (d, n) in zip(kept, mine):
            own = min(LONGEST, sum(e for e, m in mine if m == n))
            digest = hashlib.sha256(",".join(map(str, centres[n])).encode()).hexdigest()
            out.append((i, n, d, own, whole_sum, digest))
    return sorted(out, key=repr)


def found(df, **options):
    return sorted(map(tuple, centroids.clusters(df, dims=8, **options).collect()), key=repr)


def test_equals_brute_force(spark):
    rows = rows_of()
    assert found(frame(spark, rows)) == brute(rows)


def test_fewer_vectors_than_clusters(spark):
    rows = rows_of(1)[:5]
    assert found(frame(spark, rows)) == brute(rows)


def test_only_copies(spark):
    """All but the first centroid stay empty, and stay where they are."""
    rows = [(i, [0.25] * 8) for i in range(300)]
    assert found(frame(spark, rows)) == brute(rows)
    assert {r[1] for r in found(frame(spark, rows))} == {0}


@pytest.mark.parametrize("size", [1e6, 3e8, 1e17, 1e300])
def test_large_components(spark, size):
    draw = np.random.default_rng(2)
    rows = [(i, (draw.normal(0, size, 8)).tolist()) for i in range(60)]
    assert found(frame(spark, rows), k=4, rounds=2) == brute(rows, 4, 2)


def test_empty_table(spark):
    assert found(frame(spark, [])) == []
    assert found(frame(spark, [(1, None)])) == []


def test_other_columns_take_no_part(spark):
    rows = rows_of(3)
    df = frame(spark, rows)
    assert found(df.select("embedding", "vec_id")) == found(df.withColumn("place", F.lit(1)))


def test_sign_tests_find_the_nearest():
    draw = np.random.default_rng(4)
    centres = draw.integers(-3, 4, (9, 3)).tolist() + [[1, 1, 1], [1, 1, 1]]
    x = draw.integers(-4, 5, (2000, 3))
    winner, distance = centroids.Tournament(centres).assign(x)
    apart = ((x[:, None, :] - np.array(centres)[None]) ** 2).sum(axis=2)
    assert (winner == apart.argmin(axis=1)).all() and (distance == apart.min(axis=1)).all()
