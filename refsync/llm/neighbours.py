"""Nearest neighbours by a block matrix join.

Vectors are quantised to int8 with a scale each. The product of two blocks of
quantised vectors approximates every inner product, and the lengths of what
quantisation cut off bound the error: with x = x' + r and q = q' + s,
|qx - q'x'| <= |s||x| + |q'||r|. Pairs whose upper bound lies below the k-th
lower bound, or below the k-th score already found, are discarded; the others
are computed in double precision and merged in a heap per query. So the result
is exact.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refsync.llm.blocks import nearest_rows, usable_vectors

ROW_BLOCK = 16_384
QUERY_BLOCK = (6, 256, 4096)
TILE = 2048


def quantise(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 vectors, their scales, the lengths of the quantised and of the cut off parts."""
    scale = np.abs(vectors).max(axis=1) / 127.0
    scale[scale == 0] = 1.0
    small = np.rint(vectors / scale[:, None]).astype(np.int8)
    back = small * scale[:, None]
    return small, scale, np.linalg.norm(back, axis=1), np.linalg.norm(vectors - back, axis=1)


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of int8 vectors, exact: their sums stay below 2**24 in single precision."""
    kind = np.float32 if left.shape[1] * 127 * 127 < 1 << 24 else np.float64
    return left.astype(kind) @ right.astype(kind).T


def inner(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products row by row in double precision, component by component in order."""
    total = np.zeros(len(left))
    for d in range(left.shape[1]):
        total += left[:, d] * right[:, d]
    return total


def search(rows, queries, k: int) -> list[np.ndarray]:
    """The best ``k`` rows of a block for each query of a block, by inner product."""
    x = np.frombuffer(rows.body, np.float64).reshape(rows.n, rows.dims)
    q = np.frombuffer(queries.body, np.float64).reshape(queries.n, rows.dims)
    x8, x_scale, _, x_cut = quantise(x)
    q8, q_scale, q_length, q_cut = quantise(q)
    x_length = np.linalg.norm(x, axis=1)
    heaps: list[list[tuple]] = [[] for _ in range(queries.n)]
    floor = np.full(queries.n, -np.inf)
    for start in range(0, rows.n, TILE):
        part = slice(start, min(rows.n, start + TILE))
        near = products(q8, x8[part]).astype(np.float64)
        near *= q_scale[:, None]
        near *= x_scale[part]
        longest = x_length[part].max()
        # The last term covers the rounding of these bounds themselves.
        error = q_cut * longest + q_length * x_cut[part].max() + 1e-9 * q_length * longest + 1e-300
        width = near.shape[1]
        # One more than k, since a query may find its own row.
        if width > k + 1:
            at = width - (k + 1)
            kth = np.partition(near, at, axis=1)[:, at]
            bar = np.maximum(floor, kth - error)
        else:
            bar = floor
        which, column = np.nonzero(near >= (bar - error)[:, None])
        column += start
        other = queries.places[which] != rows.places[column]
        which, column = which[other], column[other]
        if not len(which):
            continue
        exact = inner(q[which], x[column])
        # Rows are in order of id and place, so the position breaks ties.
        order = np.lexsort((column, -exact, which))
        which, column, exact = which[order], column[order], exact[order]
        first = np.searchsorted(which, which, side="left")
        keep = np.arange(len(which)) - first < k
        for i, row, score in zip(
            which[keep].tolist(), column[keep].tolist(), exact[keep].tolist(), strict=True
        ):
            heap = heaps[i]
            if len(heap) < k:
                heapq.heappush(heap, (score, -row))
            else:
                heapq.heappushpop(heap, (score, -row))
            if len(heap) == k:
                floor[i] = heap[0][0]
    found = [(i, -row, score) for i, heap in enumerate(heaps) for score, row in heap]
    which = np.array([f[0] for f in found], np.int64)
    column = np.array([f[1] for f in found], np.int64)
    scores = np.array([f[2] for f in found], np.float64)
    return [
        queries.places[which],
        queries.ids[which],
        rows.places[column],
        rows.ids[column],
        scores,
    ]


def nearest(
    vectors: DataFrame,
    k: int = 20,
    every: int = 20,
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """The ``k`` rows with the largest inner product for each query, in double precision.

    Queries are the rows whose id ``every`` divides; a query's own row is no
    candidate, another row with the same id is. Equal scores go by id. Returns
    ``query_id``, ``rank`` from 1, ``vec_id``, ``score``; fewer candidates give
    fewer rows.

    Vectors that are null, zero or hold null or non-finite components, and rows
    without an id, take no part. Vectors meet those with as many components.
    Other columns, whatever their names, take no part. An empty table gives an
    empty result.
    """
    usable = usable_vectors(vectors, key, vector).where(F.exists("vec", lambda x: x != 0))
    return nearest_rows(
        usable,
        every,
        k,
        ROW_BLOCK,
        QUERY_BLOCK,
        np.ndarray.tobytes,
        np.ndarray.tobytes,
        search,
        "double",
    )
