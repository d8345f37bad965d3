"""Exact top-k search with a bit-sliced index.

Components are quantised to integers. Of a block of rows the index holds one
bitmap per component and binary digit. A query's scores for the whole block
are sums of such bitmaps, shifted by the digits of the query's components and
added with full adders, so that the result is again one bitmap per digit.
The best rows are then picked from the most significant digit downwards; rows
that remain equal in every digit at the boundary are taken in order of id.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from refsync.llm.blocks import nearest_rows, usable_vectors

ROW_BLOCK = 65_536
QUERY_BLOCK = (24, 64, 4096)
LONGEST = (1 << 63) - 1


def quantised(vectors: np.ndarray, factor: float) -> np.ndarray:
    """``floor(factor * x)``, at the limits of a long beyond them."""
    with np.errstate(over="ignore"):
        whole = np.floor(vectors * factor)
    high = whole >= 2.0**63
    found = np.where(high, 0.0, np.maximum(whole, -(2.0**63))).astype(np.int64)
    found[high] = LONGEST
    return found


def slices(values: np.ndarray) -> bytes:
    """Lowest value, number of digits, and the bitmaps of (component, digit)."""
    rows, dims = values.shape
    low = int(values.min()) if values.size else 0
    lifted = values.astype(np.uint64) - np.uint64(low % (1 << 64))
    digits = max(1, int(lifted.max()).bit_length()) if values.size else 1
    words = -(-rows // 64)
    maps = np.zeros((dims, digits, words * 8), np.uint8)
    for digit in range(digits):
        bits = ((lifted >> np.uint64(digit)) & np.uint64(1)).astype(np.uint8).T
        packed = np.packbits(bits, axis=1, bitorder="little")
        maps[:, digit, : packed.shape[1]] = packed
    return np.array([low, digits], np.int64).tobytes() + maps.tobytes()


class Adder:
    """Adds bitmaps by weight; three of a weight become one and a carry."""

    def __init__(self, words: int):
        self.words = words
        self.free: list[np.ndarray] = []
        self.waiting: list[list[tuple[np.ndarray, bool]]] = []

    def _new(self) -> np.ndarray:
        return self.free.pop() if self.free else np.empty(self.words, np.uint64)

    def add(self, weight: int, bitmap: np.ndarray, own: bool = False) -> None:
        while True:
            while len(self.waiting) <= weight:
                self.waiting.append([])
            here = self.waiting[weight]
            here.append((bitmap, own))
            if len(here) < 3:
                return
            (a, own_a), (b, own_b), (c, own_c) = here
            half, total, carry = self._new(), self._new(), self._new()
            np.bitwise_xor(a, b, out=half)
            np.bitwise_xor(half, c, out=total)
            np.bitwise_and(a, b, out=carry)
            np.bitwise_and(half, c, out=half)
            np.bitwise_or(carry, half, out=carry)
            self.free.append(half)
            self.free.extend(x for x, mine in here if mine)
            here[:] = [(total, True)]
            weight, bitmap, own = weight + 1, carry, True

    def digits(self) -> list[np.ndarray]:
        """One bitmap per weight."""
        weight = 0
        while weight < len(self.waiting):
            here = self.waiting[weight]
            if len(here) == 2:
                (a, _), (b, _) = here
                total, carry = a ^ b, a & b
                here[:] = [(total, True)]
                self.add(weight + 1, carry, True)
            weight += 1
        zero = np.zeros(self.words, np.uint64)
        return [here[0][0] if here else zero for here in self.waiting]


def ones(rows: int, words: int) -> np.ndarray:
    bits = np.zeros(words * 64, np.uint8)
    bits[:rows] = 1
    return np.packbits(bits, bitorder="little").view(np.uint64)


def positions(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def best(digits: list[np.ndarray], among: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` largest sums; equal ones at the boundary by position."""
    sure, open_ = np.zeros_like(among), among
    missing = k
    for bitmap in reversed(digits):
        high = open_ & bitmap
        count = int(np.bitwise_count(high).sum())
        if count > missing:
            open_ = high
        else:
            sure = sure | high
            missing -= count
            open_ = open_ & ~bitmap
            if not missing:
                return positions(sure)
    return np.concatenate([positions(sure), positions(open_)[:missing]])


def search(rows, queries, k: int) -> list[np.ndarray]:
    """The best ``k`` rows of a block for each query of a block, by integer inner product."""
    low, digits = map(int, np.frombuffer(rows.body, np.int64, 2))
    words = -(-rows.n // 64)
    maps = np.frombuffer(rows.body, np.uint64, offset=16).reshape(rows.dims, digits, words)
    inverse = ~maps
    weights = np.frombuffer(queries.body, np.int64).reshape(queries.n, rows.dims)
    everyone = ones(rows.n, words)
    at = {int(place): i for i, place in enumerate(rows.places)}
    top = (1 << digits) - 1
    out: list[list[np.ndarray]] = []
    for q in range(queries.n):
        adder = Adder(words)
        constant = 0
        for d in range(rows.dims):
            weight = int(weights[q, d])
            if not weight:
                continue
            # w * x = w * (u + low) for w > 0, and |w| * ((top - u) - top - low) for w < 0.
            planes = maps[d] if weight > 0 else inverse[d]
            constant += weight * low if weight > 0 else weight * (low + top)
            weight = abs(weight)
            shift = 0
            while weight:
                if weight & 1:
                    for digit in range(digits):
                        adder.add(shift + digit, planes[digit])
                weight >>= 1
                shift += 1
        summed = adder.digits()
        among = everyone
        own = at.get(int(queries.places[q]))
        if own is not None:
            among = everyone.copy()
            among[own >> 6] &= ~np.uint64(1 << (own & 63))
        picked = best(summed, among, k)
        # The digits say who is best whatever their number; only the score has to fit a long.
        kind = np.int64 if len(summed) < 62 and abs(constant) < 1 << 62 else object
        scores = np.full(len(picked), constant, kind)
        for weight, bitmap in enumerate(summed):
            bit = (bitmap[picked >> 6] >> (picked & 63).astype(np.uint64)) & np.uint64(1)
            scores += bit.astype(kind) * (1 << weight)
        if kind is object:
            scores = np.array([max(-LONGEST - 1, min(LONGEST, n)) for n in scores], np.int64)
        n = len(picked)
        out.append(
            [
                np.full(n, queries.places[q]),
                np.full(n, queries.ids[q]),
                rows.places[picked],
                rows.ids[picked],
                scores,
            ]
        )
    return [np.concatenate(column) for column in zip(*out, strict=True)]


def top_k(
    vectors: DataFrame,
    k: int = 20,
    every: int = 20,
    factor: float = 64.0,
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """The ``k`` rows with the largest integer inner product for each query.

    Components become ``floor(factor * x)``. Queries are the rows whose id
    ``every`` divides; a query's own row is no candidate, another row with the
    same id is. Equal scores go by id. Returns ``query_id``, ``rank`` from 1,
    ``vec_id``, ``score``; fewer candidates give fewer rows.

    Null vectors, vectors with null or non-finite components, and rows without
    an id take no part. Vectors meet those with as many components. Components
    and scores beyond 64 bits count as the nearest long; of rows that share such
    a score the smaller ids come first. Other columns, whatever their names,
    take no part. An empty table gives an empty result.
    """
    usable = usable_vectors(vectors, key, vector)
    return nearest_rows(
        usable,
        every,
        k,
        ROW_BLOCK,
        QUERY_BLOCK,
        lambda rows: slices(quantised(rows, factor)),
        lambda rows: quantised(rows, factor).tobytes(),
        search,
        "long",
    )
