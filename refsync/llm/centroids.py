"""Clustering by centroids, each vector assigned in a tournament of bisectors.

Between two centroids lies the plane of points that are equally near to both.
With integer components, x is nearer to c_j than to c_i exactly if
2 x.(c_j - c_i) > |c_j|^2 - |c_i|^2. The normals 2 (c_j - c_i) and thresholds
of all pairs are computed once a round. A vector then needs one sign test per
further centroid: the centroid that has won so far meets the next one, the
loser is out, and zero favours the smaller number. Only the distance to the
winner is computed.

A round adds up its vectors within the tasks; what comes to the driver is one
sum per centroid and component, whatever the number of vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refsync.llm.common import materialize, python_tasks

CLUSTERS = 16
ROUNDS = 3
LONGEST = (1 << 63) - 1


def whole_numbers(vec, factor: float):
    """``floor(factor * x)`` of every component, at the limits of a long beyond them."""
    return F.transform(vec, lambda x: F.floor(x * F.lit(factor)).cast("long"))


def whole_matrix(column: pa.Array, dims: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(column), dims)


def largest(values: np.ndarray) -> int:
    """The largest magnitude."""
    return max(abs(int(values.max())), abs(int(values.min()))) if values.size else 0


class Tournament:
    """The bisecting planes of all pairs of centroids."""

    def __init__(self, centroids: list[list[int]]):
        exact = np.array(centroids, object).reshape(len(centroids), -1)
        lengths = (exact * exact).sum(axis=1)
        normals = 2 * (exact[None, :, :] - exact[:, None, :])
        thresholds = lengths[None, :] - lengths[:, None]
        self.largest = max((abs(int(c)) for row in centroids for c in row), default=0)
        self.small = self._fits(0, exact.shape[1])
        kind = np.int64 if self.small else object
        self.exact, self.exact_planes = exact, (normals, thresholds)
        self.centroids = exact.astype(kind)
        self.normals, self.thresholds = normals.astype(kind), thresholds.astype(kind)

    def _fits(self, most: int, dims: int) -> bool:
        """Whether tests and distances of components up to ``most`` stay in 64 bits."""
        widest = max(most, self.largest)
        return max(1, dims) * (2 * widest) ** 2 * 2 < LONGEST

    def assign(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroid and the squared distance, which ends at the limit of a long."""
        small = self.small and self._fits(largest(vectors), vectors.shape[1])
        if small:
            x, normals, thresholds, centroids = (
                vectors, self.normals, self.thresholds, self.centroids
            )
        else:
            x, centroids = vectors.astype(object), self.exact
            normals, thresholds = self.exact_planes
        winner = np.zeros(len(x), np.int64)
        for challenger in range(1, len(centroids)):
            side = (x * normals[winner, challenger]).sum(axis=1) - thresholds[winner, challenger]
            winner[side > 0] = challenger
        apart = x - centroids[winner]
        distance = (apart * apart).sum(axis=1)
        if not small:
            distance = np.array([min(int(d), LONGEST) for d in distance], np.int64)
        return winner, distance


def _sums(kept: DataFrame, centroids: list[list[int]], dims: int) -> dict[tuple[int, int], int]:
    """Per centroid and component the sum of its vectors; component -1 counts them."""
    rounds = Tournament(centroids)
    k = len(centroids)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, dims + 1), object)
        for batch in batches:
            x = whole_matrix(batch.column("q"), dims)
            if largest(x) * max(1, len(x)) > LONGEST:
                x = x.astype(object)
            winner, _ = rounds.assign(whole_matrix(batch.column("q"), dims))
            for cluster in np.unique(winner).tolist():
                mine = x[winner == cluster]
                total[cluster, :dims] += mine.sum(axis=0).astype(object)
                total[cluster, dims] += len(mine)
        used = [c for c in range(k) if total[c, dims]]
        cells = [(c, d) for c in used for d in range(dims + 1)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([c for c, _ in cells], pa.int32()),
                pa.array([d if d < dims else -1 for _, d in cells], pa.int32()),
                pa.array([int(total[c, d]) for c, d in cells], pa.decimal128(38, 0)),
            ],
            ["cluster", "component", "total"],
        )

    # Every task hands on one row per centroid and component, and so does the sum.
    summed = (
        kept.select("q")
        .mapInArrow(add, "cluster int, component int, total decimal(38, 0)")
        .groupBy("cluster", "component")
        .agg(F.sum("total").alias("total"))
    )
    return {(r["cluster"], r["component"]): int(r["total"]) for r in summed.collect()}


def moved(
    centroids: list[list[int]], sums: dict[tuple[int, int], int]
) -> list[list[int]]:
    """The floor of every mean; a centroid without vectors stays."""
    return [
        [sums[cluster, d] // sums[cluster, -1] for d in range(len(centroid))]
        if (cluster, -1) in sums
        else centroid
        for cluster, centroid in enumerate(centroids)
    ]


def digest(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def clusters(
    vectors: DataFrame,
    k: int = CLUSTERS,
    rounds: int = ROUNDS,
    dims: int = 64,
    factor: float = 64.0,
    seed: str = "1",
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """Each vector's cluster after ``rounds`` rounds of moving the centroids.

    Components become ``floor(factor * x)``. The first centroids are the ``k``
    vectors with the smallest SHA-256 of ``<seed>:<key>``, in that order; fewer
    vectors give fewer centroids. Equal digests, of repeated ids, are in order
    of their components. Returns ``vec_id``, ``cluster`` from 0, ``distance``
    (squared), ``cluster_inertia``, ``inertia`` and ``centroid_sha256``, the
    digest of the final centroid's components.

    Vectors that are null, do not have ``dims`` components or hold null or
    non-finite ones are left out. Repeated rows count as often as they are
    there. A row without an id is clustered like any other, but becomes a first
    centroid only if there are not enough with one. Components beyond 64 bits
    count as the nearest long, and so do distances and their sums. Other
    columns, whatever their names, take no part. An empty table gives an empty
    result.
    """
    spark = vectors.sparkSession
    python_tasks(spark)
    vec = F.col(vector).cast("array<double>")
    finite = F.forall(
        vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    kept = materialize(
        vectors.where(vec.isNotNull() & (F.size(vec) == dims) & finite).select(
            F.col(key).alias("vec_id"), whole_numbers(vec, factor).alias("q")
        ),
        "kept",
    )
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = kept.orderBy(name.asc_nulls_last(), "q").limit(k)
    centroids = [[int(x) for x in row["q"]] for row in first.select("q").collect()]
    for _ in range(rounds if centroids else 0):
        centroids = moved(centroids, _sums(kept, centroids, dims))
    last = Tournament(centroids) if centroids else None

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            winner, distance = last.assign(whole_matrix(batch.column("q"), dims))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(winner, pa.int32()), pa.array(distance)],
                ["vec_id", "cluster", "distance"],
            )

    kind = dict(kept.dtypes)["vec_id"]
    assigned = materialize(
        kept.mapInArrow(assign, f"vec_id {kind}, cluster int, distance long"), "assigned"
    )
    inertia = {
        r["cluster"]: int(r["total"])
        for r in assigned.groupBy("cluster")
        .agg(F.sum(F.col("distance").cast("decimal(38, 0)")).alias("total"))
        .collect()
    }
    whole = min(sum(inertia.values()), LONGEST)
    # One row per centroid.
    facts = spark.createDataFrame(
        [
            (c, min(inertia[c], LONGEST), whole, digest(centroids[c]))
            for c in sorted(inertia)
        ],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return assigned.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
