"""Vectors in blocks: a grid of row blocks and query blocks.

Both sides are gathered into blocks of bounded size, one row each, and every
pair of blocks meets in a group of its own by an equality join on the pair.
The work is that of comparing the query set with all rows; what moves is each
block once per block of the other side.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from refsync.llm.common import materialize, python_tasks

FOUND = "query_place long, query_id long, place long, vec_id long, score {}"
BLOCK = "dims int, block int, n int, ids binary, places binary, body binary"


def usable_vectors(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``place``, ``id``, ``vec`` (doubles) and ``dims`` of the rows that take part.

    Vectors that are null or hold null or non-finite components do not, nor do
    rows without an id, which no result could name. Equal rows keep places of
    their own.
    """
    vec = F.col(vector).cast("array<double>")
    finite = F.forall(
        vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return (
        vectors.select(
            F.monotonically_increasing_id().alias("place"),
            F.col(key).cast("long").alias("id"),
            vec.alias("vec"),
        )
        .where(F.col("id").isNotNull() & F.col("vec").isNotNull() & finite)
        .withColumn("dims", F.size("vec"))
    )


def matrix(group: pa.Table, dtype=np.float64) -> np.ndarray:
    """The vectors of a group, which share their number of components."""
    dims = group.column("dims")[0].as_py()
    values = group.column("vec").combine_chunks()
    if isinstance(values, pa.ChunkedArray):
        values = pa.concat_arrays(values.chunks)
    return values.flatten().to_numpy(zero_copy_only=False).reshape(group.num_rows, dims).astype(dtype)


def gathered(
    rows: DataFrame, total: int, size: int, encode: Callable[[np.ndarray], bytes]
) -> DataFrame:
    """Blocks of about ``size`` rows: ids, places and the encoded vectors, in order of id."""
    blocks = max(1, -(-total // size))

    def block(group: pa.Table) -> pa.Table:
        group = group.sort_by([("id", "ascending"), ("place", "ascending")])
        ids = group.column("id").to_numpy().astype(np.int64)
        places = group.column("place").to_numpy().astype(np.int64)
        return pa.table(
            {
                "dims": pa.array([group.column("dims")[0].as_py()], pa.int32()),
                "block": pa.array([group.column("block")[0].as_py()], pa.int32()),
                "n": pa.array([group.num_rows], pa.int32()),
                "ids": pa.array([ids.tobytes()], pa.binary()),
                "places": pa.array([places.tobytes()], pa.binary()),
                "body": pa.array([encode(matrix(group))], pa.binary()),
            }
        )

    return (
        rows.withColumn("block", F.pmod(F.xxhash64("place"), F.lit(blocks)).cast("int"))
        .groupBy("dims", "block")
        .applyInArrow(block, BLOCK)
    )


def nearest_rows(
    vectors: DataFrame,
    every: int,
    k: int,
    row_block: int,
    query_block: tuple[int, int, int],
    encode_rows: Callable[[np.ndarray], bytes],
    encode_queries: Callable[[np.ndarray], bytes],
    search: Callable[..., list[np.ndarray]],
    score_type: str,
) -> DataFrame:
    """The ``k`` best rows for each query, the rows whose id ``every`` divides.

    ``search(row block, query block, k)`` returns the arrays of ``FOUND`` for a
    pair of blocks. ``query_block`` is the number of query blocks to aim for,
    and the least and largest number of queries in one. A query meets vectors
    of its own number of components.
    """
    spark = vectors.sparkSession
    python_tasks(spark)
    rows = materialize(vectors, "vectors")
    queries = rows.where(F.pmod(F.col("id"), F.lit(every)) == 0)
    counts = rows.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(F.when(F.pmod(F.col("id"), F.lit(every)) == 0, 1)).alias("queries"),
    ).first()
    wanted, least, most = query_block
    per_block = min(most, max(least, -(-counts["queries"] // wanted)))
    row_blocks = max(1, -(-counts["rows"] // row_block))
    query_blocks = max(1, -(-counts["queries"] // per_block))

    def pairs(blocks: DataFrame, others: int) -> DataFrame:
        return blocks.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(others - 1))))

    left = pairs(gathered(rows, counts["rows"], row_block, encode_rows), query_blocks)
    right = pairs(
        gathered(queries, counts["queries"], per_block, encode_queries), row_blocks
    ).select("dims", F.col("other").alias("block"), F.col("block").alias("other"), "n", "ids",
             "places", "body")
    schema = FOUND.format(score_type)
    names = [part.split()[0] for part in schema.split(", ")]

    def meet(these: pa.Table, those: pa.Table) -> pa.Table:
        found = [np.empty(0, np.int64)] * 5
        if these.num_rows and those.num_rows:
            found = search(_block(these), _block(those), k)
        kinds = [pa.int64()] * 4 + [pa.int64() if score_type == "long" else pa.float64()]
        return pa.table([pa.array(a, t) for a, t in zip(found, kinds, strict=True)], names)

    on = ["dims", "block", "other"]
    found = left.groupBy(*on).cogroup(right.groupBy(*on)).applyInArrow(meet, schema)
    best = Window.partitionBy("query_place").orderBy(F.desc("score"), "vec_id", "place")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


class _block:
    """Ids, places and body of a block."""

    def __init__(self, table: pa.Table):
        self.n = table.column("n")[0].as_py()
        self.dims = table.column("dims")[0].as_py()
        self.ids = np.frombuffer(table.column("ids")[0].as_py(), np.int64)
        self.places = np.frombuffer(table.column("places")[0].as_py(), np.int64)
        self.body = table.column("body")[0].as_py()
