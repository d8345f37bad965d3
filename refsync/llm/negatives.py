"""Hard negatives by a secondary sort.

A positive of an anchor opens a window of scores below its own; negatives in
the window are hard. Pair scores are packed into keys of anchor, descending
score, positive before negative, and id, whose bytes sort in that order. The
keys are dealt out by anchor and sorted within the partitions, which is what
``repartitionAndSortWithinPartitions`` does on pairs. A task then reads its
keys as one stream: a positive opens its window, a negative goes to every
window it lies in, and nothing of an anchor is kept but its few windows.

Scores come from a grid of row blocks and anchor blocks, both bounded in bytes;
each pair of blocks meets in a group of its own. A row travels once per block
of anchors, and a block of them holds many thousand. Before anything is sorted
a meeting drops what cannot be in the result. First each hands on its best
positives only, from which the windows of every anchor follow; then its best
negatives of each window. So the sort gets at most ``k * positives`` keys an
anchor from each block of rows.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from refsync.llm.centroids import LONGEST, largest, whole_matrix, whole_numbers
from refsync.llm.common import materialize, python_tasks

# Bytes of a block, components counted as 8 each.
ROW_BLOCK = 8 << 20
ANCHOR_BLOCK = 32 << 20
# Anchors whose scores with a block of rows are held at a time.
TILE = 128
# Of a positive's score, in hundredths.
LOWEST, HIGHEST = 30, 90

_SIDE = "dims int, block int, n int, facts binary, body binary"
_PAIR = "anchor long, anchor_id long, score long, negative boolean, id long, place long"
_KEY = struct.Struct(">QQ?QQ")
_LIFT = 1 << 63
_FEWEST = -LONGEST


def key_of(anchor: int, score: int, negative: bool, vec_id: int, place: int) -> bytes:
    """Bytes that sort by anchor, score from the highest, positives first, id and place."""
    return _KEY.pack(anchor + _LIFT, LONGEST - score, negative, vec_id + _LIFT, place + _LIFT)


def parts_of(key: bytes) -> tuple[int, int, bool, int]:
    """Anchor, score, whether negative, and id."""
    anchor, score, negative, vec_id, _ = _KEY.unpack(key)
    return anchor - _LIFT, LONGEST - score, negative, vec_id - _LIFT


def window(score: int, lowest: int = LOWEST, highest: int = HIGHEST) -> tuple[int, int]:
    """The least and the largest whole score from ``lowest`` to ``highest`` hundredths."""
    return -(-lowest * score // 100), highest * score // 100


def products(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products of integer vectors, exact; beyond 64 bits the nearest long."""
    bound = max(1, anchors.shape[1]) * largest(anchors) * largest(rows)
    if bound < 1 << 53:
        return (anchors.astype(np.float64) @ rows.T.astype(np.float64)).astype(np.int64)
    if bound < LONGEST:
        return anchors @ rows.T
    exact = anchors.astype(object) @ rows.T.astype(object)
    return np.clip(exact, _FEWEST, LONGEST).astype(np.int64)


def best(scores: np.ndarray, valid: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Line and column of each line's ``k`` highest valid scores, ties to smaller columns."""
    masked = np.where(valid, scores, _FEWEST - 1)
    width = masked.shape[1]
    if width > k:
        bar = np.partition(masked, width - k, axis=1)[:, width - k]
        valid = valid & (masked >= bar[:, None])
    line, column = np.nonzero(valid)
    order = np.lexsort((column, -scores[line, column], line))
    line, column = line[order], column[order]
    kept = np.arange(len(line)) - np.searchsorted(line, line, side="left") < k
    return line[kept], column[kept]


class _Side:
    """A block: ids, places, labels, windows if it has any, and vectors."""

    def __init__(self, table: pa.Table):
        n, dims = table.column("n")[0].as_py(), table.column("dims")[0].as_py()
        facts = np.frombuffer(table.column("facts")[0].as_py(), np.int64).reshape(-1, n)
        self.ids, self.places, self.labels = facts[:3]
        self.windows = facts[3:]
        body = table.column("body")[0].as_py()
        kind = np.dtype(f"i{body[0]}")
        self.vectors = np.frombuffer(body, kind, offset=1).reshape(n, dims).astype(np.int64)


def _gathered(rows: DataFrame, blocks: int) -> DataFrame:
    """One row per block; ``bounds``, if there are any, become its windows."""
    windows = "bounds" in rows.columns

    def block(group: pa.Table) -> pa.Table:
        group = group.sort_by([("id", "ascending"), ("place", "ascending")])
        dims = group.column("dims")[0].as_py()
        vectors = whole_matrix(group.column("q").combine_chunks(), dims)
        width = next(w for w in (1, 2, 4, 8) if largest(vectors) < 1 << (8 * w - 1) or w == 8)
        facts = [group.column(name).to_numpy().astype(np.int64) for name in ("id", "place", "label")]
        if windows:
            facts += list(np.array(group.column("bounds").to_pylist(), np.int64).T)
        return pa.table(
            {
                "dims": pa.array([dims], pa.int32()),
                "block": pa.array([group.column("block")[0].as_py()], pa.int32()),
                "n": pa.array([group.num_rows], pa.int32()),
                "facts": pa.array([np.stack(facts).tobytes()], pa.binary()),
                "body": pa.array([bytes([width]) + vectors.astype(f"i{width}").tobytes()], pa.binary()),
            }
        )

    return (
        rows.withColumn("block", F.pmod(F.xxhash64("place"), F.lit(blocks)).cast("int"))
        .groupBy("dims", "block")
        .applyInArrow(block, _SIDE)
    )


def _blocks(components: int, size: int) -> int:
    return max(1, -(-8 * components // size))


def _pairs(anchors: _Side, at: np.ndarray, rows: _Side, column, score, negative: bool) -> pa.Table:
    n = len(at)
    columns = [
        anchors.places[at], anchors.ids[at], score, np.full(n, negative), rows.ids[column],
        rows.places[column],
    ]
    return pa.table([pa.array(c) for c in columns], [p.split()[0] for p in _PAIR.split(", ")])


def _met(left: DataFrame, right: DataFrame, grid: tuple[int, int], choose) -> DataFrame:
    """``choose(anchors, rows, tile, scores)`` of every pair of blocks, as ``_PAIR``."""

    def times(blocks: DataFrame, others: int) -> DataFrame:
        return blocks.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(others - 1))))

    def meet(these: pa.Table, those: pa.Table) -> pa.Table:
        found = []
        if these.num_rows and those.num_rows:
            rows, anchors = _Side(these), _Side(those)
            for start in range(0, len(anchors.ids), TILE):
                tile = np.arange(start, min(start + TILE, len(anchors.ids)))
                scores = products(anchors.vectors[tile], rows.vectors)
                found.append(choose(anchors, rows, tile, scores))
        none = np.empty(0, np.int64)
        empty = pa.table(
            [pa.array(none)] * 3 + [pa.array(none.astype(bool))] + [pa.array(none)] * 2,
            [p.split()[0] for p in _PAIR.split(", ")],
        )
        return pa.concat_tables([empty, *found])

    left = times(left, grid[1])
    right = times(right, grid[0]).select(
        "dims", F.col("other").alias("block"), F.col("block").alias("other"), "n", "facts", "body"
    )
    on = ["dims", "block", "other"]
    return left.groupBy(*on).cogroup(right.groupBy(*on)).applyInArrow(meet, _PAIR)


def streamed(keys: Iterator[tuple[bytes, int]], k: int, lowest: int, highest: int) -> Iterator[tuple]:
    """Read sorted keys with their anchors' ids; emit each positive's first ``k`` negatives.

    What is kept is the open windows of one anchor.
    """
    now, open_ = None, []
    for key, anchor_id in keys:
        anchor, score, negative, vec_id = parts_of(key)
        if anchor != now:
            now, open_ = anchor, []
        if not negative:
            open_.append([vec_id, score, *window(score, lowest, highest), 0])
            continue
        for positive in open_:
            if positive[4] < k and positive[2] <= score <= positive[3]:
                positive[4] += 1
                yield anchor_id, positive[0], positive[4], vec_id, positive[1], score


def hard_negatives(
    vectors: DataFrame,
    k: int = 10,
    positives: int = 5,
    every: int = 100,
    factor: float = 256.0,
    lowest: int = LOWEST,
    highest: int = HIGHEST,
    relabel: int | None = 7,
    labels: int = 10,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """For each anchor and positive the ``k`` highest negatives within the window.

    Components become ``floor(factor * x)``; a score is the integer inner
    product. Anchors are the rows whose id ``every`` divides; an anchor's
    positives are the first ``positives`` other rows of its label, by score and
    smaller id. Negatives are rows of another label that score from ``lowest``
    to ``highest`` hundredths of the positive. Where ``relabel`` divides the id,
    ``(label + 1) % labels`` takes the label's place first. Returns
    ``anchor_id``, ``positive_id``, ``rank`` from 1, ``negative_id``,
    ``positive_score`` and ``negative_score``.

    Rows without an id, a label or a vector, or with a null or non-finite
    component, take no part. A row is never its own positive; another row with
    the same id may be. Repeated rows count as often as they are there, as
    anchors too. Vectors meet those with as many components. A positive below
    zero has an empty window. Components and scores beyond 64 bits count as the
    nearest long. Other columns, whatever their names, take no part. An empty
    table, or an anchor without positives, gives no row.
    """
    spark = vectors.sparkSession
    python_tasks(spark)
    vec = F.col(vector).cast("array<double>")
    finite = F.forall(
        vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    own = F.col(label).cast("long")
    if relabel:
        turned = F.col(key).cast("long") % relabel == 0
        own = F.when(turned, (own + 1) % labels).otherwise(own)
    # Written once, so that places stay what they are.
    rows = materialize(
        vectors.where(
            F.col(key).cast("long").isNotNull() & F.col(label).isNotNull() & vec.isNotNull() & finite
        ).select(
            F.monotonically_increasing_id().alias("place"),
            F.col(key).cast("long").alias("id"),
            own.alias("label"),
            F.size(vec).alias("dims"),
            whole_numbers(vec, factor).alias("q"),
        ),
        "rows",
    )
    is_anchor = F.col("id") % every == 0
    components = F.greatest("dims", F.lit(1)).cast("long")
    sizes = rows.agg(
        F.coalesce(F.sum(components), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(is_anchor, components)), F.lit(0)).alias("anchors"),
    ).first()
    anchors = rows.where(is_anchor)
    grid = _blocks(sizes["rows"], ROW_BLOCK), _blocks(sizes["anchors"], ANCHOR_BLOCK)
    # Read by both meetings.
    left = materialize(_gathered(rows, grid[0]), "row-blocks")

    def nearest_positives(anchor_side, row_side, tile, scores):
        valid = anchor_side.labels[tile][:, None] == row_side.labels
        valid &= anchor_side.places[tile][:, None] != row_side.places
        line, column = best(scores, valid, positives)
        return _pairs(anchor_side, tile[line], row_side, column, scores[line, column], False)

    found = _met(left, _gathered(anchors, grid[1]), grid, nearest_positives)
    first = Window.partitionBy("anchor").orderBy(F.desc("score"), "id", "place")
    opened = materialize(
        found.withColumn("n", F.row_number().over(first)).where(F.col("n") <= positives).drop("n"),
        "positives",
    )
    # Missing positives get a window that holds nothing.
    bounds = opened.groupBy("anchor").agg(F.sort_array(F.collect_list("score")).alias("found"))
    spare = F.array_repeat(F.lit(-1).cast("long"), positives)
    windowed = anchors.join(bounds, F.col("place") == F.col("anchor")).withColumn(
        "bounds", F.slice(F.concat("found", spare), 1, positives)
    )

    def nearest_negatives(anchor_side, row_side, tile, scores):
        other = anchor_side.labels[tile][:, None] != row_side.labels
        kept = np.zeros(scores.shape, bool)
        for scored in anchor_side.windows[:, tile]:
            limits = np.array([window(int(s), lowest, highest) for s in scored], np.int64)
            inside = other & (scores >= limits[:, :1]) & (scores <= limits[:, 1:])
            kept[best(scores, inside, k)] = True
        line, column = np.nonzero(kept)
        return _pairs(anchor_side, tile[line], row_side, column, scores[line, column], True)

    windowed = windowed.select(*anchors.columns, "bounds")
    hard = _met(left, _gathered(windowed, grid[1]), grid, nearest_negatives)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = ("anchor", "score", "negative", "id", "place")
            packed = map(key_of, *(batch.column(name).to_pylist() for name in names))
            yield pa.RecordBatch.from_arrays(
                [batch.column("anchor"), pa.array(packed, pa.binary()), batch.column("anchor_id")],
                ["anchor", "key", "anchor_id"],
            )

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = (
            pair
            for batch in batches
            for pair in zip(
                batch.column("key").to_pylist(), batch.column("anchor_id").to_pylist(), strict=True
            )
        )
        ready: list[tuple] = []
        for row in streamed(keys, k, lowest, highest):
            ready.append(row)
            if len(ready) == 10_000:
                yield _emitted(ready)
                ready = []
        yield _emitted(ready)

    keys = opened.unionByName(hard).mapInArrow(pack, "anchor long, key binary, anchor_id long")
    return keys.repartition("anchor").sortWithinPartitions("key").mapInArrow(emit, _EMITTED)


_EMITTED = (
    "anchor_id long, positive_id long, rank int, negative_id long, positive_score long,"
    " negative_score long"
)


def _emitted(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * 6
    kinds = [pa.int32() if part.split()[1] == "int" else pa.int64() for part in _EMITTED.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
        [part.split()[0] for part in _EMITTED.split(", ")],
    )

