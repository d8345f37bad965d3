"""Joins of records with the tables they refer to."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructType

from refsync.session import materialize

# A side is broadcast only if it was counted and lies within both bounds.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024
# Tables whose files hold more than this are not counted at all.
COUNTED_BYTES = 1024 * 1024 * 1024
# Spark's estimate of a source that tells no size, such as a database.
_NO_ESTIMATE = 1 << 62

_FIXED_WIDTH = 16


def _width(name: str, data_type: DataType) -> Column:
    column = F.col(f"`{name}`")
    if isinstance(data_type, StringType):
        return F.coalesce(F.octet_length(column), F.lit(0)) + _FIXED_WIDTH
    if isinstance(data_type, (ArrayType, MapType, StructType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0)) + _FIXED_WIDTH
    return F.lit(_FIXED_WIDTH)


class Size(NamedTuple):
    rows: int
    bytes: int

    def broadcastable(self) -> bool:
        return self.rows <= BROADCAST_ROWS and self.bytes <= BROADCAST_BYTES


TOO_LARGE = Size(BROADCAST_ROWS + 1, BROADCAST_BYTES + 1)


def _scanned_bytes(frame: DataFrame) -> int:
    """What the sources of a frame hold, by their own statistics; no job runs.

    A remote session does not show its plans, so there nothing is known.
    """
    if not hasattr(frame, "_jdf"):
        return _NO_ESTIMATE
    leaves = frame._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(sizes)


def measured(*frames: DataFrame) -> list[Size]:
    """Rows and bytes of each frame, in one job.

    Counting is a partial aggregate per partition; no rows move. What reads
    more than ``COUNTED_BYTES`` is too large without a look at it, and of a
    source without statistics no more rows are fetched than the bound asks for.
    """
    counts = None
    for index, frame in enumerate(frames):
        scanned = _scanned_bytes(frame)
        if COUNTED_BYTES < scanned < _NO_ESTIMATE:
            continue
        if scanned >= _NO_ESTIMATE:
            frame = frame.limit(BROADCAST_ROWS + 1)
        width = sum((_width(f.name, f.dataType) for f in frame.schema.fields), F.lit(0))
        count = frame.agg(
            F.lit(index).alias("frame"),
            F.count(F.lit(1)).alias("rows"),
            F.coalesce(F.sum(width.cast("long")), F.lit(0)).alias("bytes"),
        )
        counts = count if counts is None else counts.unionAll(count)
    rows = counts.collect() if counts is not None else []
    found = {row["frame"]: Size(row["rows"], row["bytes"]) for row in rows}
    return [found.get(index, TOO_LARGE) for index in range(len(frames))]


def fits_broadcast(*frames: DataFrame) -> list[bool]:
    return [size.broadcastable() for size in measured(*frames)]


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    how: str = "left",
    small: bool | None = None,
) -> DataFrame:
    """Join records with a reference table.

    The reference side is broadcast after a check of its size, so that records
    do not move and a hot key costs nothing. Beyond the bounds both sides are
    shuffled on the key, and the runtime re-plan splits a hot key's partition
    (see ``session.configure``). It can do so only where nothing but the
    shuffle stands between a table and the join. A semi or anti join needs the
    keys on its right once; they are made distinct and written out first.
    """
    if small is None:
        (small,) = fits_broadcast(right)
    if small:
        return left.join(F.broadcast(right), on, how)
    if how in ("left_semi", "left_anti"):
        right = materialize(right.select(on).distinct(), "keys")
    return left.join(right, on, how)
