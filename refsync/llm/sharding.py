"""Sharding by a hierarchical weighted hash tree.

The law is ``key``: a row's key and the tree decide, nothing else. From the top
a row descends region, rack and shard. At each level every child draws an
exponential waiting time from a hash of the key and the child's own path,
divided by the child's weight; the shortest time wins. A child's chance is its
share of the weights, and its draw does not depend on its siblings. So a
changed weight moves rows only into (raised) or out of (lowered) the subtree
that carries it, and the rest of the tree keeps its rows.

Regions and racks have weights of their own. A shard added to a rack whose
weight stays takes rows from that rack only; ``grown`` adds it as a region of
its own, which takes rows from everywhere, each only into the new shard.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refsync.llm.common import materialize, text_of

# Rows are numbered per shard and bucket; the counts of all buckets are small.
BUCKETS = 1024


@dataclass(frozen=True)
class Node:
    """A region or rack with ``children``, or a shard with a ``number``.

    All shards of a tree lie on the same level.
    """

    path: str
    weight: float
    children: tuple[Node, ...] = ()
    number: int | None = None


def tree(shards: int, racks: int = 4, per_rack: int = 5) -> tuple[Node, ...]:
    """Regions of ``racks`` racks of ``per_rack`` shards; a shard that fills no region has its own.

    Weights are numbers of shards. Growing shard by shard restructures only
    where a region fills up; ``grown`` never does.
    """
    regions = []
    per_region = racks * per_rack
    for region in range(shards // per_region):
        name = f"region{region}"
        inner = []
        for rack in range(racks):
            path = f"{name}/rack{rack}"
            first = region * per_region + rack * per_rack
            leaves = tuple(
                Node(f"{path}/shard{number}", 1.0, number=number)
                for number in range(first, first + per_rack)
            )
            inner.append(Node(path, float(per_rack), leaves))
        regions.append(Node(name, float(per_region), tuple(inner)))
    whole = tuple(regions)
    for number in range(shards // per_region * per_region, shards):
        whole = grown(whole, number)
    return whole


def grown(regions: Sequence[Node], number: int, weight: float = 1.0) -> tuple[Node, ...]:
    """The tree with one more shard, as a region of its own."""
    region = f"single{number}"
    leaf = Node(f"{region}/rack/shard{number}", weight, number=number)
    return (*regions, Node(region, weight, (Node(f"{region}/rack", weight, (leaf,)),)))


def draw(key: Column, path: Column, weight: Column) -> Column:
    """Exponential waiting time of a node for a key."""
    hashed = F.xxhash64(F.concat(key, F.lit("|"), path))
    uniform = (F.shiftrightunsigned(hashed, 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    return -F.log(uniform) / weight


def descend(key: Column, regions: Sequence[Node]) -> Column:
    """Number of the shard that a key reaches, level by level."""
    parents, reached = [Node("", 1.0, tuple(regions))], F.lit(0)
    while parents[0].children:
        below = [child for parent in parents for child in parent.children]
        place = {child.path: i for i, child in enumerate(below)}
        families = F.array(
            *(
                F.array(
                    *(
                        F.struct(
                            F.lit(c.path).alias("path"),
                            F.lit(float(c.weight)).alias("weight"),
                            F.lit(place[c.path]).alias("i"),
                        )
                        for c in parent.children
                    )
                )
                for parent in parents
            )
        )
        times = F.transform(
            F.get(families, reached),
            lambda c: F.struct(draw(key, c["path"], c["weight"]).alias("t"), c["i"].alias("i")),
        )
        reached, parents = F.array_min(times)["i"], below
    return F.get(F.array(*(F.lit(leaf.number) for leaf in parents)), reached)


def shard(
    docs: DataFrame,
    regions: Sequence[Node],
    more: Sequence[Node] | None = None,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Assign every row of ``docs`` to a shard and a slot in it.

    Returns the key, ``size`` (UTF-8 bytes of the text plus 16), ``text_crc32``,
    ``law``, ``shard``, ``slot`` (gapless from 0 in each shard) and
    ``grown_shard``, the shard under the tree ``more``.

    A null key counts as the empty string, a null text as empty; rows with the
    same key share a shard and get slots of their own. Other columns, whatever
    their names, take no part. An empty table gives an empty result.

    Rows are numbered in ``shards x 1024`` groups: a group's start comes from
    the counts of the groups before it, of which there are at most that many.
    Equal keys are spread over the groups by their place in the input. Only
    that place decides the slot between equal rows, so the small table of
    assignments is written out once before it is counted and numbered.
    """
    name = F.coalesce(F.col(key).cast("string"), F.lit(""))
    body = text_of(text)
    assigned = docs.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(body).cast("long") + 16).alias("size"),
        F.crc32(body).alias("text_crc32"),
        name.alias("name"),
        F.monotonically_increasing_id().alias("place"),
    ).select(
        "doc_id",
        "size",
        "text_crc32",
        descend(F.col("name"), regions).cast("int").alias("shard"),
        (descend(F.col("name"), more) if more else F.lit(None)).cast("int").alias("grown_shard"),
        F.pmod(F.xxhash64("name", "place"), F.lit(BUCKETS)).cast("int").alias("bucket"),
        "place",
    )
    assigned = materialize(assigned, "shards")

    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    counts = assigned.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    starts = counts.select(
        "shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    )
    inside = Window.partitionBy("shard", "bucket").orderBy("place")
    # At most shards x BUCKETS rows of 16 bytes: under 64 MB for 4,000 shards.
    return (
        assigned.withColumn("at", F.row_number().over(inside) - 1)
        .join(F.broadcast(starts), ["shard", "bucket"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("key").alias("law"),
            "shard",
            (F.col("start") + F.col("at")).cast("long").alias("slot"),
            "grown_shard",
        )
    )
