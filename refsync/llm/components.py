"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refsync.llm.common import materialize


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` for every node of ``links`` (columns ``a``, ``b``).

    In each round a node joins the neighbour that comes first in an order drawn
    anew for the round, and links are redrawn between the nodes that are left.
    A random order shrinks chains by a constant share per round, so the rounds
    grow with the logarithm of the longest one. Neighbours are compared by an
    aggregate that combines on the map side, and the two lookups are joins of
    stored tables, whose hot keys the re-plan splits. Every round is a written
    table, so a lost executor costs one round at most.
    """
    both = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = materialize(both.where(F.col("a") != F.col("b")).distinct(), "links")
    rounds: list[DataFrame] = []
    while not edges.isEmpty():
        drawn = len(rounds)
        first = F.min(F.struct(F.xxhash64("b", F.lit(drawn)).alias("h"), F.col("b").alias("b")))
        own = F.struct(F.xxhash64("a", F.lit(drawn)).alias("h"), F.col("a").alias("b"))
        joined = edges.groupBy("a").agg(first.alias("first"))
        parents = materialize(
            joined.select(
                F.col("a").alias("node"), F.least(own, F.col("first"))["b"].alias("root")
            ),
            "parents",
        )
        rounds.append(parents)
        edges = materialize(
            edges.join(parents.toDF("a", "pa"), "a")
            .select("b", "pa")
            .join(parents.toDF("b", "pb"), "b")
            .where("pa != pb")
            .select(F.col("pa").alias("a"), F.col("pb").alias("b"))
            .distinct(),
            "links",
        )
    if not rounds:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root")).limit(0)
    # From the last round back: the root of a node is that of the node it joined.
    roots = rounds.pop()
    while rounds:
        later = roots.toDF("root", "last")
        roots = materialize(
            rounds.pop().join(later, "root", "left").select(
                "node", F.coalesce("last", "root").alias("root")
            ),
            "roots",
        )
    return roots
