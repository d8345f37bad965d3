import math
import zlib
from collections import Counter

import xxhash
from pyspark.sql import functions as F

from refsync.llm import sharding


def reached(key, children):
    """The same descent in plain Python."""
    while True:

        def time(node):
            hashed = xxhash.xxh64_intdigest(f"{key}|{node.path}".encode(), 42)
            return -math.log(((hashed >> 11) + 0.5) / 2**53) / node.weight

        best = min(children, key=time)
        if best.number is not None:
            return best.number
        children = best.children


REGIONS = sharding.tree(40)
MORE = sharding.grown(REGIONS, 40)


def test_awkward_documents(spark, awkward):
    rows = sharding.shard(awkward, REGIONS, MORE).collect()
    texts = sorted(((r.doc_id, r.text or "") for r in awkward.collect()), key=repr)
    found = sorted(((r.doc_id, r["size"], r.text_crc32) for r in rows), key=repr)
    assert found == sorted(
        ((i, len(t.encode()) + 16, zlib.crc32(t.encode())) for i, t in texts), key=repr
    )
    for r in rows:
        name = "" if r.doc_id is None else str(r.doc_id)
        assert (r.shard, r.grown_shard) == (reached(name, REGIONS), reached(name, MORE))


def test_slots_are_gapless_and_the_new_shard_takes_rows_only_into_itself(spark, sample):
    ids = spark.range(3000).withColumnRenamed("id", "doc_id").withColumn("text", F.lit("t"))
    rows = sharding.shard(ids, REGIONS, MORE).collect()
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
        assert r.grown_shard in (r.shard, 40)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) == set(range(40))
    counts = Counter(r.shard for r in rows)
    assert max(counts.values()) < 1.6 * 75 and min(counts.values()) > 0.5 * 75
    assert sum(r.grown_shard == 40 for r in rows) > 30


def test_a_changed_weight_moves_rows_only_in_its_subtree():
    region = REGIONS[0]
    rack = region.children[0]
    heavier = sharding.Node(rack.path, rack.weight * 3, rack.children)
    changed = (
        sharding.Node(region.path, region.weight, (heavier, *region.children[1:])),
        *REGIONS[1:],
    )
    mine = {leaf.number for leaf in rack.children}
    inside = {leaf.number for r in region.children for leaf in r.children}
    for key in range(2000):
        old, new = reached(key, REGIONS), reached(key, changed)
        if old != new:
            assert new in mine and old in inside


def test_empty_table(spark, nothing):
    assert sharding.shard(nothing, REGIONS, MORE).collect() == []
