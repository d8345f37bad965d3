"""Near-duplicates by SimHash and tables of distances to pivots.

A fingerprint holds, per bit, the majority over the hashes of a text's word
shingles. Its Hamming distances to a fixed set of reference fingerprints, the
pivots, are computed once. By the triangle inequality two fingerprints within
``d`` bits differ by at most ``d`` in every one of these distances, so a pair
whose largest difference is above ``d`` is discarded; survivors are verified
bit by bit. For a large ``d`` most pairs would survive; there one pivot keeps
far tiles of long runs apart, and the other pairs are verified at once.

Pairs are only looked for where they can be: fingerprints are cut into
``d + 2`` blocks, of which ``d`` differing bits leave two untouched, so both
fingerprints of a pair agree on some two blocks and meet in the bucket of
these. Equal fingerprints are one node. Buckets too large for a task are cut
into chunks of which every two meet. A task reports what it linked as stars
rather than as pairs; the stars of all tasks give the components.

``one_of_each`` looks for a similarity rather than for a number of bits. It
compares several independent fingerprints, any of which may propose a pair, and
verifies proposed pairs by their shingles.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from refsync.llm.common import free_name, materialize, mix, python_tasks, text_of
from refsync.llm.components import components

WORDS = 4
MAX_BITS = 4
SEED = 42
# Fingerprints that one task compares with each other; larger buckets are cut.
BUCKET = 50_000
PIVOTS = mix(np.arange(1, 17, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
# Rows that a task links at a time; runs up to these lengths are compared by
# shifting them against themselves and by one square table, longer ones by tiles.
CHUNK = 100_000
SHORT_RUN = 16
SQUARE_RUN = 512
TILE = 1024
# Beyond so many bits the pivots let most pairs pass, so all bits are compared at once.
PIVOT_BITS = 6
# Shingles that stand for a text when pairs are verified first: all, if it has fewer.
SKETCH = 400
# Similarities estimated from sketches count if they are so far off, six deviations at
# the least; nearer pairs are verified by all their shingles.
MARGIN = 0.125
# Deviations by which fingerprints of similar texts may lie above the mean, all bits together.
DEVIATIONS = 3.5
# Every so many buckets of a node are taken to connect clusters before the others are.
FIRST_TABLES = 6
# What a task compares of a cluster at a time, and twice that where blocks meet.
CLUSTER_BYTES = 32 << 20
CLUSTER_ROWS = 4096

_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(
    np.int64
)
_COLUMNS = np.arange(8, dtype=np.int64) * 256


def shingle_hashes(text: str, words: int, seed: int = SEED) -> np.ndarray:
    """XXH64 of every shingle of ``words`` words, in order, repeats included.

    A-Z are lower-cased; words lie between spaces and the characters 9 to 13.
    Fewer words make one shingle, none make none.
    """
    import xxhash

    found = text.encode("utf-8", "replace").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    last = ends[words - 1 :].tolist() if len(found) >= words else [len(joined)]
    digest = xxhash.xxh64_intdigest
    return np.array(
        [digest(joined[a:b], seed) for a, b in zip(starts, last, strict=False)], np.uint64
    )


def majority(hashes: np.ndarray) -> int:
    """The bits set in more than half of the hashes; zero if there are none."""
    if not len(hashes):
        return 0
    counts = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 65_536):
        part = hashes[start : start + 65_536].astype("<u8").view(np.uint8).reshape(-1, 8)
        by_byte = np.bincount((part + _COLUMNS).ravel(), minlength=2048).reshape(8, 256)
        counts += (by_byte @ _BYTE_BITS).ravel()
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def _signed(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def sketch(hashes: np.ndarray) -> bytes:
    """The smallest different hashes, of 32 bits each."""
    return np.unique(mix(hashes).astype(np.uint32))[:SKETCH].tobytes()


def alike(a: bytes, b: bytes) -> float:
    """Jaccard similarity of two texts by their sketches; exact if both hold all shingles."""
    x, y = np.frombuffer(a, np.uint32), np.frombuffer(b, np.uint32)
    if not len(x) or not len(y):
        return float(len(x) == len(y))
    union = np.union1d(x, y)
    if max(len(x), len(y)) >= SKETCH:
        union = union[:SKETCH]
    both = np.intersect1d(x, y, assume_unique=True)
    return float(np.isin(union, both, assume_unique=True).mean())


def fingerprints(
    docs: DataFrame,
    keys: dict[str, Column],
    words: int = WORDS,
    count: int = 1,
    sketched: bool = False,
    text: str = "text",
) -> DataFrame:
    """The columns ``keys`` (name to expression), ``node``, ``node1`` ... and ``sketch``.

    ``node`` is the fingerprint; ``count`` - 1 independent ones follow.
    """
    python_tasks(docs.sparkSession)
    body = free_name(keys, "body")
    rows = docs.select(
        *(column.alias(name) for name, column in keys.items()), text_of(text).alias(body)
    )
    names = list(keys)
    made = ["node", *(f"node{i}" for i in range(1, count))]
    fields = [StructField(name, LongType()) for name in made]
    if sketched:
        fields.append(StructField("sketch", BinaryType()))

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = [shingle_hashes(t, words) for t in batch.column(body).to_pylist()]
            columns = [_signed([majority(h) for h in hashes])]
            for i in range(1, count):
                columns.append(_signed([majority(mix(h + np.uint64(i))) for h in hashes]))
            if sketched:
                columns.append(pa.array([sketch(h) for h in hashes], pa.binary()))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in names), *columns],
                [*names, *(f.name for f in fields)],
            )

    return rows.mapInArrow(
        compute, StructType([*(rows.schema[name] for name in names), *fields])
    )


def _blocks(count: int) -> list[tuple[int, int]]:
    """(shift, bits) of ``count`` blocks that cover 64 bits."""
    bounds = [round(i * 64 / count) for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(bounds, bounds[1:], strict=False)]


def bucket_keys(values: np.ndarray, max_bits: int, which: int = 0) -> list[np.ndarray]:
    """For each two of ``max_bits + 2`` blocks, the bucket of every fingerprint."""
    blocks = _blocks(max_bits + 2)
    parts = [
        (values >> np.uint64(shift)) & np.uint64((1 << bits) - 1) for shift, bits in blocks
    ]
    return [
        (np.uint64((which << 56) | (table << 48)) | (parts[i] << np.uint64(blocks[j][1])) | parts[j])
        .view(np.int64)
        for table, (i, j) in enumerate(combinations(range(len(parts)), 2))
    ]


def hubs(roots: np.ndarray, degree: np.ndarray) -> np.ndarray:
    """For every row the row of its component that is linked with most others."""
    order = np.lexsort((np.arange(len(roots)), -degree, roots))
    _, first, back = np.unique(roots[order], return_index=True, return_inverse=True)
    found = np.empty(len(roots), np.int64)
    found[order] = order[first][back]
    return found


def few_pairs(
    values: np.ndarray, labels: np.ndarray, a: np.ndarray, b: np.ndarray, pairs: str
) -> tuple[np.ndarray, np.ndarray]:
    """Of linked rows: each row with the hub of its component, and if ``few`` with its nearest.

    Copies of a text are more alike to it than to each other, and a hub is most
    often that text, whatever part of the copies a bucket holds.
    """
    if not len(a):
        return a, b
    low = a.min()
    span = max(a.max(), b.max()) + 1 - low
    ends, others = np.concatenate([a, b]), np.concatenate([b, a])
    roots = merged(np.arange(span), a - low, b - low)
    hub = hubs(roots, np.bincount(ends - low, minlength=span)) + low
    which = np.unique(ends)
    left, right = [which], [hub[which - low]]
    if pairs == "few":
        apart = np.bitwise_count(values[ends] ^ values[others])
        order = np.lexsort((others, apart, ends))
        which, first = np.unique(ends[order], return_index=True)
        left.append(which)
        right.append(others[order][first])
    x, y = np.concatenate(left), np.concatenate(right)
    off = labels[x] != labels[y]
    return x[off], y[off]


def close_pairs(
    keys: np.ndarray,
    values: np.ndarray,
    max_bits: int,
    labels: np.ndarray | None = None,
    pairs: str = "few",
    words: np.ndarray | None = None,
    total_bits: int = 0,
    touched: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """Rows of equal key and different labels whose values lie within ``max_bits``.

    If there are ``words``, they must lie within ``total_bits`` over all of them.

    ``all`` such pairs, or a ``few`` per row, or of each row and its ``hubs`` only;
    the latter two connect what is linked. Every row that has any such pair, whether it
    is among those returned or not, is set in ``touched``, if that is given.
    """
    if labels is None:
        labels = np.arange(len(keys))
    starts = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1])
    lengths = np.diff(np.concatenate([starts, [len(keys)]]))
    left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    wide = max_bits > PIVOT_BITS
    pivots = PIVOTS[:1] if wide else PIVOTS
    table = np.bitwise_count(values[:, None] ^ pivots).astype(np.int8)

    def verified(a: np.ndarray, b: np.ndarray) -> None:
        near = np.bitwise_count(values[a] ^ values[b]) <= max_bits
        near &= labels[a] != labels[b]
        a, b = a[near], b[near]
        if words is not None:
            near = np.bitwise_count(words[:, a] ^ words[:, b]).sum(axis=0) <= total_bits
            a, b = a[near], b[near]
        if touched is not None:
            touched[a] = touched[b] = True
        if pairs != "all":
            a, b = few_pairs(values, labels, a, b, pairs)
        left.append(a)
        right.append(b)

    none = np.empty(0, np.int64)
    short_a, short_b = [none], [none]
    short = np.repeat(lengths <= SHORT_RUN, lengths)
    room = np.repeat(starts + lengths, lengths) - np.arange(len(keys)) - 1
    for lag in range(1, SHORT_RUN):
        a = np.flatnonzero(short & (room >= lag))
        if not len(a):
            break
        b = a + lag
        for pivot in range(len(pivots)):
            kept = np.abs(table[a, pivot] - table[b, pivot]) <= max_bits
            a, b = a[kept], b[kept]
        short_a.append(a)
        short_b.append(b)
    verified(np.concatenate(short_a), np.concatenate(short_b))
    for start, length in zip(
        starts[lengths > SHORT_RUN].tolist(), lengths[lengths > SHORT_RUN].tolist(), strict=True
    ):
        part = slice(start, start + length)
        run = np.ascontiguousarray(table[part].T)
        if length <= SQUARE_RUN and wide:
            near = _near(values[part], values[part], max_bits)
            a, b = np.divmod(np.flatnonzero(near), length)
            verified(a[a < b] + start, b[a < b] + start)
        elif length <= SQUARE_RUN:
            kept = labels[part][:, None] != labels[part]
            for line in run:
                kept &= _within(line, line, max_bits)
            a, b = np.nonzero(np.triu(kept, 1))
            verified(a + start, b + start)
        else:
            own = None if words is None else words[:, part]
            marks = None if touched is None else touched[part]
            a, b = _long_run(
                values[part], run, max_bits, labels[part], pairs, own, total_bits, marks
            )
            left.append(a + start)
            right.append(b + start)
    return np.concatenate(left), np.concatenate(right)


def _within(rows: np.ndarray, columns: np.ndarray, max_bits: int) -> np.ndarray:
    """Whether the distances to one pivot differ by at most ``max_bits``, for all pairs."""
    return np.abs(rows[:, None] - columns) <= max_bits


def _near(rows: np.ndarray, columns: np.ndarray, max_bits: int) -> np.ndarray:
    """Whether the values differ in at most ``max_bits``, for all pairs."""
    return np.bitwise_count(rows[:, None] ^ columns) <= max_bits


def _long_run(
    values: np.ndarray,
    table: np.ndarray,
    max_bits: int,
    labels: np.ndarray,
    pairs: str,
    words: np.ndarray | None,
    total_bits: int,
    touched: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """Tiles of rows, sorted by the first pivot's distance so that far ones never meet.

    Unless ``all`` pairs count, rows are not compared with those they are connected
    with already, and every row is reported with the hub of its component. For ``touched``
    rows of different labels are compared until both are set.
    """
    order = np.argsort(table[0], kind="stable")
    turned, labels, sorted_ = table[:, order], labels[order], values[order]
    count = len(order)
    roots = np.unique(labels, return_index=True, return_inverse=True)
    roots = roots[1][roots[2]]
    degree = np.zeros(count, np.int64)
    marks = None if touched is None else np.zeros(count, bool)
    left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]

    def open_(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Of rows and columns that broadcast, the pairs which are still to be compared."""
        kept = roots[x] != roots[y]
        if marks is not None:
            kept |= (labels[x] != labels[y]) & ~(marks[x] & marks[y])
        return kept

    for start in range(0, count, TILE):
        rows = np.arange(start, min(start + TILE, count))
        end = int(np.searchsorted(turned[0], turned[0, rows[-1]] + max_bits, "right"))
        for other in range(start, end, TILE):
            columns = np.arange(other, min(other + TILE, end))
            if max_bits > PIVOT_BITS:
                kept = _near(sorted_[rows], sorted_[columns], max_bits)
                # Most often next to none are near; of copies nearly all are, but connected.
                many = np.count_nonzero(kept) > TILE
                if many:
                    kept &= open_(rows[:, None], columns)
                x, y = np.divmod(np.flatnonzero(kept), len(columns))
                x, y = rows[x], columns[y]
                if not many:
                    still = open_(x, y)
                    x, y = x[still], y[still]
            else:
                kept = open_(rows[:, None], columns)
                for line in turned:
                    kept &= _within(line[rows], line[columns], max_bits)
                x, y = np.nonzero(kept)
                x, y = rows[x], columns[y]
                near = np.bitwise_count(sorted_[x] ^ sorted_[y]) <= max_bits
                x, y = x[near], y[near]
            if words is not None:
                apart = np.bitwise_count(words[:, order[x]] ^ words[:, order[y]]).sum(axis=0)
                x, y = x[apart <= total_bits], y[apart <= total_bits]
            if marks is not None:
                marks[x] = marks[y] = True
                if pairs != "all":
                    apart = roots[x] != roots[y]
                    x, y = x[apart], y[apart]
            if pairs == "all":
                left.append(x)
                right.append(y)
            elif len(x):
                degree += np.bincount(x, minlength=count) + np.bincount(y, minlength=count)
                if pairs == "few":
                    for ends, others in ((x, y), (y, x)):
                        which, first = np.unique(ends, return_index=True)
                        left.append(which)
                        right.append(others[first])
                roots = merged(roots, x, y)
    if pairs != "all":
        left.append(np.arange(count))
        right.append(hubs(roots, degree))
    if touched is not None:
        touched[order] |= marks
    a, b = np.concatenate(left), np.concatenate(right)
    off = labels[a] != labels[b]
    return order[a[off]], order[b[off]]


def merged(roots: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest row of every row's component, after linking ``a`` with ``b``."""
    roots = roots.copy()
    while True:
        x, y = roots[a], roots[b]
        if (x == y).all():
            return roots
        low = np.minimum(x, y)
        np.minimum.at(roots, x, low)
        np.minimum.at(roots, y, low)
        while True:
            higher = roots[roots]
            if (higher == roots).all():
                break
            roots = higher


def links(
    nodes: DataFrame,
    columns: list[str],
    max_bits: int,
    pairs: str = "stars",
    bucket: int = BUCKET,
    total_bits: int = 0,
    tables: slice = slice(None),
) -> DataFrame:
    """Pairs (``a``, ``b``) of ``node`` that are within ``max_bits`` in one of ``columns``.

    Of several columns, the first of which is ``node``, the pairs must be within
    ``total_bits`` over all as well.

    As ``pairs`` either ``stars``, the least that connects what a task has linked, and if
    nodes have a ``label`` the least that connects the labels, which then are returned;
    or each node with the ``hubs`` of its buckets, or a ``few`` for every node, or
    ``all``, and then only those whose ``label`` differs, which nodes must have.
    With ``hubs`` or ``few`` a node that has such a pair, but none among those
    reported, is reported with itself. ``tables`` takes some of the buckets only.
    """
    extra = ["label"] if pairs != "stars" or "label" in nodes.columns else []
    fields = [*columns, *extra]
    kinds = ", ".join(f"{name} long" for name in fields)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for which, name in enumerate(columns):
                column = batch.column(name)
                values = column.to_numpy().astype(np.int64).view(np.uint64)
                others = [batch.column(other) for other in fields]
                for keys in bucket_keys(values, max_bits, which)[tables]:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys), *others], ["key", *fields]
                    )

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The keys of many nodes with their number of rows, as buckets are far fewer than rows."""

        def report(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            for which, values in enumerate(np.concatenate(parts, axis=1).view(np.uint64)):
                for keys in bucket_keys(values, max_bits, which)[tables]:
                    found, rows = np.unique(keys, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(found), pa.array(rows)], ["key", "rows"]
                    )

        waiting, rows = [], 0
        for batch in batches:
            waiting.append(np.stack([c.to_numpy().astype(np.int64) for c in batch.columns]))
            rows += batch.num_rows
            if rows >= CHUNK:
                yield from report(waiting)
                waiting, rows = [], 0
        if rows:
            yield from report(waiting)

    spread_out = nodes.select(*fields).mapInArrow(
        spread, f"key long, {kinds}"
    )
    hot = materialize(
        nodes.select(*columns)
        .mapInArrow(counted, "key long, rows long")
        .groupBy("key")
        .agg(F.sum("rows").alias("count"))
        .where(F.col("count") > bucket)
        .select("key", F.ceil(F.col("count") * 2 / bucket).cast("int").alias("chunks")),
        "hot-buckets",
    )
    if hot.isEmpty():
        tiled = spread_out.withColumn("tile", F.lit(0).cast("long"))
    else:
        # A node of a cut bucket goes to the tiles of its chunk with every chunk.
        own = F.pmod(F.xxhash64("node"), F.col("chunks"))
        others = F.when(F.col("chunks").isNull(), F.array(F.lit(None).cast("int"))).otherwise(
            F.sequence(F.lit(0), F.col("chunks") - 1)
        )
        tile = F.least("own", "other") * F.lit(1 << 31) + F.greatest("own", "other")
        tiled = (
            spread_out.join(hot, "key", "left")
            .select("key", *fields, own.alias("own"), F.explode(others).alias("other"))
            .withColumn("tile", F.when(F.col("other").isNull(), F.lit(0)).otherwise(tile))
            .select("key", *fields, F.col("tile").cast("long").alias("tile"))
        )

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def report(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            key, tile, *rest = np.concatenate(parts, axis=1)
            words, node = np.stack(rest[: len(columns)]).view(np.uint64), rest[0]
            value = words[key >> 56, np.arange(len(key))]
            # Rows come sorted, so a change of key or tile is a new run.
            runs = np.zeros(len(key), np.int64)
            runs[1:] = np.cumsum((np.diff(key) != 0) | (np.diff(tile) != 0))
            known = rest[-1] if extra else None
            kind = "hubs" if pairs == "stars" else pairs
            several = words if len(columns) > 1 else None
            touched = np.zeros(len(key), bool) if pairs in ("hubs", "few") else None
            a, b = close_pairs(runs, value, max_bits, known, kind, several, total_bits, touched)
            if pairs == "stars" and len(a):
                roots = merged(np.arange(len(node)), a, b)
                a = np.flatnonzero(roots != np.arange(len(node)))
                b = roots[a]
            named = known if extra and pairs == "stars" else node
            ends = np.sort(np.stack([named[a], named[b]]), axis=0)
            ends = ends[:, ends[0] != ends[1]]
            if touched is not None:
                alone = np.setdiff1d(node[touched], ends)
                ends = np.concatenate([ends, np.stack([alone, alone])], axis=1)
            if ends.shape[1]:
                ends = np.unique(ends, axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ends[0]), pa.array(ends[1])], ["a", "b"]
                )

        waiting: list[np.ndarray] = []
        rows = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            part = np.stack(
                [batch.column(name).to_numpy() for name in ("key", "tile", *fields)]
            )
            changes = np.flatnonzero((np.diff(part[:2], axis=1) != 0).any(axis=0)) + 1
            cut = int(changes[-1]) if len(changes) else 0
            new_run = bool(waiting) and bool((waiting[-1][:2, -1] != part[:2, 0]).any())
            if rows >= CHUNK and (cut or new_run):
                if cut:
                    waiting.append(part[:, :cut])
                yield from report(waiting)
                waiting, rows = [part[:, cut:]], part.shape[1] - cut
            else:
                waiting.append(part)
                rows += part.shape[1]
        if waiting:
            yield from report(waiting)

    # The first row of a star is its centre; in order of label stars share their centres.
    order = ["label", "node"] if extra and pairs == "stars" else ["node"]
    return (
        tiled.repartition("key", "tile")
        .sortWithinPartitions("key", "tile", *order)
        .mapInArrow(link, "a long, b long")
    )


def settled(a: bytes, b: bytes, similarity: float) -> bool | None:
    """Whether two texts are at least so similar, or null if their sketches leave it open."""
    found = alike(a, b)
    whole = 4 * SKETCH
    if max(len(a), len(b)) >= whole and abs(found - similarity) < MARGIN:
        return None
    return found >= similarity


def shingle_sets(texts: DataFrame, words: int) -> DataFrame:
    """``node`` and all the different ``shingles`` of one text of each node (``node``, ``body``)."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [
                np.unique(shingle_hashes(t, words)).tobytes()
                for t in batch.column("body").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array(sets, pa.binary())], ["node", "shingles"]
            )

    return texts.select("node", "body").mapInArrow(compute, "node long, shingles binary")


def jaccard(a: bytes, b: bytes) -> float:
    """Similarity of two texts by all their shingles."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / max(1, len(x) + len(y) - both)


def similar_pairs(
    pairs: DataFrame, nodes: DataFrame, similarity: float, texts: DataFrame, words: int
) -> DataFrame:
    """The ``pairs`` whose texts are at least so similar.

    The sketches of ``nodes`` settle most; the others are verified by all shingles of
    their ``texts`` (``identity``, ``body``), of which only theirs are looked up.
    """

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                settled(x, y, similarity)
                for x, y in zip(
                    batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True
                )
            ]
            made = batch.select(["a", "b"]).append_column("similar", pa.array(found, pa.bool_()))
            yield made.filter(pa.array([f is not False for f in found], pa.bool_()))

    def verify_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [
                jaccard(x, y) >= similarity
                for x, y in zip(
                    batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True
                )
            ]
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    def both(rows: DataFrame, known: DataFrame) -> DataFrame:
        return (
            rows.select("a", "b")
            .join(known.toDF("a", "x"), "a")
            .join(known.toDF("b", "y"), "b")
            .select("a", "b", "x", "y")
        )

    found = materialize(
        both(pairs, nodes.select("node", "sketch")).mapInArrow(
            verify, "a long, b long, similar boolean"
        ),
        "settled",
    )
    clear, near = found.where("similar").select("a", "b"), found.where("similar is null")
    if near.isEmpty():
        return clear
    wanted = near.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    named = materialize(
        nodes.join(wanted, "node", "left_semi").select(
            "node", F.col("first.identity").alias("identity")
        ),
        "open-nodes",
    )
    # Rows of one identity have one text; copies meet on the map side.
    sets = shingle_sets(texts.join(named, "identity"), words)
    known = materialize(sets.dropDuplicates(["node"]), "shingles")
    return clear.unionAll(both(near, known).mapInArrow(verify_all, "a long, b long"))


def expected_bits(similarity: float, words: int) -> tuple[float, float]:
    """Mean and deviation of the bits in which ``words`` fingerprints of similar texts differ."""
    cosine = 2 * similarity / (1 + similarity)
    share = np.arccos(cosine) / np.pi
    bits = 64 * words
    return float(bits * share), float(np.sqrt(bits * share * (1 - share)))


def similar_links(
    nodes: DataFrame,
    columns: list[str],
    max_bits: int,
    similarity: float,
    texts: DataFrame,
    words: int,
) -> DataFrame:
    """Verified links that connect all similar texts that are ``max_bits`` apart.

    A large group of near-copies has far more pairs than it takes to connect it.
    So a first pass verifies texts within ``MAX_BITS`` with the hubs of their
    buckets, which connects most copies. What lies within ``max_bits`` is then
    gathered in clusters, see ``cluster_links``, where all pairs that are not
    connected yet are compared and none is written down. Clusters are connected
    by some of the buckets first, so that the others meet few labels.
    """
    mean, deviation = expected_bits(similarity, len(columns))
    total_bits = round(mean + DEVIATIONS * deviation)
    among = nodes.select("node", *columns[1:])
    alone = among.withColumn("label", F.col("node"))
    linked = links(alone, columns, min(MAX_BITS, max_bits), "hubs", total_bits=total_bits)
    proposed = materialize(linked.distinct().where("a != b"), "proposed")
    found = materialize(similar_pairs(proposed, nodes, similarity, texts, words), "similar")
    member = materialize(
        _rooted(alone, components(found)).withColumn("verified", F.col("label")), "labelled"
    )
    for tables in (slice(0, None, FIRST_TABLES), slice(None)):
        near = links(member, columns, max_bits, "stars", total_bits=total_bits, tables=tables)
        member = materialize(
            _rooted(member, components(materialize(near.distinct(), "near"))), "labelled"
        )
    member = member.select(
        "node", *columns[1:], F.col("label").alias("cluster"), F.col("verified").alias("label")
    )
    more = cluster_links(member, nodes, columns, total_bits, similarity, texts, words)
    return found.unionAll(materialize(more, "similar"))


def _rooted(member: DataFrame, roots: DataFrame) -> DataFrame:
    """``member`` with the roots of its labels as labels."""
    return (
        member.join(roots.toDF("label", "_root"), "label", "left")
        .withColumn("label", F.coalesce("_root", "label"))
        .drop("_root")
    )


def cluster_links(
    member: DataFrame,
    nodes: DataFrame,
    columns: list[str],
    total_bits: int,
    similarity: float,
    texts: DataFrame,
    words: int,
) -> DataFrame:
    """Links between similar texts of one ``cluster`` and different ``label``.

    A text comes to its cluster once, with all its shingles, so that similarities are
    exact. Of pairs that fingerprints leave open a task counts the shingles in common;
    it returns links that connect what it has found, fewer than it has texts. Clusters
    too large for a task are cut into blocks of which every two meet.
    """
    # Where all carry one label nothing is left to find.
    mixed = member.groupBy("cluster").agg(F.min("label").alias("x"), F.max("label").alias("y"))
    open_ = materialize(mixed.where("x != y").select("cluster"), "open-clusters")
    member = materialize(member.join(open_, "cluster", "left_semi"), "members")
    named = materialize(
        nodes.join(member.select("node"), "node", "left_semi").select(
            "node", F.col("first.identity").alias("identity")
        ),
        "member-names",
    )
    # Rows of one identity have one text; copies meet on the map side.
    sets = materialize(
        shingle_sets(texts.join(named, "identity"), words).dropDuplicates(["node"]), "member-sets"
    )
    whole = materialize(member.join(sets, "node"), "cluster-texts")
    parts = F.greatest(
        F.ceil(F.sum(F.octet_length("shingles").cast("long")) / CLUSTER_BYTES),
        F.ceil(F.count(F.lit(1)) / CLUSTER_ROWS),
    )
    large = materialize(
        whole.groupBy("cluster").agg(parts.cast("int").alias("blocks")).where("blocks > 1"),
        "large-clusters",
    )
    own = F.pmod(F.xxhash64("node"), F.coalesce("blocks", F.lit(1))).cast("int")
    spread = (
        whole.join(large, "cluster", "left")
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)))
        .withColumn("low", F.least("own", "other"))
        .withColumn("high", F.greatest("own", "other"))
        .select("cluster", "low", "high", "own", "label", *columns, "shingles")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if row[:3] != at:
                    if len(held) > 1:
                        yield _linked(held, total_bits, similarity)
                    at, held = row[:3], []
                held.append(row[3:])
        if len(held) > 1:
            yield _linked(held, total_bits, similarity)

    return (
        spread.repartition("cluster", "low", "high")
        .sortWithinPartitions("cluster", "low", "high", "own", "node")
        .mapInArrow(compare, "a long, b long")
    )


def _linked(rows: list[tuple], total_bits: int, similarity: float) -> pa.RecordBatch:
    """Links of the rows (block, label, fingerprints, shingles) of one cluster or two of its blocks."""
    own, labels, *prints, sets = zip(*rows, strict=True)
    own, labels = np.array(own), np.array(labels, np.int64)
    prints = np.array(prints, np.int64).view(np.uint64)
    sets = [np.frombuffer(s, np.uint64) for s in sets]
    lengths = np.array([len(s) for s in sets])
    ids = np.unique(np.concatenate(sets), return_inverse=True)[1]
    ends = np.cumsum(lengths)
    marked = np.zeros(len(ids) + 1, bool)
    # Rows of one label are connected; of two blocks only pairs across are to be found here.
    roots = np.unique(labels, return_index=True, return_inverse=True)
    roots = roots[1][roots[2]]
    across = own[0] != own[-1]
    left, right = [], []
    for row in range(len(rows) - 1):
        others = np.arange(row + 1, len(rows))
        if across:
            others = others[own[others] != own[row]]
        others = others[roots[others] != roots[row]]
        apart = np.bitwise_count(prints[:, others] ^ prints[:, row : row + 1]).sum(axis=0)
        # The smaller set must have so many shingles to be similar at all.
        fits = np.minimum(lengths[others], lengths[row]) >= similarity * np.maximum(
            lengths[others], lengths[row]
        )
        others = others[(apart <= total_bits) & fits & (lengths[others] > 0)]
        if not len(others):
            continue
        mine = ids[ends[row] - lengths[row] : ends[row]]
        marked[mine] = True
        for start in range(0, len(others), 256):
            part = others[start : start + 256]
            part = part[roots[part] != roots[row]]
            if not len(part):
                continue
            first = np.cumsum(lengths[part]) - lengths[part]
            place = np.arange(lengths[part].sum()) + np.repeat(
                ends[part] - lengths[part] - first, lengths[part]
            )
            both = np.add.reduceat(marked[ids[place]].astype(np.int64), first)
            alike_ = both >= similarity * (lengths[row] + lengths[part] - both)
            for other in part[alike_].tolist():
                if roots[other] != roots[row]:
                    left.append(prints[0, row])
                    right.append(prints[0, other])
                    roots[roots == roots[other]] = roots[row]
        marked[mine] = False
    return pa.RecordBatch.from_arrays([_signed(left), _signed(right)], ["a", "b"])


def node_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``node`` and ``component``: the least ``first`` of the nodes connected with it."""
    roots = materialize(components(edges), "components")
    rooted = materialize(
        nodes.select("node", "first")
        .join(roots, "node", "left")
        .withColumn("root", F.coalesce("root", "node")),
        "rooted",
    )
    heads = materialize(rooted.groupBy("root").agg(F.min("first").alias("component")), "heads")
    return materialize(rooted.join(heads, "root").select("node", "component"), "node-components")


def near_duplicates(
    docs: DataFrame,
    words: int = WORDS,
    max_bits: int = MAX_BITS,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per document: the key, ``fingerprint`` and ``component_id``.

    ``component_id`` is the smallest key reachable over fingerprints that
    differ in at most ``max_bits`` bits. A null text counts as empty, and a text
    without words has fingerprint zero, which is linked like any other. Rows
    with the same key or the same text keep a row each. A null key keeps its
    row, is no candidate for the smallest, and a component without any other
    has a null id. Other columns, whatever their names, take no part. An empty
    table gives an empty result.
    """
    prints = materialize(fingerprints(docs, {"doc_id": F.col(key)}, words, text=text), "prints")
    nodes = materialize(prints.groupBy("node").agg(F.min("doc_id").alias("first")), "nodes")
    found = node_components(nodes, links(nodes, ["node"], max_bits))
    return prints.join(found, "node").select(
        "doc_id",
        F.lpad(F.lower(F.hex("node")), 16, "0").alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def one_of_each(
    docs: DataFrame,
    words: int = 5,
    max_bits: int = 10,
    similarity: float = 0.8,
    count: int = 3,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: the smallest key of each component stays.

    Texts are linked if one of ``count`` independent fingerprints differs in at
    most ``max_bits`` bits, slightly more than a ``similarity`` of 0.8 comes to on
    average, if all together differ in no more than ``DEVIATIONS`` above that
    average, and if the Jaccard similarity of their shingles of ``words`` words
    is at least ``similarity``. The latter is estimated from ``SKETCH`` shingles
    where that is clear, ``MARGIN`` or more off, and else of all shingles. Equal
    fingerprints are linked without further check. At 0.8 itself three
    fingerprints find about 19 pairs in 20, and more the more alike texts are.

    Rows with the same key and text count as one, whatever their other columns
    hold; a null key comes last. All columns are returned as they are.
    """
    name = F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("-"))
    identity = F.unhex(F.sha2(F.concat_ws("|", name, text_of(text)), 256))
    prints = fingerprints(
        docs, {"doc_id": F.col(key), "identity": identity}, words, count, sketched=True, text=text
    )
    first = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("identity"))
    columns = ["node", *(f"node{i}" for i in range(1, count))]
    # Copies meet on the map side, so a hot text sends one row per task.
    nodes = materialize(
        prints.groupBy("node").agg(
            F.min(first).alias("first"),
            *(F.min_by(name, first).alias(name) for name in [*columns[1:], "sketch"]),
        ),
        "nodes",
    )
    texts = docs.select(identity.alias("identity"), text_of(text).alias("body"))
    edges = similar_links(nodes, columns, max_bits, similarity, texts, words)
    found = node_components(nodes, edges)
    mark = free_name(docs.columns, "identity")
    kept = materialize(found.select(F.col("component.identity").alias("kept")).distinct(), "kept")
    # Copies with the same key fall together on the map side, before texts are shuffled.
    distinct = docs.withColumn(mark, identity).dropDuplicates([mark])
    return distinct.join(kept, distinct[mark] == kept["kept"], "left_semi").drop(mark)
