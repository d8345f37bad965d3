"""Bounded-space best-fit packing of documents into sequences.

A task holds a fixed number of open bins, found through a bitset keyed by free
space: bit ``f`` is set while some open bin has ``f`` tokens left. A piece goes
to the open bin with the least room that still holds it, which is the lowest
set bit at or above its length. If none does, a new bin is opened, and when
that makes one too many, the fullest closes.

Pieces are dealt to tasks by a hash, and each task packs its share. Bins that
are still open at the end hand their pieces on to the next round, which has
fewer tasks; the last round is one task over what a fixed number of rows holds.
So bins left half empty are as rare as in one single pass. Within a chunk that
the open bins can hold a task takes the longest pieces first; from chunk to chunk
it is online.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from refsync.llm.common import materialize, python_tasks, text_of, tokenizer_path

CAPACITY = 1024
OPEN_BINS = 1024
END_TOKEN = 2
# Pieces that one task packs; a piece is a row of about 60 bytes without text.
PIECES_PER_TASK = 50_000

_tokenizers: dict[str, tuple] = {}


def _tokenizer(path: str, ranks_path: str):
    """The tokenizer by ``tokenizers``, and the same vocabulary in the faster ``tiktoken``."""
    if path not in _tokenizers:
        import base64

        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        whole = Tokenizer.from_file(path)
        special = {
            token.content: number for number, token in whole.get_added_tokens_decoder().items()
        }
        fast = tiktoken.Encoding(
            "ranks",
            pat_str=public_tokenizers.PATTERN,
            mergeable_ranks=ranks,
            special_tokens=special,
        )
        _tokenizers[path] = (whole, fast)
    return _tokenizers[path]


def token_ids(text: str, path: str, ranks_path: str) -> np.ndarray:
    """Ids of ``text`` as ``tokenizers`` gives them, without added special tokens.

    Both libraries give the same ids; they rely on Unicode tables of their own,
    so the faster one is used only for characters of Latin-1, whose classes
    have never changed. Its pattern matching gives up on very long runs of
    one kind, such as white space; such texts are left to the other as well.
    """
    whole, fast = _tokenizer(path, ranks_path)
    if text.isascii() or _is_latin(text):
        if not _LONG_RUN.search(text):
            try:
                return np.asarray(fast.encode_to_numpy(text, allowed_special="all"), np.uint32)
            except ValueError:
                pass  # its matcher's stack is full
    return np.asarray(whole.encode(text, add_special_tokens=False).ids, np.uint32)


# Far below what the faster library's pattern matching stands.
_LONG_RUN = re.compile(r"\s{20000}|\w{20000}|[^\s\w]{20000}")


def _is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def pieces(
    docs: DataFrame,
    path: str | None = None,
    ranks_path: str | None = None,
    capacity: int = CAPACITY,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Tokenize and cut: key, ``piece``, ``start``, ``length``, ``ids_crc32`` and ``place``.

    A document ends with the end token, so an empty or null text has one token.
    A longer document is cut into pieces of ``capacity``; what is over goes
    into the first piece. ``place`` numbers the rows of ``docs``, of which
    equal ones stay apart.
    """
    python_tasks(docs.sparkSession)
    path = path or tokenizer_path("byte_bpe_50k.json")
    ranks_path = ranks_path or tokenizer_path("byte_bpe_50k.tiktoken")
    rows = docs.select(
        F.col(key).alias("doc_id"),
        F.monotonically_increasing_id().alias("place"),
        text_of(text).alias("body"),
    )
    out = StructType(
        [
            rows.schema["doc_id"],
            StructField("place", LongType()),
            StructField("piece", LongType()),
            StructField("start", LongType()),
            StructField("length", LongType()),
            StructField("ids_crc32", LongType()),
        ]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, made = [], []
            for row, body in enumerate(batch.column("body").to_pylist()):
                ids = np.append(token_ids(body, path, ranks_path), END_TOKEN).astype("<u4")
                first = (len(ids) - 1) % capacity + 1
                bounds = [0, *range(first, len(ids) + 1, capacity)]
                for number, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
                    owner.append(row)
                    made.append((number, a, b - a, zlib.crc32(ids[a:b].tobytes())))
            columns = np.array(made, np.int64).reshape(-1, 4)
            taken = pa.array(owner, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(taken),
                    batch.column("place").take(taken),
                    *(pa.array(columns[:, i]) for i in range(4)),
                ],
                ["doc_id", "place", "piece", "start", "length", "ids_crc32"],
            )

    return rows.mapInArrow(cut, out)


class Bins:
    """Open bins of one task, best fit first, the fullest closing."""

    def __init__(self, capacity: int, limit: int):
        self.capacity, self.limit = capacity, limit
        self.by_free: list[list[list]] = [[] for _ in range(capacity + 1)]
        self.bits = 0
        self.count = 0

    def _take(self, free: int) -> list:
        found = self.by_free[free].pop()
        if not self.by_free[free]:
            self.bits &= ~(1 << free)
        self.count -= 1
        return found

    def _put(self, free: int, bin_: list) -> None:
        self.by_free[free].append(bin_)
        self.bits |= 1 << free
        self.count += 1

    def add(self, length: int, item) -> list | None:
        """Place an item; returns the items of a bin that this closes, if any."""
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            bin_ = self._take(free)
        else:
            free, bin_ = self.capacity, []
        bin_.append(item)
        free -= length
        if not free:
            return bin_
        self._put(free, bin_)
        if self.count > self.limit:
            return self._take((self.bits & -self.bits).bit_length() - 1)
        return None

    def rest(self) -> Iterator[tuple[int, list]]:
        """Free space and items of the bins still open, the fullest first."""
        for free, bins in enumerate(self.by_free):
            for bin_ in bins:
                yield free, bin_


def _round(
    rows: DataFrame,
    count: int,
    tasks: int,
    level: int,
    capacity: int,
    open_bins: int,
    last: bool = False,
) -> DataFrame:
    """One packing round; rows of bins left open have no sequence unless this is the last.

    A task takes its share in chunks that the open bins can hold, the longest
    pieces of a chunk first, so that short ones find the gaps that long ones left.
    """
    last = last or tasks == 1
    out = StructType(
        [*rows.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())]
    )
    names = rows.columns

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        serial = (level << 56) | (part << 32)
        done: list[tuple] = []
        bins = Bins(capacity, open_bins)

        def close(items: list[tuple], final: bool = True) -> None:
            nonlocal serial
            offset = 0
            for item in items:
                done.append((*item, serial if final else None, offset if final else None))
                offset += item[length_at]
            serial += final

        def flush() -> pa.RecordBatch:
            columns = list(zip(*done, strict=True)) or [[]] * len(out)
            made = pa.RecordBatch.from_arrays(
                [
                    pa.array(column, kind)
                    for column, kind in zip(
                        columns, [*kinds, pa.int64(), pa.int64()], strict=True
                    )
                ],
                [*names, "sequence_id", "offset"],
            )
            done.clear()
            return made

        length_at = names.index("length")
        kinds = None
        for batch in batches:
            kinds = batch.schema.types
            for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                closed = bins.add(row[length_at], row)
                if closed:
                    close(closed)
            if done:
                yield flush()
        for free, items in bins.rest():
            # Less than a 64th to spare is as good as full.
            close(items, final=last or free * 64 <= capacity)
        if done:
            yield flush()

    chunks = max(1, round(count / tasks / (1.5 * open_bins)))
    order = F.xxhash64("place", "piece", F.lit(level))
    chunk = F.pmod(F.shiftright(order, 32), F.lit(chunks))
    dealt = rows.repartition(tasks, order).sortWithinPartitions(
        chunk, F.desc("length"), order, "place", "piece"
    )
    return dealt.mapInArrow(pack, out)


def pack(
    cut: DataFrame,
    capacity: int = CAPACITY,
    open_bins: int = OPEN_BINS,
    pieces_per_task: int = PIECES_PER_TASK,
) -> DataFrame:
    """Place the rows of ``pieces`` into sequences of at most ``capacity`` tokens.

    Adds ``sequence_id`` and ``offset``; every row is placed, sequences are
    gapless. ``cut`` is written out once, as a round reads it twice. An empty
    table gives an empty result.
    """
    waiting = materialize(cut, "pieces")
    placed = None
    level = 1
    left = waiting.count()
    while True:
        tasks = max(1, -(-left // pieces_per_task))
        done = materialize(_round(waiting, left, tasks, level, capacity, open_bins), "packed")
        now = done.where(F.col("sequence_id").isNotNull())
        placed = now if placed is None else placed.unionAll(now)
        if tasks == 1:
            return placed
        waiting = done.where(F.col("sequence_id").isNull()).drop("sequence_id", "offset")
        before, left = left, waiting.count()
        if left > before * 0.9:
            # Hardly anything fits together any more, so what a task leaves open is as good
            # as done; it is closed in as many tasks as ever.
            closed = materialize(
                _round(waiting, left, tasks, level + 1, capacity, open_bins, last=True), "packed"
            )
            return placed.unionAll(closed)
        level += 1


def packed_documents(docs: DataFrame, **options) -> DataFrame:
    """Pack all documents: key, piece, start, length, ids_crc32, sequence_id, offset.

    Null and repeated keys keep their rows; a null text is an empty one; other
    columns, whatever their names, take no part.
    """
    return pack(pieces(docs, **options)).select(
        "doc_id",
        F.col("piece").cast("int").alias("piece"),
        "start",
        "length",
        "ids_crc32",
        "sequence_id",
        "offset",
    )
