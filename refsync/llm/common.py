"""Helpers that the operators of this package share."""

from __future__ import annotations

import hashlib
import shutil
import tempfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from refsync.session import materialize, new_shared_path

__all__ = [
    "fold",
    "free_name",
    "hashed_words",
    "materialize",
    "new_shared_path",
    "python_tasks",
    "table",
    "text_of",
    "tokenizer_path",
]

# Documents differ in length by four orders of magnitude, so a batch for Python
# is kept short; very long texts make up a batch of their own.
BATCH_ROWS = 512
BATCH_BYTES = 16 * 1024 * 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def python_tasks(spark: SparkSession) -> None:
    """Send the package to the Python workers, and let batches of whole texts stay small.

    The number of partitions that a scan aims for is fixed too. Otherwise it
    follows the executors at hand, and two scans of a file may be cut
    differently if some are lost in between.
    """
    context = spark.sparkContext
    if not any(name.startswith("refsync-") for name in map(_file_name, context.listFiles)):
        root = Path(__file__).resolve().parents[2]
        made = tempfile.mkdtemp(prefix="refsync-")
        zipped = shutil.make_archive(f"{made}/refsync-package", "zip", root, "refsync")
        context.addPyFile(zipped)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set("spark.sql.files.minPartitionNum", context.defaultParallelism)


def _file_name(path: str) -> str:
    return path.rpartition("/")[2]


def text_of(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def fold(doc_id: str = "doc_id") -> Column:
    """Fold of a document, 0 to 4; a document without an id is in fold 0."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 5


def free_name(taken: Iterable[str], wanted: str) -> str:
    """A column name that no column in ``taken`` has, whatever its case."""
    used = {name.lower() for name in taken}
    while wanted.lower() in used:
        wanted += "_"
    return wanted


def tokenizer_path(name: str) -> str:
    """Where the public tokenizer file ``name`` is installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _word_bytes() -> np.ndarray:
    """Maps a byte of lower-cased UTF-8 text to itself if it belongs to a word, else 0."""
    kept = np.zeros(256, np.uint64)
    for byte in range(256):
        if chr(byte).isascii():
            if chr(byte).isalnum():
                kept[byte] = ord(chr(byte).lower()) + 1
        else:
            kept[byte] = byte + 1
    return kept


_KEPT = _word_bytes()
_BASE = 0x9E3779B97F4A7C15 | 1
_SPAN = 1 << 17
_POWERS = np.full(_SPAN + 1, _BASE, np.uint64)
_POWERS[0] = 1
_POWERS = np.cumprod(_POWERS, dtype=np.uint64)
_INVERSE = np.full(_SPAN + 1, pow(_BASE, -1, 1 << 64), np.uint64)
_INVERSE[0] = 1
_INVERSE = np.cumprod(_INVERSE, dtype=np.uint64)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (a bijection)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _spans(raw: bytes) -> Iterator[bytes]:
    """Cut a long text between words; a span is longer than the others only for one long word."""
    outside = np.flatnonzero(_KEPT[np.frombuffer(raw, np.uint8)] == 0)
    start = 0
    while len(raw) - start > _SPAN:
        # After the last byte that belongs to no word, or else where the word at hand ends.
        last = int(np.searchsorted(outside, start + _SPAN)) - 1
        if last < 0 or outside[last] < start:
            last += 1
        end = int(outside[last]) + 1 if last < len(outside) else len(raw)
        yield raw[start:end]
        start = end
    yield raw[start:]


def _span_hashes(raw: bytes) -> np.ndarray:
    values = _KEPT[np.frombuffer(raw, np.uint8)]
    if np.count_nonzero(values) > _SPAN:  # one word, of more bytes than there are powers
        digest = hashlib.blake2b(values[values > 0].tobytes(), digest_size=8).digest()
        return np.frombuffer(digest, np.uint64).copy()
    inside = np.empty(len(values) + 2, np.int8)
    inside[0] = inside[-1] = 0
    inside[1:-1] = values != 0
    edges = np.diff(inside)
    starts = np.flatnonzero(edges == 1)
    ends = np.flatnonzero(edges == -1)
    sums = np.empty(len(values) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(values * _POWERS[: len(values)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _INVERSE[starts])


def hashed_words(text: str) -> np.ndarray:
    """64-bit hashes of a text's words, in order.

    A word is a run of ASCII letters and digits and of any characters beyond
    ASCII, lower-cased, however long.
    """
    raw = text.lower().encode("utf-8", "replace")
    if not raw:
        return np.empty(0, np.uint64)
    if len(raw) <= _SPAN:
        return _span_hashes(raw)
    return np.concatenate([_span_hashes(span) for span in _spans(raw)])
