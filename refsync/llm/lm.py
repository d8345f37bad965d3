"""Scoring by the difference of two language models.

A target model and a background model, bigrams backed by words, are matched:
one vocabulary, one smoothing. A document's score is the mean over its words of
the background model's loss less the target model's, so that a higher score
means closer to the target.

Every word is known, however rare, unless a least share of the background is
asked for; then words below it are one unknown word. Counts of words and of
pairs grow with the corpus and stay distributed, under one 64-bit key each. Rows
of the input form chunks. A chunk asks for each of its different words and pairs
once, with how often it holds them: these requests are at the same time the
counts. They are dealt by key, so that one group sees all of a key's counts, and
the group answers every chunk with the counts of both corpora, in the order
asked. Chunks then score their documents. A pair that is everywhere is one
number per chunk, so no group is larger than others.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refsync.llm.common import hashed_words, mix, python_tasks, text_of

# Words with a smaller share of the background are unknown: none.
LEAST_SHARE = 0.0
# Weight of the shared distribution in a word's, and of a word's in a pair's probability.
WORD_PRIOR = 5000.0
PAIR_PRIOR = 100.0
CHUNK_BITS = 9
# Words of the corpus per group of pairs.
WORDS_PER_GROUP = 2_000_000
_MERGE_ROWS = 1_000_000


def summed(keys: np.ndarray, *counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Different keys in order, and the sums of their counts."""
    different, place = np.unique(keys, return_inverse=True)
    return (
        different,
        *(np.bincount(place, weights=c, minlength=len(different)).astype(np.int64) for c in counts),
    )


def packed(counts: np.ndarray) -> bytes:
    """Counts by place of byte, so that the zeros of small ones compress to nothing."""
    return counts.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def unpacked(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, np.uint8).reshape(8, -1).T.copy().view("<u8").ravel()


def word_counts(rows: DataFrame) -> DataFrame:
    """``word``, ``background`` and ``target``: occurrences of every word (by hash)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def merge() -> tuple:
            return summed(*(np.concatenate(column) for column in zip(*held, strict=True)))

        for batch in batches:
            target = batch.column("target").to_pylist()
            texts = batch.column("body").to_pylist()
            for wanted in (False, True):
                found = [hashed_words(t) for t, flag in zip(texts, target, strict=True) if flag == wanted]
                if not found:
                    continue
                words, n = np.unique(np.concatenate(found), return_counts=True)
                none = np.zeros_like(n)
                held.append((words, none, n) if wanted else (words, n, none))
            if sum(len(part[0]) for part in held) > _MERGE_ROWS:
                held = [merge()]
                if len(held[0][0]) > _MERGE_ROWS // 2:
                    yield _counts(held.pop())
        if held:
            yield _counts(merge())

    return (
        rows.mapInArrow(count, "word long, background long, target long")
        .groupBy("word")
        .agg(F.sum("background").alias("background"), F.sum("target").alias("target"))
    )


def _counts(part: tuple) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(part[0].view(np.int64)), pa.array(part[1]), pa.array(part[2])],
        ["word", "background", "target"],
    )


# Keys of the unknown word and of the start of a document; no hash of a word is likely to be one.
UNKNOWN, START = np.uint64(0x9D39247E33776D41), np.uint64(0x2AF7398005AAA5C7)


@dataclass
class Vocabulary:
    """Totals of both corpora, and the known words in order if not all are known."""

    totals: np.ndarray  # words of background and target
    words: np.ndarray | None

    def keys(self, text: str) -> np.ndarray:
        """The start of a document and its words."""
        hashes = hashed_words(text)
        if self.words is not None:
            if len(self.words):
                place = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
                hashes = np.where(self.words[place] == hashes, hashes, UNKNOWN)
            else:
                hashes = np.full(len(hashes), UNKNOWN)
        return np.concatenate([[START], hashes]).astype(np.uint64)

    def differences(self, word: np.ndarray, before: np.ndarray, pair: np.ndarray) -> np.ndarray:
        """Background loss less target loss of pairs, given counts of both corpora in two rows each.

        The counts are of the word, of the word before it, and of the two together.
        """
        both = (word[0] + word[1] + 1e-9) / (self.totals.sum() + 1e-9)
        logs = []
        for side in (0, 1):
            share = (word[side] + WORD_PRIOR * both) / (self.totals[side] + WORD_PRIOR)
            logs.append(np.log((pair[side] + PAIR_PRIOR * share) / (before[side] + PAIR_PRIOR)))
        return logs[1] - logs[0]


def pair_keys(keys: np.ndarray) -> np.ndarray:
    """One key for each two neighbours; the order of the two matters."""
    return mix(mix(keys[:-1]) * np.uint64(0x9E3779B97F4A7C15) + keys[1:])


def vocabulary(rows: DataFrame, least_share: float) -> tuple[Vocabulary, int]:
    """The shared vocabulary, and the number of words of both corpora together."""
    if least_share > 0:
        counted = word_counts(rows).persist()
        try:
            total = _totals(counted)
            # At most 1 / least_share rows, since their shares add up to one at most.
            known = counted.where(
                (F.col("background") > 0) & (F.col("background") >= least_share * int(total[0]))
            ).select("word").toArrow()
        finally:
            counted.unpersist()
        words = np.sort(known.column("word").to_numpy().view(np.uint64))
    else:
        total, words = _totals(word_totals(rows)), None
    return Vocabulary(total.astype(float), words), int(total.sum())


def _totals(counted: DataFrame) -> np.ndarray:
    row = counted.agg(
        *(F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in ("background", "target"))
    ).first()
    return np.array([row["background"], row["target"]])


def word_totals(rows: DataFrame) -> DataFrame:
    """``background`` and ``target``: words of parts of the rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = [0, 0]
        for batch in batches:
            for flag, text in zip(
                batch.column("target").to_pylist(), batch.column("body").to_pylist(), strict=True
            ):
                sides[flag] += len(hashed_words(text))
        yield pa.RecordBatch.from_arrays(
            [pa.array([n], pa.int64()) for n in sides], ["background", "target"]
        )

    return rows.mapInArrow(count, "background long, target long")


def asked(texts: list[np.ndarray], groups: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different keys of a chunk, their order when asked, and the bounds of each group in it.

    ``texts`` are the keys of words, starts included, of each text.
    """
    each = [part for keys in texts for part in (keys, pair_keys(keys))]
    different = np.unique(np.concatenate(each)) if each else np.empty(0, np.uint64)
    group = (mix(different) % np.uint64(groups)).astype(np.int64)
    order = np.argsort(group, kind="stable")
    bounds = np.searchsorted(group[order], np.arange(groups + 1))
    return different, order, bounds


def requests(rows: DataFrame, shared, groups: int) -> DataFrame:
    """Per chunk and group: the keys asked for and their counts in the chunk."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value

        def of(chunk: int, found: list[tuple[bool, np.ndarray]]) -> Iterator[pa.RecordBatch]:
            different, order, bounds = asked([keys for _, keys in found], groups)
            sides = []
            for wanted in (False, True):
                some = [
                    np.searchsorted(different, part)
                    for flag, keys in found
                    if flag == wanted
                    for part in (keys, pair_keys(keys))
                ]
                place = np.concatenate(some) if some else np.empty(0, np.int64)
                sides.append(np.bincount(place, minlength=len(different)).astype(np.int64)[order])
            used = np.flatnonzero(np.diff(bounds))
            cuts = [(bounds[g], bounds[g + 1]) for g in used]
            wanted_keys = different[order]
            columns = [
                pa.array([wanted_keys[a:b].tobytes() for a, b in cuts], pa.binary()),
                *(pa.array([packed(line[a:b]) for a, b in cuts], pa.binary()) for line in sides),
            ]
            # Only documents are scored; a chunk of target texts needs no answer.
            asker = chunk if any(not flag for flag, _ in found) else None
            yield pa.RecordBatch.from_arrays(
                [pa.array(used, pa.int32()), pa.array([asker] * len(used), pa.int64()), *columns],
                ["grp", "chunk", "keys", "background", "target"],
            )

        now, held = None, []
        for batch in batches:
            for chunk, flag, body in zip(
                *(batch.column(name).to_pylist() for name in ("chunk", "target", "body")),
                strict=True,
            ):
                if chunk != now and held:
                    yield from of(now, held)
                    held = []
                now = chunk
                held.append((flag, words.keys(body)))
        if held:
            yield from of(now, held)

    return rows.select("chunk", "target", "body").mapInArrow(
        ask, "grp int, chunk long, keys binary, background binary, target binary"
    )


def answers(wanted: DataFrame) -> DataFrame:
    """Per chunk and group the counts of both corpora, in the order asked."""

    def answer(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(blob, np.uint64) for blob in table.column("keys").to_pylist()]
        keys, place = np.unique(np.concatenate(parts), return_inverse=True)
        ends = np.cumsum([len(p) for p in parts])
        columns = {
            "grp": table.column("grp"),
            "chunk": table.column("chunk"),
            "check": pa.array([zlib.crc32(p) for p in parts], pa.int64()),
        }
        for name in ("background", "target"):
            held = np.concatenate([unpacked(blob) for blob in table.column(name).to_pylist()])
            # Doubles hold counts exactly.
            counts = np.bincount(place, weights=held, minlength=len(keys))
            values = counts.astype(np.int64)[place]
            columns[name] = pa.array(
                [packed(values[end - len(p) : end]) for p, end in zip(parts, ends, strict=True)],
                pa.binary(),
            )
        made = pa.table(columns)
        return made.filter(pc.is_valid(made.column("chunk")))

    return wanted.groupBy("grp").applyInArrow(
        answer, "grp int, chunk long, check long, background binary, target binary"
    )


def cross_entropy_difference(
    docs: DataFrame,
    target: DataFrame,
    least_share: float = LEAST_SHARE,
    key: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
) -> DataFrame:
    """Per row of ``docs``: the key, ``n_words`` and ``score``.

    The background model is learned from all of ``docs``, the target model from
    all of ``target``; both grow with their tables. ``docs`` is read again for
    the scores, and must come in the same order then, as a stored table does; if
    it does not, the run fails rather than mix up answers. A null or wordless text has
    score 0. Null and repeated keys keep their rows. With an empty ``target``
    both models agree up to smoothing. Other columns, whatever their names,
    take no part. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    python_tasks(spark)
    place = F.monotonically_increasing_id()
    body = text_of(text).alias("body")
    rows = docs.select(F.lit(False).alias("target"), body).unionAll(
        target.select(F.lit(True), text_of(target_text))
    )
    known, size = vocabulary(rows, least_share)
    # At most 1 / least_share words, none if all are known.
    shared = spark.sparkContext.broadcast(known)
    groups = max(1, -(-size // WORDS_PER_GROUP))
    chunked = rows.withColumn("chunk", F.shiftright(place, CHUNK_BITS))
    answered = answers(requests(chunked, shared, groups))

    # The partitions of ``docs`` come first in the union, so the places are the same.
    asking = docs.select(F.col(key).alias("doc_id"), body, place.alias("place")).withColumn(
        "chunk", F.shiftright("place", CHUNK_BITS)
    )

    def score(these: pa.Table, those: pa.Table) -> pa.Table:
        texts = [shared.value.keys(t) for t in these.column("body").to_pylist()]
        different, order, bounds = asked(texts, groups)
        wanted = different[order]
        blobs = sorted(
            zip(
                *(those.column(name).to_pylist() for name in ("grp", "check", "background", "target")),
                strict=True,
            )
        )
        here = [(g, zlib.crc32(wanted[bounds[g] : bounds[g + 1]])) for g, *_ in blobs]
        given = np.stack(
            [np.concatenate([unpacked(blob[side]) for blob in blobs]) for side in (2, 3)]
        )
        if given.shape[1] != len(different) or here != [(g, check) for g, check, *_ in blobs]:
            raise ValueError("a chunk holds other rows than when it asked")
        counts = np.empty((2, len(different)))
        counts[:, order] = given

        def score_of(keys: np.ndarray) -> float:
            if len(keys) < 2:
                return 0.0
            words = counts[:, np.searchsorted(different, keys)]
            pairs = counts[:, np.searchsorted(different, pair_keys(keys))]
            return float(shared.value.differences(words[:, 1:], words[:, :-1], pairs).mean())

        return pa.table(
            {
                "doc_id": these.column("doc_id"),
                "n_words": pa.array([len(keys) - 1 for keys in texts], pa.int64()),
                "score": pa.array([score_of(keys) for keys in texts], pa.float64()),
            }
        )

    kind = docs.select(F.col(key)).schema[0].dataType.simpleString()
    return (
        asking.groupBy("chunk")
        .cogroup(answered.groupBy("chunk"))
        .applyInArrow(score, f"doc_id {kind}, n_words long, score double")
    )
