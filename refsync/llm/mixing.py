"""Mixing sources to target weights by Pareto order sampling.

Every source has a target number of words. A target of ``t`` times the words of
its source takes ``floor(t)`` whole copies of each document for certain; the
rest is a sample of fixed size without replacement. For it, documents are
ranked by random odds divided by inclusion odds, ``u / (1 - u)`` over
``p / (1 - p)``, and taken in this order until the words are reached. Inclusion
odds are unequal: a fragment has less than a longer text.

The rank at which the words are reached is found without sorting a source:
ranks are cut into bins that hold a few hundred documents each, words are
summed by bin, and only the documents of the one bin in which the words are
reached are ranked one by one. There a document that is too long for what is
left is passed over, so that the words come out almost exactly. Equal rows share
a rank; if only some of them fit, rows are numbered to tell which.

Only built-in functions; nothing but one row per source is ever in one place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refsync.llm.common import free_name, materialize, text_of

WEIGHTS = (5, 2, 1)
SHARE = 1.5
LIMIT = 2
# Documents per bin of ranks, and bins that are summed up once more.
PER_BIN = 256
BINS_PER_GROUP = 4096
# Documents with fewer words have smaller inclusion odds, down to a tenth.
FULL_ODDS_WORDS = 50
LARGEST_CHANCE = 0.999999
# Words left beside whole copies from which a source is ranked.
LEAST_ROOM = 0.5


def words_of(text: Column) -> Column:
    """Number of words: runs without space and the characters 9 to 13."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def inclusion_weight(size: Column) -> Column:
    return F.greatest(F.lit(0.1), F.least(F.lit(1.0), size / F.lit(float(FULL_ODDS_WORDS))))


def document_key(key: str, text: Column) -> Column:
    """Hash that names a row by its key and text; equal rows share it."""
    name = F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("-"))
    return F.xxhash64(F.concat_ws("|", name, text))


def random_number(key: Column) -> Column:
    """Number between 0 and 1 drawn from the key, so that reruns agree."""
    drawn = F.xxhash64(F.concat(F.lit("draw"), key.cast("string")))
    return (F.shiftrightunsigned(drawn, 11) + F.lit(0.5)) / F.lit(float(1 << 53))


def rank_of(key: Column, size: Column, scale: Column, bins: Column) -> Column:
    """Random over inclusion odds, folded into 0 to 1.

    Chances stay so far from 1 that the last of a source's documents do not
    share the first bin with all others.
    """
    largest = F.least(F.lit(LARGEST_CHANCE), 1 - 1 / (bins * PER_BIN))
    chance = F.least(largest, scale * inclusion_weight(size))
    u = random_number(key)
    odds = u / (1 - u) * (1 - chance) / chance
    return odds / (1 + odds)


def bin_of(rank: Column, bins: Column) -> Column:
    return F.least(F.floor(rank * bins), bins - 1).cast("long")


def targets(sources: DataFrame, weights: Sequence[int], share: float, limit: float) -> DataFrame:
    """Adds ``target`` to one row per source (``source``, ``words``).

    Sources in order of code point, null last, have ``weights`` in turn and
    divide ``share`` of all words by them. A target stops at ``limit`` times its
    source; what is over goes to the others by weight, until none is above.
    With sources ordered by where they stop, the level that this ends at is the
    largest share per weight that any of them sees.
    """
    place = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    weighted = sources.withColumn(
        "weight",
        F.get(F.array(*(F.lit(float(w)) for w in weights)), F.pmod(place, F.lit(len(weights)))),
    ).withColumn("cap", F.col("words") * F.lit(float(limit)))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.asc_nulls_last("source"))
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    later = order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(0))
    left = F.sum("words").over(everything) * F.lit(share) - F.coalesce(
        F.sum("cap").over(earlier), F.lit(0.0)
    )
    return (
        weighted.withColumn("level", left / F.sum("weight").over(later))
        .withColumn("level", F.max("level").over(everything))
        .withColumn("target", F.least("cap", F.col("weight") * F.col("level")))
        .select("source", "words", "documents", "weighted_words", "target")
    )


def mix_plan(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    limit: float = LIMIT,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """One row per source: what to take of it.

    ``source``, ``words``, ``target``, ``whole`` (certain copies), ``scale`` (of
    the inclusion odds), ``bins``, ``cut`` (the bin in which the words are
    reached) and ``picks`` (of the documents in that bin the ``key``, how many ``rows`` have it,
    and how ``some`` of them are taken).
    """
    body = text_of(text)
    base = materialize(
        docs.select(
            F.col(source).alias("source"),
            words_of(body).alias("size"),
            document_key(key, body).alias("key"),
        ),
        "mix-sizes",
    )
    sources = base.groupBy("source").agg(
        F.sum("size").alias("words"),
        F.count(F.when(F.col("size") > 0, 1)).alias("documents"),
        F.sum(F.col("size") * inclusion_weight(F.col("size"))).alias("weighted_words"),
    )
    ratio = F.when(F.col("words") > 0, F.col("target") / F.col("words")).otherwise(F.lit(0.0))
    planned = materialize(
        targets(sources, weights, share, limit)
        .withColumn("whole", F.floor(ratio).cast("long"))
        .withColumn("room", F.col("target") - F.col("whole") * F.col("words"))
        .withColumn(
            "bins", F.greatest(F.lit(1), F.ceil(F.col("documents") / PER_BIN)).cast("long")
        )
        # Far smaller odds would put all documents into the last bin.
        .withColumn("least", 1 / F.col("bins"))
        .withColumn("scale", F.greatest("least", F.col("room") / F.col("weighted_words")))
        .withColumn("scale", F.coalesce("scale", "least"))
        .drop("least"),
        "mix-targets",
    )

    # With room for half a word or less nothing comes nearer than whole copies alone, and a
    # source that stops at its limit has none at all.
    ranked = (
        base.where(F.col("size") > 0)
        .alias("d")
        .join(
            planned.where(F.col("room") > LEAST_ROOM)
            .select("source", "scale", "bins", "room")
            .alias("p"),
            F.col("d.source").eqNullSafe(F.col("p.source")),
        )
        .select(
            "d.source",
            "key",
            "size",
            "room",
            rank_of(F.col("key"), F.col("size"), F.col("scale"), F.col("bins")).alias("rank"),
            "bins",
        )
        .withColumn("bin", bin_of(F.col("rank"), F.col("bins")))
        .withColumn("group", F.floor(F.col("bin") / BINS_PER_GROUP))
    )

    def reached(part: str, rows: DataFrame, before: Column) -> DataFrame:
        """Per source the first ``part`` in which the words are reached, and the words before it."""
        running = Window.partitionBy("source").orderBy(part)
        return (
            rows.groupBy("source", part)
            .agg(F.sum("size").alias("n"), F.first("room").alias("room"), before.alias("before"))
            .withColumn("upto", F.col("before") + F.sum("n").over(running))
            .where((F.col("upto") > F.col("room")) & (F.col("upto") - F.col("n") <= F.col("room")))
            .select("source", part, (F.col("upto") - F.col("n")).alias("before"))
        )

    groups = materialize(reached("group", ranked, F.lit(0).cast("long")), "mix-groups")
    in_group = _within(ranked, groups, "group")
    cuts = materialize(reached("bin", in_group, F.first("before")), "mix-bins")
    last = in_one_bin(ranked, cuts)
    # Two ways to meet the words: take what fits in order of rank, or take all and leave out
    # what is too much, from the last rank on. The nearer one counts.
    total = F.aggregate(
        "items", F.lit(0).cast("long"), lambda n, item: n + item["n"] * item["rows"]
    )
    taken = _fitting(F.col("items"), F.col("left"))
    left_out = _fitting(F.reverse("items"), total - F.col("left"))
    others = F.filter(
        F.transform(
            "items",
            lambda item: F.struct(
                item["key"].alias("key"),
                (
                    item["rows"]
                    - F.aggregate(
                        left_out["picks"],
                        F.lit(0).cast("long"),
                        lambda n, out: n + F.when(out["key"] == item["key"], out["some"]).otherwise(0),
                    )
                ).alias("some"),
                item["rows"].alias("rows"),
            ),
        ),
        lambda pick: pick["some"] > 0,
    )
    nearer = F.when(F.abs(taken["gap"]) <= F.abs(left_out["gap"]), taken["picks"]).otherwise(others)
    picked = last.select("source", "cut", nearer.alias("picks"))
    return materialize(
        planned.alias("p")
        .join(picked.alias("c"), F.col("p.source").eqNullSafe(F.col("c.source")), "left")
        .select("p.*", F.coalesce("cut", F.lit(0).cast("long")).alias("cut"), "picks"),
        "mix-plan",
    )


def in_one_bin(ranked: DataFrame, cuts: DataFrame) -> DataFrame:
    """Per source the ``items`` of the bin found for it, and the words ``left`` for them.

    A bin in which words are reached holds a few ``PER_BIN`` documents at most,
    whatever the input's size.
    """
    return (
        _within(ranked, cuts, "bin")
        .groupBy("source", "key")
        .agg(
            F.min("size").alias("n"),
            F.count(F.lit(1)).alias("rows"),
            F.min("rank").alias("rank"),
            F.first("room").alias("room"),
            F.first("before").alias("before"),
            F.first("bin").alias("cut"),
        )
        .groupBy("source", "cut")
        .agg(
            F.array_sort(F.collect_list(F.struct("rank", "key", "n", "rows"))).alias("items"),
            (F.first("room") - F.first("before")).alias("left"),
        )
    )


_PICKS = "array<struct<key:bigint,some:bigint,rows:bigint>>"


def _fitting(items: Column, room: Column) -> Column:
    """``picks`` of the items that fit into ``room`` words in their order, and the ``gap`` left.

    Of an item that stands for several equal rows ``some`` may fit. The smallest row
    passed over is added if that brings the words nearer.
    """
    start = F.struct(
        room.cast("double").alias("gap"),
        F.array().cast(_PICKS).alias("picks"),
        F.lit(None).cast("struct<n:bigint,key:bigint,some:bigint,rows:bigint>").alias("over"),
    )

    def pick(item: Column, some: Column) -> Column:
        return F.struct(item["key"].alias("key"), some.alias("some"), item["rows"].alias("rows"))

    def step(state: Column, item: Column) -> Column:
        some = F.greatest(
            F.lit(0).cast("long"),
            F.least(item["rows"], F.floor(state["gap"] / item["n"]).cast("long")),
        )
        # One row more of this item.
        this = F.struct(
            item["n"].alias("n"),
            item["key"].alias("key"),
            (some + 1).alias("some"),
            item["rows"].alias("rows"),
        )
        return F.struct(
            (state["gap"] - some * item["n"]).alias("gap"),
            F.when(some > 0, F.array_append(state["picks"], pick(item, some)))
            .otherwise(state["picks"])
            .alias("picks"),
            F.when(some < item["rows"], F.least(state["over"], this))
            .otherwise(state["over"])
            .alias("over"),
        )

    def end(state: Column) -> Column:
        over = state["over"]
        closed = F.struct(
            (state["gap"] - over["n"]).alias("gap"),
            F.array_append(
                F.filter(state["picks"], lambda p: p["key"] != over["key"]),
                pick(over, over["some"]),
            ).alias("picks"),
        )
        plain = F.struct(state["gap"].alias("gap"), state["picks"].alias("picks"))
        return F.when(over["n"] < 2 * state["gap"], closed).otherwise(plain)

    return F.aggregate(items, start, step, end)


def _within(ranked: DataFrame, found: DataFrame, part: str) -> DataFrame:
    """The rows of the ``part`` found for their source, with the words ``before`` it."""
    other = found.select(
        F.col("source").alias("found_source"), F.col(part).alias("found_part"), "before"
    )
    return ranked.join(
        other,
        F.col("source").eqNullSafe(F.col("found_source")) & (F.col(part) == F.col("found_part")),
    ).drop("found_source", "found_part")


def with_copies(
    docs: DataFrame,
    plan: DataFrame,
    columns: dict[str, Column],
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """``columns`` of every row of ``docs``, evaluated with the row's plan at hand.

    They may use ``mix_size``, ``mix_words``, ``mix_target`` and
    ``mix_copies``, which are no columns of ``docs`` then.
    """
    row = free_name(docs.columns, "row")
    body = text_of(text)
    sized = docs.select(
        F.struct("*").alias(row),
        words_of(body).alias("mix_size"),
        document_key(key, body).alias("mix_key"),
        F.col(source).alias("mix_source"),
    ).join(plan, F.col("mix_source").eqNullSafe(F.col("source")), "left")
    rank = rank_of(F.col("mix_key"), F.col("mix_size"), F.col("scale"), F.col("bins"))
    at = bin_of(rank, F.col("bins"))
    own = F.filter("picks", lambda p: p["key"] == F.col("mix_key"))
    some = F.when((F.col("mix_size") > 0) & (at == F.col("cut")), F.get(own, F.lit(0)))
    placed = sized.withColumn("mix_some", some)
    partly = F.coalesce(F.col("mix_some")["some"] < F.col("mix_some")["rows"], F.lit(False))
    whole = (F.col("mix_size") > 0) & ((at < F.col("cut")) | F.col("mix_some").isNotNull())
    if plan.where(F.exists("picks", lambda p: p["some"] < p["rows"])).isEmpty():
        found = placed.withColumn("mix_more", F.coalesce(whole, F.lit(False)))
    else:
        numbered = _numbered(placed.where(partly))
        few = numbered.withColumn("mix_more", F.col("mix_number") < F.col("mix_some")["some"])
        rest = placed.where(~partly).withColumn("mix_more", F.coalesce(whole, F.lit(False)))
        found = rest.unionByName(few.drop("mix_number"))
    return (
        found.withColumn("mix_copies", F.col("whole") + F.when(F.col("mix_more"), 1).otherwise(0))
        .withColumn("mix_words", F.col("words"))
        .withColumn("mix_target", F.col("target"))
        .select(*(column.alias(name) for name, column in columns.items()), F.col(row))
    )


def _numbered(equal: DataFrame) -> DataFrame:
    """``mix_number``: from zero, for each key and source.

    The rows are stored with the task that they came from. They are numbered within
    tasks, and those of a task go on where the tasks before it end, so that a key which
    most rows share is nowhere in one place.
    """
    stored = materialize(equal.withColumn("mix_task", F.spark_partition_id()), "mix-equal")
    earlier = (
        Window.partitionBy("mix_key", "mix_source")
        .orderBy("mix_task")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    # One row per task and key, of a few keys a source.
    counts = stored.groupBy("mix_key", "mix_source", "mix_task").agg(F.count(F.lit(1)).alias("n"))
    shifts = counts.select(
        F.col("mix_key").alias("k"),
        F.col("mix_source").alias("s"),
        F.col("mix_task").alias("t"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("mix_shift"),
    )
    within = Window.partitionBy("mix_key", "mix_source", "mix_task").orderBy("mix_task")
    return (
        stored.withColumn("mix_within", F.row_number().over(within) - 1)
        .join(
            shifts,
            (F.col("mix_key") == F.col("k"))
            & F.col("mix_source").eqNullSafe(F.col("s"))
            & (F.col("mix_task") == F.col("t")),
        )
        .withColumn("mix_number", F.col("mix_shift") + F.col("mix_within"))
        .drop("k", "s", "t", "mix_shift", "mix_within", "mix_task")
    )


def mixed(docs: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """Per row: the key, ``size``, ``source_size``, ``target`` and ``taken`` words.

    A null text has size 0 and nothing is taken of it; null is a source like
    any other, the last. Of rows with equal key and text as many are taken as fit;
    which of them is not told apart. Other columns, whatever their names, take no part. An empty table gives an empty
    result.
    """
    named = {name: options[name] for name in ("text", "source") if name in options}
    columns = {
        "size": F.col("mix_size"),
        "source_size": F.col("mix_words"),
        "target": F.col("mix_target"),
        "taken": F.col("mix_size") * F.col("mix_copies"),
    }
    found = with_copies(docs, mix_plan(docs, key=key, **options), columns, key, **named)
    row = found.columns[-1]
    return found.select(F.col(row)[key].alias("doc_id"), *columns)


def mixture(docs: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with all their columns."""
    named = {name: options[name] for name in ("text", "source") if name in options}
    found = with_copies(
        docs, mix_plan(docs, key=key, **options), {"copies": F.col("mix_copies")}, key, **named
    )
    row = found.columns[-1]
    repeated = found.where("copies > 0").select(
        row, F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))
    )
    return repeated.select(f"{row}.*")
