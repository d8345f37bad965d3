"""Maps of supported programs, keyed by program code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from refsync.sources.schemas import PROGRAM_MAP, PROGRAM_SUPPORT


def no_programs() -> Column:
    return F.create_map().cast(PROGRAM_MAP)


def support_entry(program_id: Column) -> Column:
    """What a program known only by its id is taken to be supported as."""
    return F.struct(
        program_id.alias("id"),
        F.lit(True).alias("supportActive"),
        F.lit(False).alias("supportLocallyFulfilled"),
        F.lit(None).cast("string").alias("supportStartDate"),
    ).cast(PROGRAM_SUPPORT)


def ordered_map(entries: Column) -> Column:
    """A map of ``(code, support)`` entries with unique codes.

    Keys are ordered by length and then by bytes, the order in which the source
    database keeps the keys of a JSON object.
    """
    keyed = F.transform(
        entries,
        lambda e: F.struct(
            F.octet_length(e["code"]).alias("width"), e["code"].alias("code"),
            e["support"].alias("support"),
        ),
    )
    pairs = F.transform(F.array_sort(keyed), lambda e: F.struct(e["code"], e["support"]))
    return F.map_from_entries(pairs)


def merge_programs(kept: Column, added: Column) -> Column:
    """Both maps together; a code in both keeps its entry of ``kept``."""
    fresh = F.map_filter(added, lambda code, _: ~F.map_contains_key(kept, code))
    return F.map_concat(kept, fresh)


def program_list(programs: Column) -> Column:
    """The entries of a program map as the array a payload carries."""
    return F.map_values(programs)


def programs_from_json(text: Column) -> Column:
    """The program map out of a JSON object keyed by program code.

    Entries without an ``id`` key are dropped. A missing support flag takes its
    default, whereas a flag that is present and null stays null.
    """

    def given(entry: Column, name: str) -> Column:
        return F.array_contains(F.json_object_keys(entry), name)

    def flag(entry: Column, name: str, default: bool) -> Column:
        value = F.get_json_object(entry, f"$.{name}").try_cast("boolean")
        return F.when(given(entry, name), value).otherwise(F.lit(default))

    entries = F.from_json(text, "map<string, string>")
    return F.transform_values(
        F.map_filter(entries, lambda _, e: given(e, "id")),
        lambda _, e: F.struct(
            F.get_json_object(e, "$.id").alias("id"),
            flag(e, "supportActive", True).alias("supportActive"),
            flag(e, "supportLocallyFulfilled", False).alias("supportLocallyFulfilled"),
            F.get_json_object(e, "$.supportStartDate").alias("supportStartDate"),
        ),
    ).cast(PROGRAM_MAP)
