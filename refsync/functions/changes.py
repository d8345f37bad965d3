"""What counts as a change between a facility payload and the one it would replace."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Watched:
    """A payload field whose value is watched.

    ``unless`` is the id of an object that is only assumed where the record
    knows none: a reference to it must not replace what was assigned by hand.
    ``reference`` fields have such an id, null if none is configured.
    """

    field: str
    reference: bool = False
    unless: str | None = None


# Programs are kept up by other means and never make a facility differ.
PLAIN_FIELDS = ("name", "code", "active", "enabled", "openLmisAccessible")


def watched_fields(
    fallback_zone: str | None = None, fallback_type: str | None = None
) -> tuple[Watched, ...]:
    references = {"geographicZone": fallback_zone, "type": fallback_type}
    return (
        *map(Watched, PLAIN_FIELDS),
        *(Watched(field, True, unless) for field, unless in references.items()),
    )


def differences(
    new: Column, old: Column, watched: Sequence[Watched], null_safe: bool = False
) -> Column:
    """``array<struct<field, differs>>``, one entry per watched field.

    Unless ``null_safe``, a null on either side makes ``differs`` unknown.
    """

    def unequal(left: Column, right: Column) -> Column:
        return ~left.eqNullSafe(right) if null_safe else left != right

    def entry(watch: Watched) -> Column:
        differs = unequal(new[watch.field], old[watch.field])
        if watch.reference:
            differs = differs & unequal(new[watch.field]["id"], F.lit(watch.unless))
        return F.struct(F.lit(watch.field).alias("field"), differs.alias("differs"))

    if not watched:
        return F.array().cast("array<struct<field:string,differs:boolean>>")
    return F.array(*map(entry, watched))


def any_change(found: Column) -> Column:
    """True if a field differs and of none it is unknown."""
    unknown = F.exists(found, lambda entry: entry["differs"].isNull())
    return ~unknown & F.exists(found, lambda entry: F.coalesce(entry["differs"], F.lit(False)))


def changed_fields(found: Column) -> Column:
    """Names of the fields that differ, also where others are unknown."""
    return F.transform(F.filter(found, lambda entry: entry["differs"]), lambda e: e["field"])
