"""Where to cut a table, so that it is read in parts of even size.

The bounds are the keys at even ranks, so a part holds its share of the rows
however the keys are distributed. A source that answers queries finds them by
itself, and only the bounds leave it; other tables are numbered in ranges, of
which no task sees more than one. A key is one or several columns, of any type
that has an order: where the first column repeats, the next ones cut inside it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime
from decimal import Decimal
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refsync.operators.numbering import running_total

# A number of rows like any other: more parts than this are no help to a source.
MOST_PARTS = 65_536


class Queried(Protocol):
    def query(self, sql: str) -> DataFrame: ...


def literal(value: object) -> str:
    """A value as SQL has it."""
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, (int, Decimal)):
        return str(value)
    if isinstance(value, float):
        return f"cast('{value!r}' as double precision)"
    if isinstance(value, datetime):
        return f"timestamp '{value.isoformat(sep=' ')}'"
    if isinstance(value, date):
        return f"date '{value.isoformat()}'"
    return "'" + str(value).replace("'", "''") + "'"


@dataclass(frozen=True)
class Splits:
    """The lower bounds of all parts but the first, in order of the key.

    Null comes before every other value. ``rows`` is the number of rows of each
    part that the bounds were found to make.
    """

    columns: tuple[str, ...]
    bounds: tuple[tuple, ...]
    rows: tuple[int, ...] = ()

    def predicates(self) -> list[str]:
        """One condition per part; every row fulfils exactly one, nulls included."""
        starts = [None, *self.bounds]
        ends = [*self.bounds, None]
        return [
            " and ".join(
                f"({part})"
                for part in (
                    self._from(start) if start is not None else None,
                    self._below(end) if end is not None else None,
                )
                if part
            )
            or "1 = 1"
            for start, end in zip(starts, ends)
        ]

    def _below(self, bound: tuple, at: int = 0) -> str:
        column, value = self.columns[at], bound[at]
        last = at == len(self.columns) - 1
        if value is None:
            # Nothing is below null but, among nulls, what the next columns say.
            return "1 = 0" if last else f"{column} is null and ({self._below(bound, at + 1)})"
        text = f"{column} is null or {column} < {literal(value)}"
        if last:
            return text
        return f"{text} or ({column} = {literal(value)} and ({self._below(bound, at + 1)}))"

    def _from(self, bound: tuple, at: int = 0) -> str:
        column, value = self.columns[at], bound[at]
        last = at == len(self.columns) - 1
        if value is None:
            if last:
                return "1 = 1"
            return f"{column} is not null or ({self._from(bound, at + 1)})"
        if last:
            return f"{column} >= {literal(value)}"
        return (
            f"{column} > {literal(value)}"
            f" or ({column} = {literal(value)} and ({self._from(bound, at + 1)}))"
        )

    def largest_share(self) -> float:
        """The rows of the largest part, as a multiple of the mean."""
        total = sum(self.rows)
        return max(self.rows) * len(self.rows) / total if total else 1.0


def _checked(columns: Sequence[str], parts: int) -> tuple[str, ...]:
    if isinstance(columns, str):
        columns = (columns,)
    if not columns:
        raise ValueError("a key has at least one column")
    if not 1 <= parts <= MOST_PARTS:
        raise ValueError(f"parts must lie between 1 and {MOST_PARTS}")
    return tuple(columns)


def bounds_sql(table: str, columns: Sequence[str], parts: int) -> str:
    """The statement that finds the bounds inside a database.

    One row per part: the key at its first row, and the number of rows with
    smaller keys. Only the key is read, in its order where there is an index on
    it. ``place * parts`` passes a multiple of the number of rows exactly at the
    first row of a part.
    """
    columns = _checked(columns, parts)
    names = ", ".join(columns)
    order = ", ".join(f"{name} nulls first" for name in columns)
    return (
        f"select distinct {names}, n, total from (select {names},"
        f" row_number() over (order by {order}) - 1 as place,"
        f" rank() over (order by {order}) - 1 as n, count(*) over () as total"
        f" from {table}) ranked where mod(place * {parts}, total) < {parts}"
    )


def splits_in(source: Queried, table: str, columns: Sequence[str], parts: int) -> Splits:
    """Splits of a database's table, found by the database."""
    columns = _checked(columns, parts)
    return _splits(source.query(bounds_sql(table, columns, parts)), columns)


def splits_of(frame: DataFrame, columns: Sequence[str], parts: int) -> Splits:
    """Splits of any other table; the key alone is read, and ordered in ranges."""
    columns = _checked(columns, parts)
    return _splits(bounds_of(frame, columns, parts), columns)


def bounds_of(frame: DataFrame, columns: Sequence[str], parts: int) -> DataFrame:
    """What ``bounds_sql`` selects, from a DataFrame.

    Equal keys are counted first, so a key that many rows share is one row, and
    the ranges in which the rest is numbered stay even.
    """
    columns = _checked(columns, parts)
    keys = frame.groupBy(*columns).agg(F.count(F.lit(1)).alias("_rows"))
    # Rows before the first of each key.
    ranked = running_total(keys, columns, "_rows", "n")
    total = ranked.agg(F.sum("_rows").alias("total"))
    begun = _begun(F.col("n") + F.col("_rows"), parts) - _begun(F.col("n"), parts)
    return (
        ranked.crossJoin(F.broadcast(total)).filter(begun > 0).select(*columns, "n", "total")
    )


def _begun(rows: Column, parts: int) -> Column:
    """How many parts begin within the first ``rows`` rows: part j does at j * total / parts."""
    reached = (rows - 1) * parts
    # A multiple of the total, so that the quotient is a whole number.
    whole = (reached - F.pmod(reached, F.col("total"))) / F.col("total")
    return F.when(rows > 0, F.round(whole).cast("long") + 1).otherwise(0)


def _splits(found: DataFrame, columns: tuple[str, ...]) -> Splits:
    # One row per part.
    rows = sorted(found.collect(), key=lambda row: row["n"])
    if not rows:
        return Splits(columns, ())
    total, starts = rows[0]["total"], {}
    for row in rows:
        starts[tuple(row[name] for name in columns)] = row["n"]
    keys = list(starts)
    ends = [*(starts[key] for key in keys[1:]), total]
    begins = [0, *(starts[key] for key in keys[1:])]
    return Splits(columns, tuple(keys[1:]), tuple(e - b for b, e in zip(begins, ends)))
