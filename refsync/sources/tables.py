"""Where source tables come from.

Every source answers ``table("schema.name")`` with a lazy DataFrame, so jobs
read files, catalog tables and databases the same way.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession

from refsync.sources.splits import splits_in


class TableSource(Protocol):
    def table(self, name: str) -> DataFrame: ...


@dataclass(frozen=True)
class FileSource:
    """Tables kept as folders ``<root>/<schema>.<table>``."""

    spark: SparkSession
    root: str
    format: str = "parquet"
    schemas: Mapping[str, str] = field(default_factory=dict)

    def table(self, name: str) -> DataFrame:
        reader = self.spark.read.format(self.format)
        if name in self.schemas:
            reader = reader.schema(self.schemas[name])
        return reader.load(f"{self.root}/{name}")


@dataclass(frozen=True)
class CatalogSource:
    """Tables of the session catalog; ``names`` maps logical to stored names."""

    spark: SparkSession
    names: Mapping[str, str] = field(default_factory=dict)

    def table(self, name: str) -> DataFrame:
        return self.spark.table(self.names.get(name, name))


@dataclass(frozen=True)
class JdbcSource:
    """Tables and queries of a database.

    ``splits`` gives, per table, the predicates that cut it into partitions
    read in parallel; ``keys`` gives the columns of a key and the number of
    partitions instead, and the database is asked where to cut. A table with
    neither is read by a single task, which is right for small tables only.
    """

    spark: SparkSession
    url: str
    properties: Mapping[str, str] = field(default_factory=dict)
    splits: Mapping[str, Sequence[str]] = field(default_factory=dict)
    keys: Mapping[str, tuple[Sequence[str], int]] = field(default_factory=dict)

    def table(self, name: str) -> DataFrame:
        predicates = self.splits.get(name)
        if predicates is None and name in self.keys:
            predicates = splits_in(self, name, *self.keys[name]).predicates()
        if predicates:
            return self.spark.read.jdbc(
                self.url, name, predicates=list(predicates), properties=dict(self.properties)
            )
        return self._reader().option("dbtable", name).load()

    def query(self, sql: str) -> DataFrame:
        """Push a whole query to the database."""
        return self._reader().option("query", sql).load()

    def ranged(
        self, name: str, column: str, lower: object, upper: object, partitions: int
    ) -> DataFrame:
        """Read by ranges of a numeric, date or timestamp column."""
        return (
            self._reader()
            .option("dbtable", name)
            .option("partitionColumn", column)
            .option("lowerBound", str(lower))
            .option("upperBound", str(upper))
            .option("numPartitions", str(partitions))
            .load()
        )

    def _reader(self):
        return self.spark.read.format("jdbc").option("url", self.url).options(**self.properties)


def uuid_splits(column: str, partitions: int) -> list[str]:
    """Predicates that cut a UUID key into equal ranges covering every row.

    UUID keys have no numeric range to split on. The bounds are full UUIDs, so
    the database can use its index on the key.
    """
    if not 1 <= partitions <= 65536:
        raise ValueError("partitions must lie between 1 and 65536")
    bounds = [
        f"{65536 * i // partitions:04x}0000-0000-0000-0000-000000000000"
        for i in range(1, partitions)
    ]
    if not bounds:
        return ["1 = 1"]
    first = f"({column} < '{bounds[0]}' or {column} is null)"
    middle = [f"{column} >= '{lo}' and {column} < '{hi}'" for lo, hi in zip(bounds, bounds[1:])]
    return [first, *middle, f"{column} >= '{bounds[-1]}'"]
