"""Known facilities kept in buckets of their code.

A delivery is matched with the known facilities by code. Stored in as many
buckets as the join has partitions, they are read bucket by bucket: only the
delivered records move. That pays where deliveries come more often than the
facilities change, as the facilities are dealt out when they are stored, once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Codes are dealt out over this many files at least.
BUCKETS = 200


def store_by_key(
    frame: DataFrame, name: str, path: str, key: str, buckets: int | None = None
) -> DataFrame:
    """Write ``frame`` below ``path`` in buckets of ``key`` and name it in the catalog.

    Fewer buckets than a join has partitions would be dealt out again, so there
    are as many at least. Rows are dealt out before they are written, or every
    task would leave a file in every bucket. A table of that name is replaced;
    ``path`` must not be what ``frame`` is read from.
    """
    spark = frame.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(buckets or BUCKETS, partitions)
    (
        frame.repartition(buckets, key)
        .write.mode("overwrite")
        .format("parquet")
        .bucketBy(buckets, key)
        .sortBy(key)
        .option("path", path)
        .saveAsTable(name)
    )
    return spark.table(name)


def forget(spark: SparkSession, name: str) -> None:
    """Take the name out of the catalog; the files stay."""
    spark.sql(f"drop table if exists {name}")
