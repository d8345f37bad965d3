"""Global numbering without sorting everything in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from refsync.session import materialize


def running_total(
    df: DataFrame, order_by: Sequence[str], weight: str | None = None, column: str = "row_no"
) -> DataFrame:
    """Add the total ``weight`` of all rows that come earlier in the order.

    ``order_by`` must identify a row, which also keeps the ranges even.
    Without a weight every row counts one, so the result numbers the rows from
    zero. Rows are cut into ranges; a range is numbered by itself and shifted by
    the totals of the ranges before it. The cut is written out once, as its
    bounds come from a sample and must not differ between the two steps.
    """
    spark = df.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    amount = F.col(weight).cast("long") if weight else F.lit(1).cast("long")

    cut = df.repartitionByRange(ranges, *order_by).withColumn("_range", F.spark_partition_id())
    cut = materialize(cut, "numbering")

    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range: bounded by the number of shuffle partitions.
    shifts = cut.groupBy("_range").agg(F.sum(amount).alias("_total"))
    shifts = shifts.select(
        "_range", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_shift")
    )

    within = (
        Window.partitionBy("_range").orderBy(*order_by).rowsBetween(Window.unboundedPreceding, -1)
    )
    numbered = cut.withColumn("_within", F.coalesce(F.sum(amount).over(within), F.lit(0)))
    return (
        numbered.join(F.broadcast(shifts), "_range")
        .withColumn(column, F.col("_shift") + F.col("_within"))
        .drop("_range", "_shift", "_within")
    )
