"""Row numbers in large groups, without a group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kalendria.plans import scratch


def numbered(rows: DataFrame, by: list[str], order: list[Column], name: str = "rank") -> DataFrame:
    """Numbers from 1 in ``order`` within each group of ``by``.

    Rows are dealt out in ranges of the whole order and written once, so that
    ranges stay as they are; a row's number is its place in its range plus the
    rows of its group in earlier ranges. The order must leave no ties but of
    equal rows.
    """
    ranges = scratch.table(rows.repartitionByRange(*by, *order).withColumn("_range", F.spark_partition_id()))
    earlier = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranges.groupBy(*by, "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select(*(F.col(c).alias(f"_by_{c}") for c in by), F.col("_range").alias("_r"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    on = F.col("_range") == F.col("_r")
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    place = F.row_number().over(Window.partitionBy("_range", *by).orderBy(*order))
    return ranges.withColumn("_place", place).join(before, on).select(*rows.columns, (F.col("_place") + F.col("_before")).cast("long").alias(name))
