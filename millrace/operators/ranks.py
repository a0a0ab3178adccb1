"""Ranks and running sums in groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.shared import written


def ranked(rows: DataFrame, by: list[str], order: list[Column], total: str | None = None) -> DataFrame:
    """The rows with ``rank``, from 1 in each group of ``by`` (no nulls there), and, if ``total`` is given, ``before``:
    the sum of that column over the group's rows of lower rank, exact for whole numbers.

    Rows are dealt out in ranges of the order, so that a group of any size spreads over
    tasks; a range's offsets come from the counts of the ranges before it, of which
    there are as many as partitions.  ``order`` must leave no ties.
    """
    dealt = written(rows.repartitionByRange(*map(F.col, by), *order).withColumn("_range", F.spark_partition_id()), "ranges")
    amount = F.sum(total) if total else F.lit(None).cast("bigint")
    ranges = dealt.groupBy(*by, "_range").agg(F.count("*").alias("rows"), amount.alias("amount"))
    earlier = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offset = lambda c: F.coalesce(F.sum(c).over(earlier), F.lit(0))
    offsets = ranges.select(*by, "_range", offset("rows").alias("_rows"), offset("amount").alias("_amount"))
    within = Window.partitionBy(*by, "_range").orderBy(*order)
    placed = dealt.join(offsets, [*by, "_range"]).withColumn("rank", (F.row_number().over(within) + F.col("_rows")).cast("int"))
    if total:
        before = F.sum(total).over(within.rowsBetween(Window.unboundedPreceding, -1))
        placed = placed.withColumn("before", F.coalesce(before, F.lit(0)) + F.col("_amount"))
    return placed.select(*rows.columns, "rank", *(["before"] if total else []))
