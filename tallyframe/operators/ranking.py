"""Ranks and running sums over whole tables, without ever bringing all rows to one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.sources.shared import reliable

PLACE = (1 << 33) - 1


def laid_out(df: DataFrame, order: list[str | Column], partitions: int | None = None) -> DataFrame:
    """df range-partitioned and sorted in that order, written once so that later passes read it as it is."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return reliable(df.repartitionByRange(n, *order).sortWithinPartitions(*order))


def offsets(laid: DataFrame, value: Column) -> Column:
    """What `value`, an aggregate, comes to in all partitions before a row's own: one number for each partition goes to the driver."""
    found = {r[0]: r[1] or 0 for r in laid.groupBy(F.spark_partition_id()).agg(value).collect()}
    starts, total = [], 0
    for p in range(max(found, default=0) + 1):
        starts.append(total)
        total += found.get(p, 0)
    return F.element_at(F.array(*map(F.lit, starts)), F.spark_partition_id() + 1)


def global_rank(df: DataFrame, order: list[str | Column], name: str = "rank") -> DataFrame:
    """df with its row number in that order, from 1. The order must end in a key, or equal rows share their places by chance."""
    laid = laid_out(df, order)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit(PLACE))
    return laid.withColumn(name, (offsets(laid, F.count("*")) + place + 1).cast("long"))


def running_sum(df: DataFrame, order: list[str | Column], value: str, name: str) -> DataFrame:
    """df with the sum of `value` over all rows up to and with its own."""
    laid = laid_out(df, order)
    own = laid.withColumn("_before", offsets(laid, F.sum(value))).withColumn("_p", F.spark_partition_id())
    within = F.sum(value).over(Window.partitionBy("_p").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return own.withColumn(name, F.col("_before") + within).drop("_before", "_p")
