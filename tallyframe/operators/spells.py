"""Spells: intervals built from snapshots, runs and panels, by windows and never by loops."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def runs(rows: DataFrame, member: str, value: str, order: list[str]) -> DataFrame:
    """(member, island, value): maximal runs of the same value in order, numbered from 1."""
    w = Window.partitionBy(member).orderBy(*order)
    changed = (~F.lag(value).over(w).eqNullSafe(F.col(value))).cast("int")
    changed = F.when(F.row_number().over(w) == 1, 1).otherwise(changed)
    numbered = rows.withColumn("_new", changed).withColumn("island", F.sum("_new").over(w))
    return numbered.groupBy(member, "island").agg(F.min(value).alias(value))


def transitions(spells: DataFrame, member: str = "member", value: str = "bloc", order: str = "island") -> DataFrame:
    """(member, bloc_from, bloc_to) for each two adjacent spells of a member."""
    after = F.lead(value).over(Window.partitionBy(member).orderBy(order))
    return spells.select(member, F.col(value).alias(f"{value}_from"), after.alias(f"{value}_to")).where(F.col(f"{value}_to").isNotNull())


def value_spells(seen: DataFrame) -> DataFrame:
    """Spells that tile each member's time from snapshots (member, day, value); null values are skipped.

    A new value closes the old spell on its own day. The last spell ends with the last snapshot only if the member is in it.
    bracketed: a bound that lies between two snapshots and is not the first or last one.
    """
    seen = seen.where(F.col("value").isNotNull())
    ends = seen.agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"))
    w = Window.partitionBy("member").orderBy("day")
    changed = F.when(F.lag("value").over(w) == F.col("value"), 0).otherwise(1)
    islands = seen.withColumn("new", changed).withColumn("island", F.sum("new").over(w))
    s = islands.groupBy("member", "island").agg(F.min("value").alias("value"), F.min("day").alias("a"), F.max("day").alias("b"))
    s = s.withColumn("next", F.lead("a").over(Window.partitionBy("member").orderBy("a"))).crossJoin(F.broadcast(ends))
    return s.select("member", "value", F.col("a").alias("start_date"), F.coalesce("next", "b").alias("end_date"), ((F.col("a") > F.col("first_day")) | F.col("next").isNotNull()).alias("bracketed"))


def presence_spells(seen: DataFrame) -> DataFrame:
    """(member, role, start_date, last_seen, snapshots): absence from one snapshot closes a spell; the role is the last one seen."""
    days = seen.select("day").distinct().withColumn("n", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("day")))
    p = seen.join(F.broadcast(days), "day").withColumn("island", F.col("n") - F.row_number().over(Window.partitionBy("member").orderBy("day")))
    return p.groupBy("member", "island").agg(F.max_by("value", "day").alias("role"), F.min("day").alias("start_date"), F.max("day").alias("last_seen"), F.count("*").alias("snapshots")).drop("island")


def observe(seen: DataFrame, category: str) -> DataFrame:
    """First and last sight of each member, whether it came late, and its first absence from a later snapshot of its category."""
    days = seen.groupBy(category).agg(F.array_sort(F.collect_set("day")).alias("days"))
    m = seen.groupBy("member", category).agg(F.min("day").alias("first_seen"), F.max("day").alias("last_seen")).join(F.broadcast(days), category)
    return m.select("member", category, "first_seen", "last_seen", (F.col("first_seen") > F.col("days")[0]).alias("late_arrival"), F.array_min(F.filter("days", lambda d: d > F.col("last_seen"))).alias("first_absent"))


def month_calendar(ends: DataFrame) -> DataFrame:
    """Every month from a to b of the one row of ends."""
    return ends.select(F.explode(F.expr("sequence(trunc(a, 'month'), trunc(b, 'month'), interval 1 month)")).alias("month"))


def monthly_panel(spells: DataFrame, member: str, value: str, tie: list[str]) -> DataFrame:
    """(member, month, value): one value for each member and month; of overlapping spells the one that started last.

    Open bounds run to the first start and the last bound of all spells.
    """
    ends = spells.agg(F.min("start_date").alias("_a"), F.max(F.coalesce("end_date", "start_date")).alias("_b"))
    months = F.expr("sequence(trunc(coalesce(start_date, _a), 'month'), trunc(coalesce(end_date, _b), 'month'), interval 1 month)")
    dated = spells.crossJoin(F.broadcast(ends)).where(F.coalesce("start_date", "_a") <= F.coalesce("end_date", "_b"))
    return dated.withColumn("month", F.explode(months)).groupBy(member, "month").agg(F.max_by(value, F.struct("start_date", *tie)).alias(value))
