"""Joins over time that neither multiply a key's rows nor hold them in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ranking import laid_out


def carried(df: DataFrame, key: str, order: list[str | Column], value: str, name: str) -> DataFrame:
    """df with the last known (not null) `value` at or before each row among the rows of its key, in that order.

    Rows are range-partitioned by key and order, so that a key of any size is spread over tasks; what a partition inherits from those
    before it is one value for each partition, found on the driver. The key must not be null.
    """
    laid = laid_out(df, [F.col(key), *order])
    p = F.spark_partition_id()
    own = Window.partitionBy("_p", key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    within = laid.withColumn("_p", p).withColumn("_known", F.last(value, ignorenulls=True).over(own))
    place = F.monotonically_increasing_id()
    ends = laid.withColumn("_at", place).groupBy(p.alias("p")).agg(F.min(key).alias("a"), F.max(key).alias("b"), F.max_by(F.struct(key, value), F.when(F.col(value).isNotNull(), F.struct(key, "_at"))).alias("last"))
    inherits, open_key, open_value = [], None, None
    for r in sorted(ends.collect(), key=lambda r: r["p"]):
        if open_value is not None and r["a"] == open_key:
            inherits.append((r["p"], open_key, open_value))
        if r["last"] is not None and r["last"][0] == r["b"]:
            open_key, open_value = r["b"], r["last"][1]
        elif r["b"] != open_key:
            open_key, open_value = r["b"], None
    if not inherits:
        return within.withColumn(name, F.col("_known")).drop("_p", "_known")
    kinds = f"_q int, _key {df.schema[key].dataType.simpleString()}, _from {df.schema[value].dataType.simpleString()}"
    past = F.broadcast(df.sparkSession.createDataFrame(inherits, kinds))
    return within.join(past, (F.col("_p") == F.col("_q")) & (F.col(key) == F.col("_key")), "left").withColumn(name, F.coalesce("_known", "_from")).drop("_p", "_known", "_q", "_key", "_from")


def nearest_in_time(queries: DataFrame, versions: DataFrame, key: str, at: str, id: str, version: str) -> DataFrame:
    """(id, version): for each query its key's version nearest in `at`, a whole number; of equally near ones the smallest. Keys without versions and null keys or times drop out.

    queries: key, at, id (each once); versions: key, at, version. Versions of one time are folded, both sides are sorted together, and each query takes what was known last before
    it and first after it: no query meets more than two versions.
    """
    v = versions.where(F.col(key).isNotNull() & F.col(at).isNotNull()).groupBy(key, at).agg(F.min(version).alias("v"))
    q = queries.where(F.col(key).isNotNull() & F.col(at).isNotNull()).select(key, at, F.col(id).alias("id"))
    both = q.withColumn("v", F.lit(None).cast(v.schema["v"].dataType)).unionByName(v.withColumn("id", F.lit(None).cast(q.schema["id"].dataType)))
    both = both.select(key, at, "id", F.when(F.col("v").isNotNull(), F.struct(F.col(at).alias("t"), "v")).alias("mark"))
    before = carried(both, key, [F.col(at), F.col("id").asc_nulls_first()], "mark", "before")
    after = carried(before, key, [F.col(at).desc(), F.col("id").asc_nulls_first()], "mark", "after").where("id IS NOT NULL")
    far = lambda c: F.when(F.col(c).isNotNull(), F.struct(F.abs(F.col(at) - F.col(f"{c}.t")).alias("d"), F.col(f"{c}.v").alias("v")))
    return after.select(F.col("id").alias(id), F.least(far("before"), far("after"))["v"].alias(version)).where(F.col(version).isNotNull())


def overlaps(left: DataFrame, right: DataFrame, a: tuple[str, str], b: tuple[str, str], width: int) -> DataFrame:
    """left joined to right where a[0] < b[1] and a[1] > b[0], whole numbers, nulls never. Column names must differ.

    Spans are dealt to buckets of `width` that they touch, at most those that the other side reaches, and a pair is made in the first bucket that both
    touch: an equi-join, whose rows are the pairs and no product of the sides.
    """
    ends = right.agg(F.min(F.least(b[0], F.col(b[1]) - 1)).alias("_lo"), F.max(F.greatest(b[0], F.col(b[1]) - 1)).alias("_hi")).first()
    lo, hi = (F.lit(x).cast("long") for x in (ends["_lo"], ends["_hi"]))

    def dealt(df: DataFrame, span: tuple[str, str], first: str) -> DataFrame:
        start, end = (F.col(c).cast("long") for c in span)
        low, high = F.greatest(F.least(start, end - 1), lo), F.least(F.greatest(start, end - 1), hi)
        spans = df.where(start.isNotNull() & end.isNotNull()).withColumn(first, F.floor(low / width)).withColumn("_z", F.floor(high / width))
        return spans.where(F.col("_z") >= F.col(first)).withColumn("_bucket", F.explode(F.sequence(first, "_z"))).drop("_z")

    met = dealt(left, a, "_fa").join(dealt(right, b, "_fb"), "_bucket")
    inside = (F.col(a[0]) < F.col(b[1])) & (F.col(a[1]) > F.col(b[0]))
    return met.where(inside & (F.col("_bucket") == F.greatest("_fa", "_fb"))).drop("_bucket", "_fa", "_fb")
