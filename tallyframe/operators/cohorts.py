"""Do later cohorts carry the names of an earlier one? Coverage, its null, a positive control, power and a filter of names."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: md5 values are uniform, so that the n-th smallest of N lies close to n / N of their range: within so many standard deviations and ranks.
SIGMAS, SPARE = 8, 16
#: Draws by people that a task hashes, about.
ROWS_EACH = 1 << 18


def md5_range(n: int, size: int) -> tuple[str, str]:
    """Bounds of the n-th smallest of `size` md5 values: those before the first are surely among the n, those from the second on surely not."""
    share = min(n / max(size, 1), 1.0)
    slack = (SIGMAS * math.sqrt(size * share * (1 - share)) + SPARE) / max(size, 1)
    low, high = (f"{int(f * 16**8):08x}" if f < 1 else "g" for f in (max(share - slack, 0.0), share + slack))
    return low, high


def hashed(people: DataFrame, n: int, draws: int, seed: str) -> tuple[DataFrame, str, int]:
    """people in each draw with m, the md5 of seed, draw and id, but for those surely beyond the n smallest; the bound of those surely among them; and how many must be found."""
    size = people.count()
    low, high = md5_range(n, size)
    dealt = people.repartition(max(1, math.ceil(size * draws / ROWS_EACH)), "id")
    each = dealt.crossJoin(F.broadcast(people.sparkSession.range(draws).withColumnRenamed("id", "draw")))
    mixed = F.md5(F.concat_ws("|", F.lit(seed), F.col("draw").cast("string"), F.col("id").cast("string")))
    return each.withColumn("m", mixed).where(F.col("m") < high), low, min(n, size)


def drawn(people: DataFrame, n: int, draws: int, seed: str) -> DataFrame:
    """(draw, id, name, place): n of people (id, name) in each draw, those with the smallest md5 of seed, draw and id. Only those that can be among them are ranked."""
    near, _, wanted = hashed(people, n, draws, seed)
    w = Window.partitionBy("draw")
    placed = near.withColumn("place", F.row_number().over(w.orderBy("m", "id"))).withColumn("_n", F.count("*").over(w))
    enough = F.when(F.col("_n") >= wanted, F.col("place")).otherwise(F.raise_error(F.lit("the last md5 value drawn lies outside the ranked range")).cast("int"))
    return placed.where(enough <= n).select("draw", "id", "name", "place")


def drawn_names(people: DataFrame, n: int, draws: int, seed: str) -> DataFrame:
    """(draw, name, taken): how many of each name drawn() draws. Those surely drawn are counted where they are; only those around the last one are shuffled and ranked."""
    near, low, wanted = hashed(people, n, draws, seed)
    kept = lambda c: F.when(F.col("m") >= low, F.col(c)).alias(c)
    sums = near.groupBy("draw", "name", kept("m"), kept("id")).agg(F.count("*").alias("rows"))
    upto = F.sum("rows").over(Window.partitionBy("draw").orderBy(F.asc_nulls_first("m"), "id", "name").rowsBetween(Window.unboundedPreceding, 0))
    reached = sums.withColumn("upto", upto).where(F.col("upto") <= n)
    found = F.sum("rows").over(Window.partitionBy("draw"))
    whole = F.when(found == wanted, F.col("rows")).otherwise(F.raise_error(F.lit("the last md5 value drawn lies outside the ranked range")).cast("long"))
    return reached.withColumn("rows", whole).groupBy("draw", "name").agg(F.sum("rows").alias("taken"))


def coverage(target: DataFrame, names: DataFrame) -> float:
    """The share of target (id, name) whose name is among names (name); 0 of none."""
    found = target.join(names.select("name").distinct().withColumn("_in", F.lit(1)), "name", "left").agg(F.avg(F.coalesce("_in", F.lit(0))).alias("share")).first()["share"]
    return found or 0.0


def coverage_null(target: DataFrame, n: int, draws: int, seed: str = "cover") -> DataFrame:
    """(draw, share): n of the target drawn as a cohort, and the share of the rest whose names the cohort has."""
    totals = target.groupBy("name").agg(F.count("*").alias("total"))
    size = target.count()
    hit = drawn_names(target, n, draws, seed).join(totals, "name")
    return hit.groupBy("draw").agg((F.sum(F.col("total") - F.col("taken")) / F.lit(max(size - n, 1))).alias("share"))


def against_null(null: DataFrame, observed: float) -> DataFrame:
    """One row: observed, null_mean, null_sd, z and the one-sided p = (k + 1) / (n + 1)."""
    o = F.lit(float(observed))
    mean, sd = F.avg("share"), F.stddev_pop("share")
    p = (F.count_if(F.col("share") >= o - 1e-12) + 1) / (F.count("*") + 1)
    return null.agg(F.round(o, 6).alias("observed"), F.round(mean, 6).alias("null_mean"), F.round(sd, 6).alias("null_sd"), F.round(F.try_divide(o - mean, sd), 6).alias("z"), F.round(p, 6).alias("p_higher"), F.count("*").alias("draws"))


def positive_control(donors: DataFrame, target: DataFrame, draws: int, samples: int) -> DataFrame:
    """against_null() for two cohorts between which continuity is expected: donors' and target's members in both must be taken out before.

    Cohorts are a third of the target at most. The observed share is the mean over samples of so many donors.
    """
    n = min(donors.count(), max(target.count() // 3, 2))
    names = drawn_names(donors, n, samples, "donors").select("draw", "name")
    totals = target.groupBy("name").agg(F.count("*").alias("total"))
    covered = names.join(totals, "name").agg(F.coalesce(F.sum("total"), F.lit(0)).alias("s")).first()["s"]
    return against_null(coverage_null(target, n, draws, "control"), covered / max(1, samples * target.count()))


def power(target: DataFrame, names: DataFrame, null: DataFrame, planted: tuple[int, ...], sims: int) -> DataFrame:
    """(k, power): how often the share of the target with one of the names reaches the null's 95th percentile, if k of the target, drawn anew in
    each simulation, are given such a name. A k beyond the target is left out."""
    size = target.count()
    marked = target.join(names.select("name").distinct().withColumn("_in", F.lit(1)), "name", "left").select("id", F.col("id").alias("name"), F.coalesce("_in", F.lit(0)).alias("has"))
    have = marked.agg(F.coalesce(F.sum("has"), F.lit(0)).alias("s")).first()["s"]
    level = null.orderBy("share").offset(int(0.95 * null.count())).limit(1).first()
    threshold = F.lit(float(level["share"]) if level else 1.0)
    ks = [k for k in planted if k <= size]
    # The first k of one order are the k drawn: all k share a simulation's order.
    placed = drawn(marked.select("id", "name"), max(ks, default=0), sims, "power").select("draw", "id", "place").join(marked.select("id", "has"), "id")
    spark = target.sparkSession
    grid = spark.createDataFrame([(k,) for k in ks], "k int").crossJoin(spark.range(sims).withColumnRenamed("id", "draw"))
    lost = grid.join(placed, (grid["draw"] == placed["draw"]) & (placed["place"] <= grid["k"]), "left").groupBy("k", grid["draw"]).agg(F.coalesce(F.sum("has"), F.lit(0)).alias("lost"))
    share = (F.lit(have) - F.col("lost") + F.col("k")) / F.lit(max(size, 1))
    return lost.groupBy("k").agg(F.round(F.avg((share >= threshold - 1e-12).cast("double")), 6).alias("power"))


def credible(first: Column, last: Column) -> Column:
    """Whether a word stands last in names at least as often as first, as family names do; one that was never seen passes."""
    return last >= first


def credible_only(people: DataFrame, places: DataFrame) -> DataFrame:
    """people without those whose name stands first more often than last. places: word, first_places, last_places; a name that it lacks passes."""
    named = people.join(places.withColumnRenamed("word", "name"), "name", "left")
    return named.where(credible(F.coalesce("first_places", F.lit(0)), F.coalesce("last_places", F.lit(0)))).select(*people.columns)
