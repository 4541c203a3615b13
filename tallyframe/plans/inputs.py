"""Analogues of members, divisions, groups, spells and documents in the driver's tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.sources.tables import load

#: Divisions are parts modulo this, so that every scale has as many positions in each.
DIVISIONS = 200

POSITIONS = f"""pos AS (SELECT l_suppkey AS member, l_partkey % {DIVISIONS} AS division, max_by(l_returnflag, row(l_shipdate, l_orderkey, l_linenumber, l_extendedprice)) AS flag, min(l_shipdate)::DATE AS day
  FROM lineitem GROUP BY 1, 2),
sides AS (SELECT member, division, CASE flag WHEN 'A' THEN 1 ELSE -1 END AS side FROM pos WHERE flag IN ('A', 'R'))"""
CONTESTED = POSITIONS + """,
kept AS (SELECT division FROM sides GROUP BY 1 HAVING count(*) >= 8 AND least(count(*) FILTER (side = 1), count(*) FILTER (side = -1)) / count(*)::DOUBLE >= 0.025),
cast_ AS (SELECT s.* FROM sides s SEMI JOIN kept USING (division))"""
AGREEMENT = CONTESTED + """,
dyads AS (SELECT a.member AS source, b.member AS target, count(*) AS shared, count(*) FILTER (a.side = b.side) AS agreed
  FROM cast_ a JOIN cast_ b ON a.division = b.division AND a.member < b.member GROUP BY 1, 2 HAVING count(*) >= 30),
ties AS (SELECT source, target, shared, round(agreed / shared::DOUBLE, 6) AS weight FROM dyads)"""
BLOCS = "blocs AS (SELECT s_suppkey AS member, r_name AS bloc FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"
SPELLS = """spells AS (SELECT l_suppkey AS person, (l_orderkey % 7)::VARCHAR AS assembly, l_partkey % 40 AS grp, min(l_shipdate)::DATE AS start_date,
  CASE WHEN l_suppkey % 5 = 0 THEN NULL ELSE min(l_shipdate)::DATE + ((l_suppkey % 9) * 30)::INTEGER END AS end_date
  FROM lineitem GROUP BY l_suppkey, l_orderkey % 7, l_partkey % 40)"""
MOVES = """runs AS (SELECT user_id AS member, event_type AS bloc, ts, event_id, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events),
islands AS (SELECT *, sum(CASE WHEN before IS DISTINCT FROM bloc THEN 1 ELSE 0 END) OVER (PARTITION BY member ORDER BY ts, event_id) AS island FROM runs),
spell AS (SELECT member, island, min(bloc) AS bloc, min(ts) AS start_ts, max(ts) AS last_ts FROM islands GROUP BY 1, 2)"""


def positions(spark: SparkSession, sf: str) -> DataFrame:
    order = F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice")
    return (
        load(spark, sf, "lineitem")
        .groupBy(F.col("l_suppkey").alias("member"), (F.col("l_partkey") % DIVISIONS).alias("division"))
        .agg(F.max_by("l_returnflag", order).alias("flag"), F.min("l_shipdate").cast("date").alias("day"))
    )


def sides(spark: SparkSession, sf: str) -> DataFrame:
    """+1 and -1; abstentions are no side."""
    return positions(spark, sf).where(F.col("flag").isin("A", "R")).select("member", "division", F.when(F.col("flag") == "A", 1).otherwise(-1).alias("side"))


def blocs(spark: SparkSession, sf: str) -> DataFrame:
    s, n, r = (load(spark, sf, t) for t in ("supplier", "nation", "region"))
    return s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey).select(F.col("s_suppkey").alias("member"), F.col("r_name").alias("bloc"))


def spells(spark: SparkSession, sf: str) -> DataFrame:
    """Dated memberships: person, assembly, grp, start_date, end_date (null while open)."""
    first = F.min("l_shipdate").cast("date")
    return (
        load(spark, sf, "lineitem")
        .groupBy(F.col("l_suppkey").alias("person"), (F.col("l_orderkey") % 7).cast("string").alias("assembly"), (F.col("l_partkey") % 40).alias("grp"))
        .agg(first.alias("start_date"))
        .withColumn("end_date", F.when(F.col("person") % 5 != 0, F.date_add("start_date", ((F.col("person") % 9) * 30).cast("int"))))
    )
