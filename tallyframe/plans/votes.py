"""Queries over positions: agreement, cohesion, fragmentation, similarity of divisions and their nulls."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyframe.operators import spectral
from tallyframe.operators import votes as V
from tallyframe.operators.ranking import global_rank
from tallyframe.sources.shared import reliable
from tallyframe.sources.tables import load

from .inputs import AGREEMENT, BLOCS, CONTESTED, POSITIONS, blocs, positions, sides
from .registry import query

MIN_CAST, MIN_SHARED = 8, 30
#: Draws of the bootstraps and shuffles of the phi null, as in the reference.
BOOTSTRAP, NULLS = 400, 10
DAYS = ", days AS (SELECT l_partkey % 200 AS division, min(l_shipdate)::DATE AS day FROM lineitem GROUP BY 1)"
CHUNKS = DAYS + """, numbered AS (SELECT division, row_number() OVER (ORDER BY day, division) - 1 AS rn, count(*) OVER () AS n FROM days SEMI JOIN kept USING (division)),
chunks AS (SELECT division, least(rn // greatest(n // {0}, 1), {0} - 1) AS chunk FROM numbered)"""


def kept(spark, sf):
    """Contested sides. All sides are written once, since the queries read them several times and each time would sort the line items anew."""
    return V.contested(reliable(sides(spark, sf)), MIN_CAST)


def days(spark, sf):
    return load(spark, sf, "lineitem").groupBy((F.col("l_partkey") % 200).alias("division")).agg(F.min("l_shipdate").cast("date").alias("day"))


def with_chunk(spark, sf, n):
    s = kept(spark, sf)
    d = days(spark, sf).join(s.select("division").distinct(), "division", "left_semi")
    return s.join(V.chunked(d, n, ["day", "division"]).select("division", "chunk"), "division")


def contested_ties(spark, sf):
    """Agreement over contested divisions."""
    s = reliable(sides(spark, sf))
    return V.agreement_ties(s, MIN_SHARED, V.contested_divisions(s, MIN_CAST))


def tie_tiles(spark, sf, level=None, kind=V.ROUNDED):
    """As contested_ties(), which are summed up or picked where they are made."""
    s = reliable(sides(spark, sf))
    return V.Ties(s, MIN_SHARED, V.contested_divisions(s, MIN_CAST), level, kind=kind)


@query("contested_filter", f"WITH {CONTESTED} SELECT division, count(*) AS cast_votes, count(*) FILTER (side = 1) AS yes FROM cast_ GROUP BY 1")
def contested_filter(spark, sf):
    return V.contested_divisions(sides(spark, sf), MIN_CAST)


@query("active_members", f"WITH {CONTESTED} SELECT member, count(*) AS votes FROM cast_ GROUP BY 1 HAVING count(*) >= 30")
def active_members(spark, sf):
    return kept(spark, sf).groupBy("member").agg(F.count("*").alias("votes")).where("votes >= 30")


@query("vote_agreement", f"WITH {AGREEMENT} SELECT source, target, 'vote_agreement' AS layer, shared, weight FROM ties")
def vote_agreement(spark, sf):
    t = tie_tiles(spark, sf).pairs()
    return t.select("source", "target", F.lit("vote_agreement").alias("layer"), "shared", F.col("value").alias("weight"))


@query("rice_cohesion", f"""WITH {POSITIONS}, {BLOCS}, tally AS (SELECT bloc, division, count(*) AS c, abs(sum(side)) / count(*)::DOUBLE AS score FROM sides JOIN blocs USING (member) GROUP BY 1, 2 HAVING count(*) >= 5)
SELECT bloc, count(*) AS divisions, round(median(score), 6) AS median_rice, round(avg(score), 6) AS mean_rice, round(count(*) FILTER (score = 1) / count(*)::DOUBLE, 6) AS share_unanimous FROM tally GROUP BY 1""")
def rice_cohesion(spark, sf):
    r = V.rice(sides(spark, sf), blocs(spark, sf))
    return r.groupBy("bloc").agg(F.count("*").alias("divisions"), F.round(F.median("score"), 6).alias("median_rice"), F.round(F.avg("score"), 6).alias("mean_rice"), F.round(F.avg((F.col("score") == 1).cast("double")), 6).alias("share_unanimous"))


@query("vote_margins", f"""WITH {POSITIONS}, m AS (SELECT division, abs(sum(side)) / count(*)::DOUBLE AS margin FROM sides GROUP BY 1)
SELECT division, round(margin, 6) AS margin, margin >= 0.95 AS near_unanimous, least(floor(margin * 40), 39)::BIGINT AS bin FROM m""")
def vote_margins(spark, sf):
    m = sides(spark, sf).groupBy("division").agg((F.abs(F.sum("side")) / F.count("*")).alias("margin"))
    return m.select("division", F.round("margin", 6).alias("margin"), (F.col("margin") >= 0.95).alias("near_unanimous"), F.least(F.floor(F.col("margin") * 40), F.lit(39)).cast("long").alias("bin"))


@query("participation_decay", f"""WITH {POSITIONS}, size AS (SELECT count(DISTINCT member) AS n FROM pos),
d AS (SELECT division, strftime(min(day), '%Y-%m') AS month, 1 - count(*) / max(n)::DOUBLE AS absent, count(*) FILTER (flag = 'N') / max(n)::DOUBLE AS abstained FROM pos, size GROUP BY 1)
SELECT month, count(*) AS divisions, round(median(absent), 6) AS absent, round(median(abstained), 6) AS abstained, round(median(absent + abstained), 6) AS not_voting FROM d GROUP BY 1 HAVING count(*) >= 5""")
def participation_decay(spark, sf):
    p = positions(spark, sf)
    size = p.agg(F.count_distinct("member").alias("n"))
    d = p.crossJoin(F.broadcast(size)).groupBy("division").agg(F.date_format(F.min("day"), "yyyy-MM").alias("month"), (1 - F.count("*") / F.max("n")).alias("absent"), (F.sum(F.when(F.col("flag") == "N", 1).otherwise(0)) / F.max("n")).alias("abstained"))
    return d.groupBy("month").agg(F.count("*").alias("divisions"), *[F.round(F.median(c), 6).alias(n) for c, n in ((F.col("absent"), "absent"), (F.col("abstained"), "abstained"), (F.col("absent") + F.col("abstained"), "not_voting"))]).where("divisions >= 5")


@query("turnout_by_window", f"""WITH {CONTESTED}{CHUNKS.format(4)}, {BLOCS}, sizes AS (SELECT bloc, count(*) AS members FROM blocs GROUP BY 1), spans AS (SELECT chunk, count(*) AS divisions FROM chunks GROUP BY 1),
c AS (SELECT bloc, chunk, count(*) AS n FROM cast_ JOIN chunks USING (division) JOIN blocs USING (member) GROUP BY 1, 2)
SELECT bloc, chunk, members, divisions, round(n / (members * divisions)::DOUBLE, 6) AS turnout FROM c JOIN sizes USING (bloc) JOIN spans USING (chunk)""")
def turnout_by_window(spark, sf):
    t, b = with_chunk(spark, sf, 4), blocs(spark, sf)
    spans = t.groupBy("chunk").agg(F.count_distinct("division").alias("divisions"))
    sizes = b.groupBy("bloc").agg(F.count("*").alias("members"))
    c = t.join(b, "member").groupBy("bloc", "chunk").agg(F.count("*").alias("n"))
    return c.join(sizes, "bloc").join(spans, "chunk").select("bloc", "chunk", "members", "divisions", F.round(F.col("n") / (F.col("members") * F.col("divisions")), 6).alias("turnout"))


@query("chunked_windows", f"WITH {CONTESTED}{CHUNKS.format(6)} SELECT chunk, count(*) AS divisions, strftime(min(day), '%Y-%m-%d') AS first_day, strftime(max(day), '%Y-%m-%d') AS last_day FROM chunks JOIN days USING (division) GROUP BY 1")
def chunked_windows(spark, sf):
    d = days(spark, sf).join(kept(spark, sf).select("division").distinct(), "division", "left_semi")
    return V.chunked(d, 6, ["day", "division"]).groupBy("chunk").agg(F.count("*").alias("divisions"), F.min("day").cast("string").alias("first_day"), F.max("day").cast("string").alias("last_day"))


CHUNK_PAIRS = """, chunk_pairs AS (SELECT chunk, a.member AS source, b.member AS target, count(*) AS shared, count(*) FILTER (a.side = b.side) AS agreed
  FROM cast_ a JOIN cast_ b ON a.division = b.division AND a.member < b.member JOIN chunks ON chunks.division = a.division GROUP BY 1, 2, 3 HAVING count(*) >= {0})"""


@query("agreement_over_time", f"""WITH {CONTESTED}{CHUNKS.format(6)}{CHUNK_PAIRS.format(12)}, {BLOCS}
SELECT chunk, x.bloc = y.bloc AS within, count(*) AS pairs, round(avg(agreed / shared::DOUBLE), 6) AS mean_agreement FROM chunk_pairs JOIN blocs x ON x.member = source JOIN blocs y ON y.member = target GROUP BY 1, 2""")
def agreement_over_time(spark, sf):
    t = V.Ties(reliable(with_chunk(spark, sf, 6)), 12, by=["chunk"], kind=V.EXACT).bloc_sums(blocs(spark, sf)).where("bloc IS NOT NULL AND other IS NOT NULL")
    # Each pair is summed from both ends.
    return t.groupBy("chunk", (F.col("bloc") == F.col("other")).alias("within")).agg((F.sum("n") / 2).cast("long").alias("pairs"), F.round(F.sum("weight") / F.sum("n"), 6).alias("mean_agreement"))


@query("agreement_by_block", f"WITH {CONTESTED}{CHUNKS.format(4)}{CHUNK_PAIRS.format(12)} SELECT chunk, source, target, shared, round(agreed / shared::DOUBLE, 6) AS weight FROM chunk_pairs")
def agreement_by_block(spark, sf):
    return V.Ties(reliable(with_chunk(spark, sf, 4)), 12, by=["chunk"]).pairs().withColumnRenamed("value", "weight")


@query("balanced_panel", f"""WITH {CONTESTED}{CHUNKS.format(4)}{CHUNK_PAIRS.format(15)}, whole AS (SELECT source, target FROM chunk_pairs GROUP BY 1, 2 HAVING count(*) = 4)
SELECT chunk, count(*) AS pairs, round(avg(agreed / shared::DOUBLE), 6) AS mean_agreement FROM chunk_pairs SEMI JOIN whole USING (source, target) GROUP BY 1""")
def balanced_panel(spark, sf):
    s = reliable(with_chunk(spark, sf, 4))
    p = V.agreement_panel(s, s.select("division", "chunk").distinct(), 4, 15)
    return p.groupBy("chunk").agg(F.count("*").alias("pairs"), F.round(F.avg(F.col("agreed") / F.col("shared")), 6).alias("mean_agreement"))


@query("matched_volume", f"""WITH {CONTESTED}{CHUNKS.format(4)}, r AS (SELECT division, chunk, row_number() OVER (PARTITION BY chunk ORDER BY division) AS rn, min(c) OVER () AS least_ FROM (SELECT *, count(*) OVER (PARTITION BY chunk) AS c FROM chunks))
SELECT chunk, division FROM r WHERE rn <= least_""")
def matched_volume(spark, sf):
    d = with_chunk(spark, sf, 4).select("chunk", "division").distinct()
    w = Window.partitionBy("chunk")
    least = d.groupBy("chunk").count().agg(F.min("count").alias("least"))
    return d.withColumn("rn", F.row_number().over(w.orderBy("division"))).crossJoin(F.broadcast(least)).where("rn <= least").select("chunk", "division")


PHI = """cells AS (SELECT a.division AS d1, b.division AS d2, count(*) AS n, count(*) FILTER (a.side = 1 AND b.side = 1) AS n11, count(*) FILTER (a.side = 1 AND b.side = -1) AS n10,
  count(*) FILTER (a.side = -1 AND b.side = 1) AS n01, count(*) FILTER (a.side = -1 AND b.side = -1) AS n00 FROM {0} a JOIN {0} b ON a.member = b.member AND a.division < b.division{1} GROUP BY 1, 2 HAVING count(*) >= 15),
phis AS (SELECT d1, d2, n, abs(n11 * n00 - n10 * n01) / sqrt((n11 + n10)::DOUBLE * (n01 + n00) * (n11 + n01) * (n10 + n00)) AS phi FROM cells WHERE (n11 + n10) * (n01 + n00) * (n11 + n01) * (n10 + n00) > 0)"""


@query("division_phi", f"WITH {CONTESTED}, {PHI.format('cast_', '')} SELECT d1, d2, n, round(phi, 6) AS phi FROM phis")
def division_phi(spark, sf):
    return V.phi(kept(spark, sf), 15).select("d1", "d2", "n", F.round("phi", 6).alias("phi"))


@query("mean_phi", f"WITH {CONTESTED}, {PHI.format('cast_', '')} SELECT count(*) AS pairs, round(avg(phi), 6) AS mean_phi FROM phis")
def mean_phi(spark, sf):
    return V.phi(kept(spark, sf), 15).agg(F.count("*").alias("pairs"), F.round(F.avg("phi"), 6).alias("mean_phi"))


@query("phi_bootstrap", f"""WITH {CONTESTED}, {PHI.format('cast_', '')}, n AS (SELECT row_number() OVER (ORDER BY division) - 1 AS i, division, count(*) OVER () AS n FROM kept),
picks AS (SELECT DISTINCT draw, b.division FROM range({BOOTSTRAP}) d(draw), n JOIN n b ON b.i = ('0x' || substr(md5('phi|' || draw || '|' || n.i), 1, 8))::BIGINT % n.n)
SELECT x.draw, count(*) AS pairs, round(avg(phi), 6) AS mean_phi FROM phis JOIN picks x ON x.division = d1 JOIN picks y ON y.division = d2 AND y.draw = x.draw GROUP BY 1""")
def phi_bootstrap(spark, sf, draws=BOOTSTRAP):
    s = kept(spark, sf)
    n = s.select("division").distinct().withColumn("i", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("division")) - 1).withColumn("n", F.count("*").over(Window.partitionBy(F.lit(0))))
    drawn = n.crossJoin(spark.range(draws).withColumnRenamed("id", "draw"))
    pick = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit("phi"), "draw", "i")), 1, 8), 16, 10).cast("long") % F.col("n")
    picks = drawn.select("draw", pick.alias("i")).join(n.select("i", "division"), "i").select("draw", "division").distinct()
    p = V.phi(s, 15)
    t = p.join(picks.toDF("draw", "d1"), "d1").join(picks.toDF("draw", "d2"), ["draw", "d2"])
    return t.groupBy("draw").agg(F.count("*").alias("pairs"), F.round(F.avg("phi"), 6).alias("mean_phi"))


SHUFFLED = """drawn AS (SELECT draw, division, member, side, row_number() OVER (PARTITION BY draw, division ORDER BY member) AS place,
  row_number() OVER (PARTITION BY draw, division ORDER BY md5('{0}|' || draw || '|' || division || '|' || member), member) AS other FROM cast_, range({1}) d(draw)),
mixed AS (SELECT a.draw, a.division, a.member, b.side FROM drawn a JOIN drawn b ON a.draw = b.draw AND a.division = b.division AND a.place = b.other)"""


@query("phi_null", f"""WITH {CONTESTED}, {SHUFFLED.format('null', NULLS)}, {PHI.format('mixed', ' AND a.draw = b.draw').replace('SELECT a.division', 'SELECT a.draw, a.division').replace('SELECT d1', 'SELECT draw, d1').replace('BY 1, 2', 'BY 1, 2, 3')},
means AS (SELECT draw, count(*) AS pairs, avg(phi) AS mean FROM phis GROUP BY 1) SELECT coalesce(sum(pairs), 0)::BIGINT AS pairs, round(avg(mean), 6) AS mean_phi FROM means""")
def phi_null(spark, sf, draws=NULLS):
    """The mean of the shuffles' mean phis; pairs of all shuffles."""
    each = V.phi(V.permuted_sides(kept(spark, sf), draws, "null"), 15, ["draw"]).groupBy("draw").agg(F.count("*").alias("pairs"), F.avg("phi").alias("mean_phi"))
    return each.agg(F.coalesce(F.sum("pairs"), F.lit(0)).alias("pairs"), F.round(F.avg("mean_phi"), 6).alias("mean_phi"))


WINS = """tally AS (SELECT {0}division, sum(side) AS net, count(*) FILTER (inside) AS n1, count(*) FILTER (NOT inside) AS n0, count(*) FILTER (inside AND side = 1) AS y1,
  count(*) FILTER (NOT inside AND side = 1) AS y0 FROM {1} JOIN inside USING (member) GROUP BY ALL),
wins AS (SELECT {0}division, CASE WHEN net >= 0 THEN y1 ELSE n1 - y1 END / n1::DOUBLE > 0.5 AND CASE WHEN net >= 0 THEN y0 ELSE n0 - y0 END / n0::DOUBLE > 0.5 AS won_by_both FROM tally WHERE n1 > 0 AND n0 > 0)"""
INSIDE = f"{BLOCS}, inside AS (SELECT member, bloc = (SELECT bloc FROM blocs GROUP BY 1 ORDER BY count(*) DESC, bloc LIMIT 1) AS inside FROM blocs)"


def inside(spark, sf):
    b = blocs(spark, sf)
    largest = b.groupBy("bloc").count().orderBy(F.desc("count"), "bloc").limit(1).select(F.col("bloc").alias("largest"))
    return b.crossJoin(F.broadcast(largest)).select("member", (F.col("bloc") == F.col("largest")).alias("inside"))


@query("cross_cutting", f"WITH {CONTESTED}, {INSIDE}, {WINS.format('', 'cast_')} SELECT division, won_by_both FROM wins")
def cross_cutting(spark, sf):
    return V.cross_cutting(kept(spark, sf), inside(spark, sf))


@query("cross_cutting_null", f"WITH {CONTESTED}, {INSIDE}, {SHUFFLED.format('wins', 12)}, {WINS.format('draw, ', 'mixed')} SELECT draw, count(*) AS divisions, count(*) FILTER (won_by_both) AS wins FROM wins GROUP BY 1")
def cross_cutting_null(spark, sf):
    w = V.cross_cutting(V.permuted_sides(kept(spark, sf), 12, "wins"), inside(spark, sf), ["draw"])
    return w.groupBy("draw").agg(F.count("*").alias("divisions"), F.count_if("won_by_both").alias("wins"))


@query("quarterly_series", f"""WITH {CONTESTED}{DAYS}, q AS (SELECT date_trunc('quarter', day)::DATE AS quarter, count(*) AS divisions FROM days SEMI JOIN kept USING (division) GROUP BY 1),
cal AS (SELECT unnest(generate_series((SELECT min(quarter) FROM q) - INTERVAL 3 MONTH, (SELECT max(quarter) FROM q) + INTERVAL 3 MONTH, INTERVAL 3 MONTH))::DATE AS quarter)
SELECT year(quarter) || 'Q' || quarter(quarter) AS quarter, coalesce(divisions, 0) AS divisions, coalesce(divisions, 0) >= 12 AS scored FROM cal LEFT JOIN q USING (quarter)""")
def quarterly_series(spark, sf):
    d = days(spark, sf).join(kept(spark, sf).select("division").distinct(), "division", "left_semi")
    q = d.groupBy(F.trunc("day", "quarter").alias("quarter")).agg(F.count("*").alias("divisions"))
    ends = q.agg(F.add_months(F.min("quarter"), -3).alias("a"), F.add_months(F.max("quarter"), 3).alias("b"))
    cal = ends.select(F.explode(F.expr("sequence(a, b, interval 3 months)")).alias("quarter"))
    n = F.coalesce("divisions", F.lit(0)).cast("long")
    return cal.join(q, "quarter", "left").select(F.concat(F.year("quarter"), F.lit("Q"), F.quarter("quarter")).alias("quarter"), n.alias("divisions"), (n >= 12).alias("scored"))


@query("decode_positions", """WITH coded AS (SELECT l_suppkey AS member, string_agg(CASE l_returnflag WHEN 'A' THEN 'P' WHEN 'R' THEN 'C' ELSE '-' END, '' ORDER BY l_shipdate, l_orderkey, l_linenumber, l_extendedprice) AS codes FROM lineitem GROUP BY 1),
letters AS (SELECT member, unnest(generate_series(1, length(codes))) AS i, codes FROM coded), ids AS (SELECT p_partkey AS vote, row_number() OVER (ORDER BY p_partkey) AS i FROM part)
SELECT member, vote, CASE codes[letters.i] WHEN 'P' THEN 'pour' ELSE 'contre' END AS position FROM letters JOIN ids ON ids.i = letters.i WHERE codes[letters.i] <> '-'""")
def decode_positions(spark, sf):
    order = F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice", F.translate("l_returnflag", "ARN", "PC-").alias("c"))
    coded = load(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("member")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(order)), lambda x: x["c"]), "").alias("codes"))
    ids = global_rank(load(spark, sf, "part").select(F.col("p_partkey").alias("vote")), ["vote"]).select("vote", (F.col("rank") - 1).alias("i"))
    letters = coded.select("member", F.posexplode(F.split("codes", "")).alias("i", "c"))
    return letters.join(ids, "i").where("c IN ('P', 'C')").select("member", "vote", F.when(F.col("c") == "P", "pour").otherwise("contre").alias("position"))


@query("encode_positions", f"""WITH {POSITIONS}, grid AS (SELECT member, division FROM (SELECT DISTINCT member FROM pos), (SELECT DISTINCT division FROM pos))
SELECT member, string_agg(CASE flag WHEN 'A' THEN 'P' WHEN 'R' THEN 'C' WHEN 'N' THEN 'A' ELSE '-' END, '' ORDER BY division) AS codes FROM grid LEFT JOIN pos USING (member, division) GROUP BY 1""")
def encode_positions(spark, sf):
    p = positions(spark, sf)
    grid = p.select("member").distinct().crossJoin(F.broadcast(p.select("division").distinct()))
    code = F.coalesce(F.translate("flag", "ARN", "PCA"), F.lit("-"))
    listed = F.array_sort(F.collect_list(F.struct("division", code.alias("c"))))
    return grid.join(p, ["member", "division"], "left").groupBy("member").agg(F.array_join(F.transform(listed, lambda x: x["c"]), "").alias("codes"))


@query("scaling_inputs", f"""WITH {CONTESTED}, m AS (SELECT member FROM cast_ GROUP BY 1 HAVING count(*) >= 30), n AS (SELECT count(*) AS n FROM m), c AS (SELECT * FROM cast_ SEMI JOIN m USING (member)),
means AS (SELECT division, sum(side) / max(n)::DOUBLE AS mean FROM c, n GROUP BY 1), own AS (SELECT member, sum(side * mean) AS s FROM c JOIN means USING (division) GROUP BY 1), sq AS (SELECT sum(mean * mean) AS q FROM means),
raw AS (SELECT a.member AS source, b.member AS target, sum(a.side * b.side) AS g FROM c a JOIN c b ON a.division = b.division AND a.member <= b.member GROUP BY 1, 2)
SELECT source, target, round(g - x.s - y.s + q, 6) AS gram FROM raw JOIN own x ON x.member = source JOIN own y ON y.member = target, sq""")
def scaling_inputs(spark, sf):
    return gram(spark, sf).select("source", "target", F.round("gram", 6).alias("gram"))


def gram(spark, sf):
    """Inner products of members' sides, columns centred with non-votes as zeros: one row for source <= target that share a division. Pairs carry what centring takes off at either end, so that none is moved."""
    c, own, q = centred(spark, sf)
    raw = V.Ties(c, 1, kind=V.PRODUCT).pairs(own).select("source", "target", F.col("value").alias("g"), F.col("a_s").alias("x"), F.col("b_s").alias("y"))
    oneself = c.groupBy("member").agg(F.count("*").cast("double").alias("g")).join(own, "member").select(F.col("member").alias("source"), F.col("member").alias("target"), "g", F.col("s").alias("x"), F.col("s").alias("y"))
    return raw.unionByName(oneself).select("source", "target", (F.col("g") - F.col("x") - F.col("y") + F.lit(q)).alias("gram"))


def centred(spark, sf):
    """Sides of active members; (member, s): what centring takes off for each; and the sum of squared means."""
    s = kept(spark, sf)
    active = s.groupBy("member").count().where("count >= 30").select("member")
    c = reliable(s.join(active, "member", "left_semi"))
    n = c.select("member").distinct().count()
    means = reliable(c.groupBy("division").agg((F.sum("side") / F.lit(max(n, 1))).alias("mean")))
    own = reliable(c.join(means, "division").groupBy("member").agg(F.sum(F.col("side") * F.col("mean")).alias("s")))
    return c, own, means.agg(F.coalesce(F.sum(F.col("mean") * F.col("mean")), F.lit(0.0)).alias("q")).first()["q"]


@query("rollcall_scaling")
def rollcall_scaling(spark, sf):
    """Two dimensions of the active members' sides; the first member's are non-negative."""
    s = kept(spark, sf)
    active = s.groupBy("member").count().where("count >= 30").select("member")
    return spectral.scale_sides(s.join(active, "member", "left_semi"))


@query("corr_dummy", f"""WITH {CONTESTED}, {INSIDE}, s AS (SELECT member, avg(side) AS score FROM cast_ GROUP BY 1)
SELECT inside, count(*) AS members, round(avg(score), 6) AS mean_score, (SELECT round(pow(corr(score, inside::INTEGER), 2), 6) FROM s JOIN inside USING (member)) AS r_squared FROM s JOIN inside USING (member) GROUP BY 1""")
def corr_dummy(spark, sf):
    s = kept(spark, sf).groupBy("member").agg(F.avg("side").alias("score")).join(inside(spark, sf), "member")
    r = s.agg(F.round(F.pow(F.corr("score", F.col("inside").cast("int")), 2), 6).alias("r_squared"))
    return s.groupBy("inside").agg(F.count("*").alias("members"), F.round(F.avg("score"), 6).alias("mean_score")).crossJoin(F.broadcast(r))


@query("cluster_bootstrap", f"""WITH {AGREEMENT}, m AS (SELECT member, row_number() OVER (ORDER BY member) - 1 AS i, count(*) OVER () AS n FROM (SELECT DISTINCT member FROM cast_)),
picks AS (SELECT draw, b.member, count(*) AS mult FROM range({BOOTSTRAP}) d(draw), m JOIN m b ON b.i = ('0x' || substr(md5('cluster|' || draw || '|' || m.i), 1, 8))::BIGINT % m.n GROUP BY 1, 2),
means AS (SELECT x.draw, sum(weight * x.mult * y.mult) / sum(x.mult * y.mult) AS mean FROM ties JOIN picks x ON x.member = source JOIN picks y ON y.member = target AND y.draw = x.draw GROUP BY 1),
ranked AS (SELECT mean, row_number() OVER (ORDER BY mean) - 1 AS r, count(*) OVER () AS n FROM means)
SELECT round(min(mean) FILTER (r = floor(0.025 * n)), 6) AS low, round(min(mean) FILTER (r = floor(0.975 * n)), 6) AS high, count(*) AS draws FROM ranked""")
def cluster_bootstrap(spark, sf, draws=BOOTSTRAP):
    """Each draw's mean is summed up in the tiles of members, so that neither ties nor ties by draws are rows."""
    s = reliable(kept(spark, sf))
    w0 = Window.partitionBy(F.lit(0))
    members = global_rank(s.select("member").distinct(), ["member"], "i").withColumn("i", F.col("i") - 1)
    m = members.crossJoin(F.broadcast(members.agg(F.count("*").alias("n"))))
    pick = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit("cluster"), "draw", "i")), 1, 8), 16, 10).cast("long") % F.col("n")
    picks = m.crossJoin(spark.range(draws).withColumnRenamed("id", "draw")).select("draw", pick.alias("i")).join(m.select("i", "member"), "i").groupBy("draw", "member").agg(F.count("*").alias("mult"))
    means = V.bootstrap_sums(s, picks, draws, MIN_SHARED).where("bottom > 0").select("draw", (F.col("top") / F.col("bottom")).alias("mean"))
    r = means.withColumn("r", F.row_number().over(w0.orderBy("mean")) - 1).withColumn("n", F.count("*").over(w0))
    at = lambda q: F.round(F.min(F.when(F.col("r") == F.floor(F.col("n") * q), F.col("mean"))), 6)
    return r.agg(at(0.025).alias("low"), at(0.975).alias("high"), F.count("*").alias("draws"))


@query("stratified_sample", """WITH d AS (SELECT o_orderkey AS id, o_orderdate::DATE AS day, row_number() OVER (PARTITION BY o_orderdate::DATE ORDER BY md5('day|' || o_orderkey), o_orderkey) AS r FROM orders),
q AS (SELECT 500 // count(DISTINCT day) AS quota FROM d), o AS (SELECT id, day, row_number() OVER (ORDER BY CASE WHEN r <= quota THEN 0 ELSE 1 END, md5('day|' || id), id) AS place FROM d, q)
SELECT id, strftime(day, '%Y-%m-%d') AS day FROM o WHERE place <= 500""")
def stratified_sample(spark, sf):
    """500 ids, days in equal quotas by md5 rank, the rest filled by md5 from all other days."""
    d = load(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").cast("date").alias("day"))
    mixed = F.md5(F.concat(F.lit("day|"), F.col("id").cast("string")))
    d = d.withColumn("m", mixed).withColumn("r", F.row_number().over(Window.partitionBy("day").orderBy("m", "id")))
    q = d.agg(F.expr("500 div count(distinct day)").alias("quota"))
    return d.crossJoin(F.broadcast(q)).orderBy(F.when(F.col("r") <= F.col("quota"), 0).otherwise(1), "m", "id").limit(500).select("id", F.col("day").cast("string").alias("day"))
