"""Queries over the agreement graph."""

from __future__ import annotations

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyframe.operators import communities as C
from tallyframe.operators import graph as G
from tallyframe.operators import spectral
from tallyframe.operators import votes as V
from tallyframe.operators.projection import signed_edges
from tallyframe.operators.stats import wilson
from tallyframe.sources.shared import reliable
from tallyframe.sources.tables import load

from .inputs import AGREEMENT, BLOCS, blocs, sides
from .registry import query
from .votes import MIN_CAST, MIN_SHARED, contested_ties, tie_tiles

LEVEL = 0.55
STRONG = AGREEMENT + f", strong AS (SELECT * FROM ties WHERE weight >= {LEVEL})"
BOTH = ", both_ AS (SELECT source, target, weight FROM strong UNION ALL SELECT target, source, weight FROM strong)"


def ties(spark, sf):
    return contested_ties(spark, sf)


def strong(spark, sf):
    return ties(spark, sf).where(F.col("weight") >= LEVEL)


def strong_tiles(spark, sf):
    return tie_tiles(spark, sf, LEVEL)


def bloc_ties(spark, sf):
    """(bloc, other, n, weight) of strong ties from both ends."""
    return strong_tiles(spark, sf).bloc_sums(blocs(spark, sf))


@query("threshold_graph", f"WITH {STRONG} SELECT source, target, weight FROM strong")
def threshold_graph(spark, sf):
    return strong_tiles(spark, sf).pairs().select("source", "target", F.col("value").alias("weight"))


@query("edge_attr_join", f"WITH {STRONG}, {BLOCS} SELECT source, target, x.bloc AS bloc_a, y.bloc AS bloc_b FROM strong LEFT JOIN blocs x ON x.member = source LEFT JOIN blocs y ON y.member = target")
def edge_attr_join(spark, sf):
    return strong_tiles(spark, sf).pairs(blocs(spark, sf)).select("source", "target", F.col("a_bloc").alias("bloc_a"), F.col("b_bloc").alias("bloc_b"))


@query("degree_stats", f"""WITH {STRONG}{BOTH}, {BLOCS} SELECT m.member, m.bloc, count(target) AS degree, round(coalesce(sum(weight), 0.0), 6) AS strength, count(*) FILTER (o.bloc <> m.bloc) AS cross_degree
FROM blocs m LEFT JOIN both_ ON source = m.member LEFT JOIN blocs o ON o.member = target GROUP BY 1, 2""")
def degree_stats(spark, sf):
    b = blocs(spark, sf)
    # Ties are summed before they meet the members without any.
    e = strong_tiles(spark, sf).bloc_sums(b, members=True)
    known = F.col("other").isNotNull()
    own = e.groupBy("member").agg(F.sum("n").alias("degree"), F.sum("weight").alias("strength"), F.sum(F.when(known & (F.col("bloc") != F.col("other")), F.col("n"))).alias("cross_degree"))
    n = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return b.join(own, "member", "left").select("member", "bloc", n("degree"), F.round(F.coalesce("strength", F.lit(0.0)), 6).alias("strength"), n("cross_degree"))


@query("density", f"WITH {STRONG}, {BLOCS}, n AS (SELECT count(*) AS n FROM blocs) SELECT n AS nodes, (SELECT count(*) FROM strong) AS edges, round(2 * (SELECT count(*) FROM strong) / nullif(n * (n - 1), 0)::DOUBLE, 6) AS density FROM n")
def density(spark, sf):
    n = blocs(spark, sf).agg(F.count("*").alias("nodes"))
    e = strong(spark, sf).agg(F.count("*").alias("edges"))
    return n.crossJoin(e).select("nodes", "edges", F.round(F.try_divide(2.0 * F.col("edges"), F.col("nodes") * (F.col("nodes") - 1)), 6).alias("density"))


@query("assortativity", f"""WITH {STRONG}{BOTH}, {BLOCS}, e AS (SELECT x.bloc AS a, y.bloc AS b, count(*) AS n FROM both_ JOIN blocs x ON x.member = source JOIN blocs y ON y.member = target GROUP BY 1, 2),
t AS (SELECT sum(n)::DOUBLE AS t, sum(n) FILTER (a = b)::DOUBLE AS same FROM e), m AS (SELECT sum(m * m) AS sq FROM (SELECT sum(n)::DOUBLE AS m FROM e GROUP BY a))
SELECT round((coalesce(same, 0) / t - sq / (t * t)) / nullif(1 - sq / (t * t), 0), 6) AS assortativity FROM t, m""")
def assortativity(spark, sf):
    return G.assortativity_of(bloc_ties(spark, sf).select(F.col("bloc").alias("bloc_a"), F.col("other").alias("bloc_b"), "n"))


@query("modularity", f"""WITH {STRONG}{BOTH}, {BLOCS}, t AS (SELECT sum(weight) AS m FROM strong), i AS (SELECT x.bloc, sum(weight) AS inside FROM strong JOIN blocs x ON x.member = source JOIN blocs y ON y.member = target AND y.bloc = x.bloc GROUP BY 1),
d AS (SELECT bloc, sum(weight) AS d FROM both_ JOIN blocs ON member = source GROUP BY 1)
SELECT round(sum(coalesce(inside, 0) / m - pow(d / (2 * m), 2)), 6) AS modularity FROM d LEFT JOIN i USING (bloc), t""")
def modularity(spark, sf):
    return G.modularity_of(bloc_ties(spark, sf))


#: Shuffles of the labels, as in the reference.
EI_DRAWS = 400
EI = "SELECT {0}x.bloc, count(*) FILTER (x.bloc = y.bloc) AS internal, count(*) FILTER (x.bloc <> y.bloc) AS external FROM both_ JOIN {1} x ON x.member = source JOIN {1} y ON y.member = target{2} GROUP BY ALL"


@query("ei_index", f"WITH {STRONG}{BOTH}, {BLOCS}, c AS ({EI.format('', 'blocs', '')}) SELECT bloc, internal, external, round((external - internal) / nullif(external + internal, 0)::DOUBLE, 6) AS ei FROM c")
def ei_index(spark, sf):
    same = F.col("bloc") == F.col("other")
    c = bloc_ties(spark, sf).where(same.isNotNull()).groupBy("bloc").agg(F.sum(F.when(same, F.col("n")).otherwise(0)).alias("internal"), F.sum(F.when(~same, F.col("n")).otherwise(0)).alias("external"))
    return c.select("bloc", "internal", "external", F.round(F.try_divide((F.col("external") - F.col("internal")).cast("double"), F.col("external") + F.col("internal")), 6).alias("ei"))


@query("ei_null", f"""WITH {STRONG}{BOTH}, {BLOCS}, drawn AS (SELECT draw, member, bloc, row_number() OVER (PARTITION BY draw ORDER BY member) AS place, row_number() OVER (PARTITION BY draw ORDER BY md5('ei|' || draw || '|' || member), member) AS other FROM blocs, range({EI_DRAWS}) d(draw)),
mixed AS (SELECT a.draw, a.member, b.bloc FROM drawn a JOIN drawn b ON a.draw = b.draw AND a.place = b.other), c AS ({EI.format('x.draw, ', 'mixed', ' AND y.draw = x.draw')}),
v AS (SELECT draw, bloc, (external - internal) / (external + internal)::DOUBLE AS ei FROM c)
SELECT bloc, count(*) AS draws, round(avg(ei), 6) AS mean, round(quantile_cont(ei, 0.025), 6) AS p2_5, round(quantile_cont(ei, 0.975), 6) AS p97_5 FROM v GROUP BY 1""")
def ei_null(spark, sf, draws=EI_DRAWS):
    b = blocs(spark, sf)
    names = reliable(b.select("bloc").distinct().withColumn("k", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("bloc")) - 1))
    labels = reliable(V.dealt_labels(b.join(names, "bloc").select("member", "k"), draws, "ei"))
    c = strong_tiles(spark, sf).internal_by_draw(labels, draws, max(names.count(), 1)).where("ends > 0").join(F.broadcast(names), "k")
    v = c.withColumn("ei", (F.col("ends") - 2 * F.col("internal")) / F.col("ends"))
    return v.groupBy("bloc").agg(F.count("*").alias("draws"), F.round(F.avg("ei"), 6).alias("mean"), F.round(F.percentile("ei", 0.025), 6).alias("p2_5"), F.round(F.percentile("ei", 0.975), 6).alias("p97_5"))


NEAREST = ", sym AS (SELECT source, target, weight FROM ties UNION ALL SELECT target, source, weight FROM ties), near AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY weight DESC, target) AS rank FROM sym QUALIFY rank <= 3)"


@query("nearest_k", f"WITH {AGREEMENT}{NEAREST} SELECT source, target, weight, rank FROM near")
def nearest_k(spark, sf):
    return tie_tiles(spark, sf).nearest(3).select("source", "target", "weight", F.col("rank").cast("long").alias("rank"))


@query("alignment_lift", f"""WITH {AGREEMENT}{NEAREST}, {BLOCS}, n AS (SELECT count(*) AS n FROM blocs), s AS (SELECT bloc, count(*) AS size FROM blocs GROUP BY 1)
SELECT x.bloc, count(*) AS links, round(count(*) FILTER (x.bloc = y.bloc) / count(*)::DOUBLE, 6) AS own_share, round((max(size) - 1) / (max(n) - 1)::DOUBLE, 6) AS chance
FROM near JOIN blocs x ON x.member = source JOIN blocs y ON y.member = target JOIN s ON s.bloc = x.bloc, n GROUP BY 1""")
def alignment_lift(spark, sf):
    b = blocs(spark, sf)
    sizes = b.groupBy("bloc").agg(F.count("*").alias("size")).withColumn("n", F.sum("size").over(Window.partitionBy(F.lit(0))))
    t = G.with_blocs(tie_tiles(spark, sf).nearest(3), b).join(sizes, F.col("bloc_a") == F.col("bloc"))
    return t.groupBy("bloc").agg(F.count("*").alias("links"), F.round(F.avg((F.col("bloc_a") == F.col("bloc_b")).cast("double")), 6).alias("own_share"), F.round((F.max("size") - 1) / (F.max("n") - 1), 6).alias("chance"))


@query("components", f"""WITH RECURSIVE {AGREEMENT}, strong AS (SELECT source, target FROM ties WHERE weight >= 0.62), both_ AS (SELECT source, target FROM strong UNION ALL SELECT target, source FROM strong), {BLOCS},
reach(member, seen) AS (SELECT member, member FROM blocs UNION SELECT reach.member, target FROM reach JOIN both_ ON source = seen)
SELECT member, min(seen) AS component FROM reach GROUP BY 1""")
def components(spark, sf):
    return G.components(ties(spark, sf).where("weight >= 0.62"), blocs(spark, sf)).select("member", "component")


@query("communities")
def communities(spark, sf):
    return C.communities(strong(spark, sf))


@query("crosstab_purity", f"""WITH {STRONG}{BOTH}, {BLOCS}, best AS (SELECT source AS member, min_by(target, (-weight, target)) AS community FROM both_ GROUP BY 1),
c AS (SELECT bloc, community % 5 AS community, count(*) AS n FROM best JOIN blocs USING (member) GROUP BY 1, 2)
SELECT community, sum(n)::BIGINT AS members, max(n) AS largest, round(max(n) / sum(n)::DOUBLE, 6) AS purity FROM c GROUP BY 1""")
def crosstab_purity(spark, sf):
    """Purity of groups (here: of each member's strongest tie, in five classes) against blocs."""
    best = strong_tiles(spark, sf).nearest(1).select(F.col("source").alias("member"), (F.col("target") % 5).alias("community"))
    c = best.join(blocs(spark, sf), "member").groupBy("bloc", "community").agg(F.count("*").alias("n"))
    return c.groupBy("community").agg(F.sum("n").alias("members"), F.max("n").alias("largest"), F.round(F.max("n") / F.sum("n"), 6).alias("purity"))


@query("broker_residual", f"""WITH {STRONG}{BOTH}, {BLOCS}, n AS (SELECT count(*) AS n FROM blocs), s AS (SELECT bloc, count(*) AS size FROM blocs GROUP BY 1)
SELECT source AS member, count(*) AS degree, round(count(*) FILTER (x.bloc <> y.bloc) / count(*)::DOUBLE - (max(n) - max(size)) / (max(n) - 1)::DOUBLE, 6) AS residual
FROM both_ JOIN blocs x ON x.member = source JOIN blocs y ON y.member = target JOIN s ON s.bloc = x.bloc, n GROUP BY 1""")
def broker_residual(spark, sf):
    b = blocs(spark, sf)
    sizes = b.groupBy("bloc").agg(F.count("*").alias("size")).withColumn("n", F.sum("size").over(Window.partitionBy(F.lit(0))))
    t = strong_tiles(spark, sf).bloc_sums(b, members=True).where("other IS NOT NULL")
    cross = F.sum(F.when(F.col("bloc") != F.col("other"), F.col("n")).otherwise(0)) / F.sum("n")
    own = t.groupBy("member", "bloc").agg(F.sum("n").alias("degree"), cross.alias("cross")).join(sizes, "bloc")
    return own.select("member", "degree", F.round(F.col("cross") - (F.col("n") - F.col("size")) / (F.col("n") - 1), 6).alias("residual"))


@query("within_cross_gap", f"WITH {AGREEMENT}, {BLOCS} SELECT x.bloc = y.bloc AS within, count(*) AS pairs, round(avg(weight), 6) AS mean FROM ties JOIN blocs x ON x.member = source JOIN blocs y ON y.member = target GROUP BY 1")
def within_cross_gap(spark, sf):
    t = G.with_blocs(ties(spark, sf), blocs(spark, sf)).where("bloc_a IS NOT NULL AND bloc_b IS NOT NULL")
    return t.groupBy((F.col("bloc_a") == F.col("bloc_b")).alias("within")).agg(F.count("*").alias("pairs"), F.round(F.avg("weight"), 6).alias("mean"))


MIX = f"""WITH {STRONG}, {BLOCS}, s AS (SELECT bloc, count(*) AS n FROM blocs GROUP BY 1), grid AS (SELECT x.bloc AS bloc_a, y.bloc AS bloc_b, CASE WHEN x.bloc = y.bloc THEN x.n * (x.n - 1) / 2 ELSE x.n * y.n END::DOUBLE AS possible FROM s x JOIN s y ON x.bloc <= y.bloc),
o AS (SELECT least(x.bloc, y.bloc) AS bloc_a, greatest(x.bloc, y.bloc) AS bloc_b, count(*) AS n FROM strong JOIN blocs x ON x.member = source JOIN blocs y ON y.member = target GROUP BY 1, 2),
whole AS (SELECT (SELECT count(*) FROM strong) / sum(possible) AS density FROM grid)
SELECT bloc_a, bloc_b, coalesce(n, 0) AS observed, possible::BIGINT AS possible, round(coalesce(n, 0) / nullif(possible, 0) / density, 6) AS ratio FROM grid LEFT JOIN o USING (bloc_a, bloc_b), whole"""


@query("mixing_matrix", MIX)
def mixing_matrix(spark, sf):
    b = blocs(spark, sf)
    t = reliable(strong_tiles(spark, sf).bloc_sums(b))
    s = b.groupBy("bloc").agg(F.count("*").alias("n"))
    grid = s.toDF("bloc_a", "na").crossJoin(s.toDF("bloc_b", "nb")).where("bloc_a <= bloc_b")
    grid = grid.withColumn("possible", F.when(F.col("bloc_a") == F.col("bloc_b"), F.col("na") * (F.col("na") - 1) / 2).otherwise(F.col("na") * F.col("nb")).cast("double"))
    # Each tie is counted from both ends.
    half = (F.coalesce(F.sum("n"), F.lit(0)) / 2).cast("long")
    o = t.where("bloc IS NOT NULL AND other IS NOT NULL").groupBy(F.least("bloc", "other").alias("bloc_a"), F.greatest("bloc", "other").alias("bloc_b")).agg(half.alias("n"))
    whole = t.agg(half.alias("edges")).crossJoin(grid.agg(F.sum("possible").alias("all"))).select((F.col("edges") / F.col("all")).alias("density"))
    n = F.coalesce("n", F.lit(0))
    return grid.join(o, ["bloc_a", "bloc_b"], "left").crossJoin(whole).select("bloc_a", "bloc_b", n.cast("long").alias("observed"), F.col("possible").cast("long").alias("possible"), F.round(F.try_divide(F.try_divide(n.cast("double"), F.col("possible")), F.col("density")), 6).alias("ratio"))


GROUPS = f"""WITH {AGREEMENT}, {BLOCS}, m AS (SELECT least(x.bloc, y.bloc) AS bloc_a, greatest(x.bloc, y.bloc) AS bloc_b, count(*) AS pairs, avg(weight) AS mean FROM ties JOIN blocs x ON x.member = source JOIN blocs y ON y.member = target GROUP BY 1, 2)"""


def group_means(spark, sf):
    t = G.with_blocs(ties(spark, sf), blocs(spark, sf))
    return t.groupBy(F.least("bloc_a", "bloc_b").alias("bloc_a"), F.greatest("bloc_a", "bloc_b").alias("bloc_b")).agg(F.count("*").alias("pairs"), F.avg("weight").alias("mean"))


@query("group_agreement_matrix", GROUPS + " SELECT bloc_a, bloc_b, pairs, round(mean, 6) AS mean FROM m")
def group_agreement_matrix(spark, sf):
    return group_means(spark, sf).withColumn("mean", F.round("mean", 6))


@query("mixing_vs_mean", GROUPS + " SELECT bloc_a, bloc_b, round(mean - (SELECT sum(mean * pairs) / sum(pairs) FROM m), 6) AS vs_mean FROM m")
def mixing_vs_mean(spark, sf):
    w = Window.partitionBy(F.lit(0))
    return group_means(spark, sf).select("bloc_a", "bloc_b", F.round(F.col("mean") - F.sum(F.col("mean") * F.col("pairs")).over(w) / F.sum("pairs").over(w), 6).alias("vs_mean"))


@query("block_matrix", GROUPS + """ SELECT CASE WHEN bloc_a = bloc_b THEN 'within' ELSE 'across' END AS series, sum(pairs)::BIGINT AS pairs, round(sum(mean * pairs) / sum(pairs), 6) AS weighted_mean, round(avg(mean), 6) AS plain_mean FROM m
WHERE bloc_a <> (SELECT bloc FROM blocs GROUP BY 1 ORDER BY count(*) DESC, bloc LIMIT 1) AND bloc_b <> (SELECT bloc FROM blocs GROUP BY 1 ORDER BY count(*) DESC, bloc LIMIT 1) GROUP BY 1""")
def block_matrix(spark, sf):
    largest = blocs(spark, sf).groupBy("bloc").count().orderBy(F.desc("count"), "bloc").limit(1).select(F.col("bloc").alias("largest"))
    m = group_means(spark, sf).crossJoin(F.broadcast(largest)).where("bloc_a <> largest AND bloc_b <> largest")
    return m.groupBy(F.when(F.col("bloc_a") == F.col("bloc_b"), "within").otherwise("across").alias("series")).agg(F.sum("pairs").alias("pairs"), F.round(F.sum(F.col("mean") * F.col("pairs")) / F.sum("pairs"), 6).alias("weighted_mean"), F.round(F.avg("mean"), 6).alias("plain_mean"))


@query("edge_overlap_bins", f"""WITH {AGREEMENT}, pairs AS (SELECT DISTINCT least(a.l_suppkey, b.l_suppkey) AS source, greatest(a.l_suppkey, b.l_suppkey) AS target FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_suppkey < b.l_suppkey),
t AS (SELECT floor(weight / 0.05::DOUBLE)::BIGINT AS bin, p.source IS NOT NULL AS both_ FROM ties LEFT JOIN pairs p USING (source, target)),
c AS (SELECT bin, count(*) AS n, count(*) FILTER (both_) AS k FROM t GROUP BY 1)
SELECT bin, n, k, round(k / n::DOUBLE, 6) AS share, round(greatest(0, (k / n::DOUBLE + 1.9208 / n - 1.96 * sqrt(k / n::DOUBLE * (1 - k / n::DOUBLE) / n + 0.9604 / (n * n))) / (1 + 3.8416 / n)), 6) AS low FROM c""")
def edge_overlap_bins(spark, sf):
    """The pairs with common orders look up their agreement; all others are only counted."""
    s = reliable(sides(spark, sf))
    contested = reliable(V.contested_divisions(s, MIN_CAST))
    own = reliable(V.agreement_of(sponsored(spark, sf), s, MIN_SHARED, contested).select("weight"))
    binned = lambda t: t.groupBy(F.floor(F.col("weight") / 0.05).alias("bin")).agg(F.count("*").alias("c"))
    c = binned(V.agreement_ties(s, MIN_SHARED, contested)).withColumnRenamed("c", "n").join(binned(own).withColumnRenamed("c", "k"), "bin", "left").withColumn("k", F.coalesce("k", F.lit(0)).cast("long"))
    return c.select("bin", "n", "k", F.round(F.col("k") / F.col("n"), 6).alias("share"), F.round(wilson(F.col("k"), F.col("n"))[0], 6).alias("low"))


TRIANGLES = ", tri AS (SELECT count(*) AS n FROM strong a JOIN strong b ON a.target = b.source JOIN strong c ON c.source = a.source AND c.target = b.target), deg AS (SELECT sum(d * (d - 1) / 2) AS open FROM (SELECT count(*) AS d FROM both_ GROUP BY source))"


@query("transitivity", f"WITH {STRONG}{BOTH}{TRIANGLES} SELECT n AS triangles, round(3 * n / nullif(open, 0), 6) AS transitivity FROM tri, deg")
def transitivity(spark, sf):
    s = reliable(sides(spark, sf))
    parts = reliable(V.triangle_parts(s, V.contested_divisions(s, MIN_CAST), LEVEL, MIN_SHARED))
    tri = parts.agg(F.coalesce(F.sum("triangles"), F.lit(0)).alias("triangles"))
    degrees = parts.where("member IS NOT NULL").groupBy("member").agg(F.sum("degree").alias("degree"))
    deg = degrees.agg(F.sum(F.col("degree") * (F.col("degree") - 1) / 2).alias("open"))
    return tri.crossJoin(deg).select("triangles", F.round(F.try_divide(3.0 * F.col("triangles"), F.col("open")), 6).alias("transitivity"))


@query("seriation")
def seriation(spark, sf):
    """Members along the Fiedler vector of the strong graph."""
    return spectral.seriate(strong(spark, sf))


@query("mds")
def mds(spark, sf):
    s = reliable(sides(spark, sf))
    xy = spectral.agreement_mds(V.AgreementMatrix(s, MIN_SHARED, V.contested_divisions(s, MIN_CAST)))
    return xy.select("member", F.col("v")[0].alias("x"), F.col("v")[1].alias("y"))


@query("landmark_mds")
def landmark_mds(spark, sf):
    """As mds, from 100 landmarks."""
    xy = spectral.landmark_mds(ties(spark, sf), 100)
    return xy.select("member", F.col("v")[0].alias("x"), F.col("v")[1].alias("y"), "landmark")


@query("radial_layout", f"""WITH {BLOCS}, o AS (SELECT member, bloc, row_number() OVER (PARTITION BY bloc ORDER BY member) AS i FROM blocs)
SELECT member, round(sqrt(i) * cos(i * {math.pi * (3 - math.sqrt(5))}), 6) AS x, round(sqrt(i) * sin(i * {math.pi * (3 - math.sqrt(5))}), 6) AS y FROM o""")
def radial_layout(spark, sf):
    """Members of a bloc on a spiral of golden angles."""
    i = F.row_number().over(Window.partitionBy("bloc").orderBy("member"))
    o = blocs(spark, sf).withColumn("i", i)
    angle = F.col("i") * (math.pi * (3 - math.sqrt(5)))
    return o.select("member", F.round(F.sqrt("i") * F.cos(angle), 6).alias("x"), F.round(F.sqrt("i") * F.sin(angle), 6).alias("y"))


@query("ordinal_in_type", f"WITH {BLOCS}, s AS (SELECT bloc, member % 7 AS grp, count(*) AS size FROM blocs GROUP BY 1, 2) SELECT bloc, grp, size, row_number() OVER (PARTITION BY bloc ORDER BY size DESC, grp) AS ordinal FROM s")
def ordinal_in_type(spark, sf):
    s = blocs(spark, sf).groupBy("bloc", (F.col("member") % 7).alias("grp")).agg(F.count("*").alias("size"))
    return s.withColumn("ordinal", F.row_number().over(Window.partitionBy("bloc").orderBy(F.desc("size"), "grp")).cast("long"))


@query("effect_size", f"""WITH {AGREEMENT}, {BLOCS}, t AS (SELECT x.bloc = y.bloc AS within, weight FROM ties JOIN blocs x ON x.member = source JOIN blocs y ON y.member = target),
m AS (SELECT avg(weight) FILTER (within) AS a, avg(weight) FILTER (NOT within) AS b, var_pop(weight) FILTER (within) AS va, var_pop(weight) FILTER (NOT within) AS vb, count(*) FILTER (within) AS na, count(*) FILTER (NOT within) AS nb FROM t)
SELECT round((a - b) / nullif(sqrt((va * na + vb * nb) / (na + nb)), 0), 6) AS cohens_d FROM m""")
def effect_size(spark, sf):
    t = G.with_blocs(ties(spark, sf), blocs(spark, sf)).where("bloc_a IS NOT NULL AND bloc_b IS NOT NULL").withColumn("w", F.col("bloc_a") == F.col("bloc_b"))
    a, b = F.when(F.col("w"), F.col("weight")), F.when(~F.col("w"), F.col("weight"))
    pooled = F.sqrt((F.var_pop(a) * F.count(a) + F.var_pop(b) * F.count(b)) / F.count("*"))
    return t.agg(F.round((F.avg(a) - F.avg(b)) / F.nullif(pooled, F.lit(0.0)), 6).alias("cohens_d"))


SPONSORED = """sponsored AS (SELECT a.signer AS source, b.signer AS target, count(*) AS weight FROM signed a JOIN signed b ON a.doc = b.doc AND a.signer < b.signer GROUP BY 1, 2)"""
SIGNED = "signed AS (SELECT DISTINCT l_orderkey AS doc, l_suppkey AS signer FROM lineitem)"


def sponsored(spark, sf):
    """Ties of suppliers by the orders that both serve."""
    return signed_edges(load(spark, sf, "lineitem"), "l_orderkey", "l_suppkey").select("source", "target", "weight")


@query("disparity_filter", f"""WITH {SIGNED}, {SPONSORED}, ends AS (SELECT source AS member, weight FROM sponsored UNION ALL SELECT target, weight FROM sponsored), e AS (SELECT member, count(*) AS k, sum(weight) AS s FROM ends GROUP BY 1),
p AS (SELECT source, target, weight, least(CASE WHEN x.k > 1 THEN pow(1 - weight / x.s::DOUBLE, x.k - 1) ELSE 1 END, CASE WHEN y.k > 1 THEN pow(1 - weight / y.s::DOUBLE, y.k - 1) ELSE 1 END) AS p FROM sponsored JOIN e x ON x.member = source JOIN e y ON y.member = target)
SELECT source, target, weight, round(p, 6) AS p, p < 0.05 AS kept FROM p""")
def disparity_filter(spark, sf):
    """Ties of common orders, and which of them are the backbone at 0.05."""
    return G.disparity(sponsored(spark, sf)).select("source", "target", "weight", F.round("p", 6).alias("p"), (F.col("p") < 0.05).alias("kept"))


@query("pair_correlation", f"""WITH {AGREEMENT}, {SIGNED}, {SPONSORED}, often AS (SELECT * FROM sponsored WHERE weight > (SELECT avg(weight) FROM sponsored)), b AS (SELECT t.weight AS x, s.weight AS y FROM ties t FULL JOIN often s ON s.source = t.source AND s.target = t.target),
c AS (SELECT count(*) AS pairs, count(*) FILTER (x IS NOT NULL AND y IS NOT NULL) AS in_both, corr(coalesce(x, 0)::DOUBLE, coalesce(y, 0)::DOUBLE) AS r, corr(x, (y IS NOT NULL)::INTEGER::DOUBLE) FILTER (x IS NOT NULL) AS s FROM b)
SELECT pairs, in_both, CASE WHEN NOT isnan(r) THEN round(r, 6) END AS correlation, CASE WHEN NOT isnan(s) THEN round(s, 6) END AS with_any FROM c""")
def pair_correlation(spark, sf):
    """Do those who vote alike work together? Agreement against pairs that have more common orders than the mean, pair by pair."""
    s = sponsored(spark, sf)
    often = s.crossJoin(F.broadcast(s.agg(F.avg("weight").alias("mean")))).where("weight > mean")
    return G.pair_correlation(ties(spark, sf), often)
