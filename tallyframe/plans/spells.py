"""Queries over dated spells, their projections, and the panels built from them."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyframe.operators import projection as P
from tallyframe.operators import spells as S
from tallyframe.operators import temporal
from tallyframe.operators.ranking import running_sum
from tallyframe.operators.stats import laakso
from tallyframe.sources.shared import reliable
from tallyframe.sources.tables import load

from .inputs import MOVES, SPELLS, spells
from .registry import query

DAY = "strftime({0}, '%Y-%m-%d')"
PAIRS = SPELLS + """,
sizes AS (SELECT {0}grp, count(*) AS size FROM spells GROUP BY ALL HAVING count(*) > 1),
pairs AS (SELECT a.assembly, a.grp, size, a.person AS source, b.person AS target, nullif(greatest(coalesce(a.start_date, DATE '0001-01-01'), coalesce(b.start_date, DATE '0001-01-01')), DATE '0001-01-01') AS lo,
  nullif(least(coalesce(a.end_date, DATE '9999-12-31'), coalesce(b.end_date, DATE '9999-12-31')), DATE '9999-12-31') AS hi, a.start_date IS NULL OR b.start_date IS NULL AS assumed
  FROM spells a JOIN spells b ON a.grp = b.grp{1} AND a.person < b.person JOIN sizes s ON s.grp = a.grp{2}
  WHERE greatest(coalesce(a.start_date, DATE '0001-01-01'), coalesce(b.start_date, DATE '0001-01-01')) <= least(coalesce(a.end_date, DATE '9999-12-31'), coalesce(b.end_date, DATE '9999-12-31')))"""
WITHIN = PAIRS.format("assembly, ", " AND a.assembly = b.assembly", " AND s.assembly = a.assembly")


def dates(df, *names):
    return df.withColumns({n: F.col(n).cast("date").cast("string") for n in names})


@query("project_basic", f"WITH {WITHIN} SELECT assembly, source, target, count(*) AS weight FROM pairs GROUP BY 1, 2, 3")
def project_basic(spark, sf):
    return P.weights(spells(spark, sf), ["assembly"], newman=False)


@query("interval_overlap", f"WITH {WITHIN} SELECT assembly, grp, source, target, {DAY.format('lo')} AS lo, {DAY.format('hi')} AS hi FROM pairs")
def interval_overlap(spark, sf):
    p = P.overlapping_pairs(spells(spark, sf), ["assembly", "grp"])
    return dates(p.select("assembly", "grp", "source", "target", "lo", "hi"), "lo", "hi")


@query("project_weighted", f"""WITH {WITHIN} SELECT assembly, source, target, count(*) AS weight, round(sum(1 / (size - 1)::DOUBLE), 6) AS weight_newman, string_agg(grp, ';' ORDER BY grp) AS group_ids, string_agg(size, ';' ORDER BY grp) AS group_size,
{DAY.format('min(lo)')} AS overlap_start, {DAY.format('(list(hi ORDER BY grp))[1]')} AS overlap_end, bool_or(assumed) AS dates_assumed FROM pairs GROUP BY 1, 2, 3""")
def project_weighted(spark, sf):
    return dates(P.project(spells(spark, sf)), "overlap_start", "overlap_end")


@query("project_cross_period", f"WITH {PAIRS.format('', '', '')} SELECT source, target, count(*) AS weight, round(sum(1 / (size - 1)::DOUBLE), 6) AS weight_newman FROM pairs GROUP BY 1, 2")
def project_cross_period(spark, sf):
    """Groups that outlive assemblies: spells meet across them by design."""
    return P.weights(spells(spark, sf), []).select("source", "target", "weight", F.round("weight_newman", 6).alias("weight_newman"))


@query("bipartite_incidence", f"WITH {SPELLS} SELECT person, s_name AS name, assembly, grp, p_brand AS group_name, {DAY.format('start_date')} AS start_date FROM spells JOIN supplier ON s_suppkey = person JOIN part ON p_partkey = grp")
def bipartite_incidence(spark, sf):
    s = load(spark, sf, "supplier").select(F.col("s_suppkey").alias("person"), F.col("s_name").alias("name"))
    p = load(spark, sf, "part").select(F.col("p_partkey").alias("grp"), F.col("p_brand").alias("group_name"))
    return dates(spells(spark, sf).join(s, "person").join(p, "grp").select("person", "name", "assembly", "grp", "group_name", "start_date"), "start_date")


COSIGN = """WITH d AS (SELECT DISTINCT l_orderkey AS doc, l_suppkey AS signer, l_shipdate::DATE AS day FROM lineitem), o AS (SELECT doc, signer, min(day) AS day FROM d GROUP BY 1, 2), s AS (SELECT doc, count(*) AS size, min(day) AS day FROM o GROUP BY 1 HAVING count(*) > 1)"""


@query("cosignature_edges", COSIGN + f" SELECT a.signer AS source, b.signer AS target, count(*) AS weight, round(sum(1 / (size - 1)::DOUBLE), 6) AS weight_newman, {DAY.format('min(s.day)')} AS first_day, {DAY.format('max(s.day)')} AS last_day FROM o a JOIN o b ON a.doc = b.doc AND a.signer < b.signer JOIN s ON s.doc = a.doc GROUP BY 1, 2")
def cosignature_edges(spark, sf):
    e = P.signed_edges(load(spark, sf, "lineitem"), "l_orderkey", "l_suppkey", "l_shipdate")
    return dates(e.select("source", "target", "weight", "weight_newman", "first_day", "last_day"), "first_day", "last_day")


@query("cosponsor_edges", COSIGN + " SELECT a.signer AS source, b.signer AS target, count(*) AS weight, round(sum(1 / (size - 1)::DOUBLE), 6) AS weight_newman, array_to_string(list(a.doc ORDER BY a.doc)[1:20], ';') AS documents FROM o a JOIN o b ON a.doc = b.doc AND a.signer < b.signer JOIN s ON s.doc = a.doc GROUP BY 1, 2")
def cosponsor_edges(spark, sf):
    return P.cosign(load(spark, sf, "lineitem"), "l_orderkey", "l_suppkey")


@query("cooccurrence", f"WITH {SPELLS}, m AS (SELECT DISTINCT person, grp FROM spells) SELECT a.grp AS group_a, b.grp AS group_b, count(*) AS persons FROM m a JOIN m b ON a.person = b.person AND a.grp < b.grp GROUP BY 1, 2")
def cooccurrence(spark, sf):
    m = spells(spark, sf).select("person", "grp").distinct()
    return m.toDF("person", "group_a").join(m.toDF("person", "group_b"), "person").where("group_a < group_b").groupBy("group_a", "group_b").agg(F.count("*").alias("persons"))


@query("node_table", f"""WITH {SPELLS}, o AS (SELECT *, coalesce(start_date, DATE '0001-01-01') AS s FROM spells)
SELECT person, (list(assembly ORDER BY s, assembly, grp))[1] AS first_assembly, (list(assembly ORDER BY s DESC, assembly DESC, grp DESC))[1] AS last_assembly, {DAY.format('(list(end_date ORDER BY s DESC, assembly DESC, grp DESC) FILTER (end_date IS NOT NULL))[1]')} AS last_known_end,
string_agg(DISTINCT grp % 10, ';' ORDER BY grp % 10) AS sectors, count(DISTINCT assembly) AS assemblies, s_name AS name FROM o JOIN supplier ON s_suppkey = person GROUP BY person, s_name""")
def node_table(spark, sf):
    o = F.struct("start_date", "assembly", "grp")
    named = load(spark, sf, "supplier").select(F.col("s_suppkey").alias("person"), F.col("s_name").alias("name"))
    sectors = F.array_join(F.transform(F.array_sort(F.collect_set(F.col("grp") % 10)), lambda x: x.cast("string")), ";")
    n = spells(spark, sf).groupBy("person").agg(
        F.min_by("assembly", o).alias("first_assembly"), F.max_by("assembly", o).alias("last_assembly"), F.max_by("end_date", F.when(F.col("end_date").isNotNull(), o)).alias("last_known_end"), sectors.alias("sectors"), F.count_distinct("assembly").alias("assemblies")
    )
    return dates(n.join(named, "person"), "last_known_end")


@query("spearman_weights", f"""WITH {WITHIN}, e AS (SELECT assembly, source, target, count(*) AS w, round(sum(1 / (size - 1)::DOUBLE), 6) AS v FROM pairs GROUP BY 1, 2, 3),
r AS (SELECT (rank() OVER (ORDER BY w) + (count(*) OVER (PARTITION BY w) - 1) / 2.0)::DOUBLE AS a, (rank() OVER (ORDER BY v) + (count(*) OVER (PARTITION BY v) - 1) / 2.0)::DOUBLE AS b FROM e) SELECT round(corr(a, b), 6) AS spearman, count(*) AS edges FROM r""")
def spearman_weights(spark, sf):
    # Projected once; pairs of weights are counted, and ranks come from running sums over distinct values.
    e = reliable(P.weights(spells(spark, sf), ["assembly"]).groupBy(F.col("weight").alias("w"), F.round("weight_newman", 6).alias("v")).agg(F.count("*").alias("m")))
    total = e.agg(F.sum("m")).first()[0] or 0
    for c, r in (("w", "a"), ("v", "b")):
        n = running_sum(e.groupBy(c).agg(F.sum("m").alias("n")), [c], "n", "upto")
        e = e.join(n.select(c, (F.col("upto") - (F.col("n") - 1) / 2).alias(r)), c)
    a, b = ((F.col(c) - (total + 1) / 2) for c in ("a", "b"))
    both = e.agg(F.sum(F.col("m") * a * b).alias("ab"), F.sum(F.col("m") * a * a).alias("aa"), F.sum(F.col("m") * b * b).alias("bb"))
    return both.select(F.round(F.try_divide("ab", F.sqrt(F.col("aa") * F.col("bb"))), 6).alias("spearman"), F.lit(total).cast("long").alias("edges"))


SNAP = "snaps AS (SELECT DISTINCT ts::DATE AS day FROM events), seen AS (SELECT user_id AS member, ts::DATE AS day, arg_max(event_type, (ts, event_id)) AS value FROM events GROUP BY 1, 2), ends AS (SELECT min(day) AS first_day, max(day) AS last_day FROM snaps)"


def snapshots(spark, sf):
    return load(spark, sf, "events").groupBy(F.col("user_id").alias("member"), F.col("ts").cast("date").alias("day")).agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("value"))


@query("snapshot_spells", f"""WITH {SNAP}, c AS (SELECT *, CASE WHEN lag(value) OVER w IS DISTINCT FROM value THEN 1 ELSE 0 END AS new FROM seen WINDOW w AS (PARTITION BY member ORDER BY day)),
i AS (SELECT *, sum(new) OVER (PARTITION BY member ORDER BY day) AS island FROM c), s AS (SELECT member, island, min(value) AS value, min(day) AS a, max(day) AS b FROM i GROUP BY 1, 2),
l AS (SELECT *, lead(a) OVER (PARTITION BY member ORDER BY a) AS next FROM s)
SELECT member, value, {DAY.format('a')} AS start_date, {DAY.format('CASE WHEN next IS NOT NULL THEN next WHEN b = last_day THEN last_day ELSE b END')} AS end_date, a > first_day OR next IS NOT NULL AS bracketed FROM l, ends""")
def snapshot_spells(spark, sf):
    return dates(S.value_spells(snapshots(spark, sf)), "start_date", "end_date")


@query("presence_spells", f"""WITH {SNAP}, cal AS (SELECT day, row_number() OVER (ORDER BY day) AS n FROM snaps), p AS (SELECT member, day, value, n - row_number() OVER (PARTITION BY member ORDER BY day) AS island FROM seen JOIN cal USING (day))
SELECT member, (list(value ORDER BY day DESC))[1] AS role, {DAY.format('min(day)')} AS start_date, {DAY.format('max(day)')} AS last_seen, count(*) AS snapshots FROM p GROUP BY member, island""")
def presence_spells(spark, sf):
    return dates(S.presence_spells(snapshots(spark, sf)), "start_date", "last_seen")


@query("observe_bounds", f"""WITH {SNAP}, cal AS (SELECT DISTINCT member % 3 AS category, day FROM seen), m AS (SELECT member, member % 3 AS category, min(day) AS first_seen, max(day) AS last_seen FROM seen GROUP BY 1, 2)
SELECT member, {DAY.format('first_seen')} AS first_seen, {DAY.format('last_seen')} AS last_seen, first_seen > (SELECT min(day) FROM cal c WHERE c.category = m.category) AS late_arrival,
{DAY.format('(SELECT min(day) FROM cal c WHERE c.category = m.category AND c.day > m.last_seen)')} AS first_absent FROM m""")
def observe_bounds(spark, sf):
    s = snapshots(spark, sf).withColumn("category", F.col("member") % 3)
    return dates(S.observe(s, "category").drop("category"), "first_seen", "last_seen", "first_absent")


@query("entry_exit_mode", f"""WITH {SNAP}, m AS (SELECT member, min(day) AS a, max(day) AS b FROM seen GROUP BY 1)
SELECT member, CASE WHEN a = first_day THEN 'elected' ELSE 'replacement' END AS entry, CASE WHEN b = last_day THEN 'served' ELSE 'left_early' END AS exit FROM m, ends""")
def entry_exit_mode(spark, sf):
    s = snapshots(spark, sf)
    ends = s.agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"))
    m = s.groupBy("member").agg(F.min("day").alias("a"), F.max("day").alias("b")).crossJoin(F.broadcast(ends))
    return m.select("member", F.when(F.col("a") == F.col("first_day"), "elected").otherwise("replacement").alias("entry"), F.when(F.col("b") == F.col("last_day"), "served").otherwise("left_early").alias("exit"))


CAL = "cal AS (SELECT unnest(generate_series((SELECT min(date_trunc('month', o_orderdate)) FROM orders), (SELECT max(date_trunc('month', o_orderdate)) FROM orders), INTERVAL 1 MONTH))::DATE AS month)"


@query("calendar_zero_fill", f"WITH {CAL}, c AS (SELECT date_trunc('month', o_orderdate)::DATE AS month, count(*) AS n FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 480000 GROUP BY 1) SELECT strftime(month, '%Y-%m') AS month, coalesce(n, 0) AS n FROM cal LEFT JOIN c USING (month)")
def calendar_zero_fill(spark, sf):
    o = load(spark, sf, "orders").withColumn("month", F.trunc("o_orderdate", "month"))
    cal = S.month_calendar(o.agg(F.min("month").alias("a"), F.max("month").alias("b")))
    c = o.where("o_orderpriority = '1-URGENT' AND o_totalprice > 480000").groupBy("month").agg(F.count("*").alias("n"))
    return cal.join(c, "month", "left").select(F.date_format("month", "yyyy-MM").alias("month"), F.coalesce("n", F.lit(0)).alias("n"))


PANEL = """, ends AS (SELECT min(start_date) AS a, max(coalesce(end_date, start_date)) AS b FROM spells),
months AS (SELECT person, grp, start_date, assembly, unnest(generate_series(date_trunc('month', coalesce(start_date, a)), date_trunc('month', coalesce(end_date, b)), INTERVAL 1 MONTH))::DATE AS month FROM spells, ends),
panel AS (SELECT person, month, arg_max(grp, (start_date, assembly, grp)) AS grp FROM months GROUP BY 1, 2)"""


def panel(spark, sf):
    return S.monthly_panel(spells(spark, sf), "person", "grp", ["assembly", "grp"])


@query("monthly_panel", f"WITH {SPELLS}{PANEL} SELECT person, strftime(month, '%Y-%m') AS month, grp FROM panel")
def monthly_panel(spark, sf):
    return panel(spark, sf).withColumn("month", F.date_format("month", "yyyy-MM"))


@query("panel_fold_topk", f"""WITH {SPELLS}{PANEL}, c AS (SELECT month, grp, count(*) AS n FROM panel GROUP BY 1, 2), k AS (SELECT grp FROM c GROUP BY 1 ORDER BY max(n) DESC, grp LIMIT 6)
SELECT strftime(month, '%Y-%m') AS month, CASE WHEN k.grp IS NULL THEN 'Other' ELSE c.grp::VARCHAR END AS grp, sum(n)::BIGINT AS n FROM c LEFT JOIN k USING (grp) GROUP BY 1, 2""")
def panel_fold_topk(spark, sf):
    c = panel(spark, sf).groupBy("month", "grp").agg(F.count("*").alias("n"))
    top = c.groupBy("grp").agg(F.max("n").alias("peak")).orderBy(F.desc("peak"), "grp").limit(6).select("grp", F.lit(True).alias("kept"))
    name = F.when(F.col("kept"), F.col("grp").cast("string")).otherwise("Other")
    return c.join(F.broadcast(top), "grp", "left").groupBy(F.date_format("month", "yyyy-MM").alias("month"), name.alias("grp")).agg(F.sum("n").alias("n"))


@query("effective_number", f"WITH {SPELLS}{PANEL}, c AS (SELECT month, grp, count(*)::DOUBLE AS n FROM panel GROUP BY 1, 2) SELECT strftime(month, '%Y-%m') AS month, count(*) AS parts, round(pow(sum(n), 2) / sum(n * n), 6) AS effective FROM c GROUP BY 1")
def effective_number(spark, sf):
    c = panel(spark, sf).groupBy(F.date_format("month", "yyyy-MM").alias("month"), "grp").agg(F.count("*").alias("n"))
    return laakso(c, "n", ["month"])


@query("latest_spell", f"WITH {SPELLS} SELECT person, arg_max(grp, (coalesce(start_date, DATE '0001-01-01'), assembly, grp)) AS grp FROM spells GROUP BY 1")
def latest_spell(spark, sf):
    return spells(spark, sf).groupBy("person").agg(F.max_by("grp", F.struct("start_date", "assembly", "grp")).alias("grp"))


@query("last_write_wins", "SELECT user_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY 1")
def last_write_wins(spark, sf):
    return load(spark, sf, "events").groupBy("user_id").agg(F.max_by("event_type", "event_id").alias("event_type"))


def moves(spark, sf):
    return S.runs(load(spark, sf, "events").select(F.col("user_id").alias("member"), F.col("event_type").alias("bloc"), "ts", "event_id"), "member", "bloc", ["ts", "event_id"])


TRANS = f"WITH {MOVES}, t AS (SELECT member, bloc AS bloc_from, lead(bloc) OVER (PARTITION BY member ORDER BY island) AS bloc_to FROM spell), m AS (SELECT * FROM t WHERE bloc_to IS NOT NULL)"


@query("transitions", TRANS + " SELECT bloc_from, bloc_to, count(*) AS moves, count(DISTINCT member) AS members FROM m GROUP BY 1, 2")
def transitions(spark, sf):
    return S.transitions(moves(spark, sf)).groupBy("bloc_from", "bloc_to").agg(F.count("*").alias("moves"), F.count_distinct("member").alias("members"))


@query("transition_matrix", TRANS + ", e AS (SELECT bloc_from AS bloc FROM m UNION ALL SELECT bloc_to FROM m) SELECT bloc, count(*) AS involvement, row_number() OVER (ORDER BY count(*) DESC, bloc) AS rank FROM e GROUP BY 1 QUALIFY rank <= 11")
def transition_matrix(spark, sf):
    t = S.transitions(moves(spark, sf))
    ends = t.select(F.explode(F.array("bloc_from", "bloc_to")).alias("bloc")).groupBy("bloc").agg(F.count("*").alias("involvement"))
    order = [F.desc("involvement"), "bloc"]
    return ends.orderBy(*order).limit(11).withColumn("rank", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)).cast("long"))


@query("party_flows", TRANS + ", f AS (SELECT bloc_from AS bloc, 1 AS lost, 0 AS gained FROM m WHERE bloc_from <> bloc_to UNION ALL SELECT bloc_to, 0, 1 FROM m WHERE bloc_from <> bloc_to) SELECT bloc, sum(lost)::BIGINT AS lost, sum(gained)::BIGINT AS gained, (sum(gained) - sum(lost))::BIGINT AS net FROM f GROUP BY 1 HAVING count(*) >= 3")
def party_flows(spark, sf):
    t = S.transitions(moves(spark, sf)).where("bloc_from <> bloc_to")
    ends = [F.struct(F.col(c).alias("bloc"), F.lit(lost).alias("lost"), F.lit(1 - lost).alias("gained")) for c, lost in (("bloc_from", 1), ("bloc_to", 0))]
    f = t.select(F.inline(F.array(*ends)))
    return f.groupBy("bloc").agg(F.sum("lost").alias("lost"), F.sum("gained").alias("gained"), (F.sum("gained") - F.sum("lost")).alias("net"), F.count("*").alias("n")).where("n >= 3").drop("n")


TERMS = "t AS (SELECT DISTINCT o_custkey AS person, year(o_orderdate) AS term FROM orders), r AS (SELECT term, row_number() OVER (ORDER BY term) AS n FROM (SELECT DISTINCT term FROM t)), s AS (SELECT person, n FROM t JOIN r USING (term))"


def terms(spark, sf):
    t = load(spark, sf, "orders").select(F.col("o_custkey").alias("person"), F.year("o_orderdate").alias("term")).distinct()
    r = t.select("term").distinct().withColumn("n", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("term")))
    return t.join(F.broadcast(r), "term").select("person", "n")


@query("career_patterns", f"WITH {TERMS}, p AS (SELECT person, string_agg(n, '-' ORDER BY n) AS pattern, count(*) AS chambers, max(n) - min(n) + 1 > count(*) AS gapped FROM s GROUP BY 1) SELECT pattern, chambers, gapped, count(*) AS people FROM p GROUP BY 1, 2, 3")
def career_patterns(spark, sf):
    served = terms(spark, sf).groupBy("person").agg(F.array_sort(F.collect_set("n")).alias("served"))
    p = served.select(F.array_join(F.transform("served", lambda x: x.cast("string")), "-").alias("pattern"), F.size("served").cast("long").alias("chambers"), (F.array_max("served") - F.array_min("served") + 1 > F.size("served")).alias("gapped"))
    return p.groupBy("pattern", "chambers", "gapped").agg(F.count("*").alias("people"))


@query("returners", f"WITH {TERMS}, x AS (SELECT a.n, a.person, bool_or(b.n = a.n - 1) AS prev, count(b.n) > 0 AS earlier FROM s a LEFT JOIN s b ON a.person = b.person AND b.n < a.n GROUP BY 1, 2) SELECT n, count(*) AS members, count(*) FILTER (prev) AS consecutive, count(*) FILTER (earlier AND NOT prev) AS gap FROM x GROUP BY 1")
def returners(spark, sf):
    before = F.lag("n").over(Window.partitionBy("person").orderBy("n"))
    s = terms(spark, sf).withColumn("before", before)
    return s.groupBy(F.col("n").cast("long").alias("n")).agg(F.count("*").alias("members"), F.count_if(F.col("before") == F.col("n") - 1).alias("consecutive"), F.count_if(F.col("before") < F.col("n") - 1).alias("gap"))


@query("cohort_overlap", f"WITH {TERMS} SELECT a.n AS cohort_a, b.n AS cohort_b, count(*) AS shared FROM s a JOIN s b ON a.person = b.person AND a.n < b.n GROUP BY 1, 2")
def cohort_overlap(spark, sf):
    s = terms(spark, sf).withColumn("n", F.col("n").cast("long"))
    return s.toDF("person", "cohort_a").join(s.toDF("person", "cohort_b"), "person").where("cohort_a < cohort_b").groupBy("cohort_a", "cohort_b").agg(F.count("*").alias("shared"))


@query("range_join_strict", "WITH t AS (SELECT s_suppkey AS person, 1992 + (s_suppkey % 6)::INTEGER AS start_year, CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE 1994 + (s_suppkey % 6)::INTEGER END AS end_year FROM supplier), c AS (SELECT n_nationkey AS chamber, 1990 + n_nationkey AS y0, 1993 + n_nationkey AS y1 FROM nation) SELECT person, chamber FROM t JOIN c ON start_year < y1 AND coalesce(end_year, 9999) > y0")
def range_join_strict(spark, sf):
    t = load(spark, sf, "supplier").select(F.col("s_suppkey").alias("person"), (1992 + F.col("s_suppkey") % 6).alias("start_year"), F.when(F.col("s_suppkey") % 4 != 0, 1994 + F.col("s_suppkey") % 6).alias("end_year"))
    c = load(spark, sf, "nation").select(F.col("n_nationkey").alias("chamber"), (1990 + F.col("n_nationkey")).alias("y0"), (1993 + F.col("n_nationkey")).alias("y1"))
    t = t.withColumn("end_year", F.coalesce("end_year", F.lit(9999)))
    return temporal.overlaps(t, c, ("start_year", "end_year"), ("y0", "y1"), 4).select("person", "chamber")


@query("nearest_time_join", """WITH v AS (SELECT e.event_id AS version, e.user_id, strftime(e.ts, '%Y%m%d')::BIGINT AS at FROM events e WHERE event_type = 'signup'), q AS (SELECT event_id, user_id, strftime(ts, '%Y%m%d')::BIGINT AS at FROM events WHERE event_type = 'purchase')
SELECT event_id, min_by(version, (abs(q.at - v.at), version)) AS version FROM q JOIN v USING (user_id) GROUP BY 1""")
def nearest_time_join(spark, sf):
    """The version nearest in yyyymmdd numbers, the first one among equals."""
    e = load(spark, sf, "events").withColumn("at", F.date_format("ts", "yyyyMMdd").cast("long"))
    v = e.where("event_type = 'signup'").select("user_id", F.col("event_id").alias("version"), F.col("at").alias("v_at"))
    q = e.where("event_type = 'purchase'").select("event_id", "user_id", "at")
    return temporal.nearest_in_time(q, v.withColumnRenamed("v_at", "at"), "user_id", "at", "event_id", "version")
