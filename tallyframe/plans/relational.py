"""Queries over the relational core: scans, filters, joins, aggregates, windows, orders and sets."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T_
from pyspark.sql.pandas.types import to_arrow_schema

from tallyframe.functions.digests import SIDE_BY_SIDE, Endings
from tallyframe.operators import quality as Q
from tallyframe.operators import sketches as K
from tallyframe.operators import stats as T
from tallyframe.operators.ranking import global_rank, running_sum
from tallyframe.sources.tables import load, project_to, render_cell

from .registry import query

#: Draws of the permutation test, as in the reference.
N_PERM = 10_000
#: Rows by draws for each partition, at most and (where cores would be idle) at least; standard deviations and spare rows around the k-th md5 value that are ranked.
ROWS_EACH, LEAST_EACH, RANK_SIGMAS, RANK_SPARE = 80_000_000, 5_000_000, 8, 40
#: Ranked rows that leave a task together.
NEAR_ROWS = 1 << 17


def whole():
    """A window over all rows, for ranks of small tables."""
    return Window.partitionBy(F.lit(0))


def count(cond):
    return F.count_if(cond)


def share(cond, name, digits=6):
    return F.round(F.avg(cond.cast("double")), digits).alias(name)


@query("scan_project", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_totalprice > 100000")
def scan_project(spark, sf):
    return load(spark, sf, "orders").where("o_totalprice > 100000").select("o_orderkey", "o_orderstatus")


@query("json_extract", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_extract(spark, sf):
    return load(spark, sf, "events").select("event_id", F.from_json("props", "k long")["k"].alias("k"))


@query("json_embedded", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_embedded(spark, sf):
    """The first balanced JSON object inside a script text."""
    from tallyframe.functions.text import balanced_json

    script = F.concat(F.lit("var a = 1; window.data = "), "props", F.lit("; track({\"x\": \"}\"});"))
    return load(spark, sf, "events").select("event_id", F.from_json(balanced_json(script, "window.data"), "k long")["k"].alias("k"))


@query("json_map_explode", "SELECT event_type AS party_from, user_id % 3 AS party_to, user_id AS member FROM (SELECT DISTINCT event_type, user_id FROM events)")
def json_map_explode(spark, sf):
    """A JSON map from -> to -> [members], exploded to rows."""
    e = load(spark, sf, "events").select("event_type", "user_id").distinct()
    inner = e.groupBy("event_type", (F.col("user_id") % 3).cast("string").alias("t")).agg(F.collect_set("user_id").alias("members"))
    doc = F.to_json(F.map_from_entries(F.collect_list(F.struct("t", "members"))))
    staged = inner.groupBy("event_type").agg(doc.alias("json"))
    return staged.select("event_type", F.explode(F.from_json("json", "map<string,array<long>>")).alias("t", "members")).select(F.col("event_type").alias("party_from"), F.col("t").cast("long").alias("party_to"), F.explode("members").alias("member"))


@query("schema_project", "SELECT s_suppkey::VARCHAR AS id, s_name AS name, '' AS gender, coalesce(floor(s_acctbal)::BIGINT::VARCHAR, '') AS balance FROM supplier")
def schema_project(spark, sf):
    s = load(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.floor("s_acctbal").alias("balance"))
    return project_to(s, ["id", "name", "gender", "balance"])


@query("render_cells", "SELECT p_partkey, CASE WHEN p_size > 25 THEN 'true' ELSE '' END AS big, p_size::VARCHAR || ';' || p_brand AS tags, trim(regexp_replace(p_name || chr(10) || p_type, '\\s+', ' ', 'g')) AS label, printf('%g', p_retailprice / 7) AS price FROM part")
def render_cells(spark, sf):
    p = load(spark, sf, "part").select("p_partkey", (F.col("p_size") > 25).alias("big"), F.array(F.col("p_size").cast("string"), F.lit(""), "p_brand").alias("tags"), F.concat_ws("\n", "p_name", "p_type").alias("label"), (F.col("p_retailprice") / 7).alias("price"))
    return p.select("p_partkey", *[render_cell(F.col(c), p.schema[c].dataType).alias(c) for c in ("big", "tags", "label", "price")])


@query("batch_rows", "SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 400 AS batch FROM orders")
def batch_rows(spark, sf):
    ranked = global_rank(load(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"])
    return ranked.select("o_orderkey", F.floor((F.col("rank") - 1) / 400).alias("batch"))


@query("filter_eq", "SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'")
def filter_eq(spark, sf):
    return load(spark, sf, "customer").where(F.col("c_mktsegment") == "BUILDING").select("c_custkey")


@query("filter_in", "SELECT o_orderkey FROM orders WHERE o_orderstatus IN ('F', 'P')")
def filter_in(spark, sf):
    return load(spark, sf, "orders").where(F.col("o_orderstatus").isin("F", "P")).select("o_orderkey")


@query("filter_not_empty", "SELECT doc_id FROM documents WHERE text IS NOT NULL AND text <> ''")
def filter_not_empty(spark, sf):
    return load(spark, sf, "documents").where(F.col("text").isNotNull() & (F.col("text") != "")).select("doc_id")


@query("having_min_group", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) >= 12")
def having_min_group(spark, sf):
    return load(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("n")).where("n >= 12")


@query("try_cast_num", "SELECT p_partkey, coalesce(TRY_CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS DOUBLE), -1) AS number FROM part")
def try_cast_num(spark, sf):
    return load(spark, sf, "part").select("p_partkey", T.try_number(F.regexp_extract("p_brand", "([0-9]+)", 1), -1.0).alias("number"))


@query("range_filter", "SELECT p_partkey FROM part WHERE p_size BETWEEN 10 AND 20")
def range_filter(spark, sf):
    return load(spark, sf, "part").where(F.col("p_size").between(10, 20)).select("p_partkey")


@query("largest_per_month", "SELECT strftime(o_orderdate, '%Y-%m') AS month, arg_max(o_orderkey, (o_totalprice, -o_orderkey)) AS o_orderkey FROM orders WHERE o_totalprice >= 12000 GROUP BY 1")
def largest_per_month(spark, sf):
    o = load(spark, sf, "orders").where("o_totalprice >= 12000")
    return o.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(F.max_by("o_orderkey", F.struct("o_totalprice", -F.col("o_orderkey"))).alias("o_orderkey"))


@query("even_sample", "WITH d AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i, count(*) OVER () AS n FROM documents), k AS (SELECT DISTINCT round_even(j * (n - 1) / 36.0, 0)::BIGINT AS i FROM range(37) r(j), (SELECT max(n) AS n FROM d)) SELECT doc_id FROM d SEMI JOIN k USING (i)")
def even_sample(spark, sf):
    """37 rows: the first, the last and evenly spaced ones between."""
    d = global_rank(load(spark, sf, "documents").select("doc_id"), ["doc_id"]).select("doc_id", (F.col("rank") - 1).alias("i"))
    n = d.agg(F.count("*").alias("n"))
    k = n.select(F.explode(F.expr("sequence(0, 36)")).alias("j"), "n").select(F.bround((F.col("j") * (F.col("n") - 1) / 36.0).cast("double"), 0).cast("long").alias("i")).distinct()
    return d.join(F.broadcast(k), "i", "left_semi").select("doc_id")


@query("distinct_states", "SELECT md5(text) AS digest, min(doc_id) AS first_id, max(doc_id) AS last_id FROM documents GROUP BY 1")
def distinct_states(spark, sf):
    return load(spark, sf, "documents").groupBy(F.md5(F.col("text").cast("binary")).alias("digest")).agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))


@query("join_left_dim", "SELECT s_suppkey, coalesce(n_name, '') AS nation FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey")
def join_left_dim(spark, sf):
    n = load(spark, sf, "nation")
    return load(spark, sf, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey"), "left").select("s_suppkey", F.coalesce("n_name", F.lit("")).alias("nation"))


@query("join_inner_dim", "SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey")
def join_inner_dim(spark, sf):
    return load(spark, sf, "customer").join(load(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name")


@query("join_two_hop", "SELECT r_name, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1")
def join_two_hop(spark, sf):
    c, n, r = (load(spark, sf, t) for t in ("customer", "nation", "region"))
    return c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey).groupBy("r_name").agg(F.count("*").alias("customers"))


@query("join_composite", "WITH q AS (SELECT l_partkey, l_suppkey, sum(l_quantity) AS q FROM lineitem GROUP BY 1, 2), m AS (SELECT l_partkey, l_suppkey, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2) SELECT l_partkey, l_suppkey, q, coalesce(n, 0) AS n FROM q LEFT JOIN m USING (l_partkey, l_suppkey)")
def join_composite(spark, sf):
    li = load(spark, sf, "lineitem")
    q = li.groupBy("l_partkey", "l_suppkey").agg(F.sum("l_quantity").alias("q"))
    m = li.where("l_returnflag = 'R'").groupBy("l_partkey", "l_suppkey").agg(F.count("*").alias("n"))
    return q.join(m, ["l_partkey", "l_suppkey"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


@query("semi_join", "SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')")
def semi_join(spark, sf):
    o = load(spark, sf, "orders").where("o_orderpriority = '1-URGENT'")
    return load(spark, sf, "customer").join(o, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey")


@query("anti_join", "SELECT doc_id FROM documents WHERE NOT EXISTS (SELECT 1 FROM labels WHERE labels.doc_id = documents.doc_id)")
def anti_join(spark, sf):
    return load(spark, sf, "documents").select("doc_id").join(load(spark, sf, "labels"), "doc_id", "left_anti")


TURNS = "a AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS slot, text FROM conversations WHERE role = 'user'), b AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS slot, text FROM conversations WHERE role = 'assistant'), lens AS (SELECT conv_id, count(*) FILTER (role = 'user') AS n_a, count(*) FILTER (role = 'assistant') AS n_b FROM conversations WHERE role IN ('user', 'assistant') GROUP BY 1)"


def turn_lists(spark, sf):
    """The turns of users and of assistants as two lists for each conversation."""
    c = load(spark, sf, "conversations").withColumn("slot", F.row_number().over(Window.partitionBy("conv_id", "role").orderBy("turn")).cast("long"))
    return [c.where(F.col("role") == r).select("conv_id", "slot", F.md5(F.col("text").cast("binary")).alias(n)) for r, n in (("user", "asked"), ("assistant", "answered"))]


@query("slot_join", f"WITH {TURNS} SELECT conv_id, slot, md5(a.text) AS asked, md5(b.text) AS answered FROM a JOIN b USING (conv_id, slot) JOIN lens USING (conv_id) WHERE n_a = n_b")
def slot_join(spark, sf):
    """Two parallel lists joined by key and place. Conversations that end with a question are told by slot_mismatches and left out before: unequal lists would be an error."""
    a, b = turn_lists(spark, sf)
    odd = Q.unequal_lists(a, b, "conv_id").select("conv_id")
    return Q.joined_lists(a.join(odd, "conv_id", "left_anti"), b.join(odd, "conv_id", "left_anti"), "conv_id", "slot")


@query("slot_mismatches", f"WITH {TURNS} SELECT conv_id, n_a, n_b FROM lens WHERE n_a <> n_b")
def slot_mismatches(spark, sf):
    return Q.unequal_lists(*turn_lists(spark, sf), "conv_id")


@query("count_by_key", "SELECT lang, count(*) AS n FROM documents GROUP BY 1")
def count_by_key(spark, sf):
    return load(spark, sf, "documents").groupBy("lang").agg(F.count("*").alias("n"))


@query("pivot_counts", "SELECT l_suppkey, count(*) FILTER (l_returnflag = 'A') AS A, count(*) FILTER (l_returnflag = 'N') AS N, count(*) FILTER (l_returnflag = 'R') AS R FROM lineitem GROUP BY 1")
def pivot_counts(spark, sf):
    p = load(spark, sf, "lineitem").groupBy("l_suppkey").pivot("l_returnflag", ["A", "N", "R"]).count()
    return p.select("l_suppkey", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("A", "N", "R")])


@query("pivot_provenance", "SELECT source, count(*) FILTER (lang = 'en') AS en, count(*) FILTER (lang <> 'en') AS other, string_agg(DISTINCT lang, '/' ORDER BY lang) AS langs FROM documents GROUP BY 1")
def pivot_provenance(spark, sf):
    return load(spark, sf, "documents").groupBy("source").agg(count(F.col("lang") == "en").alias("en"), count(F.col("lang") != "en").alias("other"), F.array_join(F.array_sort(F.collect_set("lang")), "/").alias("langs"))


@query("distinct_count", "SELECT l_returnflag, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY 1")
def distinct_count(spark, sf):
    return load(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.count_distinct("l_partkey").alias("parts"))


@query("sets_per_key", "SELECT user_id, string_agg(DISTINCT event_type, ';' ORDER BY event_type) AS kinds FROM events GROUP BY 1")
def sets_per_key(spark, sf):
    return load(spark, sf, "events").groupBy("user_id").agg(F.array_join(F.array_sort(F.collect_set("event_type")), ";").alias("kinds"))


@query("count_of_counts", "SELECT n, count(*) AS customers FROM (SELECT count(*) AS n FROM orders GROUP BY o_custkey) GROUP BY 1")
def count_of_counts(spark, sf):
    return load(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("n")).groupBy("n").agg(F.count("*").alias("customers"))


@query("conditional_share", "SELECT lang, round(count(*) FILTER (quality = 1) / nullif(count(quality), 0)::DOUBLE, 6) AS good FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1")
def conditional_share(spark, sf):
    t = load(spark, sf, "documents").select("doc_id", "lang").join(load(spark, sf, "labels"), "doc_id", "left")
    return t.groupBy("lang").agg(F.round(F.try_divide(count(F.col("quality") == 1).cast("double"), F.count("quality")), 6).alias("good"))


@query("top_share", "WITH t AS (SELECT count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, o_custkey) AS r, count(*) OVER () AS c FROM orders GROUP BY o_custkey) SELECT round(sum(n) FILTER (r <= 20) / sum(n)::DOUBLE, 6) AS top20, round(sum(n) FILTER (r <= greatest(1, c // 10)) / sum(n)::DOUBLE, 6) AS busiest_tenth FROM t")
def top_share(spark, sf):
    t = load(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    t = global_rank(t, [F.desc("n"), "o_custkey"], "r")
    t = t.crossJoin(F.broadcast(t.agg(F.count("*").alias("c"))))
    part = lambda cond: F.round(F.sum(F.when(cond, F.col("n"))) / F.sum("n"), 6)
    return t.agg(part(F.col("r") <= 20).alias("top20"), part(F.col("r") <= F.greatest(F.lit(1), F.floor(F.col("c") / 10))).alias("busiest_tenth"))


@query("dist_summary", "SELECT l_returnflag, round(avg(l_quantity), 6) AS mean, median(l_quantity) AS median, round(stddev_pop(l_quantity), 6) AS sd, quantile_cont(l_quantity, 0.1) AS p10, quantile_cont(l_quantity, 0.9) AS p90 FROM lineitem GROUP BY 1")
def dist_summary(spark, sf):
    q = "l_quantity"
    return load(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.round(F.avg(q), 6).alias("mean"), F.median(q).alias("median"), F.round(F.stddev_pop(q), 6).alias("sd"), F.percentile(q, 0.1).alias("p10"), F.percentile(q, 0.9).alias("p90"))


@query("arg_extreme", "SELECT c_nationkey, arg_max(c_custkey, (c_acctbal, c_custkey)) AS richest, arg_min(c_custkey, (c_acctbal, c_custkey)) AS poorest FROM customer GROUP BY 1")
def arg_extreme(spark, sf):
    o = F.struct("c_acctbal", "c_custkey")
    return load(spark, sf, "customer").groupBy("c_nationkey").agg(F.max_by("c_custkey", o).alias("richest"), F.min_by("c_custkey", o).alias("poorest"))


@query("fold_to_other", "WITH c AS (SELECT p_type, count(*) AS n FROM part GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY n DESC, p_type) AS rn FROM c) SELECT CASE WHEN rn <= 4 THEN p_type ELSE 'Other' END AS kind, sum(n)::BIGINT AS n FROM r GROUP BY 1")
def fold_to_other(spark, sf):
    c = load(spark, sf, "part").groupBy("p_type").agg(F.count("*").alias("n"))
    top = c.orderBy(F.desc("n"), "p_type").limit(4).select("p_type", F.lit(True).alias("kept"))
    r = c.join(F.broadcast(top), "p_type", "left")
    return r.groupBy(F.when(F.col("kept"), F.col("p_type")).otherwise("Other").alias("kind")).agg(F.sum("n").alias("n"))


@query("histogram", "SELECT least(floor(l_discount / 0.01), 9)::BIGINT AS bin, count(*) AS n FROM lineitem WHERE l_discount BETWEEN 0 AND 0.1 GROUP BY 1")
def histogram(spark, sf):
    return load(spark, sf, "lineitem").select(T.histogram_bin(F.col("l_discount"), 0.0, 0.1, 10).alias("bin")).where("bin IS NOT NULL").groupBy("bin").agg(F.count("*").alias("n"))


@query("band_counts", "WITH c AS (SELECT count(*) AS n FROM orders GROUP BY o_custkey) SELECT CASE WHEN n < 5 THEN '1-4' WHEN n < 20 THEN '5-19' ELSE '20+' END AS band, count(*) AS customers FROM c GROUP BY 1")
def band_counts(spark, sf):
    c = load(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    return c.groupBy(F.when(F.col("n") < 5, "1-4").when(F.col("n") < 20, "5-19").otherwise("20+").alias("band")).agg(F.count("*").alias("customers"))


@query("rank_top", "SELECT o_custkey, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, o_custkey) AS place FROM orders GROUP BY 1 QUALIFY place <= 25")
def rank_top(spark, sf):
    c = load(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    order = [F.desc("n"), "o_custkey"]
    return c.orderBy(*order).limit(25).withColumn("place", F.row_number().over(whole().orderBy(*order)).cast("long"))


@query("lorenz_gini", "WITH c AS (SELECT c_mktsegment AS series, o_custkey, count(*) AS n FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2), r AS (SELECT series, n, sum(n) OVER (PARTITION BY series ORDER BY n ROWS UNBOUNDED PRECEDING)::DOUBLE AS c, sum(n) OVER (PARTITION BY series)::DOUBLE AS t, count(*) OVER (PARTITION BY series) AS k FROM c) SELECT series, count(*) AS n, round(1 - sum((2 * c - n) / t / k), 6) AS gini FROM r GROUP BY 1")
def lorenz_gini(spark, sf):
    o, c = load(spark, sf, "orders"), load(spark, sf, "customer")
    n = o.join(c, o.o_custkey == c.c_custkey).groupBy(F.col("c_mktsegment").alias("series"), "o_custkey").agg(F.count("*").alias("v"))
    return T.lorenz(n, "v", ["series"])


@query("first_last", "SELECT o_custkey, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS first_order, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS last_order FROM orders GROUP BY 1")
def first_last(spark, sf):
    o = F.struct("o_orderdate", "o_orderkey")
    return load(spark, sf, "orders").groupBy("o_custkey").agg(F.min_by("o_orderkey", o).alias("first_order"), F.max_by("o_orderkey", o).alias("last_order"))


@query("last_non_null", "WITH e AS (SELECT event_id, user_id, ts, CASE WHEN event_type = 'purchase' THEN event_id END AS bought FROM events) SELECT event_id, last_value(bought IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS last_bought FROM e")
def last_non_null(spark, sf):
    e = load(spark, sf, "events").withColumn("bought", F.when(F.col("event_type") == "purchase", F.col("event_id")))
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    return e.select("event_id", F.last("bought", ignorenulls=True).over(w).alias("last_bought"))


@query("sort_multi", "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey) AS place FROM orders")
def sort_multi(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return global_rank(o, ["o_orderpriority", F.desc("o_totalprice"), "o_orderkey"], "place").select("o_orderkey", "place")


@query("sort_fallback", "WITH t AS (SELECT s_suppkey, CASE WHEN s_suppkey % 3 > 0 THEN s_name END AS a, CASE WHEN s_suppkey % 2 > 0 THEN 'z' || s_name END AS b FROM supplier) SELECT s_suppkey, row_number() OVER (ORDER BY coalesce(a, b, '9999'), s_suppkey) AS place FROM t")
def sort_fallback(spark, sf):
    t = load(spark, sf, "supplier").select("s_suppkey", F.when(F.col("s_suppkey") % 3 > 0, F.col("s_name")).alias("a"), F.when(F.col("s_suppkey") % 2 > 0, F.concat(F.lit("z"), "s_name")).alias("b"))
    return global_rank(t.select("s_suppkey", F.coalesce("a", "b", F.lit("9999")).alias("key")), ["key", "s_suppkey"], "place").select("s_suppkey", "place")


@query("topk", "SELECT l_partkey, sum(l_quantity) AS q FROM lineitem GROUP BY 1 ORDER BY q DESC, l_partkey LIMIT 18")
def topk(spark, sf):
    return load(spark, sf, "lineitem").groupBy("l_partkey").agg(F.sum("l_quantity").alias("q")).orderBy(F.desc("q"), "l_partkey").limit(18)


YEARS = "SELECT DISTINCT o_custkey FROM orders WHERE year(o_orderdate) = {0}"


def customers_of(spark, sf, year):
    return load(spark, sf, "orders").where(F.year("o_orderdate") == year).select("o_custkey").distinct()


@query("set_intersect", f"{YEARS.format(1995)} INTERSECT {YEARS.format(1996)}")
def set_intersect(spark, sf):
    return customers_of(spark, sf, 1995).intersect(customers_of(spark, sf, 1996))


@query("set_union", f"{YEARS.format(1995)} UNION {YEARS.format(1996)}")
def set_union(spark, sf):
    return customers_of(spark, sf, 1995).union(customers_of(spark, sf, 1996)).distinct()


@query("set_except", f"{YEARS.format(1995)} EXCEPT {YEARS.format(1996)}")
def set_except(spark, sf):
    return customers_of(spark, sf, 1995).subtract(customers_of(spark, sf, 1996))


@query("overlap_matrix", "WITH m AS (SELECT DISTINCT o_custkey AS c, year(o_orderdate)::BIGINT AS y FROM orders) SELECT a.y AS year_a, b.y AS year_b, count(*) AS shared FROM m a JOIN m b USING (c) WHERE a.y <= b.y GROUP BY 1, 2 HAVING count(*) >= 2")
def overlap_matrix(spark, sf):
    m = load(spark, sf, "orders").select(F.col("o_custkey").alias("c"), F.year("o_orderdate").cast("long").alias("y")).distinct()
    return m.toDF("c", "year_a").join(m.toDF("c", "year_b"), "c").where("year_a <= year_b").groupBy("year_a", "year_b").agg(F.count("*").alias("shared")).where("shared >= 2")


@query("dedupe_first", "SELECT md5(text) AS digest, min(doc_id) AS doc_id, arg_min(source, doc_id) AS source FROM documents GROUP BY 1")
def dedupe_first(spark, sf):
    return load(spark, sf, "documents").groupBy(F.md5(F.col("text").cast("binary")).alias("digest")).agg(F.min("doc_id").alias("doc_id"), F.min_by("source", "doc_id").alias("source"))


@query("union_series", "SELECT 'lang' AS series, lang AS key, count(*) AS documents, NULL::BIGINT AS characters FROM documents GROUP BY 2 UNION ALL SELECT 'source', source, NULL, sum(n_chars)::BIGINT FROM documents GROUP BY 2")
def union_series(spark, sf):
    d = load(spark, sf, "documents")
    a = d.groupBy(F.lit("lang").alias("series"), F.col("lang").alias("key")).agg(F.count("*").alias("documents"))
    b = d.groupBy(F.lit("source").alias("series"), F.col("source").alias("key")).agg(F.sum("n_chars").alias("characters"))
    return a.unionByName(b, allowMissingColumns=True)


@query("date_buckets", "SELECT strftime(o_orderdate, '%Y-%m') AS month, year(o_orderdate) || 'Q' || quarter(o_orderdate) AS quarter, count(*) AS n FROM orders GROUP BY 1, 2")
def date_buckets(spark, sf):
    return load(spark, sf, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month"), F.concat(F.year("o_orderdate"), F.lit("Q"), F.quarter("o_orderdate")).alias("quarter")).agg(F.count("*").alias("n"))


@query("period_label", "SELECT CASE WHEN strftime(o_orderdate, '%Y-%m-%d') < '1994-07-01' THEN 'before' WHEN strftime(o_orderdate, '%Y-%m-%d') <= '1996-06-30' THEN 'crisis' ELSE 'after' END AS period, count(*) AS n FROM orders GROUP BY 1")
def period_label(spark, sf):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return load(spark, sf, "orders").groupBy(F.when(day < "1994-07-01", "before").when(day <= "1996-06-30", "crisis").otherwise("after").alias("period")).agg(F.count("*").alias("n"))


W = "(k / n::DOUBLE + 1.9208 / n {0} 1.96 * sqrt(k / n::DOUBLE * (1 - k / n::DOUBLE) / n + 0.9604 / (n * n))) / (1 + 3.8416 / n)"


@query("wilson_interval", f"WITH c AS (SELECT lang, count(*) AS n, count(*) FILTER (quality = 1) AS k FROM documents JOIN labels USING (doc_id) GROUP BY 1) SELECT lang, n, k, round(greatest(0, {W.format('-')}), 6) AS low, round(least(1, {W.format('+')}), 6) AS high FROM c")
def wilson_interval(spark, sf):
    c = load(spark, sf, "documents").select("doc_id", "lang").join(load(spark, sf, "labels"), "doc_id").groupBy("lang").agg(F.count("*").alias("n"), count(F.col("quality") == 1).alias("k"))
    low, high = T.wilson(F.col("k"), F.col("n"))
    return c.select("lang", "n", "k", F.round(low, 6).alias("low"), F.round(high, 6).alias("high"))


@query("kde", """WITH v AS (SELECT s_acctbal AS x FROM supplier), b AS (SELECT greatest(1.06 * stddev_pop(x) * pow(count(*), -0.2), 0.001) AS h, count(*) AS n FROM v), g AS (SELECT -1000 + 250 * i AS point FROM range(49) r(i))
SELECT point::BIGINT AS point, round(sum(exp(-0.5 * pow((point - x) / h, 2))) / (max(n) * max(h) * sqrt(2 * pi())) * 1000, 6) AS density FROM g, v, b GROUP BY 1""")
def kde(spark, sf):
    """A Gaussian density on a grid of 49 points, Silverman's bandwidth; every value meets each grid point."""
    v = load(spark, sf, "supplier").select(F.col("s_acctbal").alias("x"))
    b = v.agg(F.greatest(1.06 * F.stddev_pop("x") * F.pow(F.count("*"), F.lit(-0.2)), F.lit(0.001)).alias("h"), F.count("*").alias("n"))
    g = spark.range(49).select((F.col("id") * 250 - 1000).alias("point"))
    t = v.crossJoin(F.broadcast(b)).crossJoin(F.broadcast(g))
    kernel = F.exp(-0.5 * F.pow((F.col("point") - F.col("x")) / F.col("h"), 2))
    return t.groupBy("point").agg(F.round(F.sum(kernel) / (F.max("n") * F.max("h") * F.sqrt(2 * F.pi())) * 1000, 6).alias("density"))


@query("superiority", "WITH a AS (SELECT c_acctbal AS x FROM customer WHERE c_mktsegment = 'BUILDING'), b AS (SELECT c_acctbal AS x FROM customer WHERE c_mktsegment = 'MACHINERY') SELECT round(avg(CASE WHEN a.x > b.x THEN 1.0 WHEN a.x = b.x THEN 0.5 ELSE 0.0 END), 6) AS superiority FROM a, b")
def superiority(spark, sf):
    """The chance that a value of one group exceeds one of the other, ties a half, from rank sums."""
    c = load(spark, sf, "customer").where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).groupBy("c_acctbal").agg(count(F.col("c_mktsegment") == "BUILDING").alias("a"), count(F.col("c_mktsegment") == "MACHINERY").alias("b"))
    c = running_sum(c, ["c_acctbal"], "b", "upto")
    return c.withColumn("below", F.col("upto") - F.col("b") / 2).agg(F.round(F.sum(F.col("a") * F.col("below")) / (F.sum("a").cast("double") * F.sum("b")), 6).alias("superiority"))


@query("two_group_summary", "WITH t AS (SELECT c_mktsegment = 'BUILDING' AS g, c_acctbal AS x FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')) SELECT round(median(x) FILTER (g) - median(x) FILTER (NOT g), 6) AS median_gap, count(*) FILTER (g) AS n_a, count(*) FILTER (NOT g) AS n_b, round(greatest(min(x) FILTER (g), min(x) FILTER (NOT g)), 6) AS overlap_low, round(least(max(x) FILTER (g), max(x) FILTER (NOT g)), 6) AS overlap_high FROM t")
def two_group_summary(spark, sf):
    t = load(spark, sf, "customer").where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))
    a, b = (F.when(F.col("c_mktsegment") == s, F.col("c_acctbal")) for s in ("BUILDING", "MACHINERY"))
    return t.agg(F.round(F.median(a) - F.median(b), 6).alias("median_gap"), F.count(a).alias("n_a"), F.count(b).alias("n_b"), F.round(F.greatest(F.min(a), F.min(b)), 6).alias("overlap_low"), F.round(F.least(F.max(a), F.max(b)), 6).alias("overlap_high"))


@query("permutation_test", f"""WITH c AS (SELECT c_custkey AS id, c_acctbal AS x, c_mktsegment = 'BUILDING' AS g FROM customer), k AS (SELECT count(*) FILTER (g) AS k, avg(x) FILTER (g) AS observed FROM c),
r AS (SELECT draw, x, row_number() OVER (PARTITION BY draw ORDER BY md5('perm|' || draw || '|' || id), id) AS rn FROM c, range({N_PERM}) d(draw)), m AS (SELECT draw, avg(x) FILTER (rn <= k) AS mean FROM r, k GROUP BY 1)
SELECT count(*) AS draws, round((max(observed) - avg(mean)) / stddev_pop(mean), 6) AS z, round((count(*) FILTER (mean >= observed) + 1) / (count(*) + 1)::DOUBLE, 6) AS p FROM m, k""")
def permutation_test(spark, sf, draws=N_PERM):
    """Draws without replacement by md5 ranks; p = (k + 1) / (n + 1).

    md5 values are uniform, so the k-th smallest of n lies close to k / n of their range. Values clearly below are summed where they are, those
    clearly above are left, and only those around it are shuffled and ranked. Each task hashes its rows side by side. A draw whose k-th value lies elsewhere stops the query.
    """
    c = load(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("x"), (F.col("c_mktsegment") == "BUILDING").alias("g"))
    n, k, observed = c.agg(F.count("*"), F.count_if("g"), F.avg(F.when(F.col("g"), F.col("x")))).first()
    share = k / max(n, 1)
    slack = (RANK_SIGMAS * math.sqrt(n * share * (1 - share)) + RANK_SPARE) / max(n, 1)
    low, high = (min(int(f * 16**8), 16**8) for f in (max(share - slack, 0.0), share + slack))
    parts = max(min(math.ceil(n * draws / LEAST_EACH), spark.sparkContext.defaultParallelism), math.ceil(n * draws / ROWS_EACH), 1)
    spread = c.select("id", "x").repartition(parts, "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sure = np.zeros((3, draws))
        for whole in batches:
            for batch in (whole.slice(at, SIDE_BY_SIDE) for at in range(0, whole.num_rows, SIDE_BY_SIDE)):
                ids, x = batch.column("id"), batch.column("x")
                there = x.is_valid().to_numpy(zero_copy_only=False).astype(float)
                of = np.stack([np.ones(len(x)), there, x.fill_null(0.0).to_numpy()])
                endings = Endings(["" if i is None else f"|{i}" for i in ids.to_pylist()])
                near = []
                for draw in range(draws):
                    head = endings.heads(f"perm|{draw}") >> np.uint64(32)
                    sure[:, draw] += of @ (head < low)
                    near.append(np.flatnonzero((head >= low) & (head < high)))
                drawn, at = np.repeat(np.arange(draws), [len(i) for i in near]), np.concatenate(near)
                for some in (slice(i, i + NEAR_ROWS) for i in range(0, len(at), NEAR_ROWS)):
                    rows, values, totals = of[:, at[some]]
                    yield pa.RecordBatch.from_arrays([pa.array(drawn[some]), ids.take(pa.array(at[some])), pa.array([True]).take(pa.array(np.zeros(len(rows), int))), *sums_of(rows, values, totals)], schema=schema)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(draws)), pa.nulls(draws, pa.int64()), pa.array(np.zeros(draws, bool)), *sums_of(*sure)], schema=schema)

    def sums_of(rows: np.ndarray, values: np.ndarray, totals: np.ndarray) -> list[pa.Array]:
        return [pa.array(rows.astype(np.int64)), pa.array(values.astype(np.int64)), pa.array(totals, mask=values == 0)]

    columns = "draw long, id long, near boolean, rows long, values long, total double"
    schema = to_arrow_schema(T_.StructType.fromDDL(columns))
    md5 = F.when(F.col("near"), F.unhex(F.md5(F.concat_ws("|", F.lit("perm"), "draw", "id"))))
    sums = spread.mapInArrow(run, columns).groupBy("draw", md5.alias("m"), "id").agg(*[F.sum(v).alias(v) for v in ("rows", "values", "total")])
    upto = F.sum("rows").over(Window.partitionBy("draw").orderBy(F.asc_nulls_first("m"), "id"))
    taken = lambda c: F.sum(F.when(F.col("upto") <= k, F.col(c)))
    m = sums.withColumn("upto", upto).groupBy("draw").agg(F.coalesce(taken("rows"), F.lit(0)).alias("rows"), F.try_divide(taken("total"), taken("values")).alias("mean"))
    m = m.withColumn("mean", F.when(F.col("rows") == k, F.col("mean")).otherwise(F.raise_error(F.lit("the k-th md5 value lies outside the ranked range")).cast("double")))
    observed = F.lit(observed).cast("double")
    return m.agg(F.count("*").alias("draws"), F.round((observed - F.avg("mean")) / F.stddev_pop("mean"), 6).alias("z"), F.round((count(F.col("mean") >= observed) + 1) / (F.count("*") + 1), 6).alias("p"))


EXACT = """WITH d AS (SELECT event_type, count(*) AS events, count(DISTINCT user_id) AS users FROM events GROUP BY 1)"""


@query("sketch_rollup", f"{EXACT} SELECT event_type, events, users, true AS users_within, true AS median_within FROM d")
def sketch_rollup(spark, sf):
    """Users and median value by type of event from daily sketches that are merged, held against exact figures: within the sketches' bounds?"""
    e = load(spark, sf, "events")
    daily = K.sketched(e.withColumn("day", F.to_date("ts")), ["day", "event_type"], "user_id", "value")
    rolled = K.rolled_up(daily, ["event_type"]).withColumnRenamed("rows", "events")
    exact = e.groupBy("event_type").agg(F.count_distinct("user_id").alias("users"))
    ranks = e.join(rolled.select("event_type", "median"), "event_type").groupBy("event_type").agg(F.avg((F.col("value") < F.col("median")).cast("double")).alias("below"), F.avg((F.col("value") <= F.col("median")).cast("double")).alias("upto"))
    near = (F.col("below") <= 0.5 + K.RANK_ERROR) & (F.col("upto") >= 0.5 - K.RANK_ERROR)
    close = F.abs(F.col("distinct") - F.col("users")) <= F.ceil(K.COUNT_ERROR * F.col("users"))
    return rolled.join(exact, "event_type").join(ranks, "event_type").select("event_type", "events", "users", close.alias("users_within"), near.alias("median_within"))
