"""Queries on entity resolution, validation and profiling."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyframe.functions import text as X
from tallyframe.operators import quality as Q
from tallyframe.operators import resolve as R
from tallyframe.sources.shared import delete_at_exit, shared_folder
from tallyframe.sources.tables import ColumnSpec, TableSpec, load

from .inputs import SPELLS, spells
from .registry import query
from .texts import arabic_name

#: Sources in order of trust: the documents' own, by name.
STAGED = "staged AS (SELECT md5(text) AS entity, doc_id AS seq, source, lang, n_chars, CASE WHEN source = 'src0' THEN 0 WHEN source = 'src1' THEN 1 ELSE 9 END AS priority FROM documents)"


def staged(spark, sf):
    d = load(spark, sf, "documents")
    return d.select(F.md5(F.col("text").cast("binary")).alias("entity"), F.col("doc_id").alias("seq"), "source", "lang", "n_chars", F.when(F.col("source") == "src0", 0).when(F.col("source") == "src1", 1).otherwise(9).alias("priority"))


@query("golden_record", f"WITH {STAGED} SELECT entity, arg_min(lang, (priority, seq)) AS lang, arg_min(source, (priority, seq)) FILTER (source <> '') AS source FROM staged GROUP BY 1")
def golden_record(spark, sf):
    return R.golden_record(staged(spark, sf), ["entity"], ["lang", "source"], "priority", "seq")


#: One customer after another; recurring holds all that are resolved.
RESOLVE = """WITH RECURSIVE keyed AS MATERIALIZED (SELECT row_number() OVER (ORDER BY c_nationkey % 3, c_custkey) AS i, substr('abc', (c_nationkey % 3 + 1)::INTEGER, 1) AS source, c_custkey AS seq, CASE WHEN c_custkey % 13 > 0 THEN c_custkey // 2 END AS source_key,
  c_mktsegment || c_custkey % 50 AS ar_key, CASE WHEN c_custkey % 7 > 0 THEN 'l' || c_custkey % 120 END AS lat_key, c_custkey % 4 AS chamber, 1950 + c_custkey % 9 * 8 AS year, CASE WHEN c_custkey % 10 = 0 THEN 'known' END AS born FROM customer),
every(i, source, seq, source_key, ar_key, lat_key, chamber, year, born, person, method, nth, k_i) USING KEY (i) AS (
  SELECT keyed.*, source || ':' || seq, 'source_id', NULL::INTEGER, NULL::BIGINT FROM keyed WHERE i = 1
  UNION
  SELECT r.*, coalesce(u.person, h.hit.person, r.source || ':' || r.seq), CASE WHEN u.person IS NOT NULL THEN 'source_key' ELSE coalesce(h.hit.method, 'source_id') END, h.hit.nth, h.hit.k_i
  FROM (SELECT max(i) + 1 AS i FROM every) next JOIN keyed r ON r.i = next.i
  LEFT JOIN (SELECT source, source_key, arg_min(person, i) AS person FROM recurring.every WHERE source_key IS NOT NULL GROUP BY source, source_key) u ON u.source = r.source AND u.source_key = r.source_key
  LEFT JOIN (
    SELECT q.i, min(struct_pack(nth := t.nth, k_i := k.i, person := k.person, method := CASE WHEN t.nth = 1 THEN 'normalised_name_lat' WHEN q.lat_key IS NULL OR p.p_lat IS NULL THEN 'normalised_name_ar' ELSE 'normalised_name_ar+lat' END)) AS hit
    FROM (SELECT max(i) + 1 AS i FROM every) now JOIN keyed q ON q.i = now.i CROSS JOIN (VALUES (0), (1)) t(nth)
    JOIN recurring.every k ON k.method <> 'source_key' AND k.chamber <> q.chamber AND CASE WHEN t.nth = 0 THEN k.ar_key = q.ar_key ELSE k.lat_key = q.lat_key END
    JOIN (SELECT person, arg_min(lat_key, i) FILTER (lat_key IS NOT NULL) AS p_lat, count(born) > 0 AS p_born FROM recurring.every GROUP BY person) p ON p.person = k.person
    WHERE (p.p_born OR abs(q.year - k.year) <= 40) AND (t.nth = 1 OR q.lat_key IS NULL OR p.p_lat IS NULL OR q.lat_key = p.p_lat) GROUP BY q.i) h ON h.i = r.i),
resolved AS MATERIALIZED (SELECT *, CASE WHEN method IN ('source_id', 'source_key', 'normalised_name_ar+lat') THEN 'high' ELSE 'medium' END AS confidence FROM every),
births AS (SELECT person, min(i) FILTER (born IS NOT NULL) AS known_at FROM resolved GROUP BY person),
far AS (SELECT k.person, r.source, r.seq, k.chamber AS chamber_a, r.chamber AS chamber_b, abs(r.year - k.year) AS years_apart
  FROM resolved r CROSS JOIN (VALUES (0), (1)) t(nth) JOIN resolved k ON k.i < r.i AND k.method <> 'source_key' AND k.chamber <> r.chamber AND CASE WHEN t.nth = 0 THEN k.ar_key = r.ar_key ELSE k.lat_key = r.lat_key END
  JOIN births ON births.person = k.person WHERE r.method <> 'source_key' AND abs(r.year - k.year) > 40 AND (known_at IS NULL OR known_at >= r.i) AND (r.nth IS NULL OR t.nth < r.nth OR t.nth = r.nth AND k.i < r.k_i))"""


def people(spark, sf):
    """Customers as rows of three sources. Neighbours in number have a source_key in common, so that some are re-collected."""
    c, k = load(spark, sf, "customer"), F.col("c_custkey")
    source = F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (F.col("c_nationkey") % 3 + 1).cast("int"))
    return c.select(
        source.alias("source"),
        k.alias("seq"),
        F.when(k % 13 > 0, F.floor(k / 2)).alias("source_key"),
        F.concat("c_mktsegment", (k % 50).cast("string")).alias("ar_key"),
        F.when(k % 7 > 0, F.concat(F.lit("l"), (k % 120).cast("string"))).alias("lat_key"),
        (k % 4).alias("chamber"),
        (1950 + k % 9 * 8).alias("year"),
        F.when(k % 10 == 0, "known").alias("born"),
    )


@query("resolve_entities", RESOLVE + " SELECT source, seq, person, method, confidence FROM resolved")
def resolve_entities(spark, sf):
    return R.resolve(people(spark, sf), ["a", "b", "c"], refusals=False)[0].drop("chamber")


@query("match_review", RESOLVE + " SELECT person, source, seq, chamber, method, confidence, 'confirm this is the same person' AS action_required FROM resolved WHERE method NOT IN ('source_id', 'source_key')")
def match_review(spark, sf):
    return R.match_review(R.resolve(people(spark, sf), ["a", "b", "c"], refusals=False)[0])


@query("match_refusals", RESOLVE + " SELECT person, source, seq, chamber_a, chamber_b, years_apart FROM far")
def match_refusals(spark, sf):
    return R.resolve(people(spark, sf), ["a", "b", "c"])[1]


@query("merge_veto", "WITH t AS (SELECT o_custkey AS person, min(year(o_orderdate)) AS a, max(year(o_orderdate)) AS b, min(o_orderstatus) AS s FROM orders GROUP BY 1) SELECT person, a, b, s <> 'F' AND b - a > 5 AS refused FROM t")
def merge_veto(spark, sf):
    y = F.year("o_orderdate").cast("long")
    t = load(spark, sf, "orders").groupBy(F.col("o_custkey").alias("person")).agg(F.min(y).alias("a"), F.max(y).alias("b"), F.min("o_orderstatus").alias("s"))
    return t.select("person", "a", "b", R.too_far_apart(F.col("a"), F.col("b"), F.when(F.col("s") == "F", F.lit("known")), 5).alias("refused"))


@query("resolve_place", "WITH p AS (SELECT c_custkey, CASE WHEN c_custkey % 11 = 0 THEN 'Abroad: FRANCE' ELSE '  ' || n_name || ' - ' END AS raw FROM customer JOIN nation ON n_nationkey = c_nationkey) SELECT c_custkey, coalesce((SELECT 'N-' || n_nationkey FROM nation WHERE lower(n_name) = trim(regexp_replace(replace(lower(raw), '-', ' '), '\\s+', ' ', 'g'))), CASE WHEN raw LIKE '%Abroad%' THEN 'N-99' ELSE '' END) AS place FROM p")
def resolve_place(spark, sf):
    n = load(spark, sf, "nation")
    raw = F.when(F.col("c_custkey") % 11 == 0, "Abroad: FRANCE").otherwise(F.concat(F.lit("  "), "n_name", F.lit(" - ")))
    p = load(spark, sf, "customer").join(n, F.col("n_nationkey") == F.col("c_nationkey")).select("c_custkey", raw.alias("raw"))
    p = p.withColumn("key", X.squeeze(F.replace(F.lower("raw"), F.lit("-"), F.lit(" "))))
    names = n.select(F.lower("n_name").alias("key"), F.concat(F.lit("N-"), "n_nationkey").alias("found"))
    return p.join(names, "key", "left").select("c_custkey", F.coalesce("found", F.when(F.contains("raw", F.lit("Abroad")), "N-99").otherwise("")).alias("place"))


@query("get_or_create", "SELECT 'CON-' || substr(sha1(p_brand || '|' || lower(p_type)), 1, 12) AS id, arg_min(p_name, p_partkey) AS name, arg_min(p_size, p_partkey) FILTER (p_size > 20) AS size FROM part GROUP BY 1")
def get_or_create(spark, sf):
    p = load(spark, sf, "part").withColumn("id", R.content_id("CON", F.col("p_brand"), F.lower("p_type")))
    return p.groupBy("id").agg(F.min_by("p_name", "p_partkey").alias("name"), F.min_by("p_size", F.when(F.col("p_size") > 20, F.col("p_partkey"))).alias("size"))


@query("fill_blanks", "WITH k AS (SELECT s_suppkey AS id, CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE s_name END AS name FROM supplier), g AS (SELECT c_custkey AS id, c_name AS name FROM customer WHERE c_acctbal > 0) SELECT id, coalesce(nullif(k.name, ''), g.name, '') AS name FROM k LEFT JOIN g USING (id) UNION ALL SELECT id, name FROM g WHERE id NOT IN (SELECT id FROM k)")
def fill_blanks(spark, sf):
    k = load(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.when(F.col("s_suppkey") % 3 == 0, "").otherwise(F.col("s_name")).alias("name"))
    g = load(spark, sf, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return R.fill_blanks(k, g, "id", ["name"])


def spelled(n, way):
    """A name as another page might spell it: as it is, in another case and joined by dashes, words swapped, a letter lost, doubled or exchanged, cut short, or another thing altogether."""
    words = F.split(n, " ")
    ways = (n, F.replace(F.initcap(n), F.lit(" "), F.lit("-")), F.array_join(F.reverse(words), " "), F.concat(F.substring(n, 1, 2), F.substring(n, 4, 99)), F.concat(F.substring(n, 1, 3), F.substring(n, 3, 99)), F.translate(n, "aeiou", "eioua"), F.substring(n, 1, 4), F.concat(F.lit("member of "), F.reverse(n)))
    return F.element_at(F.array(*ways), (way + 1).cast("int"))


@query("fuzzy_resolve")
def fuzzy_resolve(spark, sf):
    """Names of parts in eight spellings against the roster of names."""
    p = load(spark, sf, "part")
    roster = p.select("p_name").distinct().select(X.slug(F.col("p_name")).alias("seat"), F.col("p_name").alias("name"))
    return R.fuzzy_resolve(p.select(spelled(F.col("p_name"), F.col("p_partkey") % 8).alias("name")), roster)


def paired_lists(spark, sf):
    """Two Arabic names for each supplier and their Latin forms, of which some lists are swapped, some misspelled, some of names too near to tell and some too short."""
    k = F.col("s_suppkey")
    x, y = arabic_name(1000 + k * 37), arabic_name(F.when(k % 7 == 0, 1000 + k * 37).otherwise(20000 + k * 91))
    latin = F.transform(F.array(X.romanize(x), X.romanize(y)), lambda w: F.when(k % 5 == 0, F.replace(w, F.lit("a"), F.lit("e"))).otherwise(w))
    shown = F.when(k % 11 == 0, F.slice(latin, 1, 1)).when(k % 2 == 0, F.reverse(latin)).otherwise(latin)
    return load(spark, sf, "supplier").select(k.alias("place"), F.array(x, y).alias("arabic"), shown.alias("latin"))


@query("pair_assign")
def pair_assign(spark, sf):
    return R.pair_assign(paired_lists(spark, sf))


@query("conflict_report", "WITH a AS (SELECT o_custkey AS k, arg_min(o_orderpriority, o_orderkey) AS v FROM orders GROUP BY 1), b AS (SELECT o_custkey AS k, arg_max(o_orderpriority, o_orderkey) AS v FROM orders GROUP BY 1) SELECT k, a.v AS inline_value, b.v AS list_value FROM a JOIN b USING (k) WHERE a.v <> b.v")
def conflict_report(spark, sf):
    o = load(spark, sf, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.min_by("o_orderpriority", "o_orderkey").alias("inline_value"), F.max_by("o_orderpriority", "o_orderkey").alias("list_value"))
    return o.where("inline_value <> list_value")


@query("provenance_unpivot", "SELECT 'supplier' AS table_name, record_id, field_name, source_id, substr(sha1(value), 1, 12) AS value_hash FROM (UNPIVOT (SELECT s_suppkey::VARCHAR AS record_id, 'S' || s_nationkey AS source_id, s_name, CASE WHEN s_acctbal > 0 THEN s_nationkey::VARCHAR END AS s_nationkey FROM supplier) ON s_name, s_nationkey INTO NAME field_name VALUE value) WHERE value <> ''")
def provenance_unpivot(spark, sf):
    s = load(spark, sf, "supplier")
    t = s.select("s_suppkey", F.concat(F.lit("S"), "s_nationkey").alias("source"), "s_name", F.when(F.col("s_acctbal") > 0, F.col("s_nationkey").cast("string")).alias("s_nationkey"))
    return R.provenance(t, "supplier", "s_suppkey", ["s_name", "s_nationkey"], F.col("source"))


@query("mint_ids", "WITH known AS (SELECT n_name AS key, 'PER-' || lpad((n_nationkey + 1)::VARCHAR, 5, '0') AS id FROM nation WHERE n_regionkey < 2), new AS (SELECT n_name AS key, row_number() OVER (ORDER BY n_name) AS n FROM nation WHERE n_name NOT IN (SELECT key FROM known)) SELECT key, id FROM known UNION ALL SELECT key, 'PER-' || lpad(((SELECT max(substr(id, 5)::BIGINT) FROM known) + n)::VARCHAR, 5, '0') FROM new")
def mint_ids(spark, sf):
    n = load(spark, sf, "nation").withColumnRenamed("n_name", "key")
    known = n.where("n_regionkey < 2").select("key", F.concat(F.lit("PER-"), F.lpad((F.col("n_nationkey") + 1).cast("string"), 5, "0")).alias("id"))
    return R.mint_ids(n, known, "key", "PER")


@query("content_id", "SELECT o_orderkey, 'ORD-' || substr(sha1(o_custkey || '|' || CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END), 1, 12) AS id, substr(sha1(o_orderpriority), 1, 12) AS value_hash FROM orders")
def content_id(spark, sf):
    return load(spark, sf, "orders").select("o_orderkey", R.content_id("ORD", F.col("o_custkey"), F.nullif(F.col("o_orderstatus"), F.lit("P"))).alias("id"), F.substring(F.sha1(F.col("o_orderpriority").cast("binary")), 1, 12).alias("value_hash"))


@query("fill_rates", "WITH u AS (UNPIVOT (SELECT count(*) FILTER (trim(url) <> '') AS url, count(*) FILTER (trim(html) <> '') AS html, count(page_id) AS page_id, count(*) AS n FROM pages) ON url, html, page_id INTO NAME \"column\" VALUE filled) SELECT \"column\", filled, round(filled / n::DOUBLE, 6) AS rate FROM u")
def fill_rates(spark, sf):
    return Q.fill_rates(load(spark, sf, "pages"))


@query("enum_distribution", "WITH u AS (UNPIVOT (SELECT lang, source, n_chars::VARCHAR AS n_chars FROM documents) ON lang, source, n_chars INTO NAME \"column\" VALUE value), c AS (SELECT \"column\", value, count(*) AS n FROM u WHERE trim(value) <> '' GROUP BY 1, 2) SELECT \"column\", value, n FROM c QUALIFY count(*) OVER (PARTITION BY \"column\") <= 25")
def enum_distribution(spark, sf):
    return Q.value_distribution(load(spark, sf, "documents"), ["lang", "source", "n_chars"])


@query("coverage_rollup", "WITH r AS (SELECT r_regionkey, r_name FROM region), a AS (SELECT n_regionkey AS k, count(*) AS customers FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1), b AS (SELECT n_regionkey AS k, count(*) AS suppliers FROM supplier JOIN nation ON n_nationkey = s_nationkey GROUP BY 1), n AS (SELECT n_regionkey AS k, count(*) AS nations FROM nation GROUP BY 1) SELECT r_name, coalesce(nations, 0) AS nations, coalesce(customers, 0) AS customers, coalesce(suppliers, 0) AS suppliers, round(coalesce(suppliers, 0) / nullif(customers, 0)::DOUBLE, 6) AS rate FROM r LEFT JOIN a ON a.k = r_regionkey LEFT JOIN b ON b.k = r_regionkey LEFT JOIN n ON n.k = r_regionkey")
def coverage_rollup(spark, sf):
    n = load(spark, sf, "nation")
    out = load(spark, sf, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name").join(n.groupBy("n_regionkey").agg(F.count("*").alias("nations")), "n_regionkey", "left")
    for table, key, name in (("customer", "c_nationkey", "customers"), ("supplier", "s_nationkey", "suppliers")):
        c = load(spark, sf, table).groupBy(F.col(key).alias("n_nationkey")).agg(F.count("*").alias("c")).join(n, "n_nationkey").groupBy("n_regionkey").agg(F.sum("c").alias(name))
        out = out.join(c, "n_regionkey", "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    return out.select("r_name", *[zero(c).alias(c) for c in ("nations", "customers", "suppliers")], F.round(F.try_divide(zero("suppliers").cast("double"), "customers"), 6).alias("rate"))


@query("validate_pk", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def validate_pk(spark, sf):
    return Q.duplicate_keys(load(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


DIRTY = TableSpec("dirty", (ColumnSpec("birth", "date"), ColumnSpec("year", "integer"), ColumnSpec("rate", "number"), ColumnSpec("flag", "boolean"), ColumnSpec("priority", "enum", values=("1-URGENT", "2-HIGH", "3-MEDIUM")), ColumnSpec("name", required=True)), ("o_orderkey",))
DIRTY_SQL = """d AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN strftime(o_orderdate, '%Y-13-%d') ELSE strftime(o_orderdate, '%Y-%m-%d') END AS birth, CASE WHEN o_orderkey % 7 = 0 THEN '19x4' ELSE year(o_orderdate)::VARCHAR END AS year,
  CASE WHEN o_orderkey % 9 = 0 THEN 'n/a' ELSE (o_orderkey % 100)::VARCHAR END AS rate, CASE o_orderkey % 4 WHEN 0 THEN 'yes' WHEN 1 THEN '' ELSE 'true' END AS flag, o_orderpriority AS priority, CASE WHEN o_orderkey % 13 = 0 THEN '' ELSE 'x' END AS name FROM orders)"""


def dirty(spark, sf):
    """Orders as staged text with typical faults."""
    k, day = F.col("o_orderkey"), F.col("o_orderdate")
    return load(spark, sf, "orders").select(
        k,
        F.when(k % 5 == 0, F.concat(F.year(day), F.lit("-13-"), F.date_format(day, "dd"))).otherwise(F.date_format(day, "yyyy-MM-dd")).alias("birth"),
        F.when(k % 7 == 0, "19x4").otherwise(F.year(day).cast("string")).alias("year"),
        F.when(k % 9 == 0, "n/a").otherwise((k % 100).cast("string")).alias("rate"),
        F.when(k % 4 == 0, "yes").when(k % 4 == 1, "").otherwise("true").alias("flag"),
        F.col("o_orderpriority").alias("priority"),
        F.when(k % 13 == 0, "").otherwise("x").alias("name"),
    )


@query("validate_types", f"""WITH {DIRTY_SQL}, v AS (
SELECT o_orderkey AS "row", 'birth' AS "column", 'date' AS rule, birth AS value FROM d WHERE birth <> '' AND NOT regexp_matches(birth, '{Q.DATE_RULE}') UNION ALL SELECT o_orderkey, 'year', 'integer', year FROM d WHERE year <> '' AND NOT regexp_matches(year, '^-?[0-9]+$')
UNION ALL SELECT o_orderkey, 'rate', 'number', rate FROM d WHERE rate <> '' AND TRY_CAST(rate AS DOUBLE) IS NULL UNION ALL SELECT o_orderkey, 'flag', 'boolean', flag FROM d WHERE flag NOT IN ('', 'true', 'false')
UNION ALL SELECT o_orderkey, 'priority', 'enum', priority FROM d WHERE priority NOT IN ('', '1-URGENT', '2-HIGH', '3-MEDIUM') UNION ALL SELECT o_orderkey, 'name', 'required', name FROM d WHERE name = '') SELECT * FROM v""")
def validate_types(spark, sf):
    return Q.type_violations(dirty(spark, sf), DIRTY, "o_orderkey")


@query("validate_fk", "WITH r AS (SELECT unnest(string_split(l_suppkey || ';' || (l_suppkey + l_linenumber), ';')) AS value FROM lineitem) SELECT value, count(*) AS n FROM r WHERE value <> '' AND value NOT IN (SELECT s_suppkey::VARCHAR FROM supplier) GROUP BY 1")
def validate_fk(spark, sf):
    r = load(spark, sf, "lineitem").select(F.concat_ws(";", "l_suppkey", F.col("l_suppkey") + F.col("l_linenumber")).alias("supplier_ids"))
    return Q.missing_references(r, "supplier_ids", load(spark, sf, "supplier"), "s_suppkey")


@query("validate_intervals", f"WITH {SPELLS} SELECT person, assembly, grp FROM spells WHERE end_date - 60 < start_date AND end_date IS NOT NULL")
def validate_intervals(spark, sf):
    """Spells that would end before they start if they ended 60 days earlier."""
    return spells(spark, sf).where(F.date_sub("end_date", 60) < F.col("start_date")).select("person", "assembly", "grp")


@query("validate_age", "WITH f AS (SELECT o_custkey AS person, min(year(o_orderdate)) AS first_year, 1920 + o_custkey % 70 AS born FROM orders GROUP BY 1) SELECT person, first_year - born AS age, CASE WHEN first_year - born < 18 THEN 'young' ELSE 'old' END AS finding FROM f WHERE NOT first_year - born BETWEEN 18 AND 70")
def validate_age(spark, sf):
    f = load(spark, sf, "orders").groupBy(F.col("o_custkey").alias("person")).agg(F.min(F.year("o_orderdate")).alias("y"))
    f = f.withColumn("age", F.col("y") - (1920 + F.col("person") % 70))
    return f.where(~F.col("age").between(18, 70)).select("person", "age", F.when(F.col("age") < 18, "young").otherwise("old").alias("finding"))


@query("validate_capacity", "WITH c AS (SELECT n_name, count(c_custkey) AS filled, 40 + n_nationkey AS seats FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY n_name, n_nationkey) SELECT n_name, filled, seats, CASE WHEN filled > seats THEN 'over' ELSE 'thin' END AS finding FROM c WHERE filled > seats OR filled < 0.9 * seats")
def validate_capacity(spark, sf):
    c = load(spark, sf, "customer").groupBy("c_nationkey").agg(F.count("*").alias("f"))
    t = load(spark, sf, "nation").join(c, F.col("n_nationkey") == F.col("c_nationkey"), "left").select("n_name", F.coalesce("f", F.lit(0)).alias("filled"), (40 + F.col("n_nationkey")).alias("seats"))
    return t.where((F.col("filled") > F.col("seats")) | (F.col("filled") < 0.9 * F.col("seats"))).withColumn("finding", F.when(F.col("filled") > F.col("seats"), "over").otherwise("thin"))


@query("validate_outside_span", "SELECT o_orderstatus, count(*) AS outside FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_shipdate >= o_orderdate) GROUP BY 1")
def validate_outside_span(spark, sf):
    li = load(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_shipdate").alias("ship"))
    t = load(spark, sf, "orders").join(li, "o_orderkey", "left").where(~F.coalesce(F.col("ship") >= F.col("o_orderdate"), F.lit(False)))
    return t.groupBy("o_orderstatus").agg(F.count("*").alias("outside"))


@query("validate_rates", "SELECT rate, count(*) AS n, count(*) FILTER (NOT value BETWEEN 0 AND 0.07) AS outside FROM (UNPIVOT (SELECT l_discount AS discount, l_tax AS tax FROM lineitem) ON discount, tax INTO NAME rate VALUE value) GROUP BY 1")
def validate_rates(spark, sf):
    t = load(spark, sf, "lineitem").select(F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax")).unpivot([], ["discount", "tax"], "rate", "value")
    return t.groupBy("rate").agg(F.count("*").alias("n"), F.count_if(~F.col("value").between(0, 0.07)).alias("outside"))


@query("checked_write", f"""WITH {DIRTY_SQL} SELECT 'birth is a date' AS "check", 'warn' AS severity, count(*) FILTER (birth <> '' AND NOT regexp_matches(birth, '{Q.DATE_RULE}')) AS findings FROM d
UNION ALL SELECT 'name is there', 'warn', count(*) FILTER (name = '') FROM d UNION ALL SELECT 'key is there', 'error', count(*) FILTER (o_orderkey IS NULL) FROM d UNION ALL SELECT 'rows written', 'info', count(*) FROM d""")
def checked_write(spark, sf):
    """Staged orders, checked by the job that writes them to the shared folder; what it found is read back with what it wrote."""
    path = f"{shared_folder(spark).rstrip('/')}/checked-{uuid.uuid4().hex}"
    delete_at_exit(spark.sparkContext, path)
    checks = {"birth is a date": ("warn", Q.broken(ColumnSpec("birth", "date")) == "date"), "name is there": ("warn", F.col("name") == ""), "key is there": ("error", F.col("o_orderkey").isNull())}
    return Q.checked_write(dirty(spark, sf), path, checks)


@query("validation_summary", f"""WITH {DIRTY_SQL} SELECT 'duplicate keys' AS "check", 'error' AS severity, (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)) AS findings
UNION ALL SELECT 'orphan documents', 'warn', (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)) UNION ALL SELECT 'bad enum', 'error', (SELECT count(*) FROM d WHERE priority NOT IN ('', '1-URGENT', '2-HIGH', '3-MEDIUM'))""")
def validation_summary(spark, sf):
    bad = Q.type_violations(dirty(spark, sf), DIRTY, "o_orderkey").where("rule = 'enum'")
    return Q.summary({
        "duplicate keys": ("error", Q.duplicate_keys(load(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])),
        "orphan documents": ("warn", load(spark, sf, "documents").join(load(spark, sf, "labels"), "doc_id", "left_anti")),
        "bad enum": ("error", bad),
    })
