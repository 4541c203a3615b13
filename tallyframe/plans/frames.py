"""Frames written down in the code, the driver that writes all edge tables, cohorts of names, and small accessors."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tallyframe.functions import text as X
from tallyframe.operators import cohorts as C
from tallyframe.operators.ranking import global_rank
from tallyframe.sources.shared import delete_at_exit, reliable, shared_folder
from tallyframe.sources.tables import ColumnSpec, TableSpec, load, reference_table, write_tables

from .inputs import SPELLS, spells
from .registry import BUILDERS, ORACLES, query

#: Draws of the coverage null, samples of donors and simulations, as in the reference.
DRAWS, SAMPLES, SIMS = 10_000, 200, 200
PLANTED = (0, 10, 20, 30, 40, 50, 80)

ASSEMBLIES = TableSpec("assemblies", primary_key=("assembly",), columns=(ColumnSpec("assembly"), ColumnSpec("kind"), ColumnSpec("seats", "integer"), ColumnSpec("opened", "date")))
ASSEMBLY_ROWS = [{"assembly": str(i), "kind": "constituent" if i == 0 else "ordinary", "seats": 100 + 20 * i, "opened": f"{1992 + i}-03-01" if i < 6 else None} for i in range(7)]
FRAME = "frame AS (SELECT * FROM (VALUES " + ", ".join(f"('{r['assembly']}', '{r['kind']}', {r['seats']}, {'NULL' if r['opened'] is None else repr(r['opened'])})" for r in ASSEMBLY_ROWS) + ") t(assembly, kind, seats, opened))"


@query("reference_frame", f"WITH {SPELLS}, {FRAME} SELECT assembly, kind, seats::BIGINT AS seats, opened, coalesce(n, 0) AS spells, round(coalesce(n, 0) / seats::DOUBLE, 6) AS per_seat FROM frame LEFT JOIN (SELECT assembly, count(*) AS n FROM spells GROUP BY 1) USING (assembly)")
def reference_frame(spark, sf):
    """The frame of assemblies, a few rows written down in the code, with the spells of each."""
    frame = reference_table(spark, ASSEMBLIES, ASSEMBLY_ROWS)
    counted = spells(spark, sf).groupBy("assembly").agg(F.count("*").alias("spells"))
    n = F.coalesce("spells", F.lit(0))
    return frame.join(counted, "assembly", "left").select("assembly", "kind", F.col("seats").cast("long").alias("seats"), F.col("opened").cast("string").alias("opened"), n.alias("spells"), F.round(n / F.col("seats"), 6).alias("per_seat"))


SOURCES = TableSpec("sources", primary_key=("source_id",), columns=tuple(map(ColumnSpec, ("source_id", "name", "publisher", "access_method", "licence", "reliability_notes"))))
SOURCE_ROWS = [{"source_id": f"src{i}", "name": f"Source {i}", "publisher": "Driver", "access_method": "file" if i else "page", "licence": None if i % 2 else "open", "reliability_notes": "made up"} for i in range(4)]
REGISTER = "register AS (SELECT * FROM (VALUES " + ", ".join("(" + ", ".join("NULL" if r[c.name] is None else repr(r[c.name]) for c in SOURCES.columns) + ")" for r in SOURCE_ROWS) + f") t({', '.join(c.name for c in SOURCES.columns)}))"


@query("source_register", f"WITH {REGISTER}, c AS (SELECT source AS source_id, count(*) AS n, array_to_string(list_sort(list(DISTINCT lang)), '; ') AS language FROM documents GROUP BY 1) SELECT source_id, name, publisher, access_method, coalesce(licence, 'Not stated') AS licence, reliability_notes, coalesce(n, 0) || ' documents' AS coverage, coalesce(language, '') AS language FROM register LEFT JOIN c USING (source_id)")
def source_register(spark, sf):
    """One register row for each source that the code knows, with what was staged from it."""
    staged = load(spark, sf, "documents").groupBy(F.col("source").alias("source_id")).agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set("lang")), "; ").alias("language"))
    known = reference_table(spark, SOURCES, SOURCE_ROWS).join(staged, "source_id", "left")
    return known.select("source_id", "name", "publisher", "access_method", F.coalesce("licence", F.lit("Not stated")).alias("licence"), "reliability_notes", F.concat(F.coalesce("n", F.lit(0)).cast("string"), F.lit(" documents")).alias("coverage"), F.coalesce("language", F.lit("")).alias("language"))


#: Tables that the driver of the edge tables writes, and the queries that make them.
EDGE_TABLES = {"nodes": "node_table", "bipartite_person_group": "bipartite_incidence", "edges_comembership": "project_weighted", "edges_shared_organisation": "project_cross_period", "edges_cosignature": "cosignature_edges", "edges_cosponsorship": "cosponsor_edges", "edges_vote_agreement": "vote_agreement"}
#: Columns of each in order of names; those in millionths are numbers with fractions.
EDGE_COLUMNS = {
    "node_table": "assemblies first_assembly last_assembly last_known_end name person sectors",
    "bipartite_incidence": "assembly group_name grp name person start_date",
    "project_weighted": "assembly dates_assumed group_ids group_size overlap_end overlap_start source target weight weight_newman~",
    "project_cross_period": "source target weight weight_newman~",
    "cosignature_edges": "first_day last_day source target weight weight_newman~",
    "cosponsor_edges": "documents source target weight weight_newman~",
    "vote_agreement": "layer shared source target weight~",
}


def content_sql(name):
    cells = ", ".join(f"coalesce(CAST(round({c[:-1]} * 1000000) AS BIGINT)::VARCHAR, '')" if c.endswith("~") else f"coalesce({c}::VARCHAR, '')" for c in EDGE_COLUMNS[name].split())
    return f"SELECT count(*) AS row_count, coalesce(sum(('0x' || substr(md5(concat_ws('|', {cells})), 1, 8))::BIGINT), 0)::BIGINT AS content FROM ({ORACLES[name]})"


@query("edge_tables", " UNION ALL ".join(f"SELECT '{table}' AS table_name, row_count, content FROM ({content_sql(name)})" for table, name in EDGE_TABLES.items()))
def edge_tables(spark, sf):
    """Writes all node and edge tables to the shared folder and returns the rows of each and a hash of what they say."""
    folder = f"{shared_folder(spark).rstrip('/')}/edge-tables-{uuid.uuid4().hex}"
    delete_at_exit(spark.sparkContext, folder)
    return write_tables({table: BUILDERS[name](spark, sf) for table, name in EDGE_TABLES.items()}, folder)


BOX = """WITH p AS (SELECT c_acctbal AS x, (c_custkey * 37 % 1009)::DOUBLE AS y FROM customer), n AS (SELECT count(*) AS n FROM p),
rx AS (SELECT x, row_number() OVER (ORDER BY x) - 1 AS i FROM p), ry AS (SELECT y, row_number() OVER (ORDER BY y) - 1 AS i FROM p),
e AS (SELECT (SELECT x FROM rx, n WHERE i = floor(0.01 * n)) AS x0, (SELECT x FROM rx, n WHERE i = floor(0.99 * n)) AS x1, (SELECT y FROM ry, n WHERE i = floor(0.01 * n)) AS y0, (SELECT y FROM ry, n WHERE i = floor(0.99 * n)) AS y1),
b AS (SELECT x0 - 0.06 * (x1 - x0) AS x_low, x1 + 0.06 * (x1 - x0) AS x_high, y0 - 0.06 * (y1 - y0) AS y_low, y1 + 0.06 * (y1 - y0) AS y_high FROM e)
SELECT round(any_value(x_low), 6) AS x_low, round(any_value(x_high), 6) AS x_high, round(any_value(y_low), 6) AS y_low, round(any_value(y_high), 6) AS y_high, count(*) FILTER (NOT (x BETWEEN x_low AND x_high AND y BETWEEN y_low AND y_high)) AS clipped FROM p, b"""


def at_share(df, column, share):
    """The value of a column at index floor(share * n) of its order, from 0; one row comes to the driver."""
    ranked = global_rank(df.select(column), [column])
    row = ranked.where(F.col("rank") == int(share * df.count()) + 1).first()
    return row[column] if row else None


@query("clip_box", BOX)
def clip_box(spark, sf):
    """The box of the 1st to the 99th percentile of two coordinates, by index, with a margin of 6 percent, and how many points lie outside."""
    p = load(spark, sf, "customer").select(F.col("c_acctbal").alias("x"), (F.col("c_custkey") * 37 % 1009).cast("double").alias("y"))
    ends = {c: (at_share(p, c, 0.01), at_share(p, c, 0.99)) for c in ("x", "y")}
    box = {c: (a - 0.06 * (b - a), b + 0.06 * (b - a)) if a is not None else (None, None) for c, (a, b) in ends.items()}
    inside = F.col("x").between(*box["x"]) & F.col("y").between(*box["y"])
    sides = [F.round(F.lit(box[c][i]).cast("double"), 6).alias(f"{c}_{side}") for c in ("x", "y") for i, side in enumerate(("low", "high"))]
    return p.agg(*sides, F.count_if(~inside).alias("clipped"))


@query("reference_accessors", """SELECT c_custkey AS id, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE c_nationkey::VARCHAR END AS ref_id, CASE WHEN c_custkey % 5 = 0 OR c_custkey % 7 = 0 THEN '' ELSE c_name END AS ref_name,
CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_mktsegment END AS segment FROM customer""")
def reference_accessors(spark, sf):
    """References that stand as [id, name] or false, and scalars that are false where empty."""
    k = F.col("c_custkey")
    name = F.when(k % 7 == 0, "false").otherwise(F.concat(F.lit('"  '), "c_name", F.lit(' "')))
    ref = F.when(k % 5 == 0, "false").otherwise(F.concat(F.lit("["), F.col("c_nationkey").cast("string"), F.lit(", "), name, F.lit("]")))
    scalar = F.when(k % 3 == 0, "false").otherwise(F.concat(F.lit('"'), "c_mktsegment", F.lit('"')))
    return load(spark, sf, "customer").select(k.alias("id"), X.reference_id(ref).alias("ref_id"), X.reference_name(ref).alias("ref_name"), X.clean_value(scalar).alias("segment"))


#: Suppliers as persons: region 0 is the founding cohort, regions 1 and 2 are two later ones, names repeat.
PEOPLE = """people AS (SELECT s_suppkey AS id, 'n' || (s_suppkey * 7 % 61) AS name, n_regionkey AS cohort FROM supplier JOIN nation ON s_nationkey = n_nationkey),
target AS (SELECT id, name FROM people WHERE cohort > 0), founders AS (SELECT id, name FROM people WHERE cohort = 0), size AS (SELECT count(*) AS n FROM target), cohort AS (SELECT least((SELECT count(*) FROM founders), greatest((n - 1) // 2, 1)) AS n FROM size)"""


def drawn_sql(name, people, n, draws, seed):
    return f"{name} AS (SELECT draw, id, name FROM (SELECT draw, id, name, row_number() OVER (PARTITION BY draw ORDER BY md5('{seed}|' || draw || '|' || id), id) AS place FROM {people}, range({draws}) d(draw)) WHERE place <= {n})"


def null_sql(name, people, n, seed):
    return f"""{drawn_sql(name + '_drawn', people, n, DRAWS, seed)}, {name}_hit AS (SELECT draw, name, count(*) AS taken FROM {name}_drawn GROUP BY 1, 2), {name}_all AS (SELECT name, count(*) AS total FROM {people} GROUP BY 1),
{name} AS (SELECT draw, sum(total - taken) / greatest((SELECT count(*) FROM {people}) - {n}, 1)::DOUBLE AS share FROM {name}_hit JOIN {name}_all USING (name) GROUP BY 1)"""


AGAINST = "SELECT round(max(o), 6) AS observed, round(avg(share), 6) AS null_mean, round(stddev_pop(share), 6) AS null_sd, round((max(o) - avg(share)) / nullif(stddev_pop(share), 0), 6) AS z, round((count(*) FILTER (share >= o - 1e-12) + 1) / (count(*) + 1)::DOUBLE, 6) AS p_higher, count(*) AS draws FROM {0}, observed"
COVERED = "observed AS (SELECT count(*) FILTER (name IN (SELECT name FROM founders)) / count(*)::DOUBLE AS o FROM target)"
NULL = null_sql("cover", "target", "(SELECT n FROM cohort)", "cover")


def cohort_tables(spark, sf):
    """founders and target (id, name), all people with their cohort, and the size of a cohort drawn from the target: the founders', below half of it."""
    s, n = load(spark, sf, "supplier"), load(spark, sf, "nation")
    people = reliable(s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("id"), F.concat(F.lit("n"), (F.col("s_suppkey") * 7 % 61).cast("string")).alias("name"), F.col("n_regionkey").alias("cohort")))
    founders, target = people.where("cohort = 0").select("id", "name"), people.where("cohort > 0").select("id", "name")
    return people, founders, target, min(founders.count(), max((target.count() - 1) // 2, 1))


@query("coverage_test", f"WITH {PEOPLE}, {NULL}, {COVERED} {AGAINST.format('cover')}")
def coverage_test(spark, sf):
    """How many later members carry a founder's name, against cohorts of the same size drawn from among them."""
    _, founders, target, n = cohort_tables(spark, sf)
    return C.against_null(C.coverage_null(target, n, DRAWS), C.coverage(target, founders))


CONTROL = f"""donors AS (SELECT id, name FROM people WHERE cohort = 1), later AS (SELECT id, name FROM people WHERE cohort = 2), sizes AS (SELECT least((SELECT count(*) FROM donors), greatest(count(*) // 3, 2)) AS n, count(*) AS all_ FROM later),
{drawn_sql('picked', 'donors', '(SELECT n FROM sizes)', SAMPLES, 'donors')}, later_all AS (SELECT name, count(*) AS total FROM later GROUP BY 1),
observed AS (SELECT coalesce(sum(total), 0) / greatest({SAMPLES} * (SELECT all_ FROM sizes), 1)::DOUBLE AS o FROM (SELECT DISTINCT draw, name FROM picked) JOIN later_all USING (name)),
{null_sql('control', 'later', '(SELECT n FROM sizes)', 'control')}"""


@query("positive_control", f"WITH {PEOPLE}, {CONTROL} {AGAINST.format('control')}")
def positive_control(spark, sf):
    """The same test between two consecutive cohorts, where continuity is expected."""
    people = cohort_tables(spark, sf)[0]
    return C.positive_control(people.where("cohort = 1").select("id", "name"), people.where("cohort = 2").select("id", "name"), DRAWS, SAMPLES)


POWER = f"""marked AS (SELECT id, (name IN (SELECT name FROM founders))::INTEGER AS has FROM target), level AS (SELECT share AS t FROM (SELECT share, row_number() OVER (ORDER BY share) - 1 AS i, count(*) OVER () AS n FROM cover) WHERE i = floor(0.95 * n)),
places AS (SELECT draw, has, row_number() OVER (PARTITION BY draw ORDER BY md5('power|' || draw || '|' || id), id) AS place FROM marked, range({SIMS}) d(draw)), ks AS (SELECT k FROM (VALUES {', '.join(f'({k})' for k in PLANTED)}) v(k) WHERE k <= (SELECT n FROM size)),
lost AS (SELECT k, g.draw, coalesce(sum(has), 0) AS lost FROM (SELECT k, draw FROM ks, range({SIMS}) d(draw)) g LEFT JOIN places ON places.draw = g.draw AND place <= k GROUP BY 1, 2)
SELECT k, round(avg((((SELECT sum(has) FROM marked) - lost + k) / (SELECT n FROM size)::DOUBLE >= (SELECT t FROM level) - 1e-12)::INTEGER), 6) AS power FROM lost GROUP BY 1"""


@query("power_simulation", f"WITH {PEOPLE}, {NULL}, {POWER}")
def power_simulation(spark, sf):
    """How often the test would see so many planted descendants."""
    _, founders, target, n = cohort_tables(spark, sf)
    return C.power(target, founders, reliable(C.coverage_null(target, n, DRAWS)), PLANTED, SIMS)


#: Words of parts' names as names: suppliers' third ones are such as stand first, the others' last.
NAMED = """words AS (SELECT p_partkey AS part, string_split(p_name, ' ') AS w FROM part), profile AS (SELECT word, sum(f) AS f, sum(l) AS l FROM (SELECT w[1] AS word, 1 AS f, 0 AS l FROM words WHERE len(w) > 1 UNION ALL SELECT w[-1], 0, 1 FROM words WHERE len(w) > 1) GROUP BY 1),
everyone AS (SELECT s_suppkey AS id, CASE WHEN s_suppkey % 3 = 0 THEN w[1] ELSE w[-1] END AS name, n_regionkey AS cohort FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN words ON part = s_suppkey),
people AS (SELECT id, name, cohort FROM everyone LEFT JOIN profile ON word = name WHERE coalesce(l, 0) >= coalesce(f, 0)),
target AS (SELECT id, name FROM people WHERE cohort > 0), founders AS (SELECT id, name FROM people WHERE cohort = 0), size AS (SELECT count(*) AS n FROM target), cohort AS (SELECT least((SELECT count(*) FROM founders), greatest((n - 1) // 2, 1)) AS n FROM size)"""


def word_places(spark, sf):
    """(word, first_places, last_places): how often each word stands first and last in names of parts of several words."""
    words = load(spark, sf, "part").select(F.split("p_name", " ").alias("w")).where("size(w) > 1")
    ends = words.select(F.explode(F.array(F.struct(F.get("w", F.lit(0)).alias("word"), F.lit(1).alias("f"), F.lit(0).alias("l")), F.struct(F.element_at("w", -1).alias("word"), F.lit(0).alias("f"), F.lit(1).alias("l")))).alias("e")).select("e.*")
    return ends.groupBy("word").agg(F.sum("f").alias("first_places"), F.sum("l").alias("last_places"))


@query("credible_coverage", f"WITH {NAMED}, {NULL}, {COVERED} {AGAINST.format('cover')}")
def credible_coverage(spark, sf):
    """coverage_test over those whose names pass the credibility filter: the founders' and the later members' given-like names are taken out of both sides."""
    s, n, p = load(spark, sf, "supplier"), load(spark, sf, "nation"), load(spark, sf, "part").select("p_partkey", F.split("p_name", " ").alias("w"))
    k = F.col("s_suppkey")
    everyone = s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).join(p, k == F.col("p_partkey")).select(k.alias("id"), F.when(k % 3 == 0, F.get("w", F.lit(0))).otherwise(F.element_at("w", -1)).alias("name"), F.col("n_regionkey").alias("cohort"))
    people = reliable(C.credible_only(everyone, word_places(spark, sf)))
    founders, target = people.where("cohort = 0").select("id", "name"), people.where("cohort > 0").select("id", "name")
    size = min(founders.count(), max((target.count() - 1) // 2, 1))
    return C.against_null(C.coverage_null(target, size, DRAWS), C.coverage(target, founders))


@query("credibility_filter", """WITH w AS (SELECT string_split(p_name, ' ') AS w FROM part WHERE len(string_split(p_name, ' ')) > 1), p AS (SELECT w[1] AS word, 1 AS first_, 0 AS last_ FROM w UNION ALL SELECT w[-1], 0, 1 FROM w)
SELECT word, sum(first_)::BIGINT AS first_places, sum(last_)::BIGINT AS last_places, sum(last_) >= sum(first_) AS credible FROM p GROUP BY 1""")
def credibility_filter(spark, sf):
    """Words of names by how often they stand first and last; those that stand first more often are given names."""
    return word_places(spark, sf).withColumn("credible", C.credible(F.col("first_places"), F.col("last_places")))
