"""Titles are unescaped as their statement does it, and no further."""

import duckdb

from tallyframe.plans import registry


def test_entities_of_titles(spark, tmp_path):
    titles = ["a &quot;b&quot;", "cut &amp", "&amp;lt;b&amp;gt;", "x\x0by \t z", "&#65; &eacute;", " &lt;&gt; "]
    c = duckdb.connect()
    c.execute("CREATE TABLE pages (page_id BIGINT, html VARCHAR)")
    c.executemany("INSERT INTO pages VALUES (?, ?)", [(i, f"<Title>{t}</title>") for i, t in enumerate(titles)] + [(90, "none"), (91, None)])
    c.execute(f"COPY pages TO '{tmp_path}/pages.parquet' (FORMAT parquet)")
    got = registry.queries()["html_title"](spark, str(tmp_path)).collect()
    assert sorted((r["page_id"], r["title"]) for r in got) == sorted(c.sql(registry.oracle_sql()["html_title"]).fetchall())
