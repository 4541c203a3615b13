"""Every query that has an oracle gives the rows of its DuckDB statement."""

import duckdb
import pytest

from tallyframe.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


def rows(table):
    return sorted((tuple(r) for r in table), key=repr)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, sf, duck, name):
    df = registry.queries()[name](spark, sf)
    columns = sorted(df.columns)
    got = rows(df.select(*[f"`{c}`" for c in columns]).collect())
    if sql := registry.oracle_sql().get(name):
        want = duck.sql("SELECT " + ", ".join(f'"{c}"' for c in columns) + f" FROM ({sql})").fetchall()
        assert got == rows(want)
    else:
        assert got


def test_flagship(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.fixture(scope="module")
def larger(sf):
    """Tables in which members share enough divisions."""
    return sf.replace("sf0.001", "sf0.01")


@pytest.mark.parametrize("name", ["permutation_test", "ei_null", "cluster_bootstrap", "phi_bootstrap", "phi_null"])
def test_resampling(spark, larger, name):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{larger}/{t}.parquet'")
    sql = c.sql(registry.oracle_sql()[name])
    got = rows(registry.queries()[name](spark, larger).select(*sql.columns).collect())
    assert got and got == rows(sql.fetchall())


@pytest.mark.parametrize("name, draws", [("permutation_test", 10_000), ("ei_null", 400), ("cluster_bootstrap", 400), ("phi_bootstrap", 400)])
def test_draws_of_the_reference(spark, larger, name, draws):
    got = registry.queries()[name](spark, larger).collect()
    assert len(got) == draws if name == "phi_bootstrap" else {r["draws"] for r in got} == {draws}


def test_phi_null_shuffles_ten_times(spark, larger):
    ten, one = (registry.queries()["phi_null"](spark, larger, **few).first()["pairs"] for few in ({}, {"draws": 1}))
    assert 8 * one < ten < 12 * one
