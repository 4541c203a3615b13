"""Eigenvectors and communities have no statement: their results are held against the definitions, on matrices that DuckDB builds and made-up larger ones."""

import duckdb
import numpy as np
import pytest

from tallyframe.operators import communities as C
from tallyframe.operators import spectral
from tallyframe.plans import graphs, inputs, registry

from .test_queries import TABLES


@pytest.fixture(scope="module")
def larger(sf):
    return sf.replace("sf0.001", "sf0.01")


@pytest.fixture(scope="module")
def db(larger):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{larger}/{t}.parquet'")
    return c


def matrix(rows, members):
    at = {m: i for i, m in enumerate(members)}
    out = np.zeros((len(members), len(members)))
    for a, b, w in rows:
        out[at[a], at[b]] = out[at[b], at[a]] = w
    return out


def graph(db, sql):
    rows = db.sql(sql).fetchall()
    members = sorted({m for a, b, _ in rows for m in (a, b)})
    return members, matrix(rows, members)


def solved(spark, larger, name, *columns):
    rows = registry.queries()[name](spark, larger).collect()
    return [tuple(r[c] for c in columns) for r in rows]


def test_rollcall_scaling(spark, larger, db):
    """Scores are the singular vectors of the column-centred matrix of sides, zeros for no side."""
    rows = db.sql(f"WITH {inputs.CONTESTED} SELECT member, division, side FROM cast_ WHERE member IN (SELECT member FROM cast_ GROUP BY 1 HAVING count(*) >= 30)").fetchall()
    members, divisions = sorted({r[0] for r in rows}), sorted({r[1] for r in rows})
    sides = np.zeros((len(members), len(divisions)))
    for m, d, s in rows:
        sides[members.index(m), divisions.index(d)] = s
    centred = sides - sides.mean(0)
    u, s, _ = np.linalg.svd(centred, full_matrices=False)
    got = sorted(solved(spark, larger, "rollcall_scaling", "member", "dim1", "dim2", "share1", "share2"))
    assert [r[0] for r in got] == members
    for k in (0, 1):
        want = u[:, k] * s[k] * (1 if u[0, k] >= 0 else -1)
        assert np.allclose([r[1 + k] for r in got], want, atol=1e-6) and got[0][3 + k] == pytest.approx(s[k] ** 2 / (s**2).sum())


def test_seriation(spark, larger, db):
    """Places follow the eigenvector of the second smallest eigenvalue of the Laplacian."""
    members, w = graph(db, f"WITH {graphs.STRONG} SELECT source, target, weight FROM strong")
    laplacian = np.diag(w.sum(1)) - w
    values, vectors = np.linalg.eigh(laplacian)
    got = solved(spark, larger, "seriation", "member", "place")
    assert sorted(p for _, p in got) == list(range(len(members)))
    v = vectors[:, 1] * (-1 if vectors[0, 1] > 0 else 1)
    along = [v[members.index(m)] for m, _ in sorted(got, key=lambda r: r[1])]
    assert all(a <= b + 1e-8 for a, b in zip(along, along[1:], strict=False))


def test_mds(spark, larger, db):
    """Coordinates are eigenvectors of the double-centred squared distances, of the two largest eigenvalues and those lengths."""
    members, w = graph(db, f"WITH {inputs.AGREEMENT} SELECT source, target, weight FROM ties")
    d = 1 - w
    np.fill_diagonal(d, 0)
    centre = np.eye(len(d)) - 1 / len(d)
    b = -centre @ d**2 @ centre / 2
    values = np.sort(np.linalg.eigvalsh(b))[::-1]
    got = sorted(solved(spark, larger, "mds", "member", "x", "y"))
    assert [r[0] for r in got] == members
    for k in (0, 1):
        x = np.array([r[1 + k] for r in got])
        assert np.allclose(b @ x, values[k] * x, atol=1e-8) and (x**2).sum() == pytest.approx(values[k]) and x[0] >= 0


def modularity(w, labels):
    total, strength = w.sum(), w.sum(1)
    same = labels[:, None] == labels[None]
    return ((w - np.outer(strength, strength) / total) * same).sum() / total


def plain_louvain(w):
    """Moves of one member after another until none gains, then on the merged graph."""
    label, graph = np.arange(len(w)), w.copy()
    while True:
        own, moved = np.arange(len(graph)), True
        strength, total = graph.sum(1), graph.sum()
        while moved:
            moved = False
            for i in range(len(graph)):
                links = np.bincount(own, weights=graph[i], minlength=len(graph))
                links[own[i]] -= graph[i, i]
                sums = np.bincount(own, weights=strength, minlength=len(graph))
                sums[own[i]] -= strength[i]
                gain = links - strength[i] * sums / total
                best = int(np.argmax(gain))
                if gain[best] > gain[own[i]] + 1e-12:
                    own[i], moved = best, True
        kept, own = np.unique(own, return_inverse=True)
        label = own[label]
        if len(kept) == len(graph):
            return label
        one = np.eye(len(kept))[own]
        graph = one.T @ graph @ one


def test_communities(spark, larger, db):
    """Not below plain Louvain, and no two communities merge to a higher modularity; each is named by its first member."""
    members, w = graph(db, f"WITH {graphs.STRONG} SELECT source, target, weight FROM strong")
    got = dict(solved(spark, larger, "communities", "member", "community"))
    assert sorted(got) == members
    labels = np.array([members.index(got[m]) for m in members])
    found = modularity(w, labels)
    assert found >= modularity(w, plain_louvain(w)) - 1e-12 and found > 0
    assert all(min(m for m in members if got[m] == c) == c for c in set(got.values()))
    names = np.unique(labels)
    for a in names:
        for b in names:
            assert modularity(w, np.where(labels == a, b, labels)) <= found + 1e-9


def ties_of(spark, w):
    i, j = np.nonzero(np.triu(w, 1))
    return spark.createDataFrame(list(zip(i.tolist(), j.tolist(), w[i, j].tolist(), strict=True)), "source long, target long, weight double")


def test_planted_communities(spark):
    """Blocks that are tied among themselves come back whole, beyond the members that a matrix on the driver held."""
    rng = np.random.default_rng(3)
    size, blocks = 12, 400
    rows = [(b * size + i, b * size + j, 1.0) for b in range(blocks) for i in range(size) for j in range(i + 1, size)]
    rows += [(int(a), int(b), 0.2) for a, b in zip(rng.integers(0, 2400, 800), rng.integers(2400, 4800, 800), strict=True)]
    got = {r["member"]: r["community"] for r in C.communities(spark.createDataFrame(rows, "source long, target long, weight double"), 1).collect()}
    assert len(got) == size * blocks and all(got[m] == got[m - m % size] for m in got)


def test_communities_of_none(spark):
    none = spark.createDataFrame([], "source long, target long, weight double")
    assert C.communities(none).count() == 0


def test_scaling_at_five_thousand(spark):
    """Members beyond what a dense matrix on the driver would hold, against a sparse solver's definition of singular vectors."""
    rng = np.random.default_rng(5)
    n, d = 5000, 60
    place, lean = rng.normal(size=(n, 2)), rng.normal(size=(2, d))
    voted = rng.random((n, d)) < 0.2
    x = np.where(voted, np.where(place @ lean + rng.normal(size=(n, d)) > 0, 1, -1), 0)
    i, j = np.nonzero(x)
    sides = spark.createDataFrame(list(zip(i.tolist(), j.tolist(), x[i, j].tolist(), strict=True)), "member long, division long, side int")
    got = {r[0]: r[1:] for r in spectral.scale_sides(sides).collect()}
    there = np.array(sorted(got))
    y = x[there] - x[there].mean(0)
    u, s, _ = np.linalg.svd(y, full_matrices=False)
    for k in (0, 1):
        want = u[:, k] * s[k] * (1 if u[0, k] >= 0 else -1)
        assert np.allclose([got[m][k] for m in there.tolist()], want, atol=1e-6)
        assert got[there[0]][2 + k] == pytest.approx(s[k] ** 2 / (s**2).sum())


def test_fiedler_of_a_path_and_folded_bases(spark):
    """A small basis is folded many times on the way; the value is within 1e-6 of the dense one."""
    w = np.zeros((40, 40))
    for i in range(39):
        w[i, i + 1] = w[i + 1, i] = 1
    ties = ties_of(spark, w)
    assert [r["member"] for r in spectral.seriate(ties).orderBy("place").collect()] == list(range(40))
    rng = np.random.default_rng(2)
    a = rng.normal(size=(60, 60))
    a = np.triu(a, 1) + np.triu(a, 1).T
    entries = spectral.entries_of(ties_of(spark, a), spectral.F.col("weight"))
    values, vectors = spectral.top_eigenvectors(lambda t, k: spectral.times(entries, t, k), spark.range(60).withColumnRenamed("id", "key"), 2, block=4, basis=16)
    c = np.eye(60) - 1 / 60
    want = np.linalg.eigvalsh(c @ a @ c)[::-1][:2]
    assert np.allclose(values, want, atol=1e-6)
    v = np.array([r["v"] for r in vectors.orderBy("key").collect()])
    assert np.allclose(c @ a @ c @ v, v * want, atol=1e-5)


def test_spectra_of_little(spark):
    none = spark.createDataFrame([], "source long, target long, weight double")
    pair = spark.createDataFrame([(1, 2, 0.5)], none.schema)
    assert spectral.seriate(none).count() == 0 and spectral.classical_mds(none).count() == 0
    assert [tuple(r) for r in spectral.seriate(pair).orderBy("place").collect()] == [(1, 0), (2, 1)]
    x = {r["member"]: r["v"] for r in spectral.classical_mds(pair).collect()}
    assert x[1][0] == pytest.approx(0.25) and x[2][0] == pytest.approx(-0.25) and x[1][1] == 0


def test_landmarks(spark, larger, db):
    """With all members as landmarks the coordinates are those of classical scaling; with a tenth of them distances in the plane stay near."""
    members, w = graph(db, f"WITH {inputs.AGREEMENT} SELECT source, target, weight FROM ties")
    rng = np.random.default_rng(4)
    points = rng.random((150, 2)) / 1.5
    d = np.linalg.norm(points[:, None] - points[None], axis=2)
    ties = ties_of(spark, 1 - d)
    whole = {r["member"]: r["v"] for r in spectral.classical_mds(ties).collect()}
    every = {r["member"]: r["v"] for r in spectral.landmark_mds(ties, 150).collect()}
    assert all(np.allclose(whole[m], every[m], atol=1e-6) for m in whole)
    tenth = spectral.landmark_mds(ties, 15).collect()
    assert sum(r["landmark"] for r in tenth) == 15
    xy = np.array([r["v"] for r in sorted(tenth, key=lambda r: r["member"])])
    assert np.abs(np.linalg.norm(xy[:, None] - xy[None], axis=2) - d).max() < 1e-6
    # Agreement is far from a plane: the error against classical scaling is measured, not nought.
    full = np.array(sorted(solved(spark, larger, "mds", "member", "x", "y")))[:, 1:]
    rough = np.array(sorted(tuple(r[c] for c in ("member", "x", "y")) for r in graphs.landmark_mds(spark, larger).collect()))[:, 1:]
    assert full.shape == rough.shape and np.abs(full - rough).max() < 1e-6  # 100 members, all of them landmarks
