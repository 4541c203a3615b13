"""What grows with pairs, rounds or rows of a key is made anew, looked up or left out, and results stay the same."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from tallyframe.functions.digests import Endings
from tallyframe.operators import graph as G
from tallyframe.operators import resolve as R
from tallyframe.operators import spectral
from tallyframe.operators import votes as V


def groups(links):
    up = {}
    root = lambda x: x if up.setdefault(x, x) == x else root(up[x])
    for a, b in links:
        up[root(a)] = root(b)
    return {frozenset(y for y in up if root(y) == root(x)) for x in up}


@pytest.mark.parametrize("held", [10, 1 << 20])
def test_tasks_keep_links_that_connect(monkeypatch, held):
    monkeypatch.setattr(G, "HELD_LINKS", held)
    r = random.Random(1)
    dense = [(a, b) for a in range(100) for b in range(a)]
    for links in (dense, [(r.randrange(300), r.randrange(300)) for _ in range(250)], [(i, i + 1) for i in range(300)]):
        links = [(a, b) for a, b in links if a != b]
        batches = [pa.RecordBatch.from_pydict({"a": [a for a, _ in links[i : i + 7]], "b": [b for _, b in links[i : i + 7]]}) for i in range(0, len(links), 7)]
        kept = [x for batch in G.spanning(iter(batches)) for x in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True)]
        assert set(kept) <= set(links) and groups(kept) == groups(links)
        if held > len(links):
            assert len(kept) == sum(len(g) - 1 for g in groups(links))
    assert list(G.spanning(iter([]))) == []


@pytest.mark.parametrize("looked_up", [0, 1 << 22])
def test_agreement_as_a_matrix_that_is_never_written(spark, monkeypatch, looked_up):
    monkeypatch.setattr(V, "LOOKED_UP", looked_up)
    monkeypatch.setattr(V, "DRAWN_TILE", 25)
    monkeypatch.setattr(V, "DRAWN_ROWS", 10)
    r = random.Random(2)
    rows = [(m, d, r.choice([1, -1])) for m in range(70) for d in range(130) if r.random() < (0.02 if m == 5 else 0.5)]
    x = np.zeros((70, 130))
    for m, d, s in rows:
        x[m, d] = s
    shared, net = np.abs(x) @ np.abs(x).T, x @ x.T
    tied = (shared >= 30) & ~np.eye(70, dtype=bool)
    want = np.where(tied, (1 - np.round((shared + net) / np.maximum(2 * shared, 1), 6)) ** 2, 0)
    matrix = V.AgreementMatrix(spark.createDataFrame(rows, "member long, division long, side int"), 30)
    assert {m["key"] for m in matrix.members().collect()} == set(np.flatnonzero(tied.any(1)).tolist()) != set(range(70))
    w = np.random.default_rng(1).normal(size=(70, 3))
    got = matrix.times(spark.createDataFrame([(i, w[i].tolist()) for i in range(70)], "key long, w array<double>"), 3, lambda s: (1 - s) ** 2)
    found = {g["key"]: g["z"] for g in got.collect()}
    assert all(np.allclose(found[i], (want @ w)[i], atol=1e-9) for i in found) and len(found) >= 69
    if looked_up:
        one, other = spectral.agreement_mds(matrix), spectral.classical_mds(V.agreement_ties(spark.createDataFrame(rows, "member long, division long, side int"), 30))
        a, b = ({m["member"]: m["v"] for m in t.collect()} for t in (one, other))
        assert a.keys() == b.keys() and all(np.allclose(a[m], b[m], atol=1e-8) for m in a)


def test_resolver_holds_classes_not_rows():
    resolver, refused = R.Resolver(40), R.Refused()
    n = 5_000
    for i in range(n):
        resolver.take("a", i, i // 2, "x", f"l{i % 3}", i % 4, 1950 + i % 9 * 8, "known" if i % 2 else None, i % 2 == 0, refused)
    held = sum(len(of) for e in resolver.by_key.values() for classes in e.first.values() for of in classes.values())
    assert held < 500 and len(resolver.by_source_key) == 0


def test_resolver_is_that_of_plain_lists():
    """Every earlier entry of the key in order, as the definition says."""
    for seed in range(150):
        r = random.Random(seed)
        opt = lambda x, p: x if r.random() < p else None  # noqa: B023, E731
        rows = [(r.choice("ab"), i, opt(r.randrange(30), 0.6), opt(f"a{r.randrange(4)}", 0.9), opt(f"l{r.randrange(5)}", 0.6), opt(r.randrange(3), 0.9), opt(1900 + r.randrange(6) * 20, 0.9), opt("x", 0.15)) for i in range(60)]
        persons, keyed, before, resolver = {}, {}, [], R.Resolver(40)
        for i, (source, seq, key, ar, lat, chamber, year, born) in enumerate(rows):
            who, how, refused = keyed.get((source, key)) if key is not None else None, "source_key", []
            if who is None:
                for kind, own in ((0, ar), (1, lat)):
                    for p, k, there, then in before if own is not None and who is None else ():
                        if who is not None or k[kind] != own or there == chamber:
                            continue
                        if persons[p][1] is None and None not in (year, then) and abs(year - then) > 40:
                            refused.append((p, there, abs(year - then)))
                        elif kind or lat is None or persons[p][0] is None or lat == persons[p][0]:
                            who, how = p, "normalised_name_lat" if kind else "normalised_name_ar" if None in (lat, persons[p][0]) else "normalised_name_ar+lat"
                if who is None:
                    who, how = f"{source}:{seq}", "source_id"
                    persons[who] = [None, None]
                before.append((who, (ar, lat), chamber, year))
                keyed[source, key] = who
            persons[who] = [persons[who][0] or lat, persons[who][1] or born]
            got = R.Refused()
            more = any(x[0] == source and x[2] == key for x in rows[i + 1 :])
            assert resolver.take(*rows[i], more, got) == (who, how)
            assert sorted(zip(got.persons, map(str, got.chambers), got.years, strict=True)) == sorted((p, str(c), y) for p, c, y in refused)


@pytest.mark.parametrize("texts", [[f"|{i}" for i in (*range(0, 3000, 7), 10**6, 10**18)] + ["", "|\u00e9"], [""], []])
def test_md5_of_many_texts(texts):
    endings = Endings(texts)
    for begun in ("", "perm|0", "perm|17", "null|123", "null|9999|1234"):
        assert endings.heads(begun).tolist() == [int(hashlib.md5((begun + t).encode()).hexdigest()[:16], 16) for t in texts]
    with pytest.raises(ValueError):
        Endings(["x" * 50]).heads("beyond")


def test_sides_are_dealt_where_they_lie(spark):
    r = random.Random(4)
    rows = [(m, d, r.choice([1, -1])) for m in range(12) for d in range(3) if r.random() < 0.8]
    got = V.permuted_sides(spark.createDataFrame(rows, "member long, division long, side int"), 3, "s")
    assert not {"Window", "Join"} & set(got._jdf.queryExecution().optimizedPlan().toString().replace("(", " ").split())
    want = set()
    for draw in range(3):
        for d in range(3):
            own = sorted((m, s) for m, e, s in rows if e == d)
            mixed = sorted(own, key=lambda x: hashlib.md5(f"s|{draw}|{d}|{x[0]}".encode()).hexdigest())
            want |= {(draw, m, d, s) for (m, _), (_, s) in zip(own, mixed, strict=True)}
    assert {(x["draw"], x["member"], x["division"], x["side"]) for x in got.collect()} == want


def test_equal_heads_are_told_apart_in_full():
    texts = [f"|{i}" for i in range(20)]
    assert V._drawn(np.zeros(20, np.uint64), "s|0", texts).tolist() == sorted(range(20), key=lambda i: hashlib.md5(f"s|0{texts[i]}".encode()).hexdigest())
