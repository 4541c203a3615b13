"""Edges of common signers: summed by tasks whose number grows with the pairs, whatever their types and however often a pair meets."""

import datetime as dt
import random
from collections import Counter, defaultdict
from itertools import combinations

import pytest

from tallyframe.operators import graph as G
from tallyframe.operators import projection as P


@pytest.mark.parametrize(("held", "salt", "kind"), [(1 << 21, 1_000, int), (40, 5, int), (40, 5, str)])
def test_signed_edges(spark, monkeypatch, held, salt, kind):
    monkeypatch.setattr(P, "SIGNED_ROWS", held)
    monkeypatch.setattr(P, "SALT_SPELLS", salt)
    r = random.Random(4)
    name = (lambda x: x) if kind is int else (lambda x: f"n{x}")
    rows = [(name(r.randint(0, 60)), name(r.randint(0, 25)), dt.date(2000, 1, 1) + dt.timedelta(days=r.randint(0, 900)) if r.random() < 0.9 else None) for _ in range(600)]
    # One document of all, one of a signer alone, a pair that meets very often, and rows that say nothing.
    rows += [(name(99), name(s), None) for s in range(26)] + [(name(100), name(1), None)] + [(name(d), name(s), dt.date(1999, 1, 1)) for d in range(200, 300) for s in (3, 4)] + [(None, name(1), None), (name(7), None, None)]
    t = "long" if kind is int else "string"
    df = spark.createDataFrame(rows, f"doc {t}, who {t}, day date")
    signers, days = defaultdict(set), defaultdict(list)
    for d, s, day in rows:
        if d is not None and s is not None:
            signers[d].add(s)
            days[d] += [day] if day else []
    met = defaultdict(list)
    for d, who in signers.items():
        for a, b in combinations(sorted(who), 2):
            met[a, b].append(d)
    pairs = P.signer_pairs(df, "doc", "who")
    assert Counter(map(tuple, pairs.collect())) == Counter((d, len(signers[d]), a, b) for (a, b), docs in met.items() for d in docs)
    edges = P.signed_edges(df, "doc", "who", "day", 20)
    assert not any(n in edges._jdf.queryExecution().optimizedPlan().toString() for n in ("Aggregate", "Join", "Sort"))
    got = {(e["source"], e["target"]): e for e in edges.collect()}
    assert got.keys() == met.keys()
    for k, docs in met.items():
        first = [min(days[d]) for d in docs if days[d]]
        e = got[k]
        assert (e["weight"], e["documents"], e["first_day"], e["last_day"]) == (len(docs), ";".join(map(str, sorted(docs)[:20])), min(first, default=None), max(first, default=None))
        assert e["weight_newman"] == pytest.approx(sum(1 / (len(signers[d]) - 1) for d in docs), abs=1e-6)


def test_tasks_grow_with_pairs(spark, monkeypatch):
    monkeypatch.setattr(P, "SIGNED_ROWS", 1_000)
    df = spark.range(4_000).selectExpr("id div 4 AS doc", "id % 4 + id div 400 AS who")
    assert P.signed_edges(df, "doc", "who").rdd.getNumPartitions() == 6


def test_disparity_moves_no_tie(spark):
    ties = spark.createDataFrame([(a, b, float(a + b)) for a, b in combinations(range(30), 2)], "source long, target long, weight double")
    plan = G.disparity(ties)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
