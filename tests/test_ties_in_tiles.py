"""Findings of round 4: no size switches how rows are resolved, and ties are summed up in the tiles that make them."""

import inspect
import random
from collections import Counter

import pytest

from tallyframe.operators import graph as G
from tallyframe.operators import resolve as R
from tallyframe.operators import votes as V

from .test_operators import PEOPLE, literally_resolved


def test_no_size_switches_to_rounds(spark, monkeypatch):
    """Whatever its size, a component is resolved in order unless a caller names a limit."""
    monkeypatch.setattr(R, "rounds", lambda *_: 1 / 0)
    assert inspect.signature(R.resolve).parameters["in_order"].default is None and not hasattr(R, "IN_ORDER")
    rows = [("a", n, None, "k", random.Random(n).choice([None, "l", "m"]), n % 3, 1950 + n % 5 * 20, None) for n in range(60)]
    assert {(r["source"], r["seq"]): (r["person"], r["method"]) for r in R.resolve(spark.createDataFrame(rows, PEOPLE), ["a"])[0].collect()} == literally_resolved(rows, ["a"])[0]


@pytest.fixture(scope="module")
def votes():
    r = random.Random(5)
    return {c: {m: {d: r.choice([1, -1]) for d in range(130) if r.random() < 0.7} for m in range(45)} for c in (0, 1)}


def small(monkeypatch):
    for name, n in (("DRAWN_TILE", 13), ("DRAWN_ROWS", 5), ("TRIPLE_WORDS", 1), ("DRAWN_COLUMNS", 7), ("DEALT_ROWS", 11)):
        monkeypatch.setattr(V, name, n)


def framed(spark, votes, chunks=(0,)):
    return spark.createDataFrame([(c, m, d, s) for c in chunks for m, v in votes[c].items() for d, s in v.items()], "chunk long, member long, division long, side int")


def brute(votes, least, level):
    out = {}
    for a, x in votes.items():
        for b, y in votes.items():
            both = x.keys() & y.keys()
            agreed = sum(x[d] == y[d] for d in both)
            if a < b and len(both) >= least and (agreed * 2_000_000 + len(both)) // (2 * len(both)) / 1e6 >= level:
                out[a, b] = len(both), (agreed * 2_000_000 + len(both)) // (2 * len(both)) / 1e6
    return out


def joins(df):
    return sum(x in df._jdf.queryExecution().optimizedPlan().toString() for x in ("Join Inner", "Sort ["))


def test_ties_leave_their_tile_as_rows_once(spark, votes, monkeypatch):
    small(monkeypatch)
    labels = spark.createDataFrame([(m, "xyz"[m % 3]) for m in range(40)], "member long, bloc string")
    got = V.Ties(framed(spark, votes, (0, 1)), 60, by=["chunk"]).pairs(labels)
    want = {(c, *k): v for c in (0, 1) for k, v in brute(votes[c], 60, 0).items()}
    rows = got.collect()
    assert len(rows) == len(want) and {(r["chunk"], r["source"], r["target"]): (r["shared"], r["value"]) for r in rows} == want
    bloc = lambda m: "xyz"[m % 3] if m < 40 else None
    assert all((r["a_bloc"], r["b_bloc"]) == (bloc(r["source"]), bloc(r["target"])) for r in rows)
    assert joins(got) == 0  # pairs meet no table of members


def test_ties_are_summed_by_bloc(spark, votes, monkeypatch):
    small(monkeypatch)
    bloc = {m: "xyz"[m % 3] if m < 40 else None for m in votes[0]}
    labels = spark.createDataFrame([(m, b) for m, b in bloc.items() if b], "member long, bloc string")
    ties = V.Ties(framed(spark, votes), 55, level=0.5)
    n, weight = Counter(), Counter()
    for (a, b), (_, w) in brute(votes[0], 55, 0.5).items():
        for x, y in ((a, b), (b, a)):
            n[x, bloc[x], bloc[y]] += 1
            weight[x, bloc[x], bloc[y]] += w
    own = ties.bloc_sums(labels, members=True).collect()
    assert {(r["member"], r["bloc"], r["other"]): r["n"] for r in own} == n and len(own) == len(n)
    assert all(r["weight"] == pytest.approx(weight[r["member"], r["bloc"], r["other"]]) for r in own)
    cells = Counter()
    for (_, x, y), k in n.items():
        cells[x, y] += k
    assert {(r["bloc"], r["other"]): r["n"] for r in ties.bloc_sums(labels).collect()} == cells


def test_nearest_are_picked_in_tiles(spark, votes, monkeypatch):
    small(monkeypatch)
    near = {m: [] for m in votes[0]}
    for (a, b), (_, w) in brute(votes[0], 55, 0).items():
        near[a].append((-w, b))
        near[b].append((-w, a))
    want = {(m, n + 1): (b, -w) for m, x in near.items() for n, (w, b) in enumerate(sorted(x)[:3])}
    assert {(r["source"], r["rank"]): (r["target"], r["weight"]) for r in V.Ties(framed(spark, votes), 55).nearest(3).collect()} == want


def test_labels_are_dealt_and_counted_in_tiles(spark, votes, monkeypatch):
    """As shuffled_labels() and ei_counts_by_draw(), which move members by draws and ties."""
    small(monkeypatch)
    labels = spark.createDataFrame([(m, m * m % 3) for m in range(42)], "member long, bloc long")
    sides = framed(spark, votes)
    ties = V.agreement_ties(sides.drop("chunk"), 55).where("weight >= 0.5")
    want = {(r["draw"], r["bloc"]): (r["internal"], r["external"]) for r in G.ei_counts_by_draw(ties, G.shuffled_labels(labels, 9, "s")).collect()}
    dealt = V.dealt_labels(labels.withColumnRenamed("bloc", "k"), 9, "s")
    got = V.Ties(sides, 55, level=0.5).internal_by_draw(dealt, 9, 3).where("ends > 0").collect()
    # That one counts a tie within a bloc once for each cell and its mirror, as internal here.
    assert {(r["draw"], r["k"]): (r["internal"], r["ends"] - r["internal"]) for r in got} == want


def test_no_ties_and_no_labels(spark):
    none = spark.createDataFrame([], "member long, k int")
    assert V.dealt_labels(none, 3, "s").collect() == []
    ties = V.Ties(spark.createDataFrame([], "member long, division long, side int"), 30)
    assert ties.pairs().collect() == [] and ties.nearest(3).collect() == [] and ties.internal_by_draw(none.selectExpr("member", "array(k) AS k"), 1, 1).collect() == []
