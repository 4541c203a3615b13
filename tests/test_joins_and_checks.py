"""Joins over time, draws, parallel lists, sketches and checked writes on small inputs, against plain versions."""

import datetime as dt
import hashlib
import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyframe.operators import cohorts as C
from tallyframe.operators import graph as G
from tallyframe.operators import projection as P
from tallyframe.operators import quality as Q
from tallyframe.operators import sketches as K
from tallyframe.operators import temporal as T


@pytest.mark.parametrize("seed", [1, 2])
def test_nearest_in_time(spark, seed):
    """One user has most versions and lies in many partitions; others have none, or only later ones."""
    rng = random.Random(seed)
    user = lambda: "hot" if rng.random() < 0.7 else rng.choice(["a", "b", "c", None])
    versions = [(user(), rng.choice([None, *range(0, 400, 7)]), i) for i in range(500)] + [("late", 900, 1000), ("twice", 10, 7), ("twice", 20, 3)]
    queries = [(user(), rng.choice([None, *range(-20, 420)]), i) for i in range(300)] + [("late", 1, 500), ("none", 5, 501), ("twice", 15, 502)]
    got = T.nearest_in_time(spark.createDataFrame(queries, "user string, at int, q int"), spark.createDataFrame(versions, "user string, at int, version long"), "user", "at", "q", "version")
    want = {}
    for u, at, q in queries:
        near = [(abs(v_at - at), v) for w, v_at, v in versions if w == u and v_at is not None] if u is not None and at is not None else []
        if near:
            want[q] = min(near)[1]
    assert {r["q"]: r["version"] for r in got.collect()} == want and want[502] == 3 and want[500] == 1000


def test_carried_over_partitions(spark):
    rows = [("a", i, i if i in (2, 3) else None) for i in range(200)] + [("b", i, None) for i in range(50)] + [("c", i, -i if i == 0 else None) for i in range(120)]
    got = T.carried(spark.createDataFrame(rows, "k string, i int, v int"), "k", [F.col("i")], "v", "last")
    assert got.count() == len(rows)
    for r in got.collect():
        assert r["last"] == {"a": None if r["i"] < 2 else min(r["i"], 3), "b": None, "c": 0}[r["k"]]


@pytest.mark.parametrize("width", [1, 3, 50])
def test_overlaps(spark, width):
    rng = random.Random(width)
    span = lambda: tuple(sorted((rng.randint(0, 60), rng.randint(0, 60)), reverse=rng.random() < 0.1))
    left, right = [(i, *span()) for i in range(80)] + [(80, 0, 9999), (81, None, 5), (82, 7, 7)], [(i, *span()) for i in range(60)] + [(60, 7, 7), (61, 6, 8)]
    got = T.overlaps(spark.createDataFrame(left, "l int, s int, e int"), spark.createDataFrame(right, "r int, y0 int, y1 int"), ("s", "e"), ("y0", "y1"), width)
    want = sorted((a, b) for a, s, e in left for b, y0, y1 in right if None not in (s, e) and s < y1 and e > y0)
    assert sorted((r["l"], r["r"]) for r in got.collect()) == want
    assert T.overlaps(spark.createDataFrame(left, "l int, s int, e int"), spark.createDataFrame([], "r int, y0 int, y1 int"), ("s", "e"), ("y0", "y1"), width).count() == 0


@pytest.mark.parametrize("n", [0, 1, 40, 299, 300, 400])
def test_draws_are_the_smallest_hashes(spark, n):
    people = [(i, f"n{i % 17}") for i in range(300)]
    df = spark.createDataFrame(people, "id long, name string")
    want = {d: sorted(people, key=lambda p: (hashlib.md5(f"s|{d}|{p[0]}".encode()).hexdigest(), p[0]))[:n] for d in range(6)}  # noqa: B023
    got = {}
    for r in C.drawn(df, n, 6, "s").collect():
        got.setdefault(r["draw"], []).append((r["place"], r["id"]))
    assert {d: [i for _, i in sorted(v)] for d, v in got.items()} == {d: [i for i, _ in v] for d, v in want.items() if v}
    counts = {(r["draw"], r["name"]): r["taken"] for r in C.drawn_names(df, n, 6, "s").collect()}
    plain = {}
    for d, v in want.items():
        for _, name in v:
            plain[d, name] = plain.get((d, name), 0) + 1
    assert counts == plain


def test_parallel_lists(spark):
    a = spark.createDataFrame([(1, 1, "x"), (1, 2, "y"), (2, 1, "z")], "k int, slot int, a string")
    b = spark.createDataFrame([(1, 1, "p"), (1, 2, "q")], "k int, slot int, b string")
    assert [tuple(r) for r in Q.unequal_lists(a, b, "k").collect()] == [(2, 1, 0)]
    assert sorted(tuple(r) for r in Q.joined_lists(a.where("k = 1"), b, "k", "slot").collect()) == [(1, 1, "x", "p"), (1, 2, "y", "q")]
    for x, y in ((a, b), (b, a.where("k = 1 AND slot = 1"))):
        with pytest.raises(Exception, match="lists differ in length"):
            Q.joined_lists(x, y, "k", "slot").collect()


def test_disparity_and_correlation(spark):
    rng = np.random.default_rng(1)
    w = np.triu(np.where(rng.random((12, 12)) < 0.5, rng.integers(1, 50, (12, 12)), 0), 1)
    ties = [(i, j, float(w[i, j])) for i, j in zip(*map(list, np.nonzero(w)), strict=True)]
    ties = [(int(a), int(b), c) for a, b, c in ties] + [(100, 101, 5.0)]
    df = spark.createDataFrame(ties, "source long, target long, weight double")
    got = {(r["source"], r["target"]): r["p"] for r in G.disparity(df).collect()}
    for a, b, c in ties:
        chance = [1.0 if len(own) == 1 else (1 - c / sum(own)) ** (len(own) - 1) for own in ([x for s, t, x in ties if e in (s, t)] for e in (a, b))]
        assert got[a, b] == pytest.approx(min(chance))
    assert got[100, 101] == 1
    other = [(a, b, c * 2 + 1) for a, b, c in ties[::2]] + [(500, 501, 3.0)]
    r = G.pair_correlation(df, spark.createDataFrame(other, df.schema)).first()
    x, y = {(a, b): c for a, b, c in ties}, {(a, b): c for a, b, c in other}
    keys = sorted(x.keys() | y.keys())
    assert (r["pairs"], r["in_both"]) == (len(keys), len(x.keys() & y.keys()))
    assert r["correlation"] == pytest.approx(np.corrcoef([x.get(k, 0) for k in keys], [y.get(k, 0) for k in keys])[0, 1], abs=1e-6)
    assert r["with_any"] == pytest.approx(np.corrcoef([x[k] for k in x], [float(k in y) for k in x])[0, 1], abs=1e-6)


def test_signers_are_salted(spark, monkeypatch):
    rows = [("big", i) for i in range(60)] + [("small", i) for i in range(3)] + [("one", 1)]
    signed = spark.createDataFrame(rows, "doc string, who int")
    monkeypatch.setattr(P, "SALT_SPELLS", 7)
    got = sorted(tuple(r) for r in P.signer_pairs(signed, "doc", "who").collect())
    assert got == sorted((d, n, a, b) for d, n in (("big", 60), ("small", 3)) for a in range(n) for b in range(a + 1, n))


def test_sketches_merge_in_any_steps(spark):
    rows = spark.range(60_000).select((F.col("id") % 30).alias("day"), (F.col("id") % 7919).alias("user"), F.sqrt("id").alias("value"))
    daily = K.sketched(rows, ["day"], "user", "value")
    weekly = K.merged(daily.withColumn("week", F.floor(F.col("day") / 7)), ["week"])
    for table in (daily, weekly, K.merged(weekly, ["week"])):
        r = K.rolled_up(table.withColumn("all", F.lit(1)), ["all"]).first()
        assert r["rows"] == 60_000 and abs(r["distinct"] - 7919) <= K.COUNT_ERROR * 7919
        assert abs((r["median"] ** 2) / 60_000 - 0.5) <= K.RANK_ERROR


def test_checked_write(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "")], "k int, name string")
    warn = {"name": ("warn", F.col("name").isNull() | (F.col("name") == "")), "key": ("error", F.col("k") > 5)}
    assert [tuple(r) for r in Q.checked_write(df, path, warn).collect()] == [("name", "warn", 2), ("key", "error", 0), ("rows written", "info", 3)]
    assert spark.read.parquet(path).count() == 3
    with pytest.raises(Q.CheckFailed) as e:
        Q.checked_write(df.withColumn("k", F.col("k") * 3), path, warn)
    assert e.value.findings == {"key": 2}
    # What stood there before stays, and nothing half-written is left.
    assert spark.read.parquet(path).agg(F.max("k")).first()[0] == 3 and [p.name for p in Path(tmp_path).iterdir()] == ["out"]
    assert Q.checked_write(df.limit(2), path, warn).count() == 3 and spark.read.parquet(path).count() == 2


def test_one_scan_checks_and_writes(spark, tmp_path):
    """The counts come from the job that writes: the source is read once."""
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    df = spark.range(100).mapInArrow(seen, "id long")
    Q.checked_write(df, str(tmp_path / "once"), {"odd": ("warn", F.col("id") % 2 == 1)})
    assert read.value == 100


def test_registry_is_the_batch(spark, tmp_path):
    """Files arrive one by one, the query is stopped and started again in between; ids and spells are those of the finished table."""
    from tallyframe.streaming import registry as R

    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", R.STORE)
    try:
        rng = random.Random(8)
        days = [dt.datetime(2024, 1, 1) + dt.timedelta(days=d) for d in range(40)]
        rows = [(f"m{m}", d, rng.choice("xyz") if rng.random() < 0.3 else "x") for m in range(12) for d in days if rng.random() < (0.9 if m % 3 else 0.3)]
        end = [(f"end{i}", dt.datetime(2025, 1, 1 + i), "z") for i in range(3)]
        parts = [[r for r in rows if lo <= r[1] < hi] for lo, hi in zip([days[0], days[11], days[25]], [days[11], days[25], dt.datetime(2025, 1, 1)], strict=True)]
        schema = "member string, ts timestamp, value string"
        for i, part in enumerate([*parts, end[:1], end[1:2], end[2:]]):
            spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
            q = R.spells_of(stream, 3).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).outputMode("append").trigger(availableNow=True).start()
            assert q.awaitTermination(180) and q.exception() is None
        got = spark.read.parquet(str(tmp_path / "out")).where("member NOT LIKE 'end%'")
        want = R.spells_at_once(spark.createDataFrame(rows, schema), 3)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and want.where("closed_by = 'change'").count() > 10
    finally:
        if before:
            spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
        else:
            spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
