"""Measures of weighted undirected graphs: ties (source, target, weight), each pair once, and labels (member, bloc)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.sources.shared import beside, reliable, release, tabled


def both_ways(ties: DataFrame) -> DataFrame:
    """Each tie from either end, made in one pass."""
    ends = F.array(F.struct("source", "target", "weight"), F.struct(F.col("target").alias("source"), F.col("source").alias("target"), "weight"))
    return ties.select(F.inline(ends))


def with_blocs(ties: DataFrame, blocs: DataFrame) -> DataFrame:
    """ties with bloc_a and bloc_b; an unlabelled end keeps a null."""
    blocs = beside(blocs)
    a = blocs.select(F.col("member").alias("source"), F.col("bloc").alias("bloc_a"))
    b = blocs.select(F.col("member").alias("target"), F.col("bloc").alias("bloc_b"))
    return ties.join(a, "source", "left").join(b, "target", "left")


#: One in so many targets shows how near the k nearest are at least.
TRIED = 16


def nearest_k(ties: DataFrame, k: int = 3) -> DataFrame:
    """(source, target, weight, rank): each member's k strongest ties, smaller id first among equals.

    The k-th strongest among some targets bounds the k-th of all from below, so that only ties that reach it are sorted.
    """
    w = Window.partitionBy("source").orderBy(F.desc("weight"), "target")
    ranked = lambda t: t.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    ends = both_ways(ties)
    bound = ranked(ends.where(F.pmod(F.xxhash64("target"), F.lit(TRIED)) == 0)).where(F.col("rank") == k).select("source", F.col("weight").alias("_least"))
    return ranked(ends.join(beside(bound), "source", "left").where("_least IS NULL OR weight >= _least").drop("_least"))


def assortativity(ties: DataFrame, blocs: DataFrame) -> DataFrame:
    """One row: (trace - sum of squared margins) / (1 - the same); ties with an unlabelled end are dropped."""
    return assortativity_of(with_blocs(both_ways(ties), blocs).groupBy("bloc_a", "bloc_b").agg(F.count("*").alias("n")))


def assortativity_of(e: DataFrame) -> DataFrame:
    """assortativity() of counted ties: (bloc_a, bloc_b, n), each tie from both ends."""
    e = reliable(e.where("bloc_a IS NOT NULL AND bloc_b IS NOT NULL"))
    total = e.agg(F.sum("n").alias("total"))
    same = e.agg(F.sum(F.when(F.col("bloc_a") == F.col("bloc_b"), F.col("n")).otherwise(0)).alias("same"))
    margin = e.groupBy("bloc_a").agg(F.sum("n").alias("m")).agg(F.sum(F.col("m").cast("double") * F.col("m")).alias("squares"))
    trace, sq = F.col("same") / F.col("total"), F.col("squares") / (F.col("total").cast("double") * F.col("total"))
    return total.crossJoin(same).crossJoin(margin).select(F.round(F.try_divide(trace - sq, 1 - sq), 6).alias("assortativity"))


def modularity(ties: DataFrame, blocs: DataFrame) -> DataFrame:
    """One row: the sum over blocs of (weight inside / all weight) - (strength / twice all weight) squared."""
    blocs = beside(blocs)
    t = with_blocs(ties, blocs)
    total = ties.agg(F.sum("weight").alias("m"))
    inside = t.where("bloc_a = bloc_b").groupBy(F.col("bloc_a").alias("bloc")).agg(F.sum("weight").alias("inside"))
    strength = both_ways(ties).withColumnRenamed("source", "member").join(blocs, "member").groupBy("bloc").agg(F.sum("weight").alias("d"))
    return _modularity(strength, inside, total)


def modularity_of(e: DataFrame) -> DataFrame:
    """modularity() of summed ties: (bloc, other, weight), each tie from both ends."""
    e = reliable(e)
    own = e.where("bloc IS NOT NULL").groupBy("bloc")
    inside = own.agg((F.sum(F.when(F.col("bloc") == F.col("other"), F.col("weight"))) / 2).alias("inside"))
    return _modularity(own.agg(F.sum("weight").alias("d")), inside, e.agg((F.sum("weight") / 2).alias("m")))


def _modularity(strength: DataFrame, inside: DataFrame, total: DataFrame) -> DataFrame:
    q = strength.join(inside, "bloc", "left").crossJoin(F.broadcast(total))
    return q.agg(F.round(F.sum(F.coalesce("inside", F.lit(0.0)) / F.col("m") - F.pow(F.col("d") / (2 * F.col("m")), 2)), 6).alias("modularity"))


def ei_counts(ties: DataFrame, blocs: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(by..., bloc, internal, external): ties of each bloc's members, an internal one counted at both ends."""
    by = by or []
    ends = both_ways(ties)
    blocs = beside(blocs)
    a = blocs.select(*by, F.col("member").alias("source"), F.col("bloc").alias("bloc"))
    b = blocs.select(*by, F.col("member").alias("target"), F.col("bloc").alias("other"))
    t = ends.join(a, "source").join(b, ["target", *by])
    same = F.col("bloc") == F.col("other")
    return t.groupBy(*by, "bloc").agg(F.sum(F.when(same, 1).otherwise(0)).alias("internal"), F.sum(F.when(~same, 1).otherwise(0)).alias("external"))


def ei_counts_by_draw(ties: DataFrame, labels: DataFrame) -> DataFrame:
    """(draw, bloc, internal, external) as ei_counts gives them, for labels (draw, member, bloc) with the same draws for each member.

    A member's labels of all draws travel as one array, so that ties by draws are counted where they are and not shuffled.
    """
    names = labels.select("bloc").distinct()
    numbered = names.withColumn("k", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("bloc")).cast("int"))
    own = labels.join(numbered, labels["bloc"].eqNullSafe(numbered["bloc"])).groupBy("member").agg(F.array_sort(F.collect_list(F.struct("draw", "k"))).alias("of"))
    own = own.select("member", F.transform("of", lambda x: x["k"]).alias("k"), F.transform("of", lambda x: x["draw"]).alias("draws"))
    a, b = own.toDF("source", "a", "draws"), own.select("member", "k").toDF("target", "b")
    pairs = ties.select("source", "target").join(a, "source").join(b, "target")
    cells = pairs.select(F.inline(F.arrays_zip("draws", "a", "b"))).groupBy(F.col("draws").alias("draw"), "a", "b").agg(F.count("*").alias("n"))
    ends = cells.select("draw", "a", "b", "n").unionByName(cells.select("draw", F.col("b").alias("a"), F.col("a").alias("b"), "n"))
    counts = ends.groupBy("draw", "a").agg(F.sum(F.when(F.col("a") == F.col("b"), F.col("n")).otherwise(0)).alias("internal"), F.sum(F.when(F.col("a") != F.col("b"), F.col("n")).otherwise(0)).alias("external"))
    return counts.join(numbered, counts["a"] == numbered["k"]).select("draw", "bloc", "internal", "external")


def shuffled_labels(blocs: DataFrame, draws: int, seed: str) -> DataFrame:
    """(draw, member, bloc): labels dealt anew, bloc sizes kept, by md5 ranks."""
    drawn = blocs.crossJoin(F.broadcast(blocs.sparkSession.range(draws).withColumnRenamed("id", "draw")))
    w = Window.partitionBy("draw")
    mixed = F.md5(F.concat_ws("|", F.lit(seed), F.col("draw").cast("string"), F.col("member").cast("string")))
    ranked = drawn.withColumn("place", F.row_number().over(w.orderBy("member"))).withColumn("other", F.row_number().over(w.orderBy(mixed, "member")))
    return ranked.select("draw", "place", "member").join(ranked.select("draw", F.col("other").alias("place"), "bloc"), ["draw", "place"]).select("draw", "member", "bloc")


#: So many links are left to one task at most, and so many are held at once where they are made.
FEW_LINKS, HELD_LINKS = 100_000, 1 << 20


def contract(links: DataFrame, few: int = FEW_LINKS) -> DataFrame:
    """(node, root) for each node of links (a, b), whole numbers: nodes have the same root if and only if links connect them.

    Each round sends every node to that neighbour (or itself) which comes first in a fresh random order and carries links over, so that
    they shrink by a constant factor whatever their shape, and what is connected leaves the rounds as soon as it is one node. The last `few` links
    are merged by one task, which saves rounds and changes nothing else. Before all, each task keeps only links that connect what others of its own do not,
    so that of dense graphs little more than nodes is written or moved.
    """
    ends = links.where("a <> b").select(F.least("a", "b").cast("long").alias("a"), F.greatest("a", "b").cast("long").alias("b"))
    links = tabled(ends.mapInArrow(spanning, "a long, b long").distinct())
    rounds: list[DataFrame] = []
    while n := links.count():
        if n <= few:
            rounds.append(tabled(links.coalesce(1).mapInArrow(merged, "node long, to long")))
            break
        seed = F.lit(len(rounds))
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy("a").agg(F.min(F.struct(F.xxhash64(seed, "b").alias("o"), F.col("b").alias("n"))).alias("m"))
        moves = tabled(near.select(F.col("a").alias("node"), F.least("m", F.struct(F.xxhash64(seed, "a").alias("o"), F.col("a").alias("n")))["n"].alias("to")))
        rounds.append(moves)
        ends = links.join(moves.toDF("a", "ta"), "a").join(moves.toDF("b", "tb"), "b").where("ta <> tb")
        left = tabled(ends.select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct())
        release(links)
        links = left
    out = links.select(F.col("a").alias("node"), F.col("b").alias("root")) if not rounds else rounds[0].withColumnRenamed("to", "root")
    for later in rounds[1:]:
        out = out.join(later.toDF("root", "next"), "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    out = tabled(out)
    release(links, *rounds)
    return out


def spanning(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) of a task that connect all that its links connect: fewer than its nodes, unless these are too many to be held at once."""
    held, count = [], 0
    for batch in batches:
        held.append(np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("a", "b")]))
        count += batch.num_rows
        if count > HELD_LINKS:
            kept = forest(np.concatenate(held, 1))
            held, count = [kept], kept.shape[1]
            if count > HELD_LINKS // 2:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in kept], names=["a", "b"])
                held, count = [], 0
    if count:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in forest(np.concatenate(held, 1))], names=["a", "b"])


def forest(links: np.ndarray) -> np.ndarray:
    """Columns of links (two rows of nodes) that connect the same nodes without a circle: roots hang themselves below smaller ones, by one link each, until none is left that can."""
    _, at = np.unique(links, return_inverse=True)
    u, v = at.reshape(2, -1)
    up, open_, kept = np.arange(at.max(initial=-1) + 1), np.arange(links.shape[1]), []
    while True:
        u, v = up[u], up[v]
        apart = u != v
        u, v, open_ = u[apart], v[apart], open_[apart]
        if not len(open_):
            return links[:, np.concatenate(kept)] if kept else links[:, :0]
        roots, first = np.unique(np.maximum(u, v), return_index=True)
        up[roots] = np.minimum(u, v)[first]
        kept.append(open_[first])
        while not np.array_equal(up, above := up[up]):
            up = above


def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, to) for all links (a, b) of a task, by trees whose roots are merged."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while (above := up.setdefault(x, x)) != x:
            up[x] = up[above]
            x = above
        return x

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
    yield pa.RecordBatch.from_arrays([pa.array(list(up), pa.int64()), pa.array([root(x) for x in list(up)], pa.int64())], names=["node", "to"])


def components(ties: DataFrame, nodes: DataFrame) -> DataFrame:
    """(member, component): the smallest member that ties reach. Members are whole numbers."""
    roots = contract(ties.select(F.col("source").alias("a"), F.col("target").alias("b")))
    least = roots.groupBy("root").agg(F.min("node").alias("component"))
    named = roots.join(least, "root").select(F.col("node").alias("member"), "component")
    return nodes.select("member").join(named, "member", "left").select("member", F.coalesce("component", "member").alias("component"))


def disparity(ties: DataFrame) -> DataFrame:
    """(source, target, weight, p): how likely, at the end where it is less so, a tie's share of all the end's weight is if that were dealt at random over its ties.

    (1 - share) ** (ties - 1) at each end; the smaller one counts. A tie that is an end's only one says nothing there (1). Ties with p below a level are the backbone.
    """
    # Written, as ties are read twice; what their ends come to goes beside them, so that none is sorted or moved.
    ties = tabled(ties)
    ends = beside(both_ways(ties).groupBy(F.col("source").alias("member")).agg(F.count("*").alias("k"), F.sum("weight").alias("s")))
    a, b = ends.toDF("source", "ka", "sa"), ends.toDF("target", "kb", "sb")
    chance = lambda k, s: F.when(F.col(k) > 1, F.pow(1 - F.col("weight") / F.col(s), F.col(k) - 1)).otherwise(1.0)
    return ties.join(a, "source").join(b, "target").select("source", "target", "weight", F.least(chance("ka", "sa"), chance("kb", "sb")).alias("p"))


def pair_correlation(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row on two tables of ties: pairs in either, pairs in both, the correlation of weights over the former (0 where a pair is missing), and, over the pairs of a, that of its weight with being in b at all."""
    x = a.select("source", "target", F.col("weight").cast("double").alias("x"))
    y = b.select("source", "target", F.col("weight").cast("double").alias("y"))
    both = x.join(y, ["source", "target"], "full")
    ever = F.when(F.col("x").isNotNull(), F.col("y").isNotNull().cast("double"))
    return both.agg(
        F.count("*").alias("pairs"),
        F.count_if(F.col("x").isNotNull() & F.col("y").isNotNull()).alias("in_both"),
        F.round(correlation(F.coalesce("x", F.lit(0.0)), F.coalesce("y", F.lit(0.0))), 6).alias("correlation"),
        F.round(correlation(F.col("x"), ever), 6).alias("with_any"),
    )


def correlation(x: Column, y: Column) -> Column:
    """Pearson's, over rows that have both; null where either does not vary."""
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
