"""Importance resampling towards a target distribution.

Hashed features of documents and target are counted by bucket. What a bucket gains is an array that every task holds, so that a document's
weight is a mean over looked-up numbers. Its score is the weight and a Gumbel number of its id: the highest scores are a draw without replacement.

The draw is exact and no task holds it. Counts by score, some 100,000 numbers at most, say which score is the last to be drawn; eligible rows from there on become
sorted runs within their partitions, cut where a range of scores ends and written to the shared folder. The runs of a range meet in one task,
in a tournament tree that takes the first of all runs again and again, counts ranks on from the ranges before and stops
at the last draw. Ranges hold RANGE_ROWS rows, so that tasks grow in number and not in size. Rows alike in all that counts travel as one with their number.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, map_slices, release, spread, word_pieces

BUCKETS = 10_000
#: Rows of a run, and of a range of scores, about.
RUN_ROWS = 1 << 17
RANGE_ROWS = 1 << 17
SCORED = "doc_id long, n_words long, n_features long, weight long, score long"
#: Ids of rows without one come after all others.
NO_ID = (1 << 63) - 1


class Buckets:
    """The bucket of each feature of a text: runs of 1 to `longest` consecutive words, joined by a space."""

    #: Words whose bucket is remembered.
    MOST = 1 << 18

    def __init__(self, buckets: int, longest: int):
        self.buckets, self.longest = buckets, longest
        self.known: dict[bytes, int] = {}

    def of(self, feature: bytes) -> int:
        found = self.known.get(feature)
        if found is None:
            if len(self.known) >= self.MOST:
                self.known.clear()
            found = self.known[feature] = zlib.crc32(feature) % self.buckets
        return found

    def count(self, text: str | None) -> tuple[int, Counter]:
        """(words, counts by feature) of a text. Runs reach over the pieces that its words come in."""
        n, counts, tail = 0, Counter(), []
        for words in word_pieces(text):
            n += len(words)
            counts.update(words)
            for size in range(2, self.longest + 1):
                joined = tail[1 - size :] + words
                counts.update(b" ".join(joined[i : i + size]) for i in range(len(joined) - size + 1))
            tail = (tail + words)[1 - self.longest :] if self.longest > 1 else []
        return n, counts


def bucket_counts(df: DataFrame, text: str, buckets: int, longest: int) -> np.ndarray:
    """How many features of all texts fall in each bucket. Every task sums its own; the driver gets one number a bucket."""

    def run(slices: Iterator[list[list]]) -> Iterator[list[list]]:
        hashed, total = Buckets(buckets, longest), np.zeros(buckets, np.int64)
        for (texts,) in slices:
            for t in texts:
                for feature, n in hashed.count(t)[1].items():
                    total[hashed.of(feature)] += n
        some = np.nonzero(total)[0]
        yield [some.tolist(), total[some].tolist()]

    out = np.zeros(buckets, np.int64)
    for r in map_slices(spread(df.select(text)), run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of the smoothed target's share over the source's), for each bucket."""
    s, t, k = float(source.sum()), float(target.sum()), len(source)
    return np.array([math.floor(1000 * math.log((b + 1.0) * (s + k) / ((a + 1.0) * (t + k)))) for a, b in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def gumbel(seed: int, doc_id: int | None) -> int:
    h = int.from_bytes(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()[:4], "big")
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gains: np.ndarray, text: str, id: str, longest: int, seed: int) -> DataFrame:
    def run(slices: Iterator[list[list]]) -> Iterator[list[list]]:
        hashed, of = Buckets(len(gains), longest), gains.tolist()
        for ids, texts in slices:
            rows = []
            for i, t in zip(ids, texts, strict=True):
                n, counts = hashed.count(t)
                total = counts.total()
                weight = sum(of[hashed.of(feature)] * k for feature, k in counts.items()) // total if total else 0
                rows.append((i, n, total, weight, weight + gumbel(seed, i)))
            yield list(map(list, zip(*rows, strict=True)))

    return map_slices(spread(docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))), run, SCORED)


class Tournament:
    """A tree of losers over sorted runs of keys: pop() gives the least key left of all runs, with the number of its run and its place there."""

    def __init__(self, runs: list[list[tuple]]):
        self.runs, self.next = runs, [0] * len(runs)
        self.leaves = 1 << max(0, (len(runs) - 1).bit_length())
        self.losers: list[int] = [0] * self.leaves
        winners = [0] * self.leaves + list(range(self.leaves))
        for node in range(self.leaves - 1, 0, -1):
            a, b = winners[2 * node], winners[2 * node + 1]
            winners[node], self.losers[node] = (a, b) if self._before(a, b) else (b, a)
        self.winner = winners[1]

    def _before(self, a: int, b: int) -> bool:
        if b >= len(self.runs) or self.next[b] >= len(self.runs[b]):
            return True
        if a >= len(self.runs) or self.next[a] >= len(self.runs[a]):
            return False
        return self.runs[a][self.next[a]] <= self.runs[b][self.next[b]]

    def pop(self) -> tuple[int, int] | None:
        run = self.winner
        if run >= len(self.runs) or self.next[run] >= len(self.runs[run]):
            return None
        place = self.next[run]
        self.next[run] += 1
        # Only the winner's way to the root is played again.
        node = (run + self.leaves) // 2
        while node:
            if not self._before(self.winner, self.losers[node]):
                self.winner, self.losers[node] = self.losers[node], self.winner
            node //= 2
        return run, place


FIELDS = ("score", "doc_id", "n_features", "weight")


def sorted_runs(rows: DataFrame, bounds: list[tuple[int, int]]) -> DataFrame:
    """(range, run, copies and FIELDS as arrays): rows of each partition in runs, sorted by falling score and then by id, equal rows folded.

    Range i holds what comes before bounds[i] = (-score, id) and not before the one ahead of it. null ids are NO_ID.
    """
    target = pa.schema([("range", pa.int32()), ("run", pa.int64()), *[(c, pa.list_(pa.int64())) for c in (*FIELDS, "copies")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []

        def cut() -> pa.RecordBatch:
            score, *rest = (np.concatenate([b.column(c).to_numpy(zero_copy_only=False) for b in held]) for c in FIELDS)
            key, copies = np.unique(np.stack([-score, *rest], 1), axis=0, return_counts=True)
            firsts = [0, *(bisect_left(range(len(key)), b, key=lambda i: (int(key[i, 0]), int(key[i, 1]))) for b in bounds), len(key)]
            key[:, 0] *= -1
            parts = [(i, a, b) for i, (a, b) in enumerate(zip(firsts, firsts[1:], strict=False)) if a < b]
            columns = [[key[a:b, j] for _, a, b in parts] for j in range(len(FIELDS))]
            arrays = [pa.array([i for i, _, _ in parts], pa.int32()), pa.array([number] * len(parts), pa.int64()), *[pa.array(c, pa.list_(pa.int64())) for c in [*columns, [copies[a:b] for _, a, b in parts]]]]
            return pa.RecordBatch.from_arrays(arrays, schema=target)

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(b.num_rows for b in held) >= RUN_ROWS:
                yield cut()
                held, number = [], number + 1
        if held:
            yield cut()

    lists = ", ".join(f"{c} array<long>" for c in (*FIELDS, "copies"))
    return rows.select(*FIELDS).mapInArrow(run, f"range int, run long, {lists}")


def merged(runs: DataFrame, start_of: list[int], draw: int) -> DataFrame:
    """(FIELDS, rank, copies): the first `draw` rows of all runs, those of a range in one task, with the first rank of each."""
    schema = ", ".join(f"{c} long" for c in (*FIELDS, "rank", "copies"))

    def run(key: tuple, table: pa.Table) -> pa.Table:
        rank = start_of[key[0].as_py()]
        table = table.sort_by("run")
        parts = [list(zip(*(table.column(c)[i].values.to_pylist() for c in (*FIELDS, "copies")), strict=True)) for i in range(table.num_rows)]
        tree, out = Tournament([[(-r[0], *r[1:4]) for r in p] for p in parts]), []
        while rank < draw and (at := tree.pop()):
            row = parts[at[0]][at[1]]
            taken = min(row[4], draw - rank)
            out.append((*row[:4], rank + 1, taken))
            rank += taken
        return pa.table([pa.array(c, pa.int64()) for c in (zip(*out, strict=True) if out else [[]] * 6)], names=[*FIELDS, "rank", "copies"])

    wanted = [i for i, start in enumerate(start_of) if start < draw]
    return runs.where(F.col("range") <= F.lit(max(wanted, default=-1))).groupBy("range").applyInArrow(run, schema)


def cut_points(eligible: DataFrame, counts: list[tuple[int, int]], draw: int) -> tuple[list[tuple[int, int]], int]:
    """Bounds (-score, id) of ranges of RANGE_ROWS rows down to the last score drawn, and that score. counts: (score, rows), falling.

    A score that alone has more rows is cut at quantiles of its ids.
    """
    bounds, held, total, last = [], 0, 0, 0
    crowded = []
    for score, n in counts:
        if total >= draw:
            break
        if held and held + n > RANGE_ROWS:
            bounds.append((-score, -NO_ID - 1))
            held = 0
        if n > RANGE_ROWS:
            crowded.append((score, math.ceil(n / RANGE_ROWS)))
        held, total, last = held + n, total + n, score
    if crowded:
        shares = {s: k for s, k in crowded}
        found = eligible.where(F.col("score").isin(*shares)).groupBy("score").agg(F.percentile_approx("doc_id", F.array(*[F.lit(i / 64) for i in range(1, 64)]), F.lit(10_000)).alias("ids")).collect()
        for r in found:
            step = max(1, 64 // shares[r["score"]])
            bounds += [(-r["score"], i) for i in sorted(set(r["ids"][step - 1 :: step]))]
    return sorted(set(bounds)), last


def after(last: dict) -> Column:
    """Whether a row comes after `last` in the order of the draw."""
    out, same = F.lit(False), F.lit(True)
    for c, sign in zip(FIELDS, (-1, 1, 1, 1), strict=True):
        out = out | (same & (F.col(c) * sign > last[c] * sign))
        same = same & (F.col(c) == last[c])
    return out


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, buckets: int = BUCKETS, longest: int = 1, seed: int = 2024, text: str = "text", id: str = "doc_id", target_text: str = "text") -> DataFrame:
    """(doc_id, n_features, weight, score, rank), all long, for each row of docs: rank is its place in the draw, null of undrawn rows.

    floor(percent * N / 100) of the N rows with at least least_words words are drawn: the highest scores, ties to the smaller id (rows without one
    last), then to fewer features and the smaller weight; rows alike in all of these take the ranks between them. Null and empty texts
    have no features and weight 0. Ids must be whole numbers of 64 bits. No other columns are read.
    """
    spark = docs.sparkSession
    gains = bucket_gains(bucket_counts(docs, text, buckets, longest), bucket_counts(target, target_text, buckets, longest))
    every = cut_lineage(scored(docs, gains, text, id, longest, seed))
    enough = F.col("n_words") >= least_words
    eligible = every.where(enough).withColumn("doc_id", F.coalesce("doc_id", F.lit(NO_ID)))
    counts = sorted(((r["score"], r["n"]) for r in eligible.groupBy("score").agg(F.count("*").alias("n")).collect()), reverse=True)
    draw = percent * sum(n for _, n in counts) // 100
    columns = ["doc_id", "n_features", "weight", "score"]
    if not draw:
        return every.select(*columns, F.lit(None).cast("long").alias("rank"))
    bounds, last_score = cut_points(eligible, counts, draw)
    runs = cut_lineage(sorted_runs(eligible.where(F.col("score") >= last_score), bounds))
    in_range = {r["range"]: r["n"] for r in runs.groupBy("range").agg(F.sum(F.aggregate("copies", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n")).collect()}
    starts = list(accumulate((in_range.get(i, 0) for i in range(len(bounds))), initial=0))
    drawn = cut_lineage(merged(runs, starts, draw))
    release(runs)
    last = drawn.orderBy(F.desc("rank")).first().asDict()
    alike = F.lit(True)
    for c in FIELDS:
        alike = alike & (F.col(c) == last[c])
    # Of the rows like the last one drawn, so many stay undrawn.
    left = eligible.where(alike).count() - drawn.where(alike).agg(F.sum("copies")).first()[0]
    real = F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id")
    ranked = drawn.select(*FIELDS, F.explode(F.sequence("rank", F.col("rank") + F.col("copies") - 1)).alias("rank")).select(real, *columns[1:], "rank")
    keyed = every.withColumn("doc_id", F.coalesce("doc_id", F.lit(NO_ID)))
    undrawn = keyed.where(~enough | after(last)).select(real, *columns[1:])
    copies = spark.range(left).select(*[F.lit(last[c]).cast("long").alias(c) for c in columns]).select(real, *columns[1:])
    return ranked.unionByName(undrawn.unionByName(copies).withColumn("rank", F.lit(None).cast("long")))
