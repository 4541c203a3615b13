"""Approximate nearest neighbours: a forest of random-projection trees with one queue, then exact reranking.

Trees are fitted to a bounded sample: a node's plane lies between two random members and cuts at their median
projection. Every row is routed to one leaf of each tree. A query walks all trees through one shared priority queue, nearest
planes first, until the leaves it has reached hold its share of the rows. Rows of those leaves are its candidates,
and each gets its exact cosine in double precision. Tables of any size take this path.

The share is calibrated on the sample, by brute force there, to reach TARGET_RECALL: clustered vectors need little,
vectors without structure need much of the table, and larger tables need a smaller share than their sample.

Equal vectors are folded into one before the search: of its rows only the k + 1 smallest ids can ever be listed. Leaves are
searched in blocks of neighbours, a tile of a block's rows against a tile of its queries at a time, so that no task
holds more than a tile of each, and a query travels once to a tile and not to each of its leaves.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage, release

TREES = 4
#: Rows that the forest is fitted to, at most: those with the smallest hashes. Depth ends where a leaf holds SAMPLE_LEAF of them.
SAMPLE_ROWS = 8_192
SAMPLE_LEAF = 8
CALIBRATION_QUERIES = 256
TARGET_RECALL = 0.96
LEAF_ROWS = 128
#: A block is a subtree of this depth, 32 leaves.
BLOCK_DEPTH = 5
#: Rows, and queries, of a tile, about.
TILE_ROWS = 16_384
#: Exact cosines that are computed at once.
PAIRS = 1 << 15
SEED = 7


class Forest:
    """Complete trees of `depth`: planes [tree, node, dim] and cuts [tree, node]; and the share of rows to search."""

    def __init__(self, sample: np.ndarray, depth: int, trees: int = TREES, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.depth, nodes, dims = depth, (1 << depth) - 1, sample.shape[1]
        self.planes, self.cuts = np.zeros((trees, nodes, dims)), np.zeros((trees, nodes))
        for t in range(trees):
            members = [np.arange(len(sample))]
            for node in range(nodes):
                own = sample[members[node]]
                plane = rng.normal(size=dims)
                if len(own) > 1:
                    a, b = rng.choice(len(own), 2, replace=False)
                    if (own[a] != own[b]).any():
                        plane = own[a] - own[b]
                self.planes[t, node] = plane / np.linalg.norm(plane)
                side = own @ self.planes[t, node]
                self.cuts[t, node] = np.median(side) if len(own) else 0.0
                above = side > self.cuts[t, node]
                members += [members[node][~above], members[node][above]]

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each unit vector in each tree: [row, tree], counted from 0."""
        out = np.zeros((len(x), len(self.planes)), np.int64)
        for t in range(len(self.planes)):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                side = np.einsum("ij,ij->i", x, self.planes[t, node])
                node = 2 * node + 1 + (side > self.cuts[t, node])
            out[:, t] = node - ((1 << self.depth) - 1)
        return out

    def walk(self, x: np.ndarray) -> Iterator[tuple[int, int]]:
        """(tree, leaf), nearest first, of one unit vector."""
        first = (1 << self.depth) - 1
        margins = np.einsum("tnd,d->tn", self.planes, x) - self.cuts if self.depth else np.zeros((len(self.planes), 0))
        queue = [(0.0, t, 0) for t in range(len(self.planes))]
        while queue:
            far, t, node = heapq.heappop(queue)
            own = margins[t]
            while node < first:
                m = own[node]
                near = 2 * node + 1 + (m > 0)
                heapq.heappush(queue, (max(far, abs(m)), t, 4 * node + 3 - near))
                node = near
            yield t, int(node - first)

    def probes(self, x: np.ndarray, sizes: np.ndarray, budget: float) -> list[tuple[int, int]]:
        """Leaves until they hold `budget` rows, counted over all trees; sizes [tree, leaf]."""
        out, held = [], 0
        for t, leaf in self.walk(x):
            out.append((t, leaf))
            held += sizes[t, leaf]
            if held >= budget:
                break
        return out


def unit(x: np.ndarray) -> np.ndarray:
    # Scaled first, so that squares of very large or small components stay in range.
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def calibrate(forest: Forest, sample: np.ndarray, k: int, target: float = TARGET_RECALL) -> float:
    """Rows to search, over all trees, as a multiple of the table's, so that sample queries find `target` of their k nearest."""
    n = len(sample)
    queries = np.unique(np.linspace(0, n - 1, CALIBRATION_QUERIES).astype(int))
    leaves = forest.leaves(sample)
    sizes = np.stack([np.bincount(leaves[:, t], minlength=1 << forest.depth) for t in range(leaves.shape[1])])
    needed = []
    for q in queries.tolist():
        s = sample @ sample[q]
        s[q] = -np.inf
        want = np.argsort(-s)[: min(k, n - 1)].tolist()
        at, held = {}, 0
        for t, leaf in forest.walk(sample[q]):
            held += sizes[t, leaf]
            at[t, leaf] = held
        needed += [min(at[t, int(leaves[i, t])] for t in range(leaves.shape[1])) for i in want]
    return float(np.quantile(needed, target)) / n if needed else float(leaves.shape[1])


def usable(vectors: DataFrame, id: str, vector: str) -> DataFrame:
    """(vec, v: array<double>) of rows with an id and a vector of the most common length, finite and not zero. Repeated rows stay."""
    v = F.col(vector).cast("array<double>")
    fine = F.col(id).isNotNull() & v.isNotNull() & (F.size(v) > 0)
    fine = fine & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(v, lambda x: x != 0)
    rows = vectors.where(fine).select(F.col(id).cast("long").alias("vec"), v.alias("v"))
    lengths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.where(F.size("v") == (lengths[0]["n"] if lengths else 0))


def nearest(vectors: DataFrame, is_query, k: int = 5, id: str = "vec_id", vector: str = "embedding", sample_rows: int = SAMPLE_ROWS, target: float = TARGET_RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that is_query (a column over `vec`, the id) admits, its k nearest by cosine.

    Nearest first, ties to the smaller id; fewer than k if there are fewer other rows. Vectors that are null, zero, of
    another length than most or hold null or non-finite components take no part. Every row but the query's own is a candidate:
    a row that is there three times can be listed three times, and a query's second copy is its neighbour. Query rows
    alike in id and vector are one query. Columns other than id and vector are not read. Ids must fit in 64 bits.
    """
    spark = vectors.sparkSession
    rows = cut_lineage(usable(vectors, id, vector).withColumn("h", F.xxhash64("v")))
    place = F.row_number().over(Window.partitionBy("h", "v").orderBy("vec"))
    few = rows.withColumn("place", place).where(F.col("place") <= k + 1)
    # Equal ids may stand for unlike vectors, so that a fold is named by a number of its own.
    folded = few.groupBy("h", "v").agg(F.min("vec").alias("rep"), F.array_sort(F.collect_list(F.struct("vec", "place"))).alias("ids"))
    folded = cut_lineage(folded.withColumn("fold", F.monotonically_increasing_id()))
    queries = cut_lineage(rows.where(is_query).select("h", "v", "vec").distinct().join(folded.select("h", "v", "fold"), ["h", "v"]).select(F.col("vec").alias("query_id"), "fold"))
    n = folded.count()
    if n < 1 or queries.isEmpty():
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = folded.orderBy(F.xxhash64(F.lit(SEED), "h"), "rep", "v").limit(sample_rows).select("v").toArrow()
    points = unit(matrix(sample.column("v")))
    depth = max(0, min(round(math.log2(n / LEAF_ROWS)), int(math.log2(max(1, len(points) / SAMPLE_LEAF)))))
    forest = Forest(points, depth)
    share = calibrate(forest, points, k, target)
    shared = spark.sparkContext.broadcast(forest)
    trees, low = len(forest.planes), min(BLOCK_DEPTH, depth)
    blocks = 1 << (depth - low)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaves = shared.value.leaves(unit(matrix(batch.column("v"))))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, leaves.size + 1, trees), pa.int32()), pa.array(leaves.ravel(), pa.int32()))
                yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "leaves"])

    placed = cut_lineage(folded.select("fold", "rep", "v").mapInArrow(route, "fold long, rep long, v array<double>, leaves array<int>"))
    each = placed.select("fold", "rep", "v", F.posexplode("leaves").alias("tree", "leaf"))
    sizes = np.zeros((trees, 1 << depth), np.int64)
    for r in each.groupBy("tree", "leaf").count().collect():
        sizes[r["tree"], r["leaf"]] = r["count"]
    budget = max(share * n, k + 1)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list[dict]] = []
            for x in unit(matrix(batch.column("v"))) if batch.num_rows else ():
                masks: dict[int, int] = {}
                for t, leaf in shared.value.probes(x, sizes, budget):
                    block = t * blocks + (leaf >> low)
                    masks[block] = masks.get(block, 0) | 1 << (leaf & ((1 << low) - 1))
                out.append([{"block": b, "mask": m} for b, m in masks.items()])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.struct([("block", pa.int32()), ("mask", pa.int64())])))], names=[*batch.schema.names, "probes"])

    asking = queries.select("fold").distinct().join(folded.select("fold", "v"), "fold")
    asked = cut_lineage(asking.mapInArrow(probe, "fold long, v array<double>, probes array<struct<block:int,mask:long>>"))
    asks = asked.select(F.col("fold").alias("q"), F.col("v").alias("y"), F.inline("probes"))
    asks_of = {r["block"]: r["count"] for r in asks.groupBy("block").count().collect()}
    rows_of = sizes.reshape(trees * blocks, -1).sum(1).tolist()
    # Tiles of each block: row tiles by query tiles.
    row_tiles = [max(1, math.ceil(r / TILE_ROWS)) for r in rows_of]
    query_tiles = [math.ceil(asks_of.get(b, 0) / TILE_ROWS) for b in range(len(rows_of))]

    def tiles(counts: list[int]) -> Column:
        return F.element_at(F.array(*map(F.lit, counts)), F.col("block") + 1)

    def every(counts: list[int]) -> Column:
        return F.explode(F.sequence(F.lit(0), tiles(counts) - 1))

    block_of = (F.col("tree") * blocks + F.shiftright("leaf", low)).cast("int")
    wanted = each.withColumn("block", block_of).where(tiles(query_tiles) > 0)
    held = wanted.withColumn("r", F.pmod(F.xxhash64("fold"), tiles(row_tiles)).cast("int")).withColumn("c", every(query_tiles)).select("block", "r", "c", "fold", "rep", "v", "leaf")
    asks = asks.withColumn("c", F.pmod(F.xxhash64("q"), tiles(query_tiles)).cast("int")).withColumn("r", every(row_tiles))

    def rank(key: tuple, asks: pa.Table, rows_of: pa.Table) -> pa.Table:
        out = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        if asks.num_rows and rows_of.num_rows:
            out = search_tile(matrix(asks.column("y")), asks.column("q").to_numpy(), asks.column("mask").to_numpy(), matrix(rows_of.column("v")), rows_of.column("fold").to_numpy(), rows_of.column("rep").to_numpy(), rows_of.column("leaf").to_numpy() & ((1 << low) - 1), k + 1)
        return pa.table(dict(zip(("q", "near", "rep", "score"), map(pa.array, out), strict=True)))

    by = ["block", "r", "c"]
    found = asks.groupBy(*by).cogroup(held.groupBy(*by)).applyInArrow(rank, "q long, near long, rep long, score double")
    best = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "rep", "near"))
    top = cut_lineage(found.groupBy("q", "near", "rep").agg(F.max("score").alias("score")).withColumn("place", best).where(F.col("place") <= k + 1))
    release(rows, placed, asked)
    listed = top.join(folded.select(F.col("fold").alias("near"), "ids"), "near").select("q", "near", "score", F.inline("ids"))
    listed_place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec", "near", "place"))
    listed = listed.withColumn("at", listed_place).where(F.col("at") <= k + 1).groupBy("q").agg(F.array_sort(F.collect_list(F.struct("at", "vec", "near", "place", "score"))).alias("all"))
    listed = cut_lineage(listed)
    release(folded, top)
    # The query's own row is the first of its fold with its id.
    own = F.array_min(F.transform(F.filter("all", lambda x: (x["vec"] == F.col("query_id")) & (x["near"] == F.col("fold"))), lambda x: x["at"]))
    others = F.slice(F.filter("all", lambda x: x["at"] != F.coalesce(own, F.lit(k + 1))), 1, k)
    return (
        queries.join(listed, queries["fold"] == listed["q"])
        .select("query_id", F.posexplode(others).alias("pos", "x"))
        .select("query_id", (F.col("pos") + 1).alias("rank"), F.col("x.vec").alias("vec_id"), F.col("x.score").alias("score"))
    )


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """The rows of a column of lists of equal length."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(flat, pa.ChunkedArray):
        flat = pa.concat_arrays(flat.chunks) if flat.num_chunks else pa.array([], flat.type)
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def search_tile(y: np.ndarray, q: np.ndarray, masks: np.ndarray, v: np.ndarray, folds: np.ndarray, reps: np.ndarray, leaves: np.ndarray, most: int) -> list[np.ndarray]:
    """(q, fold, rep, score) of at most `most` rows for each query: the nearest rows of the leaves in its mask, by exact cosine, then by (rep, fold)."""
    x, u = unit(v), unit(y)
    parts = []
    for leaf in np.unique(leaves).tolist():
        rows, asks = np.nonzero(leaves == leaf)[0], np.nonzero(masks >> leaf & 1)[0]
        step = max(1, (1 << 21) // len(rows))
        for at in range(0, len(asks), step):
            own = asks[at : at + step]
            s = u[own] @ x[rows].T
            take = min(most, len(rows))
            # Near ties at the edge stay until exact cosines and ids decide, query by query.
            edge = -np.partition(-s, take - 1, axis=1)[:, take - 1 : take]
            i, j = np.nonzero(s >= edge - 1e-12)
            cuts = [0]
            while cuts[-1] < len(i):
                end = min(cuts[-1] + PAIRS, len(i))
                end = len(i) if end == len(i) else max(int(np.searchsorted(i, i[end])), int(np.searchsorted(i, i[cuts[-1]], "right")))
                cuts.append(end)
            for a, b in zip(cuts, cuts[1:], strict=False):
                pair_q, pair_r = own[i[a:b]], rows[j[a:b]]
                parts.append(best(pair_q, pair_r, cosines(y[pair_q], v[pair_r]), reps, folds, most))
    if not parts:
        return [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
    i, j, s = best(*(np.concatenate(c) for c in zip(*parts, strict=True)), reps, folds, most)
    return [q[i], folds[j], reps[j], s]


def best(i: np.ndarray, j: np.ndarray, s: np.ndarray, reps: np.ndarray, folds: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first `most` pairs of each i, by falling s, then by (reps, folds) of j."""
    order = np.lexsort((folds[j], reps[j], -s, i))
    i, j, s = i[order], j[order], s[order]
    start = np.concatenate(([True], i[1:] != i[:-1])) if len(i) else np.zeros(0, bool)
    place = np.arange(len(i)) - np.maximum.accumulate(np.where(start, np.arange(len(i)), 0))
    return i[place < most], j[place < most], s[place < most]


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each pair of rows, the same whatever stands around them."""
    a, b = a / np.abs(a).max(1, keepdims=True), b / np.abs(b).max(1, keepdims=True)
    return np.einsum("ij,ij->i", a, b) / np.sqrt(np.einsum("ij,ij->i", a, a) * np.einsum("ij,ij->i", b, b))
