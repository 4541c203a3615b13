"""Hard negatives by product quantisation with stored residual norms.

Vectors hold whole numbers. A codebook for each few dimensions is fitted to a bounded sample; every row stores its codes and, for each
subspace, the norm of what the codes leave out. A table of the anchor's products with all centroids gives a row's score by look-up, and
the norms of anchor and residuals bound how far the true product can lie from it, up or down. A row is compared exactly only
if these bounds leave it among the first of a window; the exact integer products of these candidates complete the window. Nothing is lost: a row
whose upper bound lies below so many lower bounds of rows that are surely inside can't be listed.

Rows and anchors meet in tiles, a block of rows against a block of anchors, and each tile returns a few rows a window. First come the
positives of each anchor; their scores are the windows of the second pass.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ann import matrix
from .common import cut_lineage, release

#: Rows that the codebooks are fitted to, at most: those with the smallest hashes.
SAMPLE_ROWS = 8_192
#: Dimensions of a subspace, its centroids and the rounds in which they are fitted.
SUBSPACE = 2
CENTROIDS = 256
ROUNDS = 5
#: Rows, and anchors, of a tile, about; and scores that are held at once.
TILE_ROWS = 8_192
SCORES = 1 << 20
#: Products of doubles are exact below this.
EXACT = 1 << 53
SEED = 13


class Quantizer:
    """Codebooks [subspace, centroid, dim] of whole numbers, for vectors padded with zeros to full subspaces."""

    def __init__(self, sample: np.ndarray, subspace: int = SUBSPACE, centroids: int = CENTROIDS, seed: int = SEED):
        self.dims, self.subspace = sample.shape[1], subspace
        parts = self.split(sample)
        rng = np.random.default_rng(seed)
        self.books = np.stack([self._fit(parts[:, m], centroids, rng) for m in range(parts.shape[1])])

    def split(self, x: np.ndarray) -> np.ndarray:
        """[row, subspace, dim]."""
        pad = -x.shape[1] % self.subspace
        return np.pad(x, ((0, 0), (0, pad))).reshape(len(x), -1, self.subspace)

    @staticmethod
    def _fit(points: np.ndarray, centroids: int, rng: np.random.Generator) -> np.ndarray:
        book = points[rng.integers(0, len(points), centroids)].copy()
        for _ in range(ROUNDS):
            code = nearest_code(points, book)
            n = np.bincount(code, minlength=centroids)
            for d in range(points.shape[1]):
                sums = np.bincount(code, weights=points[:, d], minlength=centroids)
                book[n > 0, d] = np.round(sums[n > 0] / n[n > 0])
        return book

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes [row, subspace] and the norms of the residuals, rounded up."""
        parts = self.split(x)
        codes = np.stack([nearest_code(parts[:, m], self.books[m]) for m in range(parts.shape[1])], 1)
        left = parts - self.books[np.arange(parts.shape[1])[None], codes]
        return codes.astype(np.uint8), raised(np.sqrt((left**2).sum(2)))

    def scores(self, anchors: np.ndarray, codes: np.ndarray, residuals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Looked-up scores [anchor, row] and by how much the true ones can differ."""
        parts = self.split(anchors)
        tables = np.einsum("amd,mcd->mac", parts, self.books)
        out = np.zeros((len(anchors), len(codes)))
        size = np.zeros_like(out)
        for m in range(parts.shape[1]):
            out += tables[m][:, codes[:, m]]
            size += np.abs(tables[m]).max(1)[:, None]
        bound = np.sqrt((parts**2).sum(2)) @ residuals.T.astype(float)
        # What rounding of doubles can add to sums of that size.
        return out, bound * (1 + 1e-9) + (size + bound + 1) * 1e-12 * parts.shape[1]


def nearest_code(points: np.ndarray, book: np.ndarray) -> np.ndarray:
    out = np.empty(len(points), np.int64)
    half = (book**2).sum(1) / 2
    for at in range(0, len(points), 4096):
        out[at : at + 4096] = np.argmin(half - points[at : at + 4096] @ book.T, 1)
    return out


def raised(x: np.ndarray) -> np.ndarray:
    """Single precision, never below x."""
    y = x.astype(np.float32)
    return np.where(y.astype(float) < x * (1 + 1e-12), np.nextafter(y, np.float32(np.inf)), y)


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of pairs of rows."""
    most = (np.abs(a).max(initial=0) * np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < EXACT:
        return np.einsum("ij,ij->i", a, b).astype(np.int64)
    return np.array([sum(int(x) * int(y) for x, y in zip(p, q, strict=True)) for p, q in zip(a.tolist(), b.tolist(), strict=True)], dtype=np.int64)


def usable(vectors: DataFrame, id: str, vector: str, label: str, scale: int) -> DataFrame:
    """(vec, label, v): rows with an id, a label and a vector of the most common length without null or non-finite components, these as floor(scale * x)."""
    v = F.col(vector).cast("array<double>")
    fine = F.col(id).isNotNull() & F.col(label).isNotNull() & v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.where(fine).select(F.col(id).cast("long").alias("vec"), F.col(label).cast("string").alias("label"), F.transform(v, lambda x: F.floor(x * scale).cast("double")).alias("v"))
    lengths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.where(F.size("v") == (lengths[0]["n"] if lengths else 0))


def coded(rows: DataFrame, quantizer: Quantizer) -> DataFrame:
    """rows with codes and residuals as bytes."""
    shared = rows.sparkSession.sparkContext.broadcast(quantizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, residuals = shared.value.encode(matrix(batch.column("v"))) if batch.num_rows else ((), ())
            more = [pa.array([c.tobytes() for c in x], pa.binary()) for x in (codes, residuals)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, "codes", "residuals"])

    return rows.mapInArrow(run, ", ".join(f"{n} {k}" for n, k in rows.dtypes) + ", codes binary, residuals binary")


def stored(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    """A column of equally long bytes as rows of numbers."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


class Tile:
    """A block of rows, and what it gives for the windows of a block of anchors."""

    def __init__(self, quantizer: Quantizer, rows: pa.Table):
        self.quantizer = quantizer
        self.vec, label, self.h, self.nth = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("vec", "label", "h", "nth"))
        names, self.label = np.unique(label.astype(str), return_inverse=True)
        self.number = {x: i for i, x in enumerate(names.tolist())}
        self.v, self.codes, self.residuals = matrix(rows.column("v")), stored(rows.column("codes"), np.uint8), stored(rows.column("residuals"), np.float32)

    def first(self, y: np.ndarray, score: np.ndarray, error: np.ndarray, fits: np.ndarray, low: float, high: float, most: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows, exact scores) of the `most` highest scores in [low, high] among rows that fit, by (-score, id)."""
        below, above = score - error, score + error
        surely = below[fits & (below >= low) & (above <= high)]
        least = np.partition(surely, len(surely) - most)[len(surely) - most] if len(surely) >= most else -np.inf
        near = np.nonzero(fits & (above >= max(low, least)) & (below <= high))[0]
        products = exact(np.broadcast_to(y, (len(near), len(y))), self.v[near])
        inside = (products >= low) & (products <= high)
        near, products = near[inside], products[inside]
        order = np.lexsort((self.vec[near], -products))[:most]
        return near[order], products[order]

    def search(self, asks: pa.Table, windows: bool, most: int) -> list[tuple]:
        """(anchor, window, vec, score): without windows the rows of the anchor's label but itself, with them rows of other labels, for each window."""
        out = []
        y, name, label, vec, h = matrix(asks.column("v")), *(asks.column(c).to_numpy(zero_copy_only=False) for c in ("anchor", "label", "vec", "h"))
        bounds = asks.column("bounds").to_pylist() if windows else None
        step = max(1, SCORES // max(1, len(self.vec)))
        for at in range(0, len(y), step):
            part = range(at, min(at + step, len(y)))
            scores, errors = self.quantizer.scores(y[part.start : part.stop], self.codes, self.residuals)
            for i, score, error in zip(part, scores, errors, strict=True):
                same = self.label == self.number.get(label[i], -1)
                if windows:
                    asked = [(b["place"], b["low"], b["high"], ~same) for b in bounds[i]]
                else:
                    own = (self.vec == vec[i]) & (self.h == h[i]) & (self.nth == 1)
                    asked = [(0, -math.inf, math.inf, same & ~own)]
                for place, low, high, fits in asked:
                    rows, products = self.first(y[i], score, error, fits, low, high, most)
                    out += [(int(name[i]), place, int(self.vec[j]), int(p)) for j, p in zip(rows.tolist(), products.tolist(), strict=True)]
        return out


def met_in_tiles(asks: DataFrame, rows: DataFrame, quantizer: Quantizer, row_tiles: int, ask_tiles: int, windows: bool, most: int) -> DataFrame:
    """(anchor, place, vec, score) of each tile's best."""
    shared = rows.sparkSession.sparkContext.broadcast(quantizer)

    def part(column: str, n: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(SEED), column), F.lit(n)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def run(key: tuple, asks: pa.Table, rows: pa.Table) -> pa.Table:
        found = Tile(shared.value, rows).search(asks, windows, most) if asks.num_rows and rows.num_rows else []
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
        return pa.table([pa.array(c, k) for c, k in zip(list(zip(*found, strict=True)) or [[]] * 4, kinds, strict=True)], names=["anchor", "place", "vec", "score"])

    a = asks.withColumn("c", part("anchor", ask_tiles)).withColumn("r", every(row_tiles))
    b = rows.withColumn("r", part("row", row_tiles)).withColumn("c", every(ask_tiles))
    return a.groupBy("r", "c").cogroup(b.groupBy("r", "c")).applyInArrow(run, "anchor long, place int, vec long, score long")


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, least_percent: int = 80, scale: int = 256, id: str = "vec_id", vector: str = "embedding", label: str = "label", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): hard negatives of each anchor and positive.

    Anchors are the rows that is_anchor (a column over `vec`, the id) admits, positives their first rows of the same label, by falling integer
    product of vectors and then by id; negatives the first rows of other labels whose score is at most the positive's and at least
    least_percent of it. Rows without id, label or vector, with null or non-finite components, or of another length than most take no
    part. Every row but the anchor's own is met, also those alike in all; anchors alike in id, label and vector are one, and its second copy is
    a positive. No other columns are read. Products must fit in 64 bits.
    """
    spark = vectors.sparkSession
    all_rows = cut_lineage(usable(vectors, id, vector, label, scale).withColumn("h", F.xxhash64("v", "label")))
    # Of rows with one vector and label only the smallest ids can be listed.
    place = F.row_number().over(Window.partitionBy("h", "v", "label").orderBy("vec"))
    few = all_rows.withColumn("place", place).where(F.col("place") <= max(positives + 1, negatives))
    few = few.withColumn("nth", F.row_number().over(Window.partitionBy("h", "v", "label", "vec").orderBy("place"))).drop("place")
    few = cut_lineage(few.withColumn("row", F.monotonically_increasing_id()))
    anchors = cut_lineage(all_rows.where(is_anchor).dropDuplicates(["vec", "h", "label", "v"]).withColumn("anchor", F.monotonically_increasing_id()))
    release(all_rows)
    n, asked = few.count(), anchors.count()
    if not n or not asked:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    sample = matrix(few.orderBy(F.xxhash64(F.lit(SEED), "h", "vec"), "row").limit(sample_rows).select("v").toArrow().column("v"))
    quantizer = Quantizer(sample)
    rows = cut_lineage(coded(few, quantizer))
    release(few)
    tiles = (math.ceil(n / TILE_ROWS), math.ceil(asked / TILE_ROWS))

    def best(found: DataFrame, most: int) -> DataFrame:
        order = F.row_number().over(Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "vec"))
        return found.withColumn("at", order).where(F.col("at") <= most)

    chosen = cut_lineage(best(met_in_tiles(anchors, rows, quantizer, *tiles, False, positives), positives).select("anchor", F.col("at").alias("place"), F.col("vec").alias("positive_id"), F.col("score").alias("positive_score")))
    # A window is empty below zero.
    low = F.expr(f"(positive_score * {int(least_percent)} + 99) div 100")
    bounds = chosen.where("positive_score >= 0").groupBy("anchor").agg(F.collect_list(F.struct("place", low.alias("low"), F.col("positive_score").alias("high"))).alias("bounds"))
    mined = cut_lineage(best(met_in_tiles(anchors.join(bounds, "anchor"), rows, quantizer, *tiles, True, negatives), negatives))
    release(rows)
    out = mined.select("anchor", "place", F.col("at").alias("rank"), F.col("vec").alias("negative_id"), F.col("score").alias("negative_score"))
    named = out.join(chosen, ["anchor", "place"]).join(anchors.select("anchor", F.col("vec").alias("anchor_id")), "anchor")
    return named.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
