"""Shards along a Hilbert curve.

Several metadata dimensions are quantised to a grid, each row gets the index of its cell on a Hilbert curve, rows
are sorted by that index and the order is cut into runs. Rows of a shard are close in all dimensions, so that
file statistics prune on any of them. Equal texts take the metadata of their first document, so they stand side by
side and can be parted only where a run ends.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, estimated_bytes, partitions_for, with_columns_of

#: Bits of each dimension on the grid.
BITS = 6
SHARDS = 40
#: What a row takes besides its text.
ROW_BYTES = 16
#: Narrow bytes in one sorted partition.
PARTITION_BYTES = 64 << 20


def hilbert_index(points: np.ndarray, bits: int) -> np.ndarray:
    """Indexes on the Hilbert curve of integer points (rows) in [0, 2**bits) per dimension, by Gray-code transposition."""
    x = points.astype(np.int64).T.copy()
    dims = len(x)
    m = 1 << (bits - 1)
    q = m
    while q > 1:
        p = q - 1
        for i in range(dims):
            hit = (x[i] & q) != 0
            t = np.where(hit, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(hit, x[0] ^ p, x[0] ^ t)
            if i:
                x[i] ^= t
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    t = np.zeros(x.shape[1], np.int64)
    q = m
    while q > 1:
        t = np.where((x[-1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    index = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            index = index << 1 | (x[i] >> b & 1)
    return index


def curve_column(cells: list[Column], bits: int = BITS) -> Column:
    """The Hilbert index of the cells, integer columns in [0, 2**bits)."""

    @F.pandas_udf("long")
    def index(frame: pd.DataFrame) -> pd.Series:
        return pd.Series(hilbert_index(frame.to_numpy(), bits))

    return index(F.struct(*[c.cast("int").alias(f"c{i}") for i, c in enumerate(cells)]))


def log_cell(size: Column, bits: int = BITS) -> Column:
    """Four steps for each doubling of a size, so that neighbours on the grid differ by a ratio."""
    return F.least(F.floor(F.log2(size.cast("double") + 1) * 4), F.lit((1 << bits) - 1))


def hash_cell(value: Column, bits: int = BITS) -> Column:
    """A cell for a value without order; null has cell 0 and is told apart from text by it only."""
    return F.when(value.isNull(), 0).otherwise(F.pmod(F.xxhash64(value), F.lit((1 << bits) - 1)) + 1)


def assign_shards(docs: DataFrame, shards: int = SHARDS, text: str = "text", id: str = "doc_id", dims: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """One row for each row of docs: its id, size, text_crc32, curve (the Hilbert index), law 'rows', shard, slot.

    Dimensions are the size of the text and the named columns of docs, as far as docs has them. A null text has
    size ROW_BYTES and the checksum of no bytes. Rows are ranked by (curve, text hash, checksum, size, id); shard
    counts differ by one at most, and slots run gapless from 0. Rows alike in all of these are interchangeable.

    Texts never shuffle: only ids, sizes and hashes do. The ranks come from a range-partitioned sort, the row
    counts of its partitions (one number each) and each row's place in its partition; hot texts and sources
    are split by the range partitioner, since the sort key ends in the id.
    """
    have = {c.lower() for c in docs.columns}
    dims = tuple(d for d in dims if d.lower() in have)
    raw = F.coalesce(F.col(text), F.lit(""))
    narrow = docs.select(
        F.col(id).alias("doc"),
        (F.octet_length(raw) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(raw.cast("binary")).alias("text_crc32"),
        F.xxhash64(raw).alias("text_hash"),
        *[hash_cell(F.col(d)).cast("int").alias(f"dim{i}") for i, d in enumerate(dims)],
    )
    base = cut_lineage(narrow)
    # Copies of a text follow the metadata of their first document. Texts that occur once are told by the count and need no join.
    first = base.groupBy("text_hash", "size", "text_crc32").agg(F.count("*").alias("copies"), *[F.min(F.struct("doc", f"dim{i}"))[f"dim{i}"].alias(f"first{i}") for i in range(len(dims))])
    moved = cut_lineage(first.where("copies > 1").drop("copies"))
    keyed = base.join(moved, ["text_hash", "size", "text_crc32"], "left") if dims else base
    cells = [log_cell(F.col("size")), *[F.coalesce(F.col(f"first{i}"), F.col(f"dim{i}")) if dims else F.col(f"dim{i}") for i in range(len(dims))]]
    ranked = keyed.select("doc", "size", "text_crc32", "text_hash", curve_column(cells).alias("curve"))
    key = ["curve", "text_hash", "text_crc32", "size", "doc"]
    parts = partitions_for(base, PARTITION_BYTES)
    # Written before and after the sort: the range partitioner samples the first, and a lost task reads the second again as it was.
    laid = cut_lineage(cut_lineage(ranked).repartitionByRange(parts, *key).sortWithinPartitions(*key))
    counts = {r[0]: r[1] for r in laid.groupBy(F.spark_partition_id().alias("p")).count().collect()}
    starts, total = [], 0
    for p in range(max(counts, default=-1) + 1):
        starts.append(total)
        total += counts.get(p, 0)
    start = F.element_at(F.array(*[F.lit(s).cast("long") for s in starts or [0]]), F.spark_partition_id() + 1)
    small, more = divmod(total, shards)
    edge = more * (small + 1)
    rank = F.col("place")
    shard = F.when(rank < edge, F.floor(rank / (small + 1))).otherwise(more + F.floor((rank - edge) / max(small, 1))).cast("int")
    begin = F.when(F.col("shard") <= more, F.col("shard").cast("long") * (small + 1)).otherwise(edge + (F.col("shard") - more).cast("long") * small)
    return (
        laid.withColumn("place", start + F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
        .withColumn("shard", shard)
        .select(F.col("doc").alias(id), "size", "text_crc32", "curve", F.lit("rows").alias("law"), "shard", (rank - begin).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
    )


def write_shards(docs: DataFrame, assigned: DataFrame, path: str, id: str = "doc_id") -> None:
    """Write docs as Parquet, a folder for each shard, rows in curve order. Ids must be unique."""
    joined = with_columns_of(docs, ["shard", "slot"]).join(assigned.select(id, "shard", "slot"), id)
    parts = max(1, estimated_bytes(docs) // PARTITION_BYTES)
    joined.repartitionByRange(int(parts), "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
