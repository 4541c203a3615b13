"""Pairs of rows, made in tiles: rows are dealt to blocks, each two blocks meet in one group, and what a tile makes of its pairs leaves it in batches."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Blocks where rows are few, rows of a block at least, and tasks at most.
LEAST_BLOCKS, LEAST_ROWS, MOST_TASKS = 6, 64, 4_096


def blocks_of(rows: DataFrame, by: list[str], tile: int) -> tuple[int, int]:
    """Blocks for each by, so that none holds many more than `tile` rows, and the number of bys."""
    met = rows.groupBy(*by).count().agg(F.max("count").alias("most"), F.count("*").alias("groups")).first()
    most = met["most"] or 0
    return max(math.ceil(most / tile), min(LEAST_BLOCKS, most // LEAST_ROWS), 1), met["groups"]


def block(key: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def tiled(rows: DataFrame, by: list[str], key: str, tile: int) -> DataFrame:
    """rows copied to the tiles (by..., _i, _j), _i <= _j, of their block and every other, and dealt to tasks; _second tells the rows of _j from those of _i where these differ.

    What moves grows with rows times blocks. The tiles of a by hold each two of its rows once.
    """
    blocks, groups = blocks_of(rows, by, tile)
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, min(groups * blocks * (blocks + 1) // 2, MOST_TASKS))
    own = block(key, blocks)
    meets = F.transform(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda n: F.struct(F.least(own, n).alias("_i"), F.greatest(own, n).alias("_j"), (n < own).alias("_second")))
    return rows.select("*", F.inline(meets)).repartition(tasks, *by, "_i", "_j")


def ends(tile: pa.Table) -> tuple[pa.Table, pa.Table, bool]:
    """The rows of either block of a tile, and whether both are the same."""
    second = tile.column("_second")
    if not pc.any(second).as_py():
        same = tile.num_rows == 0 or tile.column("_i")[0] == tile.column("_j")[0]
        return tile, tile if same else tile.slice(0, 0), same
    return tile.filter(pc.invert(second)), tile.filter(second), False


def ranks(keys: pa.ChunkedArray) -> np.ndarray:
    """Places of distinct keys in order."""
    out = np.empty(len(keys), np.int64)
    out[pc.sort_indices(keys).to_numpy()] = np.arange(len(keys))
    return out


def flat(column: pa.ChunkedArray) -> np.ndarray | pa.Array:
    """All values of a column of lists, one after another."""
    return pc.list_flatten(column.combine_chunks())
