"""Summaries that are merged instead of counted anew: distinct counts (HyperLogLog) and quantiles (KLL) by day or any other key.

A sketch table is a few kilobytes a key and is kept; a longer span, a coarser key or a day that arrives later is a merge of its rows, which
reads no events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Registers of a distinct sketch (as a power of two), and three standard errors of its count, 1.04 / sqrt(2 ** 12) each.
LG_K, COUNT_ERROR = 12, 0.05
#: Size of a quantile sketch, and the error of a rank that 99 percent of its answers keep.
K, RANK_ERROR = 200, 0.0165


def sketched(rows: DataFrame, by: list[str], distinct: str, value: str) -> DataFrame:
    """(by..., rows, hll, kll): a sketch of the distinct non-null values of one column and of the distribution of another for each key."""
    return rows.groupBy(*by).agg(F.count("*").alias("rows"), F.hll_sketch_agg(distinct, LG_K).alias("hll"), F.kll_sketch_agg_double(F.col(value).cast("double"), K).alias("kll"))


def merged(sketches: DataFrame, by: list[str]) -> DataFrame:
    """Sketches of coarser keys, or of tables put together, in the same form; merging is associative, so that it can be done in any steps."""
    return sketches.groupBy(*by).agg(F.sum("rows").alias("rows"), F.hll_union_agg("hll").alias("hll"), F.kll_merge_agg_double("kll").alias("kll"))


def rolled_up(sketches: DataFrame, by: list[str]) -> DataFrame:
    """(by..., rows, distinct, median): what merged sketches say."""
    m = merged(sketches, by)
    return m.select(*by, "rows", F.hll_sketch_estimate("hll").alias("distinct"), F.kll_sketch_get_quantile_double("kll", F.lit(0.5)).alias("median"))
