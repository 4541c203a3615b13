"""Helpers that the corpus operators share."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.sources.shared import reliable, release  # noqa: F401
from tallyframe.sources.tables import spread  # noqa: F401

#: Rows that are turned into Python strings at once; keeps a worker's memory low on long texts.
SLICE_ROWS = 256


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut_lineage(df: DataFrame) -> DataFrame:
    """df, materialised in the shared checkpoint folder (spark.checkpoint.dir). It is deleted by release(), or when Python ends."""
    return reliable(df)


#: Sizes from here on are the optimizer's stand-in for one that it does not know.
UNKNOWN_BYTES = 1 << 50


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of df's size or, where it has none, the length of its texts. It only sizes partitions, never decides a result."""
    guess = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if guess < UNKNOWN_BYTES:
        return guess
    texts = [F.coalesce(F.octet_length(f"`{c}`"), F.lit(0)) for c, kind in df.dtypes if kind == "string"]
    each = sum(texts, F.lit(16)).cast("long")
    return df.agg(F.coalesce(F.sum(each), F.lit(0))).first()[0]


def partitions_for(df: DataFrame, bytes_each: int) -> int:
    """Enough partitions for df's estimated size, and no fewer than the session's shuffle partitions."""
    floor = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(floor, math.ceil(estimated_bytes(df) / bytes_each))


def map_slices(df: DataFrame, fn: Callable[[Iterator[list[list]]], Iterator[list[list]]], schema: str, rows: int = SLICE_ROWS) -> DataFrame:
    """mapInArrow over slices of a few rows.

    fn gets an iterator over slices, each a list of Python columns, and yields lists of result columns.
    """
    target = _arrow_schema(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def slices() -> Iterator[list[list]]:
            for batch in batches:
                for at in range(0, batch.num_rows, rows):
                    part = batch.slice(at, rows)
                    yield [part.column(i).to_pylist() for i in range(part.num_columns)]

        for columns in fn(slices()):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, target, strict=True)], schema=target)

    return df.mapInArrow(run, schema)


def _arrow_schema(spark: SparkSession, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def crc_bucket(column: str, modulus: int):
    """crc32 of an id written as text, modulo; a null id falls in no bucket (null)."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % F.lit(modulus)


def smallest_by_hash(ids: DataFrame, column: str, most: int, seed: int) -> DataFrame:
    """At most `most` ids, those with the smallest hashes: a uniform sample that does not depend on partitioning."""
    return ids.select(column).where(F.col(column).isNotNull()).distinct().orderBy(F.xxhash64(F.lit(seed), F.col(column)), F.col(column)).limit(most)


def with_columns_of(df: DataFrame, columns: list[str]) -> DataFrame:
    """df without columns that a result will bring under the same name (case-insensitive, as Spark resolves them)."""
    names = {c.lower() for c in columns}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in names])


#: Bytes as words of [0-9a-z] and what lies beyond ASCII have them: A-Z become a-z, all else becomes a space.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
#: Bytes of a text whose words are held at once, about.
PIECE_BYTES = 1 << 20


def word_pieces(text: str | None, piece: int = PIECE_BYTES) -> Iterator[list[bytes]]:
    """The words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of a text with A-Z lower-cased, as UTF-8, some at a time; none of null."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(WORD_BYTES)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + piece)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end
