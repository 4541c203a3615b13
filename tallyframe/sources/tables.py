"""Reading tables and the cell rules at the edges: empty text is null inside, null is empty text in a CSV file."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = {"string": T.StringType(), "integer": T.LongType(), "number": T.DoubleType(), "date": T.DateType(), "boolean": T.BooleanType(), "enum": T.StringType()}


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    kind: str = "string"
    required: bool = False
    unique: bool = False
    values: tuple[str, ...] = ()
    references: str = ""
    description: str = ""


@dataclass(frozen=True)
class TableSpec:
    """A declared table: the single source of its schema, constraints and documentation."""

    name: str
    columns: tuple[ColumnSpec, ...]
    primary_key: tuple[str, ...]
    unit: str = ""
    notes: str = ""
    intervals: tuple[tuple[str, str], ...] = field(default=())

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, KINDS[c.kind], not c.required, {"values": list(c.values), "references": c.references, "unique": c.unique, "description": c.description}) for c in self.columns])

    def text_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, T.StringType()) for c in self.columns])


def load(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


#: Bytes of input (by the optimizer's estimate) that a task of a costly narrow pass has at least.
SPREAD_BYTES = 512 << 10
#: A table with fewer bytes for each core is dealt anew in any case.
SMALL_BYTES = 4 << 20


def spread(df: DataFrame) -> DataFrame:
    """df, dealt anew if a scan of it would leave cores idle, as that of one small file does; larger tables and results of shuffles come as they are."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    if "Exchange" in plan or "AdaptiveSparkPlan" in plan or "Scan" not in plan:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    wanted = min(cores, math.ceil(size / SPREAD_BYTES))
    # A file is split by bytes, but a row group is read by one task: of a small table's tasks most may be empty.
    idle = size < cores * SMALL_BYTES or df.rdd.getNumPartitions() < wanted
    return df.repartition(wanted) if wanted > 1 and idle else df


def read_csv(spark: SparkSession, path: str, spec: TableSpec, strict: bool = False, typed: bool = False) -> DataFrame:
    """A CSV table as text columns (or typed ones). A missing file is an empty table, unless strict."""
    try:
        df = spark.read.schema(spec.text_schema()).csv(path, header=True, multiLine=True, escape='"', nullValue="", emptyValue="", enforceSchema=False)
    except AnalysisException as e:
        if strict or "PATH_NOT_FOUND" not in str(e):
            raise
        df = spark.createDataFrame([], spec.text_schema())
    return df.select(*[F.expr(f"try_cast(`{c.name}` AS {KINDS[c.kind].simpleString()})").alias(c.name) for c in spec.columns]) if typed else df


def render_cell(value: Column, kind: T.DataType) -> Column:
    """How a value stands in a CSV cell: null and false are empty, arrays joined by ';', floats with six digits, line breaks as spaces."""
    if isinstance(kind, T.BooleanType):
        out = F.when(value, "true")
    elif isinstance(kind, T.ArrayType):
        out = F.array_join(F.filter(F.transform(value, lambda x: x.cast("string")), lambda x: x.isNotNull() & (x != "")), ";")
    elif isinstance(kind, (T.DoubleType, T.FloatType)):
        out = general_digits(value.cast("double"))
    else:
        out = value.cast("string")
    text = F.coalesce(out, F.lit(""))
    return F.when(text.rlike(r"[\r\n]"), F.trim(F.regexp_replace(text, r"\s+", " "))).otherwise(text)


def general_digits(value: Column, digits: int = 6) -> Column:
    """Like C's %.6g: six significant digits without trailing zeros, exponents outside 1e-4 to 1e6."""
    exponent = F.when(value == 0, 0).otherwise(F.floor(F.log10(F.abs(value))).cast("int"))
    # Rounding may carry into a further digit.
    lifted = F.regexp_extract(F.format_string(f"%.{digits - 1}e", value), r"e([+-]\d+)$", 1).cast("int")
    exponent = F.coalesce(lifted, exponent)
    fixed = F.element_at(F.array(*[F.format_string(f"%.{d}f", value) for d in range(digits + 5)]), F.greatest(F.least(digits - exponent, F.lit(digits + 5)), F.lit(1)))
    trimmed = F.when(fixed.contains("."), F.regexp_replace(F.regexp_replace(fixed, r"0+$", ""), r"\.$", "")).otherwise(fixed)
    mantissa = F.regexp_replace(F.regexp_replace(F.regexp_extract(F.format_string(f"%.{digits - 1}e", value), r"^([^e]*)e", 1), r"0+$", ""), r"\.$", "")
    power = F.regexp_extract(F.format_string(f"%.{digits - 1}e", value), r"(e[+-]\d+)$", 1)
    return F.when(F.isnan(value), "nan").when((exponent < -4) | (exponent >= digits), F.concat(mantissa, power)).otherwise(trimmed)


def write_csv(df: DataFrame, path: str, spec: TableSpec | None = None, columns: list[str] | None = None, extra: str = "error") -> None:
    """Write rendered cells. Missing columns stay empty; those that neither spec nor columns name are an error, or with extra='ignore' left out."""
    names = [c.name for c in spec.columns] if spec else (columns or df.columns)
    if extra == "ignore":
        df = df.select(*[c for c in df.columns if c in names])
    if unknown := sorted(set(df.columns) - set(names)):
        raise KeyError(f"undeclared columns: {', '.join(unknown)}")
    df = df.select(*[render_cell(F.col(c), df.schema[c].dataType).alias(c) if c in df.columns else F.lit("").alias(c) for c in names])
    df.write.mode("overwrite").csv(path, header=True, escape='"', emptyValue="")


def read_staging(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Nested JSON documents with the file that each came from."""
    return spark.read.schema(schema).json(path, multiLine=True).withColumn("staging_file", F.regexp_extract(F.input_file_name(), r"([^/]*)$", 1))


def write_staging(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def project_to(df: DataFrame, names: list[str]) -> DataFrame:
    """The named columns in order; those that df lacks are empty text."""
    return df.select(*[F.coalesce(F.col(n).cast("string"), F.lit("")).alias(n) if n in df.columns else F.lit("").alias(n) for n in names])


def reference_table(spark: SparkSession, spec: TableSpec, rows: list[dict]) -> DataFrame:
    """A table of rows that are written down in the code, in the declared columns and kinds; what a row lacks is null. Undeclared fields are an error."""
    names = [c.name for c in spec.columns]
    if unknown := sorted({k for r in rows for k in r} - set(names)):
        raise KeyError(f"undeclared columns: {', '.join(unknown)}")
    text = spark.createDataFrame([tuple(None if r.get(n) is None else str(r[n]) for n in names) for r in rows], spec.text_schema())
    return text.select(*[F.expr(f"try_cast(`{c.name}` AS {KINDS[c.kind].simpleString()})").alias(c.name) for c in spec.columns])


def content_hash(df: DataFrame) -> Column:
    """An aggregate over all rows of df that does not depend on their order: the sum of the first eight digits of each row's md5, whose cells stand by
    name, numbers with fractions in millionths, nulls as nothing, joined by '|'."""
    cells = [F.coalesce((F.round(F.col(c) * 1_000_000).cast("long") if kind in ("double", "float") else F.col(c)).cast("string"), F.lit("")) for c, kind in sorted(df.dtypes)]
    return F.coalesce(F.sum(F.conv(F.substring(F.md5(F.concat_ws("|", *cells)), 1, 8), 16, 10).cast("long")), F.lit(0))


def write_tables(tables: dict[str, DataFrame], folder: str) -> DataFrame:
    """Write each table as Parquet under the folder and return (table_name, row_count, content) of what was written, by content_hash()."""
    spark = next(iter(tables.values())).sparkSession
    found = []
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
        back = spark.read.parquet(f"{folder}/{name}")
        found.append((name, *back.agg(F.count("*"), content_hash(back)).first()))
    return spark.createDataFrame(found, "table_name string, row_count long, content long")
