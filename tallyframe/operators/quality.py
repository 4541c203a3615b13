"""Declarative validation and profiling: one pass for each table, violations as rows."""

from __future__ import annotations

from functools import reduce

import uuid

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tallyframe.sources.shared import delete
from tallyframe.sources.tables import ColumnSpec, TableSpec

DATE_RULE = r"^(18[5-9]\d|19\d\d|20\d\d|2100)-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])$"


def broken(column: ColumnSpec) -> Column:
    """The rule that a text cell breaks, or null. Empty cells break only `required`."""
    c = F.col(column.name)
    empty = c.isNull() | (c == "")
    rule = {
        "date": ~c.rlike(DATE_RULE),
        "integer": ~c.rlike(r"^-?\d+$"),
        "number": c.try_cast("double").isNull(),
        "boolean": ~c.isin("true", "false"),
        "enum": ~c.isin(*column.values) if column.values else F.lit(False),
    }.get(column.kind, F.lit(False))
    missing = F.when(empty, F.lit("required")) if column.required else F.when(empty, F.lit(None).cast("string"))
    return missing.when(rule, F.lit(column.kind))


def type_violations(rows: DataFrame, spec: TableSpec, row: str) -> DataFrame:
    """(row, column, rule, value) for every cell that breaks its column's rule; rows are read once."""
    cells = F.array(*[F.struct(F.lit(c.name).alias("column"), broken(c).alias("rule"), F.col(c.name).alias("value")) for c in spec.columns])
    return rows.select(F.col(row).alias("row"), F.inline(F.filter(cells, lambda x: x["rule"].isNotNull())))


def duplicate_keys(rows: DataFrame, key: list[str]) -> DataFrame:
    return rows.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def missing_references(rows: DataFrame, column: str, universe: DataFrame, target: str) -> DataFrame:
    """(value, n): values, and parts of ';'-lists, that the universe lacks. Empty ones refer to nothing."""
    parts = rows.select(F.explode(F.split(F.col(column), ";")).alias("value")).where("value <> ''")
    return parts.groupBy("value").agg(F.count("*").alias("n")).join(universe.select(F.col(target).cast("string").alias("value")).distinct(), "value", "left_anti")


def fill_rates(rows: DataFrame) -> DataFrame:
    """(column, filled, rate): non-blank cells of each column, in one pass."""
    counted = rows.agg(F.count("*").alias("_n"), *[F.count(F.when(F.trim(F.col(c).cast("string")) != "", 1)).alias(c) for c in rows.columns])
    return counted.unpivot("_n", rows.columns, "column", "filled").select("column", "filled", F.round(F.try_divide(F.col("filled").cast("double"), F.col("_n")), 6).alias("rate"))


def value_distribution(rows: DataFrame, columns: list[str], most: int = 25) -> DataFrame:
    """(column, value, n) for columns of at most `most` distinct values; blanks are left out."""
    long = rows.select(*[F.col(c).cast("string") for c in columns]).unpivot([], columns, "column", "value").where("trim(value) <> ''")
    n = long.groupBy("column", "value").agg(F.count("*").alias("n"))
    return n.withColumn("k", F.count("*").over(Window.partitionBy("column"))).where(F.col("k") <= most).drop("k")


def summary(checks: dict[str, tuple[str, DataFrame]]) -> DataFrame:
    """(check, severity, findings) of named checks, each with a severity and its findings."""
    return reduce(DataFrame.unionByName, [df.agg(F.count("*").alias("findings")).select(F.lit(n).alias("check"), F.lit(s).alias("severity"), "findings") for n, (s, df) in checks.items()])


def unequal_lists(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """(key, n_a, n_b): keys whose lists in a and b, one row an entry, differ in length; a missing list has length 0."""
    n = a.groupBy(key).agg(F.count("*").alias("n_a")).join(b.groupBy(key).agg(F.count("*").alias("n_b")), key, "full")
    return n.select(key, F.coalesce("n_a", F.lit(0)).alias("n_a"), F.coalesce("n_b", F.lit(0)).alias("n_b")).where("n_a <> n_b")


def joined_lists(a: DataFrame, b: DataFrame, key: str, slot: str) -> DataFrame:
    """a and b joined by key and place in the list, which go from 1 without gaps. Lists of a key that differ in length are an error when the rows are read."""
    both = a.withColumn("_a", F.lit(True)).join(b.withColumn("_b", F.lit(True)), [key, slot], "full")
    whole = F.when(F.col("_a") & F.col("_b"), F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("lists differ in length: "), F.col(key).cast("string"))).cast("boolean"))
    return both.where(whole).drop("_a", "_b")


class CheckFailed(ValueError):
    """A check of error severity found rows; nothing was committed. findings: by check."""

    def __init__(self, findings: dict[str, int]):
        super().__init__(", ".join(f"{k}: {n}" for k, n in findings.items()))
        self.findings = findings


def checked_write(df: DataFrame, path: str, checks: dict[str, tuple[str, Column]]) -> DataFrame:
    """Write df as Parquet under path if no row breaks a check of severity 'error', and return (check, severity, findings).

    checks: name to severity ('error' or 'warn') and a column that is true where a row breaks it. They are counted by the job that writes, which reads
    df once: rows go to a folder beside path that takes its place when the counts are known, and is deleted if one forbids it. An earlier table under path is replaced
    only then. Counts are those of the tasks that Spark accepts; a task that runs twice may count twice, which can only raise a finding.
    """
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    names = {name: f"c{i}" for i, name in enumerate(checks)}
    seen = Observation()
    observed = df.observe(seen, F.count("*").alias("rows"), *[F.count_if(F.coalesce(broken_if, F.lit(False))).alias(names[n]) for n, (_, broken_if) in checks.items()])
    staged = f"{path.rstrip('/')}.{uuid.uuid4().hex}.staged"
    observed.write.parquet(staged)
    counts = seen.get
    errors = {n: counts[names[n]] for n, (severity, _) in checks.items() if severity == "error" and counts[names[n]]}
    if errors:
        delete(spark.sparkContext, staged)
        raise CheckFailed(errors)
    source, target = (jvm.org.apache.hadoop.fs.Path(p) for p in (staged, path))
    delete(spark.sparkContext, path)
    if not source.getFileSystem(conf).rename(source, target):
        raise OSError(f"{staged} could not become {path}")
    return spark.createDataFrame([(n, severity, counts[names[n]]) for n, (severity, _) in checks.items()] + [("rows written", "info", counts["rows"])], "check string, severity string, findings long")
