"""Codebook and coverage pages: profiles are DataFrames, the page is a thin printer of their few rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.sources.tables import TableSpec

from .quality import fill_rates, value_distribution


def schema_differences(rows: DataFrame, spec: TableSpec) -> list[tuple[str, str]]:
    """(severity, finding): an empty table is a note, missing and undeclared columns are errors."""
    have, want = set(rows.columns), {c.name for c in spec.columns}
    found = [("error", f"{spec.name}: missing column {c}") for c in sorted(want - have)]
    found += [("error", f"{spec.name}: undeclared column {c}") for c in sorted(have - want)]
    return found + ([("note", f"{spec.name}: no rows")] if rows.isEmpty() else [])


def markdown_table(header: list[str], rows: list[tuple]) -> str:
    lines = ["| " + " | ".join(header) + " |", "|" + " --- |" * len(header)]
    return "\n".join([*lines, *("| " + " | ".join(str(x).replace("|", "\\|") for x in r) + " |" for r in rows)])


def codebook(rows: DataFrame, spec: TableSpec) -> str:
    """A page on a table: its columns with kinds and fill rates, and the values of its small vocabularies, most frequent first."""
    rates = {r["column"]: r["rate"] for r in fill_rates(rows).collect()}
    columns = [(c.name, c.kind + (" (required)" if c.required else ""), f"{100 * (rates.get(c.name) or 0):.1f} %", c.references, c.description) for c in spec.columns]
    page = [f"## {spec.name}", spec.unit, markdown_table(["column", "kind", "filled", "refers to", "description"], columns)]
    if listed := [c.name for c in spec.columns if c.kind == "enum"]:
        values = value_distribution(rows, listed).orderBy("column", F.desc("n"), "value").collect()
        page.append(markdown_table(["column", "value", "rows"], [tuple(r) for r in values]))
    return "\n\n".join(filter(None, page)) + "\n"


def coverage(rollup: DataFrame, order: str) -> str:
    return markdown_table(rollup.columns, [tuple(r) for r in rollup.orderBy(order).collect()]) + "\n"


def exit_code(summary: DataFrame) -> int:
    """1 if a check of severity error has findings."""
    return int(not summary.where("severity = 'error' AND findings > 0").isEmpty())


def corresponds(pairs: DataFrame, ratio: str, least: float = 0.3) -> DataFrame:
    """pairs, refused where the mean similarity of matched names is below `least`: two lists that do not belong together."""
    mean = pairs.agg(F.avg(ratio)).first()[0]
    if mean is None or mean < least:
        raise ValueError(f"mean similarity {mean} is below {least}")
    return pairs
