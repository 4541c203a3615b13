"""Operations of a training-data pipeline. Nothing outside this package imports it."""

from __future__ import annotations


def queries() -> dict:
    import corpus_pipeline

    from .digests import QUERIES

    return {**QUERIES, "pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    from .oracles import ORACLES

    return dict(ORACLES)
