"""Registry of the study queries: Spark builder plus DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}
DOC: dict[str, str] = {}


def register(qid: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``qid``; ``sql`` is
    its full DuckDB oracle (views included), or None when not expressible."""
    def deco(fn: QueryFn) -> QueryFn:
        if qid in QUERIES:
            raise ValueError(f"duplicate query id {qid}")
        QUERIES[qid] = fn
        DOC[qid] = (fn.__doc__ or "").strip()
        if sql is not None:
            ORACLE[qid] = sql
        return fn
    return deco
