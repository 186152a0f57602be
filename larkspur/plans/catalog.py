"""Registered queries of the evaluation operators and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from larkspur.plans import metric_queries, record_queries, text_queries, training_queries

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
for part in (metric_queries, text_queries, record_queries, training_queries):
    QUERIES.update(part.QUERIES)
    ORACLE_SQL.update(part.SQL)
