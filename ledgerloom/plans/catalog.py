"""Named queries and the SQL each can be checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import documents, evaluation, filings, finance, issuers, sources, texts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
for _part in (finance, evaluation, sources, texts, filings, documents, issuers):
    QUERIES |= _part.QUERIES
    ORACLE_SQL |= _part.ORACLE_SQL
