"""The registered queries: each reads whole given tables, with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rivalry.queries import chain, extraction, job, joining, learning, shaping, summaries, windows

MODULES = [windows, joining, chain, shaping, summaries, learning, extraction, job]


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def all_oracles() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.ORACLE.items()}
