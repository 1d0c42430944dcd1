"""The registered queries over the driver's tables, each with its DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
FLAGSHIP = "agg02_quartiles_by_group"


def query(name: str, oracle: str | None = None):
    """Register a function of (spark, sf_dir) under `name`, with its SQL."""

    def add(f):
        QUERIES[name] = f
        if oracle:
            ORACLE_SQL[name] = oracle
        return f

    return add
