"""Registered queries, each beside the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import importable

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of a table reader under its name, with its SQL."""

    def add(f):
        def on(spark: SparkSession, sf_dir: str) -> DataFrame:
            importable(spark)
            return f(lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"))

        QUERIES[f.__name__] = on
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def rounded(df: DataFrame, **places: int) -> DataFrame:
    return df.withColumns({c: F.round(c, n) for c, n in places.items()})
