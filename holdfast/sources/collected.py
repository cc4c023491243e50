"""What leaves Spark for the driver, and comes back: only what is known to be small."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession

MOST_ROWS = 100_000


def bounded(df: DataFrame, most: int = MOST_ROWS, what: str = "rows") -> list[Row]:
    """All rows of df; an error if there are more than `most`, of which one is fetched."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} {what} for the driver")
    return rows


def collect_map(df: DataFrame, key: str, value: str, most: int = MOST_ROWS) -> dict:
    """key -> value; of a repeated key any value."""
    return {r[0]: r[1] for r in bounded(df.select(key, value), most, f"values of {key}")}


def to_pandas(df: DataFrame, most: int = MOST_ROWS) -> pd.DataFrame:
    """df on the driver, by Arrow; an error if it has more than `most` rows."""
    found = df.limit(most + 1).toPandas()
    if len(found) > most:
        raise ValueError(f"more than {most} rows for the driver")
    return found


def from_pandas(spark: SparkSession, table: pd.DataFrame, schema: str | None = None) -> DataFrame:
    return spark.createDataFrame(table, schema)
