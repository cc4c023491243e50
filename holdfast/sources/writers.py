"""Writers of tables and models."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).parquet(path)


def write_table(df: DataFrame, format: str, path: str, mode: str = "errorifexists", single_file: bool = False) -> None:
    """Any format, with a header where the format has one; single_file is for small results."""
    (df.coalesce(1) if single_file else df).write.format(format).mode(mode).option("header", True).save(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)
