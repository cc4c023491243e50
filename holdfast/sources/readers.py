"""Readers of register, holdings and model files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..specs import ExtractSpec


def read_headerless(spark: SparkSession, path: str, names: Sequence[str], sep: str = "\t") -> DataFrame:
    """Delimited text without a header; every column is a string."""
    return spark.read.csv(path, schema=", ".join(f"`{n}` string" for n in names), sep=sep, header=False)


def read_table(spark: SparkSession, path: str | Sequence[str], format: str = "parquet", schema: str | None = None) -> DataFrame:
    """CSV with a header (strings, unless a schema is given), JSON lines, Parquet or any other format Spark reads."""
    reader = spark.read.format(format)
    if format == "csv":
        reader = reader.option("header", True).option("inferSchema", False)
    if schema:
        reader = reader.schema(schema)
    return reader.load(list(path) if not isinstance(path, str) else path)


def read_delimited(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Delimited text whose header line may come again further down; all its occurrences are taken out."""
    df = spark.read.csv(path, sep=sep, header=True, inferSchema=False)
    again = None
    for c in df.columns:
        same = F.col(f"`{c}`").eqNullSafe(F.lit(c))
        again = same if again is None else again & same
    return df if again is None else df.where(~again)


def list_files(spark: SparkSession, folder: str, extension: str) -> DataFrame:
    """The paths (column path) of the folder's files of that extension; contents are not read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", f"*.{extension.lstrip('.')}").load(folder).select("path")


def read_csv_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """CSV files of equal columns, one below the other."""
    return read_table(spark, paths, "csv")


def extract(df: DataFrame, spec: ExtractSpec) -> DataFrame:
    """Cast, filter, select, drop, rename and deduplicate, in that order."""
    if spec.cast:
        df = df.withColumns({c: F.col(c).try_cast(t) for c, t in spec.cast.items()})
    for c, values in spec.isin.items():
        df = df.where(F.col(c).isin(values))
    if spec.select:
        df = df.select(*spec.select)
    df = df.drop(*spec.drop).withColumnsRenamed(spec.rename)
    return df.distinct() if spec.distinct else df


def read_extract(spark: SparkSession, spec: ExtractSpec) -> DataFrame:
    return extract(read_table(spark, spec.path, spec.format, spec.schema), spec)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
