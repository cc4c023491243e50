"""Summaries of a table, each as a DataFrame; rendering is left to the caller."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..sources.collected import bounded
from ..sources.scratch import materialise
from .relational import column_counts


MOST_COLUMNS = 1_000


def shape(df: DataFrame) -> tuple[int, int]:
    return df.count(), len(df.columns)


def missing_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, missing_pct) of the numeric columns, or those given, in one pass."""
    columns = columns or [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    one = df.agg(*(F.avg(F.col(c).isNull().cast("double") * 100).alias(c) for c in columns))
    return one.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).alias("missing_pct")) for c in columns))).alias("r")).select("r.*")


def profile(df: DataFrame, columns: Sequence[str] | None = None, top_n: int = 10) -> DataFrame:
    """Per column: dtype, n_values (null is one), n_null, and each of its top_n values with count and share of the rows in percent.

    All columns are counted in one pass. The window that ranks a column's values
    keeps the top of each task's part only.
    """
    columns = list(columns or df.columns)
    kinds = dict(df.dtypes)
    counts = materialise(column_counts(df, columns), "counts")
    whole = counts.groupBy("column").agg(F.count("*").alias("n_values"), F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("n_null"), F.sum("n").alias("__rows"))
    order = Window.partitionBy("column").orderBy(F.desc("n"), F.col("value").asc_nulls_first())
    top = counts.withColumn("place", F.row_number().over(order)).where(F.col("place") <= top_n)
    kind = F.create_map(*(x for c in columns for x in (F.lit(c), F.lit(kinds[c]))))
    return top.join(whole, "column").select("column", kind[F.col("column")].alias("dtype"), "n_values", "n_null", "place", "value", F.col("n").alias("count"), (F.col("n") / F.col("__rows") * 100).alias("total_pct"))


def frequencies(df: DataFrame, column: str, top_n: int, normalize: bool = False) -> DataFrame:
    """(value, frequency) of the top_n values; normalised by the sum of these, not of all."""
    top = df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("__n")).orderBy(F.desc("__n"), "value").limit(top_n)
    return top.select("value", (F.col("__n") / F.sum("__n").over(Window.partitionBy()) if normalize else F.col("__n").cast("double")).alias("frequency"))


def crosstab(df: DataFrame, rows: str, columns: str) -> DataFrame:
    """Counts of rows against columns, a column per sorted value, 0 where there is none; an error beyond MOST_COLUMNS values."""
    values = sorted(r[0] for r in bounded(df.select(columns).where(F.col(columns).isNotNull()).distinct(), MOST_COLUMNS, f"values of {columns}"))
    return df.groupBy(rows).pivot(columns, values).agg(F.count(F.lit(1))).na.fill(0)


def bars(counts: DataFrame, value: str, width: int = 40, mark: str = "#") -> DataFrame:
    """counts with a column `bar`: as many marks as the value's part of the greatest one, of width."""
    greatest = counts.agg(F.max(value).alias("__greatest"))
    length = F.coalesce(F.round(F.col(value) / F.col("__greatest") * width).cast("int"), F.lit(0))
    return counts.crossJoin(F.broadcast(greatest)).select(*counts.columns, F.repeat(F.lit(mark), length).alias("bar"))  # one row


def text_table(df: DataFrame, most: int = 20, width: int = 40) -> str:
    """The first rows as aligned text, cells cut to a width."""
    rows = [df.columns, *(["" if x is None else str(x)[:width] for x in r] for r in df.limit(most).collect())]
    wide = [max(len(r[i]) for r in rows) for i in range(len(df.columns))]
    return "\n".join(" | ".join(x.ljust(n) for x, n in zip(r, wide)).rstrip() for r in rows)


def coverage(owners: DataFrame, labels: DataFrame, owner: str = "Owner_ID", label: str = "esa") -> DataFrame:
    """matched, total: how many of the owners have a label."""
    flags = owners.select(owner).distinct().join(labels.select(owner, label).dropDuplicates([owner]), owner, "left")
    return flags.agg(F.sum(F.col(label).isNotNull().cast("long")).alias("matched"), F.count("*").alias("total"))


def coverage_by_value(holdings: DataFrame, labels: DataFrame, owner: str = "Owner_ID", value: str = "Value_Held", label: str = "esa") -> DataFrame:
    """(sectorised, value): the value held by owners with and without a label."""
    totals = holdings.groupBy(owner).agg(F.sum(F.col(value).try_cast("double")).alias("value"))
    flagged = totals.join(labels.select(owner, label), owner, "left").withColumn("sectorised", F.col(label).isNotNull().cast("int"))
    return flagged.groupBy("sectorised").agg(F.sum("value").alias("value"))


def estimated_bytes(df: DataFrame, fraction: float = 0.01, seed: int = 0) -> float:
    """About how many bytes the rows take as JSON, from a sample; the whole table where the sample is empty."""
    size = F.sum(F.octet_length(F.to_json(F.struct("*"))))
    sampled = df.sample(False, fraction, seed).agg(size).first()[0]
    return sampled / fraction if sampled else float(df.agg(size).first()[0] or 0)
