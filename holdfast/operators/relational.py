"""Joins, uniqueness, unions, distinct rows and category folding.

Null keys group but never match: they are in neither part of a split, never in a
semi join and always in an anti join.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.collected import bounded
from ..sources.scratch import materialise
from ..specs import JoinSpec

#: Most rare values whose names a label joins.
MOST_NAMES = 100_000


def key_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, mode: str) -> DataFrame:
    """left rows by their match in right: 'inner' multiplies rows as right repeats a key, 'semi' does not, 'outer' keeps those without a match, anything else keeps all."""
    keys = right.select(F.col(right_key).alias("__key"))
    how = {"inner": "inner", "semi": "left_semi", "outer": "left_anti"}.get(mode, "left")
    return left.join(keys, left[left_key] == keys["__key"], how).drop("__key")


def split_unique(df: DataFrame, column: str) -> DataFrame:
    """The rows whose key occurs once, key first.

    One aggregation finds count and row together, combined before the shuffle, so
    a key that a third of the rows share costs a row per task.
    """
    rest = [c for c in df.columns if c != column]
    whole = F.first(F.struct(*rest)) if rest else F.lit(None)
    grouped = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("__n"), whole.alias("__row"))
    return grouped.where("__n = 1").select(column, *(F.col("__row")[c].alias(c) for c in rest))


def split_duplicates(df: DataFrame, column: str) -> DataFrame:
    """The rows whose key occurs more than once, key first, with the key's count."""
    many = df.groupBy(column).agg(F.count("*").alias("__n")).where("__n > 1").withColumnRenamed(column, "__key")
    rest = [c for c in df.columns if c != column]
    return df.join(many, df[column] == many["__key"]).select(column, *rest, F.col("__n").alias("count"))


def join_chain(frames: dict[str, DataFrame], specs: Sequence[JoinSpec]) -> DataFrame:
    """Left joins in the order of the specs; the first spec's keys are not used."""
    return reduce(lambda left, s: left.join(frames[s.name], list(s.keys), "left"), specs[1:], frames[specs[0].name])


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def union_by_position(*frames: DataFrame) -> DataFrame:
    """The columns of the first, whatever the others call theirs."""
    return reduce(DataFrame.union, frames)


def union_filled(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of both by name; columns that one lacks are null there."""
    return a.unionByName(b, allowMissingColumns=True)


def one_row_per(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Of the rows of each key the least, column by column; combined before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    grouped = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("__row"))
    return grouped.select(*(F.col(c) if c in keys else F.col("__row")[c].alias(c) for c in df.columns))


def unique(df: DataFrame, column: str) -> DataFrame:
    """Distinct values, null among them."""
    return df.select(column).distinct()


def nunique(df: DataFrame, column: str) -> DataFrame:
    """n: the number of distinct values, null counted as one."""
    return unique(df, column).agg(F.count("*").alias("n"))


def value_counts(df: DataFrame, column: str, top_n: int | None = None) -> DataFrame:
    counts = df.groupBy(column).agg(F.count("*").alias("count"))
    return counts.orderBy(F.desc("count"), F.col(column)).limit(top_n) if top_n else counts


def column_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n) of all the columns in one pass over df."""
    cells = F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns))
    return df.select(F.explode(cells).alias("cell")).groupBy("cell.column", "cell.value").agg(F.count("*").alias("n"))


def fold_shares(df: DataFrame, columns: Sequence[str], f_min: float, concat: bool = False, min_rare: int = 1) -> tuple[DataFrame, dict[str, list[str]], set[str]]:
    """fold_categories by a share of the rows, each column's values after it (sorted, without null), and the columns that hold nulls.

    At most 1 / f_min values a column are frequent; only these, and the joined names
    where asked for, reach the driver.
    """
    if not columns:
        return df, {}, set()
    counts = column_counts(df, columns).persist()
    sums = counts.groupBy("column").agg(F.sum("n").alias("rows"), F.max(F.col("value").isNull()).alias("nulls")).collect()  # a row to a column
    least = f_min * (sums[0].rows if sums else 0)
    known = counts.where("value is not null")
    often: dict[str, list[str]] = {c: [] for c in columns}
    for r in known.where(F.col("n") >= least).select("column", "value").collect():
        often[r["column"]].append(r.value)
    rare = known.where(F.col("n") < least)
    n_rare = {r["column"]: r.k for r in rare.groupBy("column").agg(F.count("*").alias("k")).collect()}
    folded = [c for c in columns if n_rare.get(c, 0) >= min_rare]
    names = _joined(rare, folded) if concat else {}
    left = {c: [] for c in columns}
    for r in bounded(rare.where(~F.col("column").isin(folded)), MOST_NAMES, "rare values") if set(n_rare) - set(folded) else []:
        left[r["column"]].append(r.value)
    counts.unpersist()
    label = {c: names.get(c, "other") for c in folded}
    out = df.withColumns({c: F.when(F.col(c).isNull() | F.col(c).cast("string").isin(often[c]), F.col(c)).otherwise(F.lit(label[c])) for c in folded}) if folded else df
    values = {c: sorted({*often[c], *left[c], *([label[c]] if c in label else [])}) for c in columns}
    return out.select(*df.columns), values, {r["column"] for r in sums if r.nulls}


def _joined(rare: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """Of each column its rare values, sorted and joined."""
    names: dict[str, list[str]] = {}
    for r in bounded(rare.where(F.col("column").isin(list(columns))).select("column", "value"), MOST_NAMES, "rare values"):
        names.setdefault(r["column"], []).append(r.value)
    return {c: "_".join(sorted(v)) for c, v in names.items()}


def fold_categories(df: DataFrame, columns: Sequence[str], f_min: float, concat: bool = False, min_rare: int = 1) -> DataFrame:
    """Values rarer than f_min (a share of the rows if under 1, else a count) become 'other', or their sorted names joined by '_'.

    Null stays null. With fewer than min_rare rare values a column is left alone.
    An absolute bound is a left join on the counts, and only the joined name needs
    the list of rare values on the driver.
    """
    if f_min < 1:
        return fold_shares(df, columns, f_min, concat, min_rare)[0]
    rare = materialise(column_counts(df, columns).where(F.col("value").isNotNull() & (F.col("n") < f_min)), "rare")
    n_rare = {r["column"]: r.k for r in rare.groupBy("column").agg(F.count("*").alias("k")).collect()}
    folded = [c for c in columns if n_rare.get(c, 0) >= min_rare]
    names = _joined(rare, folded) if concat else {}
    out = df
    for c in folded:
        few = rare.where(F.col("column") == c).select(F.col("value").alias("__rare"))
        out = out.join(few, out[c].cast("string") == few["__rare"], "left").withColumn(c, F.when(F.col("__rare").isNotNull(), F.lit(names.get(c, "other"))).otherwise(F.col(c))).drop("__rare")
    return out.select(*df.columns)


def class_weights(df: DataFrame, target: str, balanced: bool = False) -> DataFrame:
    """df with weight = 1 / (count * sum of 1 / count), so that the classes' weights sum to 1; balanced: rows / (classes * count)."""
    counts = df.groupBy(target).agg(F.count("*").alias("__n"))
    over = Window.partitionBy()  # over the classes, which are few
    weight = F.sum("__n").over(over) / (F.count("*").over(over) * F.col("__n")) if balanced else 1 / (F.col("__n") * F.sum(1 / F.col("__n")).over(over))
    weights = counts.select(F.col(target).alias("__class"), weight.alias("weight"))
    return df.join(weights, df[target] == weights["__class"], "left").drop("__class")


def row_ids(df: DataFrame, order: Sequence[str], name: str = "row_id") -> DataFrame:
    """df with the place of each row in the order, from 0; ties are broken by the other columns.

    Rows are dealt into ranges of the order; each range's count, one row a range, goes
    ahead of the places within the ranges after it. Unlike a task's running number, the
    same rows get the same ids in every run.
    """
    rest = [c for c in df.columns if c not in order]
    keys = [F.col(c) for c in (*order, *rest)]
    ranged = materialise(df.repartitionByRange(*keys).withColumn("__part", F.spark_partition_id()), "ranged")
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = ranged.groupBy("__part").agg(F.count("*").alias("__n")).select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy("__part").orderBy(*keys)
    placed = ranged.withColumn("__row", F.row_number().over(inside)).join(F.broadcast(ahead), "__part")  # a row to a range
    return placed.select(*df.columns, (F.col("__before") + F.col("__row") - 1).alias(name))
