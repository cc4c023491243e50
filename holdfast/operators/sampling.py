"""Samples for review: by stratum, by cluster and by decision-tree leaf."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, Imputer, StandardScaler, StringIndexer, VectorAssembler, VectorSlicer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .quantiles import lower, quantiles

#: Most rows that the sweep over numbers of clusters fits on.
SWEEP_ROWS = 200_000
#: Ranges that places within a group are counted by.
RANGES = 256


def share_of(df: DataFrame, p: float) -> float:
    """p itself, or where it is above 1 the share that leaves about p rows."""
    return min(1.0, p / max(df.count(), 1)) if p > 1 else p


def drawn(keys: Sequence[str], seed: int) -> Column:
    """A number in [0, 1) that depends on the row's key alone, so that a second run draws the same rows: 52 bits of the MD5 of seed and keys, joined by bars."""
    text = F.concat_ws("|", F.lit(str(seed)), *(F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def uniform_sample(df: DataFrame, p: float, seed: int = 42, keys: Sequence[str] | None = None) -> DataFrame:
    """The rows whose draw is below p (above 1: about p rows), without replacement; by the hash of their keys or, without keys, by a seeded random number."""
    return df.where((drawn(keys, seed) if keys else F.rand(seed)) < share_of(df, p))


def _share_by_value(column: str, shares: dict) -> Column:
    return reduce(lambda c, v: F.when(F.col(column).eqNullSafe(F.lit(v)), F.lit(float(shares[v]))).otherwise(c), shares, F.lit(0.0))


def stratified_sample(df: DataFrame, column: str, p: float | dict, seed: int = 42, keys: Sequence[str] | None = None) -> DataFrame:
    """Each row by a draw of its own, against the share of its stratum.

    A number is the share of every stratum, null among them, so a row's draw need not
    know which it is in; a mapping has the share of each value, and what it does not
    name is not drawn.
    """
    if not isinstance(p, dict):
        return uniform_sample(df, p, seed, keys)
    return df.where((drawn(keys, seed) if keys else F.rand(seed)) < _share_by_value(column, p))


def stratified_train_test_split(df: DataFrame, target: str, p_test: float | dict, seed: int = 0, keys: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(train, test): every row is in one of them, by the hash of its key (default: of all columns); the test share may differ by value of target, as in stratified_sample."""
    keys = list(keys or df.columns)
    if isinstance(p_test, dict):
        draw, share = drawn(keys, seed), _share_by_value(target, p_test)
        return df.where(draw >= share), df.where(draw < share)
    p = share_of(df, p_test)
    return df.where(drawn(keys, seed) >= p), df.where(drawn(keys, seed) < p)


def stratified_folds(df: DataFrame, target: str, folds: int, seed: int = 0, keys: Sequence[str] | None = None, name: str = "fold") -> DataFrame:
    """df with a fold from 0 in which every class has its share of rows, to one: the cuts are exact quantiles of each class's draws, so no class is sorted in one task."""
    rows = df.withColumn("__draw", drawn(list(keys or df.columns), seed))
    cuts = quantiles(rows, F.col("__draw"), [lower(k / folds) for k in range(1, folds)], F.col(target))
    marked = rows.join(cuts, rows[target].eqNullSafe(cuts["__class"]))
    return marked.withColumn(name, F.size(F.filter("__cuts", lambda c: c < F.col("__draw")))).select(*df.columns, name)


def exact_test_split(df: DataFrame, target: str, p_test: float, seed: int = 0, keys: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(train, test) with the test share exact in each stratum, up to rounding: the cut is the exact quantile of the rows' draws, without a sort of the stratum."""
    rows = df.withColumn("__draw", drawn(list(keys or df.columns), seed))
    cuts = quantiles(rows, F.col("__draw"), [lower(share_of(df, p_test))], F.col(target)).select(F.col("__class").alias("__stratum"), F.col("__cuts")[0].alias("__cut"))
    marked = rows.join(cuts, rows[target].eqNullSafe(cuts["__stratum"]))
    return tuple(marked.where(c).select(*df.columns) for c in (F.col("__draw") > F.col("__cut"), F.col("__draw") <= F.col("__cut")))


def oversample(df: DataFrame, target: str, features: Sequence[str], keys: Sequence[str], neighbours: int = 5, block: int = 1000, seed: int = 0) -> DataFrame:
    """(target, features, synthetic): df's rows, and for each class as many synthetic rows as the largest class has more.

    A synthetic row lies at a drawn place between a row and one of its nearest
    `neighbours` of the same class. Classes are cut into blocks of about `block` rows by
    a hash of their keys, and neighbours are looked for within a block, so no task holds a
    class; each block makes its part of the rows that its class lacks. Rows without a
    class or with a null among the features are left as they are. A class of one row is
    repeated.
    """
    names = list(features)
    whole = reduce(lambda c, n: c & F.col(n).isNotNull(), names, F.col(target).isNotNull())
    rows = df.where(whole).select(F.col(target).alias("__class"), *(F.col(n).cast("double").alias(f"__x{i}") for i, n in enumerate(names)), drawn(keys, seed).alias("__draw"))
    sizes = rows.groupBy("__class").agg(F.count("*").alias("__n"))
    lacking = sizes.select("__class", F.ceil(F.col("__n") / block).alias("__blocks"), ((F.max("__n").over(Window.partitionBy()) - F.col("__n")) / F.col("__n")).alias("__more"))  # over the classes, which are few
    dealt = rows.join(F.broadcast(lacking), "__class").where("__more > 0").withColumn("__block", F.floor(F.col("__draw") * F.col("__blocks")).cast("long"))
    # how many rows each row makes: the whole part of its class's ratio, and one more for the rows of the smallest draws
    placed = row_number_in(dealt, ["__class"], "__draw")
    made = placed.withColumn("__times", (F.floor((F.col("__place") + 1) * F.col("__more") + 1e-9) - F.floor(F.col("__place") * F.col("__more") + 1e-9)).cast("int"))
    columns = [f"__x{i}" for i in range(len(names))]

    def between(table: pd.DataFrame) -> pd.DataFrame:
        table = table.sort_values("__draw", kind="stable")
        x, times = table[columns].to_numpy(float), table["__times"].to_numpy(int)
        rng = np.random.default_rng([seed, int(table["__draw"].iloc[0] * 2**52)])
        square = (x * x).sum(axis=1)
        far = square[:, None] + square[None, :] - 2 * x @ x.T
        np.fill_diagonal(far, np.inf)
        near = np.argsort(far, axis=1, kind="stable")[:, : max(1, min(neighbours, len(x) - 1))]
        at = np.repeat(np.arange(len(x)), times)
        other = near[at, rng.integers(0, near.shape[1], len(at))]
        made = x[at] + rng.random((len(at), 1)) * (x[other] - x[at])
        out = pd.DataFrame(made, columns=columns)
        out.insert(0, "__class", table["__class"].iloc[0])
        return out

    kind = rows.schema["__class"].dataType
    schema = T.StructType([T.StructField("__class", kind), *(T.StructField(c, T.DoubleType()) for c in columns)])
    new = made.select("__class", "__block", "__draw", "__times", *columns).groupBy("__class", "__block").applyInPandas(between, schema)
    back = [F.col("__class").alias(target), *(F.col(c).alias(n) for c, n in zip(columns, names)), F.lit(True).alias("synthetic")]
    return df.select(target, *(F.col(n).cast("double").alias(n) for n in names), F.lit(False).alias("synthetic")).unionByName(new.select(*back))


def row_number_in(df: DataFrame, groups: Sequence[str], order: str) -> DataFrame:
    """df with __place, from 0, by a draw in [0, 1) within groups: each of RANGES equal ranges of the draw counts on its own, after the counts of those before it."""
    ranged = df.withColumn("__range", F.floor(F.col(order) * RANGES).cast("int"))
    before = Window.partitionBy(*groups).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    ahead = ranged.groupBy(*groups, "__range").agg(F.count("*").alias("__n")).select(*groups, "__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy(*groups, "__range").orderBy(order)
    return ranged.withColumn("__row", F.row_number().over(inside)).join(ahead, [*groups, "__range"]).withColumn("__place", F.col("__before") + F.col("__row") - 1).drop("__before", "__row", "__range")


def pca_features(df: DataFrame, most: int, least_variance: float, column: str = "std_features", out: str = "pca") -> tuple[DataFrame, str]:
    """(df with the fewest components whose explained variance exceeds the bound, their column); df and the input column if `most` are too few."""
    model = PCA(k=most, inputCol=column, outputCol="__pca").fit(df)
    total = 0.0
    for k, v in enumerate(model.explainedVariance, 1):
        total += v
        if total > least_variance:
            return VectorSlicer(inputCol="__pca", outputCol=out, indices=list(range(k))).transform(model.transform(df)).drop("__pca"), out
    return df, column


def elbow(costs: Sequence[tuple[int, float]], cost_reduction: float) -> int:
    """The first k whose cost falls below the given part of the way from first to last; else the largest."""
    first, last = costs[0][1], costs[-1][1]
    return next((k for k, c in costs if c < first - (first - last) * cost_reduction), costs[-1][0])


def kmeans_sample(df: DataFrame, features: Sequence[str], n_sample: float, max_clusters: int = 100, cost_reduction: float = 0.8, pca: tuple[int, float] | None = (100, 0.9), seed: int = 42, keys: Sequence[str] | None = None, sweep_rows: int = SWEEP_ROWS) -> DataFrame:
    """df with its cluster (column prediction), sampled alike in every cluster.

    The number of clusters is found on about sweep_rows rows, or all if there are fewer;
    the clusters themselves are fitted on all rows.
    """
    names = list(features)
    doubled = df.withColumns({c: F.col(c).cast("double") for c in names})
    prepared = Pipeline(stages=[Imputer(inputCols=names, outputCols=names, strategy="median"), VectorAssembler(inputCols=names, outputCol="features"), StandardScaler(inputCol="features", outputCol="std_features")])
    rows = prepared.fit(doubled).transform(doubled)
    rows, column = pca_features(rows, min(pca[0], len(names)), pca[1]) if pca else (rows, "std_features")
    few = uniform_sample(rows, max(sweep_rows, 2), seed, keys).persist()
    try:
        costs = [(k, KMeans(k=k, seed=1, featuresCol=column).fit(few).summary.trainingCost) for k in range(2, max(max_clusters, 3))]
    finally:
        few.unpersist()
    model = KMeans(k=elbow(costs, cost_reduction), seed=1, featuresCol=column).fit(rows)
    return stratified_sample(model.transform(rows), "prediction", n_sample, seed, keys).drop("features", "std_features", "pca")


def dtree_sample(df: DataFrame, features: Sequence[str], target: str, n_sample: float, min_instances: int = 1000, seed: int = 42, keys: Sequence[str] | None = None) -> DataFrame:
    """df with a decision tree's prediction of the target, sampled alike for every prediction."""
    stages = [StringIndexer(inputCol=target, outputCol="indexedLabel"), VectorAssembler(inputCols=list(features), outputCol="features"), DecisionTreeClassifier(labelCol="indexedLabel", minInstancesPerNode=min_instances)]
    rows = Pipeline(stages=stages).fit(df).transform(df)
    return stratified_sample(rows, "prediction", n_sample, seed, keys).drop("indexedLabel", "features", "rawPrediction", "probability")


def review_samples(df: DataFrame, features: Sequence[str], target: str, n: int = 100, keys: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """The two samples that reviewers get: by cluster and by decision-tree leaf."""
    return kmeans_sample(df, features, n, keys=keys), dtree_sample(df, features, target, n, keys=keys)
