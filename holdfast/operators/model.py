"""A random forest for the owners that names alone cannot place."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import Imputer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..specs import ModelSpec
from .profile import estimated_bytes
from .relational import class_weights
from .sampling import stratified_folds, stratified_train_test_split

WEIGHT, FOLD = "__weight", "__fold"


@dataclass
class Fitted:
    model: PipelineModel
    metrics: dict[str, float]


def label_pipeline(df: DataFrame, spec: ModelSpec) -> tuple[Pipeline, RandomForestClassifier]:
    """Index the target, impute medians, encode strings, and grow a forest; strings are categories, all else is a number."""
    fields = [f for f in df.schema if f.name not in (spec.id_col, spec.target, WEIGHT, FOLD)]
    text = [f.name for f in fields if isinstance(f.dataType, T.StringType)]
    numbers = [f.name for f in fields if not isinstance(f.dataType, T.StringType)]
    stages = [StringIndexer(inputCol=spec.target, outputCol="__label", handleInvalid="keep")]
    if numbers:
        stages.append(Imputer(inputCols=numbers, outputCols=[f"{c}__imputed" for c in numbers], strategy="median"))
    stages += [StringIndexer(inputCol=c, outputCol=f"{c}__indexed", handleInvalid="keep") for c in text]
    if text:
        stages.append(OneHotEncoder(inputCols=[f"{c}__indexed" for c in text], outputCols=[f"{c}__encoded" for c in text]))
    stages.append(VectorAssembler(inputCols=[f"{c}__imputed" for c in numbers] + [f"{c}__encoded" for c in text], outputCol="__features", handleInvalid="keep"))
    forest = RandomForestClassifier(labelCol="__label", featuresCol="__features", predictionCol="__prediction", probabilityCol="__probability", rawPredictionCol="__raw", seed=spec.seed, featureSubsetStrategy="sqrt")
    if spec.weighted:
        forest = forest.setWeightCol(WEIGHT)
    return Pipeline(stages=[*stages, forest]), forest


def as_numbers(df: DataFrame, spec: ModelSpec) -> DataFrame:
    """Every column that is neither text nor a key as a double."""
    return df.withColumns({f.name: F.col(f.name).cast("double") for f in df.schema if f.name not in (spec.id_col, spec.target) and isinstance(f.dataType, T.NumericType | T.BooleanType)})


def fit_labels(df: DataFrame, spec: ModelSpec = ModelSpec()) -> Fitted:
    """Fit on the labelled rows of df: by cross-validation over the grid or, with a test share, by hold-out and a refit on all."""
    labelled = as_numbers(df, spec).where(F.col(spec.target).isNotNull())
    if spec.weighted:
        labelled = class_weights(labelled, spec.target, spec.balanced).withColumnRenamed("weight", WEIGHT)
    pipeline, forest = label_pipeline(labelled, spec)
    if spec.stratified_folds and not spec.test_share:
        labelled = stratified_folds(labelled, spec.target, spec.folds, spec.seed, [spec.id_col], FOLD)
    labelled = few_partitions(labelled, spec.small_bytes).persist()
    try:
        return _fitted(labelled, pipeline, forest, spec)
    finally:
        labelled.unpersist()


def few_partitions(df: DataFrame, small_bytes: float) -> DataFrame:
    """df, in one partition for each core at most if it is small, as every step of a fit is a job over all partitions."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.coalesce(cores) if small_bytes and estimated_bytes(df, 0.1) < small_bytes else df


def _fitted(labelled: DataFrame, pipeline: Pipeline, forest: RandomForestClassifier, spec: ModelSpec) -> Fitted:
    accuracy = MulticlassClassificationEvaluator(labelCol="__label", predictionCol="__prediction", metricName="accuracy")
    if spec.test_share:
        train, test = stratified_train_test_split(labelled, spec.target, spec.test_share, spec.seed, [spec.id_col])
        guessed = pipeline.fit(train).transform(test)
        metrics = {"accuracy": accuracy.evaluate(guessed), "f1": accuracy.copy().setMetricName("f1").evaluate(guessed)}
        return Fitted(pipeline.fit(labelled), metrics)
    grid = ParamGridBuilder().addGrid(forest.maxDepth, spec.depths).addGrid(forest.minInstancesPerNode, spec.min_instances).addGrid(forest.numTrees, spec.trees).build()
    search = CrossValidator(estimator=pipeline, estimatorParamMaps=grid, evaluator=accuracy, numFolds=spec.folds, seed=spec.seed, parallelism=spec.parallelism)
    found = (search.setFoldCol(FOLD) if spec.stratified_folds else search).fit(labelled)
    return Fitted(found.bestModel, {"accuracy": max(found.avgMetrics)})


def predict_labels(df: DataFrame, model: PipelineModel, spec: ModelSpec = ModelSpec()) -> DataFrame:
    """The unlabelled rows of df with target_max_prob, the likeliest label, and max_prob."""
    rows = as_numbers(df, spec).where(F.col(spec.target).isNull())
    labels = model.stages[0].labels
    scored = model.transform(rows.withColumn(WEIGHT, F.lit(1.0)).withColumn(spec.target, F.lit(labels[0])))
    chances = F.slice(vector_to_array("__probability"), 1, len(labels))
    best = F.array_max(chances)
    named = F.element_at(F.array(*map(F.lit, labels)), F.array_position(chances, best).cast("int"))
    return scored.select(*(c for c in df.columns if c != spec.target), named.alias("target_max_prob"), best.alias("max_prob"))


def label_by_model(df: DataFrame, spec: ModelSpec = ModelSpec()) -> tuple[DataFrame, DataFrame, Fitted]:
    """(rows whose likeliest label is likely enough, under the target's name; the rest; the model)."""
    fitted = fit_labels(df, spec)
    scored = predict_labels(df, fitted.model, spec)
    sure = F.col("max_prob") >= spec.min_max_prob
    return scored.where(sure).withColumnRenamed("target_max_prob", spec.target).drop("max_prob"), scored.where(~sure), fitted
