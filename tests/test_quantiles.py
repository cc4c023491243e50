from pyspark.sql import functions as F

from holdfast.operators import quantiles as module
from holdfast.operators.features import impute_medians
from holdfast.operators.quantiles import lower, quantiles
from holdfast.operators.sampling import exact_test_split, stratified_folds

ROWS = 600_000


def test_exact_test_split_is_exact_in_a_large_stratum(spark):
    rows = spark.range(ROWS).withColumn("target", F.lit("a"))
    train, test = exact_test_split(rows, "target", 0.2, 0, ["id"])
    assert (train.count(), test.count()) == (ROWS * 4 // 5, ROWS // 5)


def test_folds_are_even_in_a_large_class(spark):
    rows = spark.range(ROWS).withColumn("target", F.when(F.col("id") % 100 > 0, "a"))
    folds = stratified_folds(rows, "target", 3, 1, ["id"]).groupBy("target", "fold").count().collect()
    assert sorted((r.target or "", r["count"]) for r in folds) == [("", ROWS // 300)] * 3 + [("a", ROWS * 99 // 300)] * 3


def test_median_is_exact_over_many_values(spark):
    rows = spark.range(ROWS).select("id", (F.pmod(F.col("id") * 7919, F.lit(ROWS + 1)) * 1.0).alias("x")).withColumn("x", F.when(F.col("id") > 0, F.col("x")))
    known = sorted(i * 7919 % (ROWS + 1) for i in range(1, ROWS))
    got = [impute_medians(rows, ["x"], interpolated=i).where("id = 0").first().x for i in (False, True)]
    assert got == [known[(len(known) - 1) // 2]] * 2


def test_small_groups_nulls_and_ties(spark):
    rows = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("a", 2.0), ("a", None), (None, 5.0), (None, 7.0), ("b", None)], "g string, x double")
    got = {r["__class"]: r["__cuts"] for r in quantiles(rows, F.col("x"), [lower(0.5), *module.MIDDLE], F.col("g")).collect()}
    assert got == {"a": [1.0, 1.0, 1.0], None: [5.0, 5.0, 7.0], "b": [None, None, None]}
    assert quantiles(rows.where("false"), F.col("x"), [lower(0.5)]).first()["__cuts"] == [None]


def test_rank_outside_its_bracket(spark, monkeypatch):
    rows = spark.range(1000).select((F.col("id") % 2).alias("g"), F.col("id").alias("x"))
    for margin in (-0.1, -0.3):
        monkeypatch.setattr(module, "MARGIN", margin)
        got = {r["__class"]: r["__cuts"] for r in quantiles(rows, F.col("x"), [lower(0.2), lower(0.5)], F.col("g")).collect()}
        assert got == {0: [198, 498], 1: [199, 499]}
