import random
from dataclasses import replace

import pytest

from holdfast.operators import model as M
from holdfast.operators import sampling as G
from holdfast.sources.readers import load_model
from holdfast.sources.writers import save_model
from holdfast.specs import BALANCED_MODEL, ModelSpec


@pytest.fixture(scope="module")
def numbers(spark):
    rnd = random.Random(1)
    data = [(k, rnd.gauss(5 * (k % 3), 0.4), rnd.gauss(0, 1) if k % 10 else None, ["red", "blue", None][k % 3], None if k % 5 == 0 else ["S1", "S2", "S3"][k % 3]) for k in range(600)]
    return spark.createDataFrame(data, "id int, x double, y double, colour string, label string").repartition(4)


def test_stratified_sample_covers_every_stratum(numbers):
    drawn = G.stratified_sample(numbers, "colour", 0.3, 1, ["id"])
    assert {r.colour for r in drawn.collect()} == {"red", "blue", None}
    assert drawn.collect() == G.stratified_sample(numbers, "colour", 0.3, 1, ["id"]).collect()
    assert 60 < G.stratified_sample(numbers, "colour", 100, 1, ["id"]).count() < 140
    assert G.stratified_sample(numbers, "colour", 10_000).count() == 600


def test_shares_may_differ_by_stratum(numbers):
    drawn = G.stratified_sample(numbers, "colour", {"red": 1.0, None: 0.5}, 1, ["id"])
    found = {r.colour: r["count"] for r in drawn.groupBy("colour").count().collect()}
    assert found["red"] == 200 and 70 < found[None] < 130 and "blue" not in found
    train, test = G.stratified_train_test_split(numbers, "colour", {"red": 0.5}, 1, ["id"])
    assert train.count() + test.count() == 600 and {r.colour for r in test.collect()} == {"red"}


def test_folds_hold_their_part_of_every_class(numbers):
    folds = G.stratified_folds(numbers, "colour", 4, 2, ["id"])
    assert {r["count"] for r in folds.groupBy("colour", "fold").count().collect()} == {50}
    assert G.stratified_folds(numbers.limit(0), "colour", 4, 2, ["id"]).count() == 0


def test_oversampling_fills_up_the_smaller_classes(spark):
    rnd = random.Random(2)
    data = [(k, "big", rnd.gauss(0, 1), rnd.gauss(0, 1)) for k in range(400)] + [(1000 + k, "small", rnd.gauss(9, 0.1), rnd.gauss(9, 0.1)) for k in range(37)] + [(2000, "single", 5.0, 5.0), (2001, None, 1.0, 1.0), (2002, "small", None, 1.0)]
    df = spark.createDataFrame(data, "id int, kind string, x double, y double")
    got = G.oversample(df, "kind", ["x", "y"], ["id"], block=20).collect()
    counts = {}
    for r in got:
        counts.setdefault(r.kind, [0, 0])[r.synthetic] += 1
    assert counts == {"big": [400, 0], "small": [38, 363], "single": [1, 399], None: [1, 0]}
    made = [r for r in got if r.synthetic and r.kind == "small"]
    real = {(r.x, r.y) for r in got if not r.synthetic and r.kind == "small" and r.x is not None}
    assert all(8 < r.x < 10 and 8 < r.y < 10 for r in made) and len({(r.x, r.y) for r in made} - real) > 300
    assert {(r.x, r.y) for r in got if r.kind == "single"} == {(5.0, 5.0)}
    assert sorted(map(repr, got)) == sorted(map(repr, G.oversample(df.repartition(3), "kind", ["x", "y"], ["id"], block=20).collect()))
    assert G.oversample(df.limit(0), "kind", ["x", "y"], ["id"]).count() == 0


def test_clusters_are_those_of_the_nearest_centre(numbers):
    got = G.kmeans_sample(numbers, ["x", "y"], 1.0, 6, 0.6, None, 1, ["id"], sweep_rows=300).collect()
    assert len(got) == 600
    assert len({(r.prediction, r.id % 3) for r in got if r.y is not None}) < 3 * len({r.prediction for r in got})


def test_split_is_exhaustive_and_disjoint(numbers):
    train, test = G.stratified_train_test_split(numbers, "label", 0.25, 3, ["id"])
    assert train.count() + test.count() == 600 and not train.join(test, "id").count()


def test_exact_split_cuts_each_stratum(numbers):
    _, test = G.exact_test_split(numbers, "colour", 0.1, 3, ["id"])
    assert {r["count"] for r in test.groupBy("colour").count().collect()} == {20}


def test_elbow_and_its_fallback():
    assert G.elbow([(2, 100.0), (3, 30.0), (4, 10.0)], 0.7) == 3
    assert G.elbow([(2, 10.0), (3, 10.0)], 0.8) == 3


def test_kmeans_sample_finds_the_clusters(numbers):
    got = G.kmeans_sample(numbers, ["x", "y"], 0.5, 6, 0.6, (2, 0.2), 1, ["id"])
    assert {r.prediction for r in got.collect()} >= {0, 1} and "features" not in got.columns
    plain = G.kmeans_sample(numbers, ["x"], 1.0, 5, 0.5, None, 1, ["id"])
    assert plain.count() == 600 and plain.select("prediction").distinct().count() == 3


def test_pca_falls_back_to_its_input(spark, numbers):
    from pyspark.ml.feature import VectorAssembler

    rows = VectorAssembler(inputCols=["x", "id"], outputCol="std_features").transform(numbers)
    assert G.pca_features(rows, 1, 2.0)[1] == "std_features"
    assert G.pca_features(rows, 2, 0.5)[1] == "pca"


def test_dtree_sample(numbers):
    got = G.dtree_sample(numbers.where("label is not null"), ["x"], "label", 1.0, 10, 1, ["id"])
    assert got.select("prediction").distinct().count() == 3


@pytest.mark.parametrize("spec", [ModelSpec("id", "label", depths=(3,), min_instances=(5,), trees=(10,)), ModelSpec("id", "label", test_share=0.3, weighted=True), replace(BALANCED_MODEL, id_col="id", target="label", depths=(5,), min_instances=(2,), trees=(10,))])
def test_labels_by_model(numbers, spec, tmp_path):
    sure, rest, fitted = M.label_by_model(numbers, spec)
    assert fitted.metrics["accuracy"] > 0.9
    got = {r.id: r.label for r in sure.collect()}
    assert len(got) + rest.count() == 120 and all(k % 5 == 0 for k in got)
    assert sum(v == ["S1", "S2", "S3"][k % 3] for k, v in got.items()) / len(got) > 0.95
    assert {"target_max_prob", "max_prob"} <= set(rest.columns) and "max_prob" not in sure.columns
    save_model(fitted.model, str(tmp_path / "model"))
    again = M.predict_labels(numbers, load_model(str(tmp_path / "model")), spec)
    assert again.where("max_prob >= 0.6").count() == len(got)
