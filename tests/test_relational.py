import pytest
from helpers import rows

from holdfast.operators import relational as R
from holdfast.specs import JoinSpec


@pytest.fixture(scope="module")
def keyed(spark):
    return spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), (None, 4), (None, 5)], "k string, v int")


def test_split_leaves_null_keys_out(keyed):
    assert rows(R.split_unique(keyed, "k")) == [("a", 1)]
    assert rows(R.split_duplicates(keyed, "k")) == [("b", 2, 2), ("b", 3, 2)]


def test_split_with_a_column_named_count(spark):
    df = spark.createDataFrame([("a", 7), ("b", 8), ("b", 9)], "k string, count int")
    assert rows(R.split_unique(df, "k")) == [("a", 7)]
    assert R.split_duplicates(df, "k").columns == ["k", "count", "count"]


def test_split_of_one_column_and_of_nothing(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",)], "k string")
    assert rows(R.split_unique(df, "k")) == [("a",)]
    assert rows(R.split_unique(df.limit(0), "k")) == []


@pytest.mark.parametrize("mode, want", [("inner", [("b", 2), ("b", 2), ("b", 3), ("b", 3)]), ("semi", [("b", 2), ("b", 3)]), ("outer", [("a", 1), (None, 4), (None, 5)])])
def test_key_join(spark, keyed, mode, want):
    right = spark.createDataFrame([("b",), ("b",), ("c",), (None,)], "id string")
    assert rows(R.key_join(keyed, right, "k", "id", mode)) == sorted(want, key=repr)


def test_join_chain_ignores_the_first_keys(spark):
    frames = {"a": spark.createDataFrame([(1, "x"), (2, "y")], "i int, u string"), "b": spark.createDataFrame([(1, 10)], "i int, w int")}
    assert rows(R.join_chain(frames, [JoinSpec("a", ("nothing",)), JoinSpec("b", ("i",))])) == [(1, "x", 10), (2, "y", None)]


def test_unions_go_by_name(spark):
    a, b = spark.createDataFrame([(1, "x")], "i int, u string"), spark.createDataFrame([("y", 2)], "u string, i int")
    assert rows(R.union_all(a, b, a)) == [(1, "x"), (1, "x"), (2, "y")]
    c = spark.createDataFrame([(3, 0.5)], "i int, w double")
    assert rows(R.union_filled(a, c)) == [(1, "x", None), (3, None, 0.5)]


def test_one_row_per_key_is_the_least(spark):
    df = spark.createDataFrame([(2, "b", 1), (1, "z", 1), (1, "y", 2)], "v int, w string, k int")
    assert rows(R.one_row_per(df, ["k"])) == [(1, "y", 2), (1, "z", 1)]


def test_unique_counts_null(keyed):
    assert R.nunique(keyed, "k").first().n == 3


def test_value_counts_break_ties_by_value(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), ("c",)], "k string")
    assert [tuple(r) for r in R.value_counts(df, "k", 2).collect()] == [("a", 2), ("b", 2)]


CATS = [("a",)] * 10 + [("b",)] * 9 + [("c",)] + [(None,)]


def test_fold_is_strict_at_the_bound(spark):
    df = spark.createDataFrame([("a",)] * 19 + [("b",)], "k string")
    assert rows(R.fold_categories(df, ["k"], 0.05)) == rows(df)
    assert ("other",) in rows(R.fold_categories(df, ["k"], 0.06))


def test_fold_keeps_null_and_names_what_it_folds(spark):
    df = spark.createDataFrame(CATS, "k string")
    assert sorted(set(rows(R.fold_categories(df, ["k"], 10, concat=True))), key=repr) == [("a",), ("b_c",), (None,)]
    assert set(rows(R.fold_categories(df, ["k"], 10))) == {("a",), ("other",), (None,)}


def test_fold_only_several_rare_values(spark):
    df = spark.createDataFrame(CATS, "k string")
    assert rows(R.fold_categories(df, ["k"], 0.1, min_rare=2)) == rows(df)


def test_fold_twice_changes_nothing(spark):
    df = spark.createDataFrame(CATS, "k string")
    once = R.fold_categories(df, ["k"], 2)
    assert rows(R.fold_categories(once, ["k"], 1)) == rows(once)


def test_class_weights_sum_to_one_over_classes(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)], "k string")
    weights = dict(R.class_weights(df, "k").distinct().collect())
    assert weights == pytest.approx({"a": 0.25, "b": 0.75})


def test_row_ids_are_the_places_in_the_order(spark):
    df = spark.createDataFrame([(k * 7 % 50, "x") for k in range(50)] + [(None, "y"), (3, "a")], "k int, w string").repartition(5)
    got = sorted((tuple(r) for r in R.row_ids(df, ["k"]).collect()), key=lambda r: r[2])
    assert [r[2] for r in got] == list(range(52))
    assert [r[0] for r in got] == [None, 0, 1, 2, 3, *range(3, 50)] and got[4][1] == "a"
    assert R.row_ids(df.limit(0), ["k"]).count() == 0


def test_union_by_position_takes_the_first_names(spark):
    a, b = spark.createDataFrame([(1, "x")], "i int, u string"), spark.createDataFrame([(2, "y")], "j int, v string")
    assert R.union_by_position(a, b).columns == ["i", "u"] and rows(R.union_by_position(a, b)) == [(1, "x"), (2, "y")]


def test_balanced_weights(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)], "k string")
    assert dict(R.class_weights(df, "k", balanced=True).distinct().collect()) == pytest.approx({"a": 4 / 6, "b": 2.0})


def test_shares_tell_the_values_that_are_left(spark):
    df = spark.createDataFrame(CATS, "k string")
    folded, values, nulls = R.fold_shares(df, ["k"], 0.1)
    assert values == {"k": ["a", "b", "other"]} and nulls == {"k"} and {r.k for r in folded.collect()} == {"a", "b", "other", None}
    same, values, _ = R.fold_shares(df, ["k"], 0.1, min_rare=2)
    assert values == {"k": ["a", "b", "c"]} and rows(same) == rows(df)
    assert R.fold_shares(df.limit(0), ["k"], 0.1)[1] == {"k": []}
