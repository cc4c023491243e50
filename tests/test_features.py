import datetime as dt

import pytest
from helpers import rows

from holdfast.operators import features as L
from holdfast.operators import profile as A
from holdfast.specs import FeatureSpec

SPEC = FeatureSpec(id_col="id", target="y", static_categorical=("kind",), static_numerical=("size",), static_text=("name",), dynamic_categorical=("cur",), dynamic_numerical=("v",), dynamic_date=("day",), keywords=("ltd", "limited"), fold_share=0.2, fold_labels_below=1)


@pytest.fixture(scope="module")
def table(spark):
    data = [(1, "a ltd", "x", "3", "USD", "9", dt.date(2016, 1, 3)), (1, "a ltd", "x", "3", None, "20", dt.date(2016, 5, 1)), (2, "b limited", "x", "bad", "A.B", "1", None), (None, "c", "x", "1", "USD", "5", dt.date(2016, 1, 1)), (3, "d", None, None, "A.B", None, dt.date(2016, 1, 1))]
    return spark.createDataFrame(data, "id int, name string, kind string, size string, cur string, v string, day date")


def test_dummies_name_null_and_keep_the_column(table):
    out, names = L.dummies(table, ["cur"])
    assert names == ["cur/A.B", "cur/Null", "cur/USD"]
    assert rows(out.select("cur", *(f"`{n}`" for n in names)).distinct()) == [("A.B", 1, 0, 0), ("Null", 0, 1, 0), ("USD", 0, 0, 1)]


def test_dummies_may_leave_null_out(table):
    out, names = L.dummies(table.select("id", "cur"), ["cur"], null_as=None, keep=False, sep="_")
    assert out.columns == ["id", "cur_A.B", "cur_USD"]
    assert (1, 0, 0) in rows(out)


def test_dynamic_features_cast_before_they_compare(table):
    got = {r.id: r.asDict() for r in L.dynamic_features(table, SPEC).collect()}
    assert set(got) == {1, 2, 3}
    one = got[1]
    assert one["count"] == 2 and one["max(v)"] == 20 and one["min(v)"] == 9 and one["sum(v)"] == 29
    assert one["avg(cur/USD)"] == 0.5 and one["sum(cur/Null)"] == 1
    assert one["min(dayofweek)"] == 1 and one["max(quarter)"] == 2
    assert got[2]["avg(month)"] is None and got[3]["sum(v)"] is None


def test_two_dates_get_names_of_their_own(table):
    spec = FeatureSpec(id_col="id", dynamic_categorical=("cur",), dynamic_numerical=("v",), dynamic_date=("day", "other"))
    out = L.dynamic_features(table.withColumn("other", table.day), spec)
    assert {"avg(day_month)", "avg(other_month)"} <= set(out.columns)


def test_static_features(table):
    got = {r.id: r for r in L.static_features(table, SPEC).collect()}
    assert set(got) == {None, 1, 2, 3}
    assert (got[1].ltd, got[2].ltd, got[2].limited) == (1.0, 1.0, 1.0)
    assert got[2]["size"] is None and got[1]["size"] == 3.0 and got[3].kind is None


def test_feature_table_has_plain_names_and_null_labels(spark, table):
    labels = spark.createDataFrame([(1, "S1")], "id int, y string")
    out = L.feature_table(table, labels, SPEC)
    assert all(c.replace("_", "").isalnum() for c in out.columns) and "avgcurAB" in out.columns
    assert {r.id: r.y for r in out.collect()} == {None: None, 1: "S1", 2: None, 3: None}


def test_missing_report_and_profile(table):
    assert dict(rows(A.missing_report(table, ["id", "v"]))) == {"id": 20.0, "v": 20.0}
    got = {(r.column, r.place): r for r in A.profile(table, ["cur", "kind"], 2).collect()}
    assert (got["cur", 1].value, got["cur", 1]["count"], got["cur", 1].n_values, got["cur", 1].n_null) == ("A.B", 2, 3, 1)
    assert got["kind", 2].value is None and got["kind", 2].total_pct == 20


def test_frequencies_normalise_by_the_top(table):
    assert [tuple(r) for r in A.frequencies(table, "kind", 1, True).collect()] == [("x", 1.0)]


def test_crosstab_and_coverage(spark, table):
    assert rows(A.crosstab(table, "kind", "cur")) == [("x", 1, 2), (None, 1, 0)]
    labels = spark.createDataFrame([(1, "S1"), (2, None)], "id int, y string")
    assert A.coverage(table, labels, "id", "y").first() == (1, 4)
    assert rows(A.coverage_by_value(table, labels, "id", "v", "y")) == [(0, 6.0), (1, 29.0)]


def test_shape_and_size(table):
    assert A.shape(table) == (5, 7)
    assert A.estimated_bytes(table, 1.0) > 100
    assert A.estimated_bytes(table.limit(0)) == 0


def test_narrowest_types_keep_every_value(spark):
    df = spark.createDataFrame([(127, -129, 2**40, 0.5, 0.1, None), (-128, 5, 1, 2.0, 0.2, None)], "a long, b long, c long, d double, e double, f int")
    kinds = dict(rows(L.narrowest(df)))
    assert kinds == {"a": "tinyint", "b": "smallint", "c": "bigint", "d": "float", "e": "double", "f": "int"}
    assert rows(L.downcast(df)) == rows(df)
    assert dict(rows(L.narrowest(df.limit(0)))) == {"a": "bigint", "b": "bigint", "c": "bigint", "d": "double", "e": "double", "f": "int"}


def test_medians_fill_nulls_and_nans(spark):
    df = spark.createDataFrame([(1.0, 1), (2.0, None), (4.0, 7), (None, 3), (float("nan"), 3)], "x double, n int")
    assert sorted(r.x for r in L.impute_medians(df, ["x"]).collect()) == [1, 2, 2, 2, 4]
    assert sorted(r.n for r in L.impute_medians(df, ["n"], interpolated=True).collect()) == [1, 3, 3, 3, 7]
    assert L.impute_medians(df.limit(0), ["x"]).count() == 0


def test_too_many_categories_are_an_error(spark):
    df = spark.range(30).selectExpr("cast(id as string) as k", "'a' as r")
    with pytest.raises(ValueError, match="more than 20 categories"):
        L.categories(df, ["k"], most=20)
    with pytest.raises(ValueError, match="values of k"):
        A.crosstab(spark.range(A.MOST_COLUMNS + 1).selectExpr("cast(id as string) as k", "1 as r"), "r", "k")


def test_bars_and_text(spark):
    df = spark.createDataFrame([("a", 4), ("b", 1), ("c", None)], "k string, n long")
    assert rows(A.bars(df, "n", 8)) == [("a", 4, "########"), ("b", 1, "##"), ("c", None, "")]
    assert A.text_table(df, 2) == "k | n\na | 4\nb | 1"
