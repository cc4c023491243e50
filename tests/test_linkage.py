import datetime as dt

import pytest
from helpers import rows
from pyspark.sql import functions as F

from holdfast.operators import linkage as L
from holdfast.operators.concentration import big_players, concentration_cut
from holdfast.plans.pipeline import label_by_name
from holdfast.specs import PASSES, HoldingsSpec
from holdfast.streaming import link_stream


def test_register_cutoff_codes_and_ambiguous_names(spark):
    data = [("one", "S14x", None), ("two", "S14", dt.date(2016, 1, 1)), ("three", "S121", dt.date(2016, 1, 2)), ("four", "S14", None), ("four", "S15", None), ("five", "S14", None), ("five", "xS14", None), ("six", "none", None), (None, "S14", None)]
    register = spark.createDataFrame(data, "idbr_name string, esa string, death_date date")
    assert rows(L.clean_register(register)) == [("five", "S14"), ("one", "S14"), ("three", "S121")]


HOLDINGS = "Owner_ID string, Owner_Name string, URL string, Owner_Type string, Owner_Country_ID string, Report_Date string, Value_Held string"


def holding(owner, name, url="u", kind="Fund", country="1", date="2016-06-30", value="1"):
    return owner, name, url, kind, country, date, value


def test_holdings_scope_nulls_and_repeated_ids(spark):
    data = [holding("1", "a"), holding("1", "a", "v"), holding("2", "b", kind=None), holding("3", "c", kind="Individual Investor"), holding("4", "d", country="7"), holding("5", "e", date="2018-01-01"), holding("6", "f", url=None), holding("7", "g"), holding("7", "h"), holding("8", "i", date="2017-12-31")]
    df = spark.createDataFrame(data, HOLDINGS)
    kept, repeated = L.clean_holdings(df)
    assert [r.Owner_ID for r in sorted(kept.collect())] == ["1", "1", "8"]
    assert rows(repeated.select("Owner_ID", "Owner_Name", "count")) == [("7", "g", 2), ("7", "h", 2)]
    assert {r.Owner_ID for r in L.clean_holdings(df, HoldingsSpec(required_cols=("Owner_ID", "Owner_Name")))[0].collect()} == {"1", "6", "8"}
    assert "3" in {r.Owner_ID for r in L.within_scope(df, HoldingsSpec(individuals=True)).collect()}


def test_big_players_by_rank_and_by_share(spark):
    df = spark.createDataFrame([("a", "5"), ("b", "3"), ("b", "2"), ("c", "4"), ("d", "nothing"), ("e", None), ("f", "6")], "Owner_ID string, Value_Held string")
    by_rank = {r.Owner_ID: (r.rank, round(r.cumsum_share, 6)) for r in big_players(df, ["Owner_ID"], "rank", 2).collect()}
    assert by_rank == {"f": (1, 0.3), "a": (2, 0.55), "b": (2, 0.8)}
    by_share = {r.Owner_ID: r.rank for r in big_players(df, ["Owner_ID"], "cumsum_share", 0.55).collect()}
    assert by_share == {"f": 1, "a": 2}
    whole = {r.Owner_ID: (r.rank, r.cumsum_share) for r in big_players(df, ["Owner_ID"], "cumsum_share", 1.5).collect()}
    assert whole["c"] == (4, pytest.approx(1)) and whole["d"][0] == whole["e"][0] == 5
    rest, players = concentration_cut(df, ["Owner_ID"], "rank", 1)
    assert {r.Owner_ID for r in players.collect()} == {"f"} and rest.count() == 6


def test_zero_total_gives_no_share(spark):
    df = spark.createDataFrame([("a", "0")], "Owner_ID string, Value_Held string")
    assert big_players(df, ["Owner_ID"]).first().share is None
    assert big_players(df.limit(0), ["Owner_ID"], "cumsum_share", 1).count() == 0


def sides(spark):
    register = [("Alpha Ltd", "S1"), ("alpha limited", "S2"), ("Beta One", "S1"), ("one BETA 7", "S1"), ("Gamma Management Holdings of Europe", "S3"), ("Delta", "S4")]
    owners = [("1", "ALPHA LTD"), ("2", "beta one"), ("3", "The Gamma Management Holdings Europe"), ("4", "Delta"), ("5", "delta!"), (None, None)]
    return spark.createDataFrame(register, "idbr_name string, esa string"), spark.createDataFrame(owners, "Owner_ID string, Owner_Name string")


def test_link_passes(spark):
    register, owners = sides(spark)
    assert rows(L.link(register, owners, PASSES[:1])[1]) == [("2", "S1")]
    rest, labels = L.link(register, owners)
    assert rows(labels) == [("2", "S1"), ("3", "S3")]
    assert rows(rest) == [("Alpha Ltd", "S1"), ("Delta", "S4"), ("alpha limited", "S2"), ("one BETA 7", "S1")]


def test_link_does_not_depend_on_row_order(spark):
    register, owners = sides(spark)
    assert rows(L.link(register.orderBy(F.desc("idbr_name")), owners.orderBy(F.desc("Owner_Name")))[1]) == rows(L.link(register, owners)[1])


def test_names_that_vanish_match_nothing(spark):
    owners = spark.createDataFrame([("1", "A&B 12"), ("2", "Common Words Here")], "Owner_ID string, Owner_Name string")
    register = spark.createDataFrame([("C/D 5", "S1"), ("here COMMON words", "S2")], "idbr_name string, esa string")
    pairs = L.candidate_pairs(owners, register, n_common=0)
    assert rows(pairs.select("Owner_ID", "idbr_name")) == [("1", None), ("2", "here COMMON words")]
    with_, without = L.recommend(owners.select("Owner_ID"), owners, register, ["Owner_ID", "Owner_Name"], n_common=0)
    assert with_.count() == 1 and without.count() == 1


def test_label_by_name_end_to_end(spark):
    register = spark.createDataFrame([("Alpha Fund", "S124", None), ("Beta", "S14", None)], "idbr_name string, esa string, death_date date")
    holdings = spark.createDataFrame([holding("1", "alpha FUND"), holding("2", "Big One", value="99"), holding("3", "Other")], HOLDINGS)
    from holdfast.plans.pipeline import PipelineSpec

    found = label_by_name(register, holdings, PipelineSpec(maxval=1))
    assert rows(found["labels"]) == [("1", "S124")]
    assert {r.Owner_ID for r in found["tr"].collect()} == {"1", "3"}
    assert [r.Owner_ID for r in found["bp"].collect()] == ["2"]


def test_link_stream(spark, tmp_path):
    register, owners = sides(spark)
    owners.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(owners.schema).parquet(str(tmp_path / "in"))
    q = link_stream(stream, register).writeStream.format("memory").queryName("linked").option("checkpointLocation", str(tmp_path / "state")).start()
    try:
        q.processAllAvailable()
        assert rows(spark.table("linked").select("Owner_ID", "esa")) == [("2", "S1"), ("4", "S4"), ("5", "S4")]
    finally:
        q.stop()


def test_pipeline_from_every_stage(spark, tmp_path):
    """Each stage reads what the ones before have written, and the later tables come out alike."""
    from holdfast.plans import pipeline
    from holdfast.specs import FeatureSpec, ModelSpec

    kinds = ["Bank", "Fund"]
    names = [f"{a} {b} {c}" for a in ("alpha", "beta", "gamma", "delta") for b in ("north", "south", "east", "west") for c in ("capital", "trust", "house", "partners")]
    register = spark.createDataFrame([(n, ["S121", "S124"][k % 2], None) for k, n in enumerate(names[:40])], "idbr_name string, esa string, death_date date")
    data = [(*holding(str(k), n.title() if k % 4 else n + " Ltd", kind=kinds[k % 2], value=str(1 + k % 5)), "GBP" if k % 2 else "USD") for k, n in enumerate(names) for _ in range(2)]
    holdings = spark.createDataFrame(data, HOLDINGS + ", Currency_Code string")
    folder = str(tmp_path / "out")
    register.write.parquet(f"{folder}/register")
    holdings.write.parquet(f"{folder}/holdings")
    features = FeatureSpec(static_categorical=("Owner_Type",), static_numerical=(), dynamic_categorical=("Currency_Code",), dynamic_numerical=("Value_Held",), fold_labels_below=1)
    spec = pipeline.PipelineSpec(maxval=0, features=features, model=ModelSpec(depths=(3,), min_instances=(1,), trees=(5,), folds=2, min_max_prob=0.99))
    counts = []
    for stage in pipeline.STAGES:
        made = pipeline.run(spark, folder, spec, stage)
        counts.append({n: df.count() for n, df in made.items()})
    assert all(c == counts[0] for c in counts)
    n = counts[0]
    assert n["labels"] == 30 and n["df"] == 64 and n["ml_labels"] + n["manual_labels"] == 34 and n["idbr"] == 10
    got = {r.Owner_ID: r.esa for r in made["ml_labels"].collect()}
    assert all(v == ["S121", "S124"][int(k) % 2] for k, v in got.items())
    assert {r.Owner_ID for r in made["mlabels_rm"].collect()} | {r.Owner_ID for r in made["mlabels_no_rm"].collect()} == {r.Owner_ID for r in made["manual_labels"].collect()}


def test_register_rows_of_one_form_and_sector_stand_for_one_name(spark):
    register = spark.createDataFrame([("Beta One", "S1"), ("one BETA 7", "S1"), ("Gamma Two", None), ("two gamma", None), ("Delta Three", "S1"), ("three delta", None)], "idbr_name string, esa string")
    owners = spark.createDataFrame([("1", "beta one"), ("2", "gamma TWO"), ("3", "delta three")], "Owner_ID string, Owner_Name string")
    rest, labels = L.link(register, owners)
    assert rows(labels) == [("1", "S1"), ("2", None)]
    assert rows(rest.select("idbr_name")) == [("Delta Three",), ("one BETA 7",), ("three delta",), ("two gamma",)]


def test_equal_holdings_in_another_order_rank_alike(spark):
    parts = [("b", 0.1), ("b", 0.2), ("b", 0.3), ("a", 0.3), ("a", 0.2), ("a", 0.1), ("c", 1e300), ("c", 1e-30), ("d", 5.0), ("d", None)]
    df = spark.createDataFrame(parts, "Owner_ID string, Value_Held double").coalesce(1)
    assert {r.Owner_ID: (r.value, r.rank) for r in big_players(df, ["Owner_ID"], "rank", 10).collect()} == {"a": (0.6, 3), "b": (0.6, 3), "c": (1e300, 1), "d": (5.0, 2)}
    small = df.where("Owner_ID <> 'c'")
    assert {r.Owner_ID: r.rank for r in big_players(small, ["Owner_ID"], "cumsum_share", 1.1).collect()} == {"a": 2, "b": 2, "d": 1}
