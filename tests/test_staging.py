import json

import pytest
from helpers import rows
from pyspark.errors import AnalysisException

from holdfast.plans.staging import HOLDINGS_JOINS, HOLDINGS_UNIONS, holdings_files, stage_holdings, stage_register
from holdfast.sources import readers, writers
from holdfast.specs import ExtractSpec


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_register(spark, tmp_path):
    live = write(tmp_path / "live.tsv", "1\tAlpha\t10\tS1\n2\tBeta\t20\tS2\n")
    dead = write(tmp_path / "dead.tsv", "3\tGamma\t30\tS3\t 01/02/2016 \n4\tDelta\t40\tS4\t1/2/2016\n5\tEta\t50\tS5\t\n")
    out = stage_register(spark, live, dead, str(tmp_path / "register"))
    assert [(r.id, r.death_date and str(r.death_date)) for r in sorted(out.collect())] == [("1", None), ("2", None), ("3", "2016-02-01"), ("4", None), ("5", None)]
    assert rows(spark.read.parquet(str(tmp_path / "register"))) == rows(out)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        stage_register(spark, live, dead, str(tmp_path / "register"))


def test_holdings(spark, tmp_path):
    raw = tmp_path / "raw"
    for name, owner in (("Consolidated_Funds_Holdings_History", 1), ("Mutual_Funds_Holdings_History", 2)):
        write(raw / name / "a.json", json.dumps({"Owner_ID": str(owner), "Security_ID": "s", "Quarter": "q", "Style_ID": "y", "Owner_Type_ID": "t", "Value_Held": "5"}) + "\n" + ("not json\n" if owner == 1 else ""))
    write(raw / "Owner_History" / "a.csv", "Owner_ID,Country_ID,Report_Date\n1,249,x\n1,249,z\n")
    write(raw / "Exchange_Listed" / "a.csv", "Instrument_ID,Exchange_Listed_Flag,Else\nu,Y,1\n")
    write(raw / "Owner_Type" / "a.csv", "Owner_Type_ID,Description\nt,Fund\n")
    write(raw / "Investment_Style" / "a.csv", "Style_ID,Style_Description\ny,Growth\n")
    spark.createDataFrame([("u", "n")], "isin_f string, name string").write.parquet(str(raw / "EOD_History_Lookup"))
    columns = "Security_ID, Issuer_Name, UID, Industry_Description, Sector_Description, LET_Desc, Listed, Trade_Date, Security_Class, Mkt_Cap_USD, Shares_Outstanding".split(", ")
    spark.createDataFrame([("s", "i", "u", "ind", "sec", "let", "l", "q", "c", "1", "2")], columns).write.parquet(str(raw / "Equity_Issuance_All"))
    out = stage_holdings(spark, holdings_files(str(raw)), HOLDINGS_UNIONS, HOLDINGS_JOINS, str(tmp_path / "staged"))
    got = {r.Owner_ID: r for r in out.where("Owner_ID is not null").collect()}
    assert set(got) == {"1", "2"}
    assert (got["1"].Owner_Country_ID, got["1"].Owner_Type, got["1"].Style_Description, got["1"].Exchange_Listed_Flag, got["1"].Issuer_Name) == ("249", "Fund", "Growth", "Y", "i")
    assert got["2"].Owner_Country_ID is None
    assert "_corrupt_record" not in out.columns


def test_repeated_headers_go(spark, tmp_path):
    path = write(tmp_path / "a.txt", "k|v\n1|x\nk|v\n2|y\n")
    assert rows(readers.read_delimited(spark, path, "|")) == [("1", "x"), ("2", "y")]


def test_files_by_extension(spark, tmp_path):
    a, b = write(tmp_path / "d" / "a.csv", "k\n1\n"), write(tmp_path / "d" / "b.csv", "k\n2\n")
    write(tmp_path / "d" / "c.txt", "no")
    paths = sorted(r.path.removeprefix("file:") for r in readers.list_files(spark, str(tmp_path / "d"), "csv").collect())
    assert paths == [a, b]
    assert rows(readers.read_csv_files(spark, [a, b])) == [("1",), ("2",)]


def test_extract_runs_in_order(spark):
    df = spark.createDataFrame([("1", "a"), ("1", "a"), ("x", "a"), ("2", "b")], "n string, k string")
    got = readers.extract(df, ExtractSpec(cast={"n": "int"}, isin={"k": ["a"]}, select=("n", "k"), drop=("k",), rename={"n": "m"}))
    assert got.columns == ["m"] and rows(got) == [(1,), (None,)]


def test_single_file_and_modes(spark, tmp_path):
    df = spark.range(10).repartition(4)
    writers.write_table(df, "csv", str(tmp_path / "one"), single_file=True)
    assert len(list((tmp_path / "one").glob("part-*"))) == 1
    writers.write_table(df, "csv", str(tmp_path / "one"), "overwrite")
    assert readers.read_table(spark, str(tmp_path / "one"), "csv").count() == 10
    writers.write_parquet(df, str(tmp_path / "two"), "overwrite")
    assert readers.read_table(spark, str(tmp_path / "two"), schema="id long").count() == 10


def test_only_small_tables_go_to_the_driver(spark):
    from holdfast.sources import collected

    df = spark.range(11).selectExpr("id", "id * 2 as twice")
    assert collected.collect_map(df, "id", "twice", 11)[5] == 10 and len(collected.to_pandas(df, 11)) == 11
    for f in (lambda: collected.collect_map(df, "id", "twice", 10), lambda: collected.to_pandas(df, 10)):
        with pytest.raises(ValueError, match="more than 10"):
            f()
    assert rows(collected.from_pandas(spark, collected.to_pandas(df))) == rows(df)


def test_scratch_tables_go_when_released_or_out_of_scope(spark):
    from holdfast.sources import scratch

    def there(df):
        try:
            return spark.read.schema("id long").parquet(df._holdfast_scratch).count()
        except AnalysisException:
            return None

    kept = scratch.materialise(spark.range(3), "kept")
    with scratch.scratch_scope():
        inside = scratch.materialise(spark.range(4), "inside")
        assert there(inside) == 4
    assert there(inside) is None and there(kept) == 3
    scratch.release(kept)
    assert there(kept) is None
