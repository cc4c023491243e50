"""Queries of readers, writers and staging: files are written from the tables to the shared folder and read back."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import profile, relational
from ..sources import readers, writers
from ..sources.collected import collect_map, from_pandas, to_pandas
from ..sources.scratch import scratch_path
from .registry import query
from .staging import HOLDINGS_JOINS, HOLDINGS_UNIONS, holdings_files, stage_holdings, stage_register


def _folder(df: DataFrame, name: str) -> str:
    return scratch_path(df.sparkSession, name)


@query("SELECT c_custkey::VARCHAR AS id, c_name AS name, c_mktsegment AS segment FROM customer")
def headerless_tsv(read):
    df = read("customer").select("c_custkey", "c_name", "c_mktsegment")
    path = _folder(df, "tsv")
    df.write.csv(path, sep="\t")
    return readers.read_headerless(df.sparkSession, path, ["id", "name", "segment"])


@query("SELECT p_partkey::VARCHAR AS p_partkey, p_name, nullif(p_brand, 'Brand#4') AS p_brand FROM part")
def csv_with_header(read):
    df = read("part").select("p_partkey", "p_name", F.nullif("p_brand", F.lit("Brand#4")).alias("p_brand"))
    path = _folder(df, "csv")
    writers.write_table(df, "csv", path)
    return readers.read_table(df.sparkSession, path, "csv")


@query("SELECT p_partkey, p_name FROM part")
def csv_with_schema(read):
    df = read("part").select("p_partkey", "p_name")
    path = _folder(df, "csv")
    writers.write_table(df, "csv", path, single_file=True)
    return readers.read_table(df.sparkSession, path, "csv", "p_partkey long, p_name string")


@query("SELECT o_orderkey, o_orderpriority, CASE WHEN o_orderkey % 3 > 0 THEN o_custkey END AS o_custkey FROM orders")
def json_lines(read):
    df = read("orders").select("o_orderkey", "o_orderpriority", F.when(F.col("o_orderkey") % 3 > 0, F.col("o_custkey")).alias("o_custkey"))
    path = _folder(df, "json")
    writers.write_table(df, "json", path)
    return readers.read_table(df.sparkSession, path, "json")


@query("SELECT 'refused' AS step, r_regionkey AS key, r_name AS name FROM region UNION ALL SELECT 'overwritten', n_nationkey, n_name FROM nation UNION ALL SELECT 'appended', n_nationkey, n_name FROM nation UNION ALL SELECT 'appended', r_regionkey, r_name FROM region")
def parquet_modes(read):
    """A second write is refused by default, and overwrites or appends where asked to."""
    region, nation = (read(t).select(F.col(f"{t[0]}_{t}key").alias("key"), F.col(f"{t[0]}_name").alias("name")) for t in ("region", "nation"))
    spark, out = region.sparkSession, []
    for step, mode in (("refused", "errorifexists"), ("overwritten", "overwrite"), ("appended", "append")):
        path = _folder(region, "modes")
        writers.write_parquet(region, path)
        try:
            writers.write_parquet(nation, path, mode)
        except AnalysisException:
            if mode != "errorifexists":
                raise
        out.append(readers.read_table(spark, path).select(F.lit(step).alias("step"), "key", "name"))
    return relational.union_all(*out)


@query("SELECT c_custkey::VARCHAR AS k, c_name AS v FROM customer")
def repeated_headers(read):
    """Lines of one file whose header comes again within it."""
    df = read("customer")
    line = F.concat_ws("|", F.col("c_custkey").cast("string"), "c_name")
    path = _folder(df, "lines")
    lines = df.coalesce(1).sortWithinPartitions("c_custkey").select(F.explode(F.when(F.col("c_custkey") % 100 == 0, F.array(F.lit("k|v"), line)).otherwise(F.array(line))).alias("value"))
    lines.write.text(path)
    return readers.read_delimited(df.sparkSession, path, "|")


@query("SELECT DISTINCT n_regionkey::VARCHAR AS region FROM nation")
def files_by_extension(read):
    df = read("nation")
    path = _folder(df, "files")
    df.withColumn("region", F.col("n_regionkey")).write.partitionBy("region").csv(path)
    read("region").write.mode("append").json(path)
    found = readers.list_files(df.sparkSession, path, "csv").select(F.regexp_extract("path", r"region=(\d+)/", 1).alias("region"))
    return found.distinct()


@query("SELECT s_suppkey::VARCHAR AS s_suppkey, s_name FROM supplier")
def csv_files_together(read):
    df = read("supplier").select("s_suppkey", "s_name")
    paths = [_folder(df, "part") for _ in range(3)]
    for k, path in enumerate(paths):
        writers.write_table(df.where(F.col("s_suppkey") % 3 == k), "csv", path)
    return readers.read_csv_files(df.sparkSession, paths)


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation")
def pandas_round_trip(read):
    df = read("nation")
    return from_pandas(df.sparkSession, to_pandas(df, 1000), "n_nationkey int, n_name string, n_regionkey int")


@query("SELECT n_name, r_name FROM nation LEFT JOIN region ON n_regionkey = r_regionkey")
def collected_lookup(read):
    """A small table as a map on the driver, and back as a literal."""
    names = collect_map(read("region"), "r_regionkey", "r_name")
    cells = F.create_map(*(F.lit(x) for pair in sorted(names.items()) for x in pair))
    return read("nation").select("n_name", cells[F.col("n_regionkey")].alias("r_name"))


@query("WITH counts AS (SELECT p_type, count(*) AS count FROM part GROUP BY 1) SELECT p_type, count, repeat('#', round(count / (SELECT max(count) FROM counts) * 40)::INTEGER) AS bar FROM counts")
def frequency_bars(read):
    return profile.bars(relational.value_counts(read("part"), "p_type"), "count")


# Staging


@query("""
    SELECT p_partkey::VARCHAR AS id, p_name AS idbr_name, p_size::VARCHAR AS sic, p_brand AS esa, NULL::DATE AS death_date FROM part WHERE p_size % 2 = 0
    UNION ALL SELECT p_partkey::VARCHAR, p_name, p_size::VARCHAR, p_brand, CASE WHEN p_partkey % 5 > 0 THEN DATE '2015-12-11' + p_size END FROM part WHERE p_size % 2 = 1""")
def staged_register(read):
    part = read("part")
    columns = [F.col("p_partkey").alias("id"), F.col("p_name").alias("idbr_name"), F.col("p_size").alias("sic"), F.col("p_brand").alias("esa")]
    died = F.concat(F.lit(" "), F.date_format(F.date_add(F.lit("2015-12-11").cast("date"), F.col("p_size")), "dd/MM/yyyy"), F.lit(" "))
    live, dead = _folder(part, "live"), _folder(part, "dead")
    part.where("p_size % 2 = 0").select(*columns).write.csv(live, sep="\t")
    part.where("p_size % 2 = 1").select(*columns, F.when(F.col("p_partkey") % 5 == 0, "31/31/2015").otherwise(died).alias("death_date")).write.csv(dead, sep="\t")
    return stage_register(part.sparkSession, live, dead, _folder(part, "register"))


def _raw_holdings(read) -> str:
    """The eight raw inputs of the holdings table, as files below one folder."""
    orders = read("orders")
    raw = _folder(orders, "raw")
    key = lambda c: F.col(c).cast("string")
    rows = orders.select(key("o_orderkey").alias("Holding"), key("o_custkey").alias("Owner_ID"), (F.col("o_custkey") % 60).cast("string").alias("Security_ID"), F.date_format("o_orderdate", "yyyy").alias("Quarter"), F.substring("o_orderpriority", 1, 1).alias("Style_ID"), F.col("o_orderstatus").alias("Owner_Type_ID"), F.col("o_orderkey").alias("Value_Held"))
    rows.where("Value_Held % 2 = 0").write.json(f"{raw}/Consolidated_Funds_Holdings_History")
    rows.where("Value_Held % 2 = 1").write.json(f"{raw}/Mutual_Funds_Holdings_History")
    writers.write_table(read("customer").where("c_custkey % 4 > 0").select(key("c_custkey").alias("Owner_ID"), F.col("c_name").alias("Owner_Name"), key("c_nationkey").alias("Country_ID"), F.lit("x").alias("Report_Date")), "csv", f"{raw}/Owner_History")
    nation = read("nation")
    writers.write_table(nation.select(F.concat(F.lit("u"), "n_nationkey").alias("Instrument_ID"), F.col("n_name").alias("Exchange_Listed_Flag"), F.lit(1).alias("Else")), "csv", f"{raw}/Exchange_Listed")
    writers.write_table(read("orders").select(F.col("o_orderstatus").alias("Owner_Type_ID"), F.concat(F.lit("type "), "o_orderstatus").alias("Description")).distinct(), "csv", f"{raw}/Owner_Type")
    writers.write_table(read("region").where("r_regionkey > 0").select(key("r_regionkey").alias("Style_ID"), F.col("r_name").alias("Style_Description")), "csv", f"{raw}/Investment_Style")
    nation.select(F.concat(F.lit("u"), "n_nationkey").alias("isin_f"), F.upper("n_name").alias("lookup")).write.parquet(f"{raw}/EOD_History_Lookup")
    issued = nation.crossJoin(F.broadcast(read("orders").select(F.date_format("o_orderdate", "yyyy").alias("Trade_Date")).distinct()))  # a row to a year
    name = lambda c: F.concat(F.lit(f"{c} "), "n_nationkey")
    issued.select(key("n_nationkey").alias("Security_ID"), name("i").alias("Issuer_Name"), F.concat(F.lit("u"), "n_nationkey").alias("UID"), *(name(c).alias(c) for c in ("Industry_Description", "Sector_Description", "LET_Desc", "Listed")), "Trade_Date", name("c").alias("Security_Class"), F.col("n_nationkey").alias("Mkt_Cap_USD"), F.col("n_regionkey").alias("Shares_Outstanding"), F.lit("dropped").alias("Else")).write.parquet(f"{raw}/Equity_Issuance_All")
    return raw


@query("""
    SELECT o_orderkey::VARCHAR AS Holding, o_custkey::VARCHAR AS Owner_ID, (o_custkey % 60)::VARCHAR AS Security_ID, strftime(o_orderdate, '%Y') AS Quarter,
           substr(o_orderpriority, 1, 1) AS Style_ID, o_orderstatus AS Owner_Type_ID, o_orderkey AS Value_Held, c_name AS Owner_Name, c_nationkey::VARCHAR AS Owner_Country_ID,
           'i ' || n_nationkey AS Issuer_Name, 'u' || n_nationkey AS UID, 'c ' || n_nationkey AS Security_Class, n_nationkey AS Mkt_Cap_USD, upper(n_name) AS lookup,
           n_name AS Exchange_Listed_Flag, r_name AS Style_Description, 'type ' || o_orderstatus AS Owner_Type
    FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 4 > 0) ON o_custkey = c_custkey LEFT JOIN nation ON o_custkey % 60 = n_nationkey
    LEFT JOIN (SELECT * FROM region WHERE r_regionkey > 0) ON substr(o_orderpriority, 1, 1) = r_regionkey::VARCHAR""")
def staged_holdings(read):
    raw = _raw_holdings(read)
    spark = read("orders").sparkSession
    staged = stage_holdings(spark, holdings_files(raw), HOLDINGS_UNIONS, HOLDINGS_JOINS, f"{raw}/staged")
    return staged.select("Holding", "Owner_ID", "Security_ID", "Quarter", "Style_ID", "Owner_Type_ID", "Value_Held", "Owner_Name", "Owner_Country_ID", "Issuer_Name", "UID", "Security_Class", "Mkt_Cap_USD", "lookup", "Exchange_Listed_Flag", "Style_Description", "Owner_Type")


# Sizes, positions


@query("SELECT (SELECT count(*) FROM part) AS n_rows, 6 AS n_columns")
def table_shape(read):
    df = read("part")
    rows, columns = profile.shape(df)
    return df.sparkSession.createDataFrame([(rows, columns)], "n_rows long, n_columns int")


@query("""SELECT sum(strlen('{"r_regionkey":' || r_regionkey || ',"r_name":"' || r_name || '"}'))::DOUBLE AS bytes FROM region""")
def table_bytes(read):
    df = read("region")
    return df.sparkSession.createDataFrame([(profile.estimated_bytes(df, 1.0),)], "bytes double")


@query("SELECT c_custkey, c_name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier")
def union_by_position(read):
    return relational.union_by_position(read("customer").select("c_custkey", "c_name"), read("supplier").select("s_suppkey", "s_name"))


@query("SELECT row_number() OVER (ORDER BY o_orderpriority, o_orderkey) - 1 AS row_id, o_orderpriority, o_orderkey FROM orders")
def surrogate_ids(read):
    return relational.row_ids(read("orders").select("o_orderpriority", "o_orderkey"), ["o_orderpriority"])
