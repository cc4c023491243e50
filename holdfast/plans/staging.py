"""From raw files to the staged register and holdings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import parse_date
from ..operators.relational import join_chain, union_all
from ..sources.readers import read_extract, read_headerless
from ..sources.writers import write_parquet
from ..specs import ExtractSpec, JoinSpec

REGISTER = ("id", "idbr_name", "sic", "esa")


def stage_register(spark: SparkSession, live: str, dead: str, out: str | None = None, mode: str = "errorifexists") -> DataFrame:
    """The live and dead businesses of two headerless files; a death date that is no date becomes null."""
    alive = read_headerless(spark, live, REGISTER).withColumn("death_date", F.lit(None).cast("string"))
    both = union_all(alive, read_headerless(spark, dead, (*REGISTER, "death_date")))
    staged = both.withColumn("death_date", parse_date(F.col("death_date")))
    if out:
        write_parquet(staged, out, mode)
    return staged


def stage_holdings(spark: SparkSession, files: dict[str, ExtractSpec], unions: dict[str, Sequence[str]], joins: Sequence[JoinSpec], out: str | None = None, mode: str = "errorifexists") -> DataFrame:
    """Extract each file, unite those listed under a new name, and left-join the chain."""
    frames = {name: read_extract(spark, spec) for name, spec in files.items()}
    for name, parts in unions.items():
        frames[name] = union_all(*(frames[p] for p in parts))
    staged = join_chain(frames, joins)
    if out:
        write_parquet(staged, out, mode)
    return staged


def holdings_files(raw: str) -> dict[str, ExtractSpec]:
    """The eight inputs of the holdings table below a folder."""
    issued = ("Security_ID", "Issuer_Name", "UID", "Industry_Description", "Sector_Description", "LET_Desc", "Listed", "Trade_Date", "Security_Class", "Mkt_Cap_USD", "Shares_Outstanding")
    return {
        "consolidated": ExtractSpec(f"{raw}/Consolidated_Funds_Holdings_History", "json", drop=("_corrupt_record",)),
        "mutual": ExtractSpec(f"{raw}/Mutual_Funds_Holdings_History", "json"),
        "owners": ExtractSpec(f"{raw}/Owner_History", "csv", drop=("Report_Date",), rename={"Country_ID": "Owner_Country_ID"}),
        "listed": ExtractSpec(f"{raw}/Exchange_Listed", "csv", select=("Instrument_ID", "Exchange_Listed_Flag"), rename={"Instrument_ID": "UID"}),
        "owner_types": ExtractSpec(f"{raw}/Owner_Type", "csv", rename={"Description": "Owner_Type"}),
        "styles": ExtractSpec(f"{raw}/Investment_Style", "csv"),
        "lookup": ExtractSpec(f"{raw}/EOD_History_Lookup", "parquet", rename={"isin_f": "UID"}),
        "equity": ExtractSpec(f"{raw}/Equity_Issuance_All", "parquet", select=issued, rename={"Trade_Date": "Quarter"}),
    }


HOLDINGS_UNIONS = {"holdings": ("consolidated", "mutual")}
HOLDINGS_JOINS = (JoinSpec("holdings"), JoinSpec("owners", ("Owner_ID",)), JoinSpec("equity", ("Security_ID", "Quarter")), JoinSpec("lookup", ("UID",)), JoinSpec("listed", ("UID",)), JoinSpec("styles", ("Style_ID",)), JoinSpec("owner_types", ("Owner_Type_ID",)))
