"""Labelling from staged tables to recommendations, from any stage on."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..operators.concentration import concentration_cut
from ..operators.features import feature_table
from ..operators.linkage import clean_holdings, clean_register, link, recommend
from ..operators.model import label_by_model
from ..operators.relational import split_unique
from ..sources.scratch import materialise
from ..specs import PASSES, FeatureSpec, HoldingsSpec, LinkPass, ModelSpec, RegisterSpec

STAGES = ("link", "features", "model", "recommend")


@dataclass(frozen=True)
class PipelineSpec:
    register: RegisterSpec = RegisterSpec()
    holdings: HoldingsSpec = HoldingsSpec()
    metric: str = "rank"
    maxval: float = 10
    passes: Sequence[LinkPass] = PASSES
    features: FeatureSpec = field(default_factory=FeatureSpec)
    model: ModelSpec = ModelSpec()


def label_by_name(register: DataFrame, holdings: DataFrame, spec: PipelineSpec = PipelineSpec()) -> dict[str, DataFrame]:
    """The register left over, ids of several names, big players, the other holdings, and labels found by name."""
    clean = clean_register(register, spec.register)
    rows, repeated = clean_holdings(holdings, spec.holdings)
    rows = materialise(rows, "scope")
    rows, players = concentration_cut(rows, list(spec.holdings.owner_cols), spec.metric, spec.maxval)
    owners = split_unique(rows.select("Owner_ID", "Owner_Name").distinct(), "Owner_Name")
    rest, labels = link(clean, owners, spec.passes)
    return {"idbr": rest, "ids_dups": repeated, "bp": players, "tr": rows, "labels": labels}


def run(spark: SparkSession, folder: str, spec: PipelineSpec = PipelineSpec(), from_stage: str = "link") -> dict[str, DataFrame]:
    """Read the staged register and holdings below folder, and write each stage's tables there; earlier stages are read back."""

    def keep(tables: dict[str, DataFrame]) -> None:
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(f"{folder}/{name}")

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}")

    start = STAGES.index(from_stage)
    if start <= 0:
        keep(label_by_name(table("register"), table("holdings"), spec))
    if start <= 1:
        keep({"df": feature_table(table("tr"), table("labels"), spec.features)})
    if start <= 2:
        sure, rest, _ = label_by_model(table("df"), spec.model)
        keep({"ml_labels": sure, "manual_labels": rest})
    with_, without_ = recommend(table("manual_labels"), table("tr"), table("idbr"), spec.holdings.owner_cols)
    keep({"mlabels_rm": with_, "mlabels_no_rm": without_})
    names = ("idbr", "ids_dups", "bp", "tr", "labels", "df", "ml_labels", "manual_labels", "mlabels_rm", "mlabels_no_rm")
    return {n: table(n) for n in names}
