"""Owners that hold most of the total value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.scratch import materialise
from .relational import one_row_per


#: Numbers that this type holds as they are, most sums of money, are summed in it; the sums leave room for 10^10 of them.
EXACT = "decimal(28,12)"


def exact_sum(x: Column) -> Column:
    """The sum of doubles: whatever the order of the rows, equal values give equal sums, as far as EXACT holds them; the others are added as doubles."""
    held = x.try_cast(EXACT)
    whole = F.coalesce(held.cast("double") == x, F.lit(False))
    exact, rest = F.sum(F.when(whole, held)).cast("double"), F.sum(F.when(~whole, x))
    return F.when(rest.isNull(), exact).otherwise(rest + F.coalesce(exact, F.lit(0.0)))


def owner_totals(holdings: DataFrame, owner: str = "Owner_ID", value: str = "Value_Held") -> DataFrame:
    """(owner, value): the sum of the values that are numbers; equal holdings have equal sums, so that they rank alike."""
    return holdings.select(owner, F.col(value).try_cast("double").alias("value")).groupBy(owner).agg(exact_sum(F.col("value")).alias("value"))


def ranked_totals(totals: DataFrame, owner: str, metric: str, maxval: float) -> DataFrame:
    """totals with share, cumsum_share and rank, as far as the metric allows.

    By rank, only the top of each task's rows is ordered together. By cumulative
    share, rows are split by ranges of the order; each range's sum, one row a range,
    goes ahead of the running sums of the ranges after it, so no task orders all
    owners.
    """
    total = totals.agg(exact_sum(F.col("value")).alias("__total"))
    shares = totals.crossJoin(total).select(owner, "value", F.try_divide("value", "__total").alias("share"))
    order = [F.desc("share"), F.col(owner)]
    if metric == "rank":
        top = shares.withColumn("rank", F.rank().over(Window.orderBy(F.desc("share")))).where(F.col("rank") <= maxval)
        running = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return top.select(owner, "value", "share", F.sum("share").over(running).alias("cumsum_share"), "rank")
    if metric != "cumsum_share":
        raise ValueError(f"metric is rank or cumsum_share, not {metric!r}")
    ranged = materialise(shares.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()), "ranged")
    parts = ranged.groupBy("__part").agg(F.sum("share").alias("__sum"), F.count("*").alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = parts.select(F.col("__part").alias("__p"), F.sum("__sum").over(before).alias("__sum_before"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__n_before"))
    inside = Window.partitionBy("__part").orderBy(*order)
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = ranged.select("*", F.sum("share").over(running).alias("__run"), F.row_number().over(inside).alias("__row")).join(ahead, F.col("__part") == F.col("__p"))
    summed = F.when(F.col("__run").isNull(), F.col("__sum_before")).otherwise(F.col("__run") + F.coalesce("__sum_before", F.lit(0.0)))
    placed = placed.select(owner, "value", "share", summed.alias("cumsum_share"), (F.col("__row") + F.col("__n_before")).alias("__place"))
    ranks = placed.groupBy("share").agg(F.min("__place").cast("int").alias("rank")).withColumnRenamed("share", "__share")
    kept = placed.where(F.col("cumsum_share") <= maxval)
    return kept.join(ranks, kept["share"].eqNullSafe(ranks["__share"])).select(owner, "value", "share", "cumsum_share", "rank")


def big_players(holdings: DataFrame, owner_cols: list[str], metric: str = "rank", maxval: float = 10, owner: str = "Owner_ID", value: str = "Value_Held") -> DataFrame:
    """The owners within the cut, their figures and their owner columns."""
    totals = materialise(owner_totals(holdings, owner, value), "totals")  # so that the grand total takes no second pass over the holdings
    found = ranked_totals(totals, owner, metric, maxval)
    info = one_row_per(holdings.select(*owner_cols), [owner])
    return found.join(info, owner, "left")


def without(holdings: DataFrame, players: DataFrame, owner: str = "Owner_ID") -> DataFrame:
    """The holdings of all other owners."""
    return holdings.join(players.select(owner), owner, "left_anti")


def concentration_cut(holdings: DataFrame, owner_cols: list[str], metric: str = "rank", maxval: float = 10, owner: str = "Owner_ID", value: str = "Value_Held") -> tuple[DataFrame, DataFrame]:
    """(the rest of the holdings, the big players)."""
    players = materialise(big_players(holdings, owner_cols, metric, maxval, owner, value), "players")
    return without(holdings, players, owner), players
