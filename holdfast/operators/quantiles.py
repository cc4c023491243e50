"""Exact quantiles of large groups."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.scratch import materialise, release

#: Accuracy of the sketch that brackets a quantile, and the share of rows on either side that the bracket spans: 20 times the sketch's error.
ACCURACY, MARGIN = 10_000, 0.002

#: A share of the rows, and the rank from 1 that it means among n rows.
Rank = tuple[float, Callable[[Column], Column]]


def lower(share: float) -> Rank:
    """The smallest value that at least this share of the rows does not exceed."""
    return share, lambda n: F.greatest(F.lit(1), n - F.floor(n - n * F.lit(float(share))))


#: The two ranks whose mean is the interpolated median; of an odd number of rows they are one.
MIDDLE: tuple[Rank, Rank] = ((0.5, lambda n: F.floor((n + 1) / 2)), (0.5, lambda n: F.floor(n / 2) + 1))


def _found(rows: DataFrame, brackets: DataFrame) -> DataFrame:
    """(class, k, at): the value at each rank; at is null where the rank lies outside its bracket."""
    marked = rows.join(brackets.select("__class", "__wanted"), rows["__group"].eqNullSafe(brackets["__class"]))
    near = marked.select("__class", "__value", F.explode(F.filter("__wanted", lambda w: F.col("__value") <= w["high"])).alias("w"))
    counts = near.groupBy("__class", "w.k", "w.rank", F.when(F.col("__value") >= F.col("w.low"), F.col("__value")).alias("__value")).agg(F.count("*").alias("__n"))
    running = Window.partitionBy("__class", "k").orderBy(F.asc_nulls_first("__value")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = counts.withColumn("__upto", F.sum("__n").over(running)).where(F.col("__upto") >= F.col("rank"))
    return upto.groupBy("__class", "k").agg(F.min_by("__value", "__upto").alias("at"))


def quantiles(df: DataFrame, value: Column, ranks: Sequence[Rank], group: Column | None = None) -> DataFrame:
    """(__class, __cuts): for each group, null among them, the values at the ranks, in their order; nulls do not count, of none the cuts are null.

    A sketch gives each rank a bracket. Values below it are counted and those
    within, some thousandths of the group, are counted by value and put in order, so no
    task orders a group. Should a rank lie outside its bracket, that group is searched whole.
    """
    rows = df.select((F.lit(0) if group is None else group).alias("__group"), value.alias("__value"))
    shares = [min(max(s + m, 0.0), 1.0) for s, _ in ranks for m in (-MARGIN, MARGIN)]
    sketch = [F.count("__value").alias("__n"), F.percentile_approx("__value", shares, ACCURACY).alias("__near"), F.min("__value").alias("__min"), F.max("__value").alias("__max")]
    sketched = rows.agg(F.lit(0).alias("__class"), *sketch) if group is None else rows.groupBy(F.col("__group").alias("__class")).agg(*sketch)

    def wanted(low: Callable[[int], Column], high: Callable[[int], Column]) -> Column:
        return F.array(*(F.struct(F.lit(k).alias("k"), rank(F.col("__n")).cast("long").alias("rank"), low(k).alias("low"), high(k).alias("high")) for k, (_, rank) in enumerate(ranks)))

    known = materialise(sketched, "sketched")
    brackets = known.withColumn("__wanted", wanted(lambda k: F.col("__near")[2 * k], lambda k: F.col("__near")[2 * k + 1]))
    found = materialise(_found(rows, brackets), "quantiles")
    hit = found.where("at is not null").groupBy("__class").agg(F.count("*").alias("hits"))
    missed = known.join(hit, known["__class"].eqNullSafe(hit["__class"]), "left").where((F.col("__n") > 0) & (F.coalesce("hits", F.lit(0)) < len(ranks))).select(known["__class"], "__n", "__min", "__max")
    if not missed.isEmpty():
        again = missed.withColumn("__wanted", wanted(lambda k: F.col("__min"), lambda k: F.col("__max")))
        first = found
        rest = first.join(missed.select(F.col("__class").alias("__again")), first["__class"].eqNullSafe(F.col("__again")), "left_anti")
        found = materialise(rest.unionByName(_found(rows, again)), "quantiles")
        release(first)
    cuts = found.groupBy(F.col("__class").alias("__of")).agg(F.array(*(F.max(F.when(F.col("k") == k, F.col("at"))) for k in range(len(ranks)))).alias("__cuts"))
    out = materialise(known.join(cuts, known["__class"].eqNullSafe(cuts["__of"]), "left").select("__class", F.coalesce("__cuts", F.array(*[F.lit(None).cast(rows.schema["__value"].dataType)] * len(ranks))).alias("__cuts")), "cuts")
    release(known, found)
    return out
