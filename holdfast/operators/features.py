"""Per-owner features from transaction rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import contains_flags, date_parts, quoted, sanitise_columns
from ..sources.collected import bounded
from ..specs import FeatureSpec
from .quantiles import MIDDLE, lower, quantiles
from .relational import fold_categories, fold_shares, one_row_per

NULL_NAME = "Null"
#: Most values of all categorical columns together; each becomes a column.
MOST_VALUES = 10_000


def categories(df: DataFrame, columns: Sequence[str], null_as: str | None = NULL_NAME, most: int = MOST_VALUES) -> dict[str, list[str]]:
    """The sorted values of each column, in one job; an error if there are more than `most` in all."""
    cells = F.array(*(F.struct(F.lit(c).alias("column"), (F.coalesce(F.col(c).cast("string"), F.lit(null_as)) if null_as else F.col(c).cast("string")).alias("value")) for c in columns))
    found: dict[str, list[str]] = {c: [] for c in columns}
    for r in bounded(df.select(F.explode(cells).alias("cell")).select("cell.*").where("value is not null").distinct(), most, "categories"):
        found[r["column"]].append(r.value)
    return {c: sorted(v) for c, v in found.items()}


def dummies(df: DataFrame, columns: Sequence[str], null_as: str | None = NULL_NAME, keep: bool = True, sep: str = "/", found: dict[str, list[str]] | None = None) -> tuple[DataFrame, list[str]]:
    """df with a 0/1 column <column><sep><value> per value (found: known already), in one projection; null is a value of its own or, with null_as=None, zero throughout."""
    found = found or categories(df, columns, null_as)
    filled = {c: F.coalesce(F.col(c).cast("string"), F.lit(null_as)) if null_as else F.col(c).cast("string") for c in columns}
    new = {f"{c}{sep}{v}": F.coalesce((filled[c] == v).cast("int"), F.lit(0)) for c in columns for v in found[c]}
    rest = [(filled[c].alias(c) if c in columns and null_as else F.col(f"`{c}`")) for c in df.columns if keep or c not in columns]
    return df.select(*rest, *(x.alias(n) for n, x in new.items())), list(new)


def dynamic_features(df: DataFrame, spec: FeatureSpec = FeatureSpec()) -> DataFrame:
    """Per owner: the row count, mean and sum of each dummy, mean, sum, min and max of each number; all doubles.

    One aggregation serves them all. Rows without an owner count for the folding
    of categories but form no owner.
    """
    rows = df.select(spec.id_col, *spec.dynamic_date, *spec.dynamic_categorical, *(F.col(c).try_cast("double").alias(c) for c in spec.dynamic_numerical))
    numbers = list(spec.dynamic_numerical)
    for c in spec.dynamic_date:
        parts = date_parts(F.col(c), f"{c}_" if len(spec.dynamic_date) > 1 else "")
        rows = rows.withColumns(parts).drop(c)
        numbers += list(parts)
    rows, values, nulls = fold_shares(rows, spec.dynamic_categorical, spec.fold_share)
    rows, flags = dummies(rows, spec.dynamic_categorical, found={c: sorted({*v, *([NULL_NAME] if c in nulls else [])}) for c, v in values.items()})
    functions = {"avg": F.avg, "sum": F.sum, "min": F.min, "max": F.max}
    wanted = [(n, f) for f in ("avg", "sum") for n in flags] + [(n, f) for f in functions for n in numbers]
    out = [functions[f](quoted(n)).cast("double").alias(f"{f}({n})") for n, f in wanted]
    return rows.where(F.col(spec.id_col).isNotNull()).groupBy(spec.id_col).agg(F.count("*").cast("double").alias("count"), *out)


def static_features(df: DataFrame, spec: FeatureSpec = FeatureSpec()) -> DataFrame:
    """One row per owner: keyword flags of the name, categories folded over owners, numbers as doubles."""
    rows = one_row_per(df.select(*spec.static_text, *spec.static_categorical, *spec.static_numerical, spec.id_col), [spec.id_col])
    flags = contains_flags(F.col(spec.static_text[0]), spec.keywords, spec.lower_keywords) if spec.static_text else {}
    rows = fold_categories(rows.withColumns(flags) if flags else rows, spec.static_categorical, spec.fold_share)
    return rows.withColumns({c: F.col(c).try_cast("double") for c in spec.static_numerical}) if spec.static_numerical else rows


def narrowest(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, type): for each numeric column the narrowest type that holds its values as they are, in one pass; of empty columns their own."""
    fields = {f.name: f.dataType for f in df.schema if isinstance(f.dataType, T.NumericType) and (columns is None or f.name in columns)}
    whole = {c: t for c, t in fields.items() if isinstance(t, T.IntegralType)}
    real = {c: t for c, t in fields.items() if isinstance(t, T.DoubleType)}
    sums = [x for c in whole for x in (F.min(quoted(c).cast("long")).alias(f"min {c}"), F.max(quoted(c).cast("long")).alias(f"max {c}"))]
    sums += [F.max(quoted(c).cast("float").cast("double") != quoted(c)).alias(f"loses {c}") for c in real]
    one = df.agg(F.count("*"), *sums)

    def kind(c: str) -> Column:
        own = F.lit(fields[c].simpleString())
        if c in whole:
            out = own
            for name, bits in (("int", 31), ("smallint", 15), ("tinyint", 7)):
                out = F.when((quoted(f"min {c}") >= -(1 << bits)) & (quoted(f"max {c}") < 1 << bits), F.lit(name)).otherwise(out)
            return out
        return F.when(~quoted(f"loses {c}"), F.lit("float")).otherwise(own) if c in real else own

    cells = [F.struct(F.lit(c).alias("column"), kind(c).alias("type")) for c in fields]
    return one.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")


def downcast(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """df with its numeric columns in their narrowest types."""
    kinds = {r["column"]: r["type"] for r in narrowest(df, columns).collect()}  # a row to a column
    return df.withColumns({c: quoted(c).cast(t) for c, t in kinds.items()})


def impute_medians(df: DataFrame, columns: Sequence[str], interpolated: bool = False) -> DataFrame:
    """df with nulls and NaNs of the columns replaced by the median: the lower one or, interpolated, the mean of the middle two; doubles."""
    names = df.columns
    known = {c: F.when(~F.isnan(quoted(c).cast("double")), quoted(c).cast("double")) for c in columns}
    for c, x in known.items():
        cuts = quantiles(df, x, MIDDLE if interpolated else [lower(0.5)]).select("__cuts")
        middle = F.col("__cuts")[0] / 2 + F.col("__cuts")[1] / 2 if interpolated else F.col("__cuts")[0]
        df = df.crossJoin(F.broadcast(cuts.select(middle.alias(f"__median {c}"))))  # one row
    return df.select(*((F.coalesce(known[c], quoted(f"__median {c}")).alias(c) if c in known else quoted(c)) for c in names))


def feature_table(df: DataFrame, labels: DataFrame, spec: FeatureSpec = FeatureSpec()) -> DataFrame:
    """Static and dynamic features and the folded label (null: to be predicted), under plain column names."""
    folded = fold_categories(labels, [spec.target], spec.fold_labels_below, concat=True)
    joined = static_features(df, spec).join(dynamic_features(df, spec), spec.id_col, "left").join(folded, spec.id_col, "left")
    return sanitise_columns(joined)
