"""Matching owners to a register by normalised names."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import first_contained, key128
from ..functions.similarity import BATTERY, score_pairs
from ..functions.text import all_tokens, chosen, normalise, top_words
from ..sources.scratch import materialise, release
from ..specs import PASSES, RECOMMEND, HoldingsSpec, LinkPass, RegisterSpec, TextSpec
from .relational import one_row_per, split_duplicates, split_unique


def clean_register(register: DataFrame, spec: RegisterSpec = RegisterSpec()) -> DataFrame:
    """(idbr_name, esa) of the businesses alive after the cutoff whose name stands for one sector code."""
    alive = register.where((F.col("death_date") > F.lit(spec.min_death_date).cast("date")) | F.col("death_date").isNull())
    coded = alive.select("idbr_name", first_contained(F.col("esa"), spec.codes).alias("esa")).dropna()
    return split_unique(coded.distinct(), "idbr_name")


def within_scope(holdings: DataFrame, spec: HoldingsSpec = HoldingsSpec(), country: str = "Owner_Country_ID", date: str = "Report_Date") -> DataFrame:
    """Holdings of the countries and dates of the spec, less individual investors (and, with them, unknown types)."""
    rows = holdings.where(F.col(country).isin(list(spec.countries)) & F.col(date).cast("date").between(F.lit(spec.start_date).cast("date"), F.lit(spec.end_date).cast("date")))
    return rows if spec.individuals else rows.where(F.col("Owner_Type") != "Individual Investor")


def clean_holdings(holdings: DataFrame, spec: HoldingsSpec = HoldingsSpec()) -> tuple[DataFrame, DataFrame]:
    """(holdings of owners known by one name, owner rows of ids with several names)."""
    rows = within_scope(holdings, spec)
    known = rows.select(*spec.owner_cols).dropna(subset=list(spec.required_cols or spec.owner_cols))
    owners = one_row_per(known, ["Owner_ID", "Owner_Name"])
    good = split_unique(owners, "Owner_ID").select("Owner_ID")
    return rows.join(good, "Owner_ID", "left_semi"), split_duplicates(owners, "Owner_ID")


def name_forms(df: DataFrame, column: str, steps: Sequence[LinkPass], *keep: Column) -> DataFrame:
    """A narrow row for each name: what to keep and, for each step i, a<i>, b<i>, the hash of its normalised form (null: none), and n<i>, its tokens.

    Steps that differ only in the tokens they choose share one tokenisation.
    """
    names = [f"__name{i}" for i in range(len(steps))]
    bases = [replace(s.text, min_token_length=1, remove_stopwords=False, extra_stopwords=(), sort_tokens=False) for s in steps]
    first = [bases.index(x) for x in bases]
    words = df.select(*keep, *(all_tokens(F.col(column), bases[i]).alias(f"__words{i}") for i in sorted(set(first))))
    kept = words.columns[: len(keep)]
    chosen_ = words.select(*kept, *(chosen(F.col(f"__words{i}"), s.text).alias(n) for n, i, s in zip(names, first, steps)))
    cells = [x for i, n in enumerate(names) for x in (*(F.when(F.col(n).isNotNull(), h).alias(f"{c}{i}") for c, h in zip("ab", key128(F.col(n)))), F.size(n).alias(f"n{i}"))]
    return chosen_.select(*kept, *cells)


def _pass(register: DataFrame, right: DataFrame, left: DataFrame, i: int, least: int, linked: DataFrame | None) -> DataFrame:
    """(Owner_ID, esa, idbr_name) of the names that are unique on both sides and equal in the form of step i."""
    names = key128(F.col("idbr_name"))
    form = [F.col(f"a{i}").alias("a"), F.col(f"b{i}").alias("b")]
    right, left = right.where(f"a{i} is not null").select("k", "l", "esa", *form, F.col(f"n{i}").alias("n")), left.where(f"a{i} is not null").select("Owner_ID", *form)
    if linked is not None:
        gone = linked.select(*(c.alias(n) for c, n in zip(names, "kl")))
        right = right.join(gone, ["k", "l"], "left_anti")
        left = left.join(linked.select("Owner_ID"), "Owner_ID", "left_anti")
    sector = F.struct("esa")
    forms = right.groupBy("a", "b").agg(F.min(sector).alias("least"), F.max(sector).alias("most"), F.max("n").alias("n"))
    forms = forms.where(F.col("least").eqNullSafe(F.col("most")) & (F.col("n") >= least)).select("a", "b", F.col("least.esa").alias("esa"))
    single = left.groupBy("a", "b").agg(F.count("*").alias("rows"), F.first("Owner_ID").alias("Owner_ID")).where("rows = 1").drop("rows")
    keys = right.select("k", "l", "a", "b").join(single.join(forms, ["a", "b"]), ["a", "b"]).distinct()
    texts = register.select("idbr_name", *(c.alias(n) for c, n in zip(names, "kl"))).join(keys, ["k", "l"])
    return texts.groupBy("a", "b").agg(F.first("Owner_ID").alias("Owner_ID"), F.first("esa").alias("esa"), F.min("idbr_name").alias("idbr_name")).drop("a", "b")


def link(register: DataFrame, owners: DataFrame, passes: Sequence[LinkPass] = PASSES) -> tuple[DataFrame, DataFrame]:
    """(the register's unmatched rows, labels Owner_ID and esa); each pass sees what the ones before have left.

    A register's name is unique if all rows of its normalised form have one sector; the
    least name stands for them. Names travel as 128-bit hashes; texts are read once for
    these, and again for what has matched only.
    """
    names = key128(F.col("idbr_name"))
    right = materialise(name_forms(register, "idbr_name", passes, names[0].alias("k"), names[1].alias("l"), F.col("esa")), "register")
    left = materialise(name_forms(owners, "Owner_Name", passes, F.col("Owner_ID")), "owners")
    linked = None
    for i, step in enumerate(passes):
        found = materialise(_pass(register, right, left, i, step.min_tokens, linked), "matched")
        linked = found if linked is None else linked.unionByName(found)
    release(right, left)
    gone = linked.select(*(c.alias(n) for c, n in zip(names, ("__k", "__l"))))
    rest = register.join(gone, (names[0] == gone["__k"]) & (names[1] == gone["__l"]), "left_anti")
    return rest, linked.select("Owner_ID", "esa")


def attach_owner(ids: DataFrame, holdings: DataFrame, owner_cols: Sequence[str]) -> DataFrame:
    """The owner columns of each id, one row of the holdings an owner."""
    return ids.select("Owner_ID").join(one_row_per(holdings.select(*owner_cols), ["Owner_ID"]), "Owner_ID", "left")


def common_words(register: DataFrame, owners: DataFrame, n: int) -> tuple[str, ...]:
    """The most frequent words of either side's names."""
    return tuple(sorted({*top_words(register, "idbr_name", n), *top_words(owners, "Owner_Name", n)}))


def candidate_pairs(owners: DataFrame, register: DataFrame, n_common: int = 10, spec: TextSpec = RECOMMEND) -> DataFrame:
    """owners, each with the register's rows of the same normalised name (nulls if none).

    Names of which nothing is left match nothing.
    """
    spec = replace(spec, extra_stopwords=common_words(register, owners, n_common))
    left = owners.withColumn("name_", normalise(F.col("Owner_Name"), spec))
    right = register.withColumn("name_", normalise(F.col("idbr_name"), spec)).where(F.size("name_") > 0)
    return left.join(right, "name_", "left")


def recommend(unlabelled: DataFrame, holdings: DataFrame, register: DataFrame, owner_cols: Sequence[str], target: str = "esa", methods: tuple[str, ...] = BATTERY, n_common: int = 10) -> tuple[DataFrame, DataFrame]:
    """(owners with candidates and their scores, owners without)."""
    pairs = candidate_pairs(attach_owner(unlabelled, holdings, owner_cols), register, n_common)
    return score_pairs(pairs.where(F.col(target).isNotNull()), "Owner_Name", "idbr_name", methods, distinct=True), pairs.where(F.col(target).isNull())
