"""Column helpers: names, codes, dates, profiles of nulls."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_contained(c: Column, values: Sequence[str]) -> Column:
    """The first of the values, in their order, that the text contains; else null."""
    return F.coalesce(*(F.when(c.contains(v), F.lit(v)) for v in values))


def contains_flags(c: Column, words: Sequence[str], lower: bool = False) -> dict[str, Column]:
    """1.0 or 0.0 per word; the flag of `ltd` also counts `limited`."""
    text = F.lower(c) if lower else c
    flags = {w: F.when(text.contains(w), 1.0).otherwise(0.0) for w in words}
    if {"ltd", "limited"} <= flags.keys():
        flags["ltd"] = flags["ltd"] + flags["limited"]
    return flags


def parse_date(c: Column, pattern: str = "dd/MM/yyyy") -> Column:
    """The date of a text; null where it is none."""
    return F.to_date(F.try_to_timestamp(F.trim(c), F.lit(pattern)))


def date_parts(c: Column, prefix: str = "") -> dict[str, Column]:
    """month, dayofmonth, dayofweek (1: Sunday) and quarter."""
    return {f"{prefix}month": F.month(c), f"{prefix}dayofmonth": F.dayofmonth(c), f"{prefix}dayofweek": F.dayofweek(c), f"{prefix}quarter": F.quarter(c)}


def sanitised(names: Sequence[str]) -> list[str]:
    """Letters, digits and underscores of each name; a number follows where two names would be equal."""
    out: list[str] = []
    taken: set[str] = set()
    for name in names:
        clean = "".join(ch for ch in name if ch.isalnum() or ch == "_") or "_"
        new, k = clean, 2
        while new in taken:
            new, k = f"{clean}_{k}", k + 1
        taken.add(new)
        out.append(new)
    return out


def sanitise_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*sanitised(df.columns))


def key128(*cells: Column) -> list[Column]:
    """Two longs that stand for the cells as a key: 128 bits of their content."""
    return [F.xxhash64(*cells), F.xxhash64(F.lit("second half"), *cells)]


def quoted(name: str) -> Column:
    """A column by its whole name, dots and slashes included."""
    return F.col(f"`{name}`")
