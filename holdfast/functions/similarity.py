"""String similarity of two columns; native where Spark has the pieces, else Arrow-batched pandas functions.

A null on either side gives null. Distances of two empty sets are 0, similarities
of two empty strings are 1 (100 for the percentages).
"""

from __future__ import annotations

from collections.abc import Callable
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NGRAM = 3


def _characters(c: Column) -> Column:
    return F.array_distinct(F.filter(F.split(c, ""), lambda x: x != ""))


def _ngrams(c: Column, n: int = NGRAM) -> Column:
    starts = F.when(F.length(c) >= n, F.sequence(F.lit(1), F.length(c) - n + 1)).otherwise(F.when(c.isNotNull(), F.array().cast("array<int>")))
    return F.array_distinct(F.transform(starts, lambda i: F.substr(c, i, F.lit(n))))


def _words(c: Column) -> Column:
    return F.filter(F.split(c, r"\W"), lambda x: x != "")


def _word_ngrams(c: Column, n: int = NGRAM) -> Column:
    words = _words(c)
    starts = F.when(F.size(words) >= n, F.sequence(F.lit(1), F.size(words) - n + 1)).otherwise(F.when(c.isNotNull(), F.array().cast("array<int>")))
    return F.array_distinct(F.transform(starts, lambda i: F.array_join(F.slice(words, i, n), " ")))


def jaccard_distance(a: Column, b: Column) -> Column:
    """Of two sets, as arrays."""
    both = F.size(F.array_union(a, b))
    return F.when(a.isNull() | b.isNull(), F.lit(None)).when(both == 0, F.lit(0.0)).otherwise((both - F.size(F.array_intersect(a, b))) / both)


def jaccard_chars(a: Column, b: Column) -> Column:
    return jaccard_distance(_characters(a), _characters(b))


def jaccard_ngrams_chars(a: Column, b: Column) -> Column:
    return jaccard_distance(_ngrams(a), _ngrams(b))


def jaccard_tokens(a: Column, b: Column) -> Column:
    return jaccard_distance(F.array_distinct(_words(a)), F.array_distinct(_words(b)))


def jaccard_ngrams_tokens(a: Column, b: Column) -> Column:
    return jaccard_distance(_word_ngrams(a), _word_ngrams(b))


def sorensen(a: Column, b: Column) -> Column:
    x, y = _characters(a), _characters(b)
    total = F.size(x) + F.size(y)
    return F.when(a.isNull() | b.isNull(), F.lit(None)).when(total == 0, F.lit(0.0)).otherwise(1 - 2 * F.size(F.array_intersect(x, y)) / total)


def edit_distance(a: Column, b: Column) -> Column:
    return F.levenshtein(a, b)


def matching_ratio(a: str, b: str) -> float:
    """2 M / T of the matching blocks."""
    return SequenceMatcher(None, a, b, autojunk=False).ratio()


def percent(a: str, b: str) -> int:
    return int(round(100 * matching_ratio(a, b)))


def partial_percent(a: str, b: str) -> int:
    """The best ratio of the shorter string with a stretch of the longer, lined up at their matching blocks."""
    short, long_ = (a, b) if len(a) <= len(b) else (b, a)
    if not short:
        return 100 if not long_ else 0
    best = 0.0
    for m in SequenceMatcher(None, short, long_, autojunk=False).get_matching_blocks():
        start = max(0, m.b - m.a)
        best = max(best, matching_ratio(short, long_[start : start + len(short)]))
    return int(round(100 * best))


def _sorted_words(s: str) -> list[str]:
    return sorted("".join(ch if ch.isalnum() else " " for ch in s.lower()).split())


def token_sort_percent(a: str, b: str) -> int:
    return percent(" ".join(_sorted_words(a)), " ".join(_sorted_words(b)))


def token_set_percent(a: str, b: str) -> int:
    """The best ratio among the common words, and these with either side's other words."""
    x, y = set(_sorted_words(a)), set(_sorted_words(b))
    common = " ".join(sorted(x & y))
    one, two = (" ".join(filter(None, (common, " ".join(sorted(s))))) for s in (x - y, y - x))
    return max(percent(common, one), percent(common, two), percent(one, two))


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, a row of bits per character."""
    where: dict[str, int] = {}
    for i, ch in enumerate(a):
        where[ch] = where.get(ch, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        hit = row & where.get(ch, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def levenshtein_ratio(a: str, b: str) -> float:
    """(|a| + |b| - d) / (|a| + |b|), where a substitution costs two."""
    total = len(a) + len(b)
    return 2 * common_subsequence(a, b) / total if total else 1.0


def jaro_winkler(a: str, b: str) -> float:
    """Jaro similarity, raised by a common beginning of up to four characters."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    used, left = [False] * len(b), []
    for i, ch in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used[j] and b[j] == ch:
                used[j] = True
                left.append(ch)
                break
    m = len(left)
    if not m:
        return 0.0
    moved = sum(x != y for x, y in zip(left, (ch for ch, u in zip(b, used) if u))) // 2
    jaro = (m / len(a) + m / len(b) + (m - moved) / m) / 3
    same = next((k for k in range(min(4, len(a), len(b))) if a[k] != b[k]), min(4, len(a), len(b)))
    return jaro + same * 0.1 * (1 - jaro) if jaro > 0.7 else jaro


def _pandas(f: Callable[[str, str], float], kind: str) -> Callable[[Column, Column], Column]:
    def each(a: pd.Series, b: pd.Series) -> pd.Series:
        pairs = list(zip(a, b))
        scores = {p: None if p[0] is None or p[1] is None else f(*p) for p in set(pairs)}  # a pair of names often comes again
        return pd.Series([scores[p] for p in pairs], dtype="object")

    return F.pandas_udf(each, kind)


#: name -> function of two columns
METHODS: dict[str, Callable[[Column, Column], Column]] = {
    "jaccard_chars": jaccard_chars,
    "jaccard_ngrams_chars": jaccard_ngrams_chars,
    "jaccard_tokens": jaccard_tokens,
    "jaccard_ngrams_tokens": jaccard_ngrams_tokens,
    "fuzz_ratio": lambda a, b: _pandas(percent, "int")(a, b),
    "fuzz_partial_ratio": lambda a, b: _pandas(partial_percent, "int")(a, b),
    "fuzz_token_sort_ratio": lambda a, b: _pandas(token_sort_percent, "int")(a, b),
    "fuzz_token_set_ratio": lambda a, b: _pandas(token_set_percent, "int")(a, b),
    "edit_distance": edit_distance,
    "levenshtein": lambda a, b: _pandas(levenshtein_ratio, "double")(a, b),
    "sorensen": sorensen,
    "sequencematcher": lambda a, b: _pandas(matching_ratio, "double")(a, b),
    "pyjaro": lambda a, b: _pandas(jaro_winkler, "double")(a, b),
}
#: Those that a recommendation shows.
BATTERY = tuple(m for m in METHODS if m not in ("jaccard_tokens", "jaccard_ngrams_tokens"))


def score_pairs(df: DataFrame, left: str, right: str, methods: tuple[str, ...] = BATTERY, lower: bool = True, distinct: bool = False) -> DataFrame:
    """df with a column per method; names are compared in lower case.

    With distinct, each pair of names is scored once however many rows hold it.
    """
    a, b = (F.lower(F.col(c)) if lower else F.col(c) for c in (left, right))
    if not distinct:
        return df.select("*", *(METHODS[m](a, b).alias(m) for m in methods))
    named = df.withColumns({"__a": a, "__b": b})
    pairs = named.select(F.col("__a").alias("__x"), F.col("__b").alias("__y")).distinct()
    scored = pairs.select("*", *(METHODS[m](F.col("__x"), F.col("__y")).alias(m) for m in methods))
    same = named["__a"].eqNullSafe(scored["__x"]) & named["__b"].eqNullSafe(scored["__y"])
    return named.join(scored, same).select(*df.columns, *methods)
