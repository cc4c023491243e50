"""Quality rules: fixed base rules, then robust multivariate outliers.

Every text gives a vector of statistics, each transformed towards a normal
spread. For each language and source the minimum-covariance-determinant
estimate is found by concentration steps over h = (n + p + 1) / 2 rows, reweighted
once over the rows within the INNER quantile, and a text is rejected if its
squared Mahalanobis distance from that estimate exceeds a chi-square quantile.
So up to nearly half of a group's rows may be junk; where junk or its copies are
the majority of a group, no such estimate tells the two apart.

A concentration step needs the covariance of the h nearest rows. Here it is one
distributed aggregation: each row falls into a bin of its distance, each bin
carries its count and moment sums (combined before the shuffle), and the bins up
to the h-th row give the next estimate; the bin that holds the h-th row counts
in proportion. No group of rows is gathered anywhere, whatever its size: a
group meets in one task as `BINS` rows at most.

Groups of fewer than MIN_ROWS rows are judged by their language's estimate, and
where that is too small too, by the base rules alone. Rows that fail the base
rules take no part in the estimates. VARIANCE_FLOOR keeps a statistic that is
constant in a group from turning the slightest deviation into an outlier: most
groups have no repeated line in most of their texts.

Edge cases: a null or wordless text has no words and fails the base rules; null
languages or sources form groups of their own; equal rows count as often as
they occur; extra columns are carried by `apply_rules` and not read.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import combinations_with_replacement, count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialise, release, slices, texts

WINDOW = 8
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: Share of normal rows that the reweighted estimate counts.
INNER = 0.975
STEPS = 4
BINS = 1024
MIN_ROWS = 50
#: Groups (some 200 bytes each) whose estimates may be broadcast.
MOST_BROADCAST = 20_000
#: Share of normal rows beyond the cut.
TAIL = 1e-3
FEATURES = ("word_length", "symbols", "dup_lines", "repeats", "capitals")
#: Each below its statistic's largest square over CUT, so that each alone can exceed the cut: x2 < 1, x3 < sqrt(MAX_REPEAT_PERCENT / 100).
VARIANCE_FLOOR = (0.05**2, 0.05**2, 0.1**2, 0.1**2, 0.05**2)
#: Lines and words added to a text's own, so that one repeated line of a short text is no outlier.
MORE_LINES, MORE_WORDS = 8, 100
MIX = np.uint64(0x9E3779B97F4A7C15)
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals")


def repeated_words(ids: np.ndarray, starts: np.ndarray, ends: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Per text ids[starts:ends], the words in windows found twice or more in that text."""
    n = len(ids)
    out = np.zeros(len(starts), np.int64)
    doc = np.repeat(np.arange(len(starts)), ends - starts)
    at = np.flatnonzero(np.arange(n) + window <= ends[doc]) if n else np.empty(0, np.int64)
    if not len(at):
        return out
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * MIX
    mixed ^= mixed >> np.uint64(29)
    key = doc[at].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for k in range(window):
        key = key * np.uint64(0x2545F4914F6CDD1D) + mixed[at + k]
    order = np.argsort(key, kind="stable")
    key, at = key[order], at[order]
    near = np.flatnonzero(key[1:] == key[:-1])
    equal = doc[at[near]] == doc[at[near + 1]]
    for k in range(window):
        equal &= ids[at[near] + k] == ids[at[near + 1] + k]
    if not equal.all():  # unequal windows of one hash: count these exactly
        seen: dict[tuple, list[int]] = defaultdict(list)
        for p in at.tolist():
            seen[(doc[p], *ids[p : p + window].tolist())].append(p)
        twice = np.array([p for x in seen.values() if len(x) > 1 for p in x], np.int64)
    else:
        twice = np.unique(np.r_[at[near], at[near + 1]])
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, twice, 1)
    np.add.at(edge, twice + window, -1)
    covered = np.cumsum(edge[:-1]) > 0
    np.add.at(out, doc[covered], 1)
    return out


def statistics_of(found: list[bytes]) -> list[np.ndarray]:
    """The STATISTICS of each text."""
    number = defaultdict(count().__next__)
    words, runs, chars, symbols, dups, lines, capitals = [], [], [], [], [], [], []
    space = b" \t\n\r\x0b\x0c"
    for text in found:
        parts = text.split()
        words.append(len(parts))
        runs.append(np.fromiter(map(number.__getitem__, parts), np.int64, len(parts)))
        raw = np.frombuffer(text, np.uint8)
        kinds = np.bincount(raw, minlength=256)
        chars.append(int(kinds.sum() - kinds[0x80:0xC0].sum() - sum(kinds[c] for c in space)))
        symbols.append(int(sum(kinds[c] for c in SYMBOLS)))
        capitals.append(int(kinds[65:91].sum()))
        full = [x for x in text.split(b"\n") if x.strip()]
        lines.append(len(full))
        dups.append(len(full) - len(set(full)))
    n = np.array(words, np.int64)
    ends = np.cumsum(n)
    ids = np.concatenate(runs) if runs else np.empty(0, np.int64)
    return [n, *(np.array(x, np.int64) for x in (chars, symbols, dups)), repeated_words(ids, ends - n, ends), *(np.array(x, np.int64) for x in (lines, capitals))]


def text_statistics(docs: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """The columns in keep and the text's STATISTICS."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = statistics_of(texts(batch.column("text")))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *(pa.array(x) for x in found)], names=[*keep, *STATISTICS])

    return docs.select(*keep, "text").mapInArrow(measure, T.StructType([*docs.select(*keep).schema.fields, *(T.StructField(c, T.LongType()) for c in STATISTICS)]))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def transformed() -> list[Column]:
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return [
        F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n).alias("x0"),
        F.sqrt(F.col("n_symbols") / n).alias("x1"),
        F.sqrt(F.col("n_dup_lines") / (F.col("n_lines") + MORE_LINES).cast("double")).alias("x2"),
        F.sqrt(F.col("n_repeat_words") / (n + MORE_WORDS)).alias("x3"),
        F.sqrt(F.col("n_capitals") / F.greatest(F.col("word_chars"), F.lit(1)).cast("double")).alias("x4"),
    ]


def chi_square_cdf(x: float, p: int) -> float:
    a, z, term = p / 2, x / 2, 1 / (p / 2)
    total, k = term, a
    for _ in range(600):
        k += 1
        term *= z / k
        total += term
    return total * math.exp(-z + a * math.log(z) - math.lgamma(a)) if x > 0 else 0.0


def chi_square_quantile(share: float, p: int) -> float:
    low, high = 0.0, 400.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square_cdf(mid, p) < share else (low, mid)
    return high


P = len(FEATURES)
PAIRS = list(combinations_with_replacement(range(P), 2))
CUT = chi_square_quantile(1 - TAIL, P)
INNER_CUT = chi_square_quantile(INNER, P)
ESTIMATE = T.StructType([T.StructField("g", T.StringType()), T.StructField("rows", T.LongType()), *(T.StructField(f"m{i}", T.DoubleType()) for i in range(P)), *(T.StructField(f"p{i}{j}", T.DoubleType()) for i, j in PAIRS)])


def subset(rows: int) -> int:
    """Rows of the subset of least covariance: the fewest that give the highest breakdown."""
    return min(rows, (rows + P + 1) // 2)


@lru_cache(100_000)
def consistency(share: float) -> float:
    """Covariance of all normal rows over that of this share, the nearest."""
    return share / chi_square_cdf(chi_square_quantile(share, P), P + 2) if share < 1 else 1.0


def _estimate(g: str, rows: int, mean: np.ndarray, cov: np.ndarray) -> dict:
    precise = np.linalg.inv(cov + np.diag(VARIANCE_FLOOR))
    return {"g": g, "rows": rows} | {f"m{i}": mean[i] for i in range(P)} | {f"p{i}{j}": precise[i, j] for i, j in PAIRS}


def _concentrate(bins: pd.DataFrame) -> pd.DataFrame:
    """One group's bins, as (g, bin, n, s<i>, s<i><j>), to its next estimate."""
    bins = bins.sort_values("bin")
    n = bins.n.to_numpy(float)
    h = subset(int(n.sum()))
    share = np.clip((h - (np.cumsum(n) - n)) / n, 0, 1)
    mean = np.array([(share * bins[f"s{i}"]).sum() for i in range(P)]) / h
    cov = np.zeros((P, P))
    for i, j in PAIRS:
        cov[i, j] = cov[j, i] = (share * bins[f"s{i}{j}"]).sum() / h - mean[i] * mean[j]
    return pd.DataFrame([_estimate(bins.g.iloc[0], int(n.sum()), mean, _definite(cov * consistency(h / int(n.sum()))))])


def _definite(cov: np.ndarray) -> np.ndarray:
    """cov without negative variances, which rounding can leave."""
    values, axes = np.linalg.eigh(cov)
    return axes @ np.diag(np.maximum(values, 0)) @ axes.T


def _reweighted(sums: pd.DataFrame) -> pd.DataFrame:
    """Each group's sums over its rows within INNER_CUT, as (g, rows, n, s<i>, s<i><j>), to its estimate."""
    out = []
    for r in sums.itertuples():
        mean = np.array([getattr(r, f"s{i}") for i in range(P)]) / r.n
        cov = np.zeros((P, P))
        for i, j in PAIRS:
            cov[i, j] = cov[j, i] = getattr(r, f"s{i}{j}") / r.n - mean[i] * mean[j]
        out.append(_estimate(r.g, r.rows, mean, _definite(cov * consistency(INNER))))
    return pd.DataFrame(out, columns=ESTIMATE.names)


def _start(medians: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame([_estimate(r.g, r.rows, np.array([getattr(r, f"m{i}") for i in range(P)]), np.diag([(1.4826 * getattr(r, f"d{i}")) ** 2 for i in range(P)])) for r in medians.itertuples()], columns=ESTIMATE.names)


def distance() -> Column:
    gap = [F.col(f"x{i}") - F.col(f"m{i}") for i in range(P)]
    return reduce(lambda a, b: a + b, ((1 if i == j else 2) * gap[i] * gap[j] * F.col(f"p{i}{j}") for i, j in PAIRS))


def group_key(level: int) -> Column:
    return F.to_json(F.struct(F.lit(level).alias("level"), F.col("lang"), *([F.col("source")] if level else [])))


def _small(found: DataFrame) -> DataFrame:
    """A stored table of groups, to be broadcast while it is small by count; beyond, joins deal both sides by group and split hot ones."""
    return F.broadcast(found) if found.count() <= MOST_BROADCAST else found


def estimates(vectors: DataFrame) -> DataFrame:
    """vectors (lang, source, x<i>) to the minimum-covariance-determinant estimate of each language, and of each language and source."""
    rows = materialise(vectors.select(F.explode(F.array(group_key(0), group_key(1))).alias("g"), *(f"x{i}" for i in range(P))), "vectors")
    medians = materialise(rows.groupBy("g").agg(F.count("*").alias("rows"), *(F.percentile_approx(f"x{i}", 0.5, 1000).alias(f"m{i}") for i in range(P))), "medians")
    spread = rows.join(_small(medians), "g").groupBy("g").agg(F.first("rows").alias("rows"), *(F.first(f"m{i}").alias(f"m{i}") for i in range(P)), *(F.percentile_approx(F.abs(F.col(f"x{i}") - F.col(f"m{i}")), 0.5, 1000).alias(f"d{i}") for i in range(P)))
    found = materialise(spread.mapInPandas(lambda batches: map(_start, batches), ESTIMATE), "estimates")
    sums = [*(F.sum(f"x{i}").alias(f"s{i}") for i in range(P)), *(F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"s{i}{j}") for i, j in PAIRS)]
    for _ in range(STEPS):
        near = rows.join(_small(found), "g").withColumn("bin", F.least(F.floor(16 * F.log2(1 + F.greatest(distance(), F.lit(0.0)))), F.lit(BINS - 1)).cast("int"))
        binned = near.groupBy("g", "bin").agg(F.count("*").alias("n"), *sums)
        # stored first: else one exchange by g would serve both steps, and carry every task's bins of a group to one task
        before, bins = found, materialise(binned, "bins")
        found = materialise(bins.groupBy("g").applyInPandas(_concentrate, ESTIMATE), "estimates")
        release(before, bins)
    inner = rows.join(_small(found), "g").where(distance() <= INNER_CUT).groupBy("g").agg(F.first("rows").alias("rows"), F.count("*").alias("n"), *sums)
    out = materialise(inner.mapInPandas(lambda batches: map(_reweighted, batches), ESTIMATE), "estimates")
    release(rows, medians, found)
    return out


def judge(stats: DataFrame) -> DataFrame:
    """stats (lang, source, STATISTICS, ...) with base_failed, kept and the distance that decided."""
    rated = stats.select("*", base_failed().alias("base_failed"), *transformed())
    found = _small(estimates(rated.where(~F.col("base_failed")))).where(F.col("rows") >= MIN_ROWS)
    columns = [c for c in found.columns if c not in ("g", "rows")]
    own = rated.withColumn("g", group_key(1)).join(found.drop("rows"), "g", "left").withColumn("own", distance()).drop("g", *columns)
    both = own.withColumn("g", group_key(0)).join(found.drop("rows"), "g", "left").withColumn("far", F.coalesce("own", distance())).drop("g", "own", *columns)
    return both.withColumn("kept", ~F.col("base_failed") & (F.coalesce("far", F.lit(0.0)) <= CUT)).drop(*(f"x{i}" for i in range(P)))


def quality_rules(docs: DataFrame) -> DataFrame:
    """Per row of docs: doc_id, the base statistics, base_failed, kept and the squared distance `far` (null if nothing judged it)."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text"))
    stats = materialise(text_statistics(narrow, ("doc_id", "lang", "source")), "statistics")
    return judge(stats).select("doc_id", *STATISTICS[:5], "base_failed", "kept", "far")


def apply_rules(docs: DataFrame) -> DataFrame:
    """The rows of docs that the rules keep, with all their columns.

    Rows are stored beside their statistics once, so that the verdict needs no
    shuffle of the texts.
    """
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"))
    keep = ("row", "lang", "source")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = (pa.RecordBatch.from_arrays([*b.columns, b.column("row").field("text")], names=[*b.schema.names, "text"]) for b in batches)
        for batch in slices(whole, "text"):
            found = statistics_of(texts(batch.column("text")))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *(pa.array(x) for x in found)], names=[*keep, *STATISTICS])

    stats = rows.mapInArrow(measure, T.StructType([*rows.schema.fields, *(T.StructField(c, T.LongType()) for c in STATISTICS)]))
    return judge(materialise(stats, "statistics")).where("kept").select("row.*")
