"""Quality classifier by positive-unlabelled learning.

Only trusted positives (label 1) and unlabelled web text are used to fit. The
class prior of the unlabelled text is estimated first: a classifier of positives
against unlabelled text is fitted on half of both, and on the other half the
prior is the least ratio, over score thresholds, of the unlabelled share above
the threshold to the positive share above it, with a margin for sampling error.
A linear model then minimises the non-negative unbiased risk

    prior * E_pos[loss(+)] + max(0, E_unl[loss(-)] - prior * E_pos[loss(-)])

with the logistic loss, by full-batch gradient steps; where the second term is
negative its gradient is ascended, as the non-negative correction asks.

Inputs of a score are the whole text's byte-class transitions and word and line
repetition; labels, language, source and id are never inputs. Of the positives the
fit takes at most SAMPLE, those of the smallest hashes. The unlabelled text counts
whole: its features' mean and spread are sums over all its rows, and all its rows
are dealt by hash into groups of about SAMPLE, each of which estimates a prior and
minimises the risk against the same positives, in a task of its own. The model is
the mean of the groups', weighted by their rows: one pass for any number of rows,
and no task holds more than a group. Scoring covers every row.

Edge cases: a null text is scored as an empty one; rows with null ids are scored
but not learnt from; an id labelled twice is positive only if all its labels
are 1; without positives or unlabelled rows every score is 0.5; rows equal in id and
features are learnt from once and get equal scores; extra columns are kept by
`keep_good` and not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialise, release, slices, texts

FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.7
#: Most positives that the fit takes, and unlabelled rows of a group, about.
SAMPLE = 12_000
CLASSES = 16
WIDTH = CLASSES * CLASSES + 3


def _class_table() -> np.ndarray:
    table = np.full(256, 15, np.uint8)
    table[0x80:] = 6
    for k, chars in enumerate([b" ", b"\n", bytes(range(9)) + b"\t\x0b\x0c\r", bytes(range(97, 123)), bytes(range(65, 91)), bytes(range(48, 58)), b"", b".", b",", b"!?", b"#*$%&", b"|<>", b"'\"-", b"()[]{}:;", b"@/\\_=+~^`"]):
        table[list(chars)] = k
    return table


_TABLE = _class_table()


def features(found: list[bytes]) -> np.ndarray:
    """One row of features per text."""
    out = np.zeros((len(found), WIDTH), np.float32)
    for row, text in zip(out, found):
        kind = _TABLE[np.frombuffer(text, np.uint8)]
        if len(kind) > 1:
            row[: CLASSES * CLASSES] = np.bincount(kind[:-1] * np.uint8(CLASSES) + kind[1:], minlength=CLASSES * CLASSES) / (len(kind) - 1)
        words = text.split()
        if words:
            row[-3] = sum(map(bytes.__eq__, words[1:], words)) / len(words)
            row[-2] = len(set(words)) / len(words)
            lines = [x for x in text.split(b"\n") if x.strip()]
            row[-1] = 1 - len(set(lines)) / len(lines)
    return np.sqrt(out)


@dataclass
class Model:
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.centre) / self.scale, -4, 4) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


CONSTANT = Model(np.zeros(WIDTH), np.ones(WIDTH), np.zeros(WIDTH), 0.0, 0.5)


def _descend(gradient, width: int, steps: int, rate: float = 0.03, decay: float = 1e-3) -> tuple[np.ndarray, float]:
    """Adam on (weights, bias); gradient(w, b) -> (dw, db)."""
    theta, m, v = np.zeros(width + 1), np.zeros(width + 1), np.zeros(width + 1)
    for t in range(1, steps + 1):
        dw, db = gradient(theta[:-1], theta[-1])
        g = np.r_[dw + decay * theta[:-1], db]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return theta[:-1], theta[-1]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def class_prior(pos: np.ndarray, unl: np.ndarray, steps: int = 150) -> float:
    """The positives' share of the unlabelled rows."""
    p, u = pos[::2], unl[::2]

    def against(w, b):  # equal weight to both kinds
        gp, gu = (_sigmoid(p @ w + b) - 1) / (2 * len(p)), _sigmoid(u @ w + b) / (2 * len(u))
        return p.T @ gp + u.T @ gu, gp.sum() + gu.sum()

    w, b = _descend(against, pos.shape[1], steps)
    p, u = np.sort(pos[1::2] @ w + b), np.sort(unl[1::2] @ w + b)
    if not len(p) or not len(u):
        return 0.5
    cuts = np.unique(p)
    above_p = 1 - np.searchsorted(p, cuts) / len(p)
    above_u = 1 - np.searchsorted(u, cuts) / len(u)
    margin = np.sqrt(np.log(20) / (2 * len(u))) + np.sqrt(np.log(20) / (2 * len(p)))
    use = above_p > 0.1
    at = np.argmin((above_u[use] + margin) / above_p[use])
    return float(np.clip(above_u[use][at] / above_p[use][at], 0.05, 0.98))


def fit_arrays(pos: np.ndarray, unl: np.ndarray, centre: np.ndarray, scale: np.ndarray, steps: int = 400) -> Model:
    """The model of one group of unlabelled rows."""
    pos, unl = (np.clip((x - centre) / scale, -4, 4) for x in (pos, unl))
    prior = class_prior(pos, unl)

    def risk(w, b):
        zp, zu = pos @ w + b, unl @ w + b
        up = (_sigmoid(zp) - 1) * prior / len(pos)  # d prior*E_pos[loss(+)]
        down = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        gu, gp = _sigmoid(zu) / len(unl), -_sigmoid(zp) * prior / len(pos)
        if down < 0:
            return -(unl.T @ gu + pos.T @ gp), -(gu.sum() + gp.sum())
        return pos.T @ (up + gp) + unl.T @ gu, up.sum() + gp.sum() + gu.sum()

    w, b = _descend(risk, pos.shape[1], steps)
    return Model(centre, scale, w, float(b), prior)


def remainder(doc_id: Column, folds: int) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(-1))


def _stacked(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(-1, WIDTH)


def _sums(rows: DataFrame, width: int) -> np.ndarray:
    """The sums over the arrays v of all rows."""
    return np.array(rows.agg(*(F.sum(F.col("v")[i]).alias(f"v{i}") for i in range(width))).first(), np.float64)


def _batch(v: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v.tolist()], pa.list_(pa.float64()))], names=["v"])


def feature_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(id, positive, x) of the distinct rows outside the held-out fold that are positive or unlabelled."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            x = features(texts(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([r.tobytes() for r in x], pa.binary())], names=["id", "x"])

    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    rows = rows.where(F.col("id").isNotNull() & (remainder(F.col("id"), FOLDS) != HELD_OUT))
    known = labels.groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.min("quality").alias("quality"))
    both = rows.mapInArrow(measure, "id long, x binary").join(known, "id", "left").where("quality is null or quality = 1")
    return both.select("id", F.col("quality").isNotNull().alias("positive"), "x").distinct()


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from the documents outside the held-out fold and from their positive labels."""
    spark = docs.sparkSession
    rows = materialise(feature_rows(docs, labels), "features")
    n = {r.positive: r["count"] for r in rows.groupBy("positive").count().collect()}
    if len(n) < 2:
        release(rows)
        return CONSTANT
    unl = rows.where(~F.col("positive"))
    marked = rows.where("positive").select("id", "x", F.xxhash64(F.lit("sample"), "id", "x").alias("draw"))
    first = F.broadcast(marked.select("draw", "id").orderBy("draw", "id").limit(sample))  # its size is bounded
    chosen = sorted((r.id, bytes(r.x)) for r in marked.join(first, ["draw", "id"]).select("id", "x").collect())
    pos = spark.sparkContext.broadcast(np.frombuffer(b"".join(x for _, x in chosen), np.float32).reshape(-1, WIDTH))

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = np.zeros(2 * WIDTH)
        for batch in batches:
            x = _stacked(batch.column("x")).astype(np.float64)
            v += np.r_[x.sum(axis=0), (x * x).sum(axis=0)]
        yield _batch(v)

    total = _sums(unl.mapInArrow(moments, "v array<double>"), 2 * WIDTH) / n[False]
    centre, scale = total[:WIDTH], np.sqrt(np.maximum(total[WIDTH:] - total[:WIDTH] ** 2, 0)) + 1e-3

    def learn(group: pa.Table) -> pa.Table:
        group = group.sort_by([("id", "ascending"), ("x", "ascending")])
        model = fit_arrays(pos.value, _stacked(group.column("x")), centre, scale)
        return pa.Table.from_batches([_batch(len(group) * np.r_[model.weights, model.bias, model.prior])])

    groups = F.pmod(F.xxhash64("id", "x"), F.lit(-(-n[False] // sample)))
    mean = _sums(unl.withColumn("group", groups).groupBy("group").applyInArrow(learn, "v array<double>"), WIDTH + 2) / n[False]
    release(rows)
    return Model(centre, scale, mean[:WIDTH], float(mean[WIDTH]), float(mean[WIDTH + 1]))


def score_documents(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of docs: doc_id, held_out, score, predicted."""

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(features(texts(batch.column("text")))))], names=["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(rate, "doc_id long, score double")
    return scored.select("doc_id", (remainder(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score_documents(docs, fit(docs, labels))


def keep_good(docs: DataFrame, labels: DataFrame, web: DataFrame | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs predicted to be good, with all their columns; learnt from the texts of web (default: docs)."""
    model = fit(docs if web is None else web, labels)

    def good(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            yield batch.filter(pa.array(model.score(features(texts(batch.column("text")))) >= threshold))

    return docs.mapInArrow(good, T.StructType([T.StructField(f.name, f.dataType) for f in docs.schema]))
