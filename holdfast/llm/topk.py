"""Exact top-k inner products by vector-approximation files.

Vectors are cut into blocks, each a file of the shared folder. Its first part is
the approximation: every dimension's range in the block is divided into
2 ** CELL_BITS equal steps, and a vector has one byte a dimension, its cell. Its
second part holds the exact integer components, one vector after the other. A
cell's middle and half width bound the inner product with a query from both sides.

A task searches for one block of queries in one slab of files. It first scans the
approximations alone and keeps the vectors whose upper bound reaches the query's kth
largest lower bound. Of these it then reads the exact vectors, one by one out of the
files, in the order of their upper bounds, until the next bound lies below the kth
exact score. The slabs' best are merged at the end. Only the numbers of files are
shuffled; no side is broadcast, and none grows with a single key. Of equal vectors
in a block the 2 k smallest ids are kept, k rows of an id at most: any other is
outranked by k of these, whichever id is the query's own.

Vectors with a component of 2 ** 24 or more after scaling, or of more than
MOST_DIMENSIONS, are wide: they form files of their own, which hold the components
before scaling; their bounds are relative to a file's largest component, and where
one side is wide exact products are Python's integers.

Edge cases: vectors that are null, empty, or hold null or non-finite components, and rows
of null ids, take no part; rows that repeat an id with another vector are rows of
their own, and a query's id never meets itself; rows equal in id and vector count
once, or with `equal_rows` each (beyond k of them change nothing); the rows of one
query id are ranked together; a query meets only vectors of its own length; fewer
candidates than k give fewer rows; further columns are not read. A score among the
best that no 64-bit integer holds raises an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import mul

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialise, partitions, release, scratch

K = 20
SCALE = 64
QUERY_STEP = 20
CELL_BITS = 8
BLOCK = 4096
QUERY_BLOCK = 1024
#: Files that a task scans for one query block, about.
SLAB = 32
#: Components below WIDE, scaled, and so many of them have inner products within 64 bits.
WIDE, MOST_DIMENSIONS = 2**24, 2**14
BLOCKS = "block long, attempt long, dim int, wide boolean, n int"
#: Exact vectors read at a time, and candidates held before their exact vectors are read.
STRIDE = 64
HELD = 1 << 20
#: Numbers of narrow and of wide files.
STORED = ("<i4", "<f8")


def quantised(vectors: DataFrame, copies: int = 1, scale: int = SCALE) -> DataFrame:
    """(vec_id, q, r) of the vectors that take part, at most `copies` of equal rows: q holds scaled whole components, or, where it is null, r what the wide ones are before scaling."""
    real = F.transform("embedding", lambda v: v.cast("double"))
    rows = vectors.where(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < float("inf"))))
    narrow = (F.size("e") <= MOST_DIMENSIONS) & F.forall("e", lambda v: F.abs(v) * scale < WIDE)
    # beyond 2 ** 46 a double's multiple by the scale is whole already
    whole = F.transform("e", lambda v: F.when(F.abs(v) < 2.0**46, F.floor(v * float(scale)).cast("double") / scale).otherwise(v))
    parts = rows.select(F.col("vec_id").cast("long").alias("vec_id"), real.alias("e")).select("vec_id", F.when(narrow, F.transform("e", lambda v: F.floor(v * float(scale)).cast("int"))).alias("q"), F.when(~narrow, whole).alias("r"))
    counted = parts.groupBy("vec_id", "q", "r").agg(F.count("*").alias("n"))
    return counted.select("vec_id", "q", "r", F.explode(F.sequence(F.lit(1).cast("long"), F.least("n", F.lit(copies)))).alias("copy")).drop("copy") if copies > 1 else counted.drop("n")


def first_copies(ids: np.ndarray, data: np.ndarray, k: int) -> np.ndarray:
    """Indices of the 2 k smallest ids of each distinct row, at most k of an id."""
    _, group = np.unique(np.ascontiguousarray(data).view([("", data.dtype)] * data.shape[1]).ravel(), return_inverse=True)
    group = group.ravel()
    order = np.lexsort((ids, group))

    def first(order: np.ndarray, new: np.ndarray, most: int) -> np.ndarray:
        starts = np.flatnonzero(np.r_[True, new])
        return order[np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)])) < most]

    order = first(order, (np.diff(group[order]) != 0) | (np.diff(ids[order]) != 0), k)
    return np.sort(first(order, np.diff(group[order]) != 0, 2 * k))


class VectorFile:
    """One block: ids and cells, read at once by `scan`, and exact vectors, read one by one by `rows`."""

    def __init__(self, folder: str, block: int, attempt: int, dim: int, wide: bool, n: int):
        self.fs, top = pa.fs.FileSystem.from_uri(folder)
        self.path = f"{top}/{block}-{attempt}.vectors"
        self.dim, self.wide, self.n, self.kind = dim, wide, n, np.dtype(STORED[wide])
        self.cells_end = 8 * (n + 2 * dim + 1) + n * dim
        self.file = None

    def write(self, ids: np.ndarray, data: np.ndarray) -> None:
        real = data.astype(np.float64)
        most = (np.abs(real).max() or 1.0) if self.wide else 1.0
        real /= most
        low, high = real.min(axis=0), real.max(axis=0)
        # a narrow cell holds `step` whole numbers
        step = (high - low) / (1 << CELL_BITS) if self.wide else np.ceil((high - low + 1) / (1 << CELL_BITS))
        cells = np.minimum((real - low) // np.where(step > 0, step, 1), (1 << CELL_BITS) - 1).astype(np.uint8)
        with self.fs.open_output_stream(self.path, compression=None) as out:
            for x in (ids.astype("<i8"), low, step, np.array([most]), cells, data.astype(self.kind)):
                out.write(np.ascontiguousarray(x).tobytes())

    def _read(self, size: int, at: int) -> pa.Buffer:
        if self.file is None:
            self.file = self.fs.open_input_file(self.path)
        self.file.seek(at)
        return self.file.read_buffer(size)

    def scan(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        """ids; the middles of the cells and half their width, per dimension, in units of the last value."""
        data, n, dim = self._read(self.cells_end, 0), self.n, self.dim
        ids = np.frombuffer(data, "<i8", n)
        low, step, most = (np.frombuffer(data, "<f8", size, 8 * at) for size, at in ((dim, n), (dim, n + dim), (1, n + 2 * dim)))
        cells = np.frombuffer(data, np.uint8, n * dim, 8 * (n + 2 * dim + 1)).reshape(n, dim)
        half = step / 2 if self.wide else (step - 1) / 2
        return ids, low + half + cells * step, half, float(most[0])

    def rows(self, at: np.ndarray) -> np.ndarray:
        size = self.dim * self.kind.itemsize
        return np.stack([np.frombuffer(self._read(size, self.cells_end + i * size), self.kind) for i in at.tolist()])

    def all_rows(self) -> tuple[np.ndarray, np.ndarray]:
        data = self._read(self.n * self.dim * self.kind.itemsize, self.cells_end)
        return np.frombuffer(self._read(8 * self.n, 0), "<i8"), np.frombuffer(data, self.kind).reshape(self.n, self.dim)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
            self.file = None


def blocks(vectors: DataFrame, size: int, folder: str, copies: int | None = None) -> DataFrame:
    """Vectors of equal length written to files of `size` vectors, a row of BLOCKS each."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = pa.fs.FileSystem.from_uri(folder)
        fs.create_dir(path, recursive=True)
        held: dict[tuple[int, bool], list[tuple[np.ndarray, np.ndarray]]] = {}
        task, attempt, made = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId(), 0

        def emit(kind: tuple[int, bool], least: int) -> Iterator[pa.RecordBatch]:
            nonlocal made
            dim, wide = kind
            ids, data = (np.concatenate(x) for x in zip(*held[kind]))
            while len(ids) >= max(least, 1):
                i, d = ids[:size], data[:size]
                if copies:
                    use = first_copies(i, d, copies)
                    i, d = i[use], d[use]
                row = ((task << 32) + made, attempt, dim, wide, len(i))
                VectorFile(folder, *row).write(i, d)
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, (pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.int32()))], names=["block", "attempt", "dim", "wide", "n"])
                made += 1
                ids, data = ids[size:], data[size:]
            held[kind] = [(ids, data)]

        for batch in batches:
            for column, wide in (("q", False), ("r", True)):
                part = batch.filter(pc.is_valid(batch.column(column)))
                ids, lists = part.column("vec_id").to_numpy(), part.column(column)
                lengths, flat = lists.value_lengths().to_numpy(), lists.flatten().to_numpy()
                starts = np.cumsum(lengths) - lengths
                for dim in np.unique(lengths).tolist():
                    at = np.flatnonzero(lengths == dim)
                    held.setdefault((dim, wide), []).append((ids[at], flat[starts[at][:, None] + np.arange(dim)]))
                    if sum(len(x) for x, _ in held[dim, wide]) >= size:
                        yield from emit((dim, wide), size)
        for kind in held:
            yield from emit(kind, 1)

    return vectors.mapInArrow(packed, BLOCKS)


FOUND = ["query_id", "vec_id", "score", "beyond"]


class Search:
    """The best k of a block of queries over the narrow files scanned so far."""

    def __init__(self, ids: np.ndarray, data: np.ndarray, k: int):
        self.ids, self.data, self.k = ids, data.astype(np.int64), k
        self.real = data.astype(np.float64)
        self.lower = np.full((len(ids), k), -np.inf)  # each query's k largest lower bounds
        self.at_least = np.full(len(ids), -np.inf)
        self.files: list[VectorFile] = []
        self.held: list[tuple[np.ndarray, ...]] = []  # query, upper bound, file, row, id of candidates
        self.score = [np.empty(0, np.int64) for _ in ids]
        self.found = [np.empty(0, np.int64) for _ in ids]

    def scan(self, file: VectorFile) -> None:
        ids, middle, half, _ = file.scan()
        near = self.real @ middle.T
        most = np.abs(middle).max(axis=0) + half
        slack = np.abs(self.real) @ half + 1e-6 * (1 + np.abs(self.real) @ most)
        near[self.ids[:, None] == ids[None, :]] = -np.inf
        best = near if len(ids) <= self.k else np.partition(near, len(ids) - self.k, axis=1)[:, len(ids) - self.k :]
        both = np.concatenate([self.lower, best - slack[:, None]], axis=1)
        self.lower = np.partition(both, both.shape[1] - self.k, axis=1)[:, both.shape[1] - self.k :]
        self.at_least = np.maximum(self.at_least, self.lower.min(axis=1))
        query, row = np.nonzero(np.isfinite(near) & (near >= (self.at_least - slack)[:, None]))
        self.held.append((query, near[query, row] + slack[query], np.full(len(row), len(self.files)), row, ids[row]))
        self.files.append(file)
        if sum(len(x[0]) for x in self.held) >= HELD:
            self.settle()

    def settle(self) -> None:
        """Read the candidates' exact vectors in the order of their upper bounds, until each query's kth score is certain."""
        if self.held:
            query, upper, file, row, ids = (np.concatenate(x) for x in zip(*self.held))
            left = np.flatnonzero(upper >= self.at_least[query])
            left = left[np.lexsort((-upper[left], query[left]))]
            for part in np.split(left, np.flatnonzero(np.diff(query[left])) + 1):
                if len(part):
                    self._settle(int(query[part[0]]), upper[part], file[part], row[part], ids[part])
        for f in self.files:
            f.close()
        self.files, self.held = [], []

    def _settle(self, query: int, upper: np.ndarray, file: np.ndarray, row: np.ndarray, ids: np.ndarray) -> None:
        best, who = self.score[query], self.found[query]
        for start in range(0, len(upper), STRIDE):
            if len(best) == self.k and upper[start] < best[-1]:
                break
            part = slice(start, start + STRIDE)
            exact = np.empty(len(row[part]), np.int64)
            for f in np.unique(file[part]).tolist():
                at = np.flatnonzero(file[part] == f)
                exact[at] = self.files[f].rows(row[part][at]).astype(np.int64) @ self.data[query]
            best, who = np.r_[best, exact], np.r_[who, ids[part]]
            order = np.lexsort((who, -best))[: self.k]
            best, who = best[order], who[order]
        self.score[query], self.found[query] = best, who
        if len(best) == self.k:
            self.at_least[query] = max(self.at_least[query], best[-1])

    def rows(self) -> pa.RecordBatch:
        self.settle()
        score = np.concatenate([*self.score, np.empty(0, np.int64)])
        return pa.RecordBatch.from_arrays([pa.array(np.repeat(self.ids, [len(x) for x in self.score])), pa.array(np.concatenate([*self.found, np.empty(0, np.int64)])), pa.array(score), pa.array(np.zeros(len(score), bool))], names=FOUND)


def whole(real: np.ndarray) -> list[int]:
    """The scaled components as integers of any size."""
    return [int(x) * SCALE if abs(x) >= 2.0**46 else int(x * SCALE) for x in real.tolist()]


class WideSearch:
    """The best k of a block of queries, held before scaling, over files where one side or both are wide."""

    def __init__(self, ids: np.ndarray, real: np.ndarray, k: int):
        self.ids, self.real, self.k = ids, real, k
        self.most = np.abs(real).max(axis=1)
        self.exact = [whole(x) for x in real]
        self.best: list[list[tuple[int, int]]] = [[] for _ in ids]  # (-score, id), ascending

    def scan(self, file: VectorFile) -> None:
        ids, middle, half, most = file.scan()
        if not file.wide:  # scaled whole numbers, made relative as well
            most = float(np.ceil(np.abs(middle).max() + half.max())) or 1.0
            middle, half, most = middle / most, half / most, most / SCALE
        k, size = self.k, np.abs(middle).max(axis=0) + half
        exact: dict[int, list[int]] = {}
        for row, own in enumerate(self.ids):
            scale = float(self.most[row]) or 1.0
            query, unit = self.real[row] / scale, whole(np.array([scale]))[0] * whole(np.array([most]))[0]
            near, slack = middle @ query, float(np.abs(query) @ half + 1e-6 * (np.abs(query) @ size) + 1e-290)
            upper, other = near + slack, ids != own
            at_least = self.relative(row, unit)
            if other.sum() > k:
                at_least = max(at_least, np.partition((near - slack)[other], other.sum() - k)[other.sum() - k])
            left = np.flatnonzero(other & (upper >= at_least))
            left = left[np.argsort(-upper[left], kind="stable")]
            for start in range(0, len(left), STRIDE):
                if upper[left[start]] < self.relative(row, unit):
                    break
                part = left[start : start + STRIDE]
                new = np.array([c for c in part.tolist() if c not in exact], np.int64)
                if len(new):
                    real = file.rows(new)
                    exact.update(zip(new.tolist(), map(whole, real if file.wide else real / SCALE)))
                scored = [(-sum(map(mul, self.exact[row], exact[c])), int(ids[c])) for c in part.tolist()]
                self.best[row] = sorted(self.best[row] + scored)[:k]
        file.close()

    def relative(self, row: int, unit: int) -> float:
        """A little less than the kth best score, in units of the block."""
        if len(self.best[row]) < self.k or not unit:
            return -np.inf
        score = -self.best[row][-1][0]
        try:
            found = score / unit
        except OverflowError:
            return np.inf if score > 0 else -np.inf
        return found - 1e-9 * abs(found) - 1e-290

    def rows(self) -> pa.RecordBatch:
        """Scores beyond 64 bits are cut to their range, and marked."""
        flat = [(q, who, -s) for q, best in zip(self.ids.tolist(), self.best) for s, who in best]
        cut = [max(-(2**63), min(s, 2**63 - 1)) for _, _, s in flat]
        return pa.RecordBatch.from_arrays([pa.array([q for q, _, _ in flat], pa.int64()), pa.array([w for _, w, _ in flat], pa.int64()), pa.array(cut, pa.int64()), pa.array([c != s for c, (_, _, s) in zip(cut, flat)], pa.bool_())], names=FOUND)


def top_k(vectors: DataFrame, k: int = K, query_step: int = QUERY_STEP, block: int = BLOCK, query_block: int = QUERY_BLOCK, equal_rows: bool = False) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all other rows for each row whose vec_id is divisible by query_step."""
    spark = vectors.sparkSession
    folder = scratch(spark, "vectors")
    rows = materialise(quantised(vectors, k if equal_rows else 1), "quantised")
    stored = materialise(blocks(rows, block, folder, k), "blocks")
    asked = materialise(blocks(rows.where(F.col("vec_id") % query_step == 0).repartition(1 + rows.count() // (query_step * query_block), F.xxhash64("vec_id", "q", "r")), query_block, f"{folder}/asked"), "queries")
    release(rows)
    n_asked, n_stored = asked.count(), stored.count()
    slabs = max(-(-2 * partitions(spark) // max(n_asked, 1)), -(-n_stored // SLAB), 1)
    shelves = stored.groupBy("dim", F.pmod(F.xxhash64("block"), F.lit(slabs)).alias("slab")).agg(F.collect_list(F.struct("block", "attempt", "wide", "n")).alias("files"))
    # the stated queries against all rows, in blocks: every slab of files goes once to each query block of its length
    meets = asked.withColumn("slab", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slabs - 1).cast("long")))).join(shelves, ["dim", "slab"])
    dealt = meets.select("dim", "block", "attempt", "wide", "n", "files", "slab").repartition(max(min(4 * partitions(spark), n_asked * slabs), 1), "block", "slab")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                own = VectorFile(f"{folder}/asked", r["block"], r["attempt"], r["dim"], r["wide"], r["n"])
                ids, data = own.all_rows()
                own.close()
                narrow, wide = None if r["wide"] else Search(ids, data, k), None
                for x in r["files"]:
                    file = VectorFile(folder, x["block"], x["attempt"], r["dim"], x["wide"], x["n"])
                    if narrow is not None and not file.wide:
                        narrow.scan(file)
                    else:
                        wide = wide or WideSearch(ids, data if r["wide"] else data / SCALE, k)
                        wide.scan(file)
                yield from (x.rows() for x in (narrow, wide) if x is not None)

    best = dealt.mapInArrow(search, "query_id long, vec_id long, score long, beyond boolean")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", F.when(F.col("beyond"), F.raise_error(F.lit("op6: a score among the best exceeds 64 bits")).cast("long")).otherwise(F.col("score")).alias("score"))
