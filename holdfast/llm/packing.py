"""Best-fit packing of tokenised documents into sequences, after Martello-Toth dominance reduction.

Lengths lie between 1 and the capacity, so the whole instance is a histogram
of at most `capacity` counts however many documents there are. The driver
packs that histogram: runs of equal bins are reduced and filled at once, so
its work is bounded by the capacity. Each piece then finds its place from its
rank among the pieces of its length.

Reduction. For the longest piece left, let a pair partner be the longest piece
that still fits beside it. The bin of the two dominates every other bin that
holds the longest piece when it is full, or when no three others fit beside that
piece and the partner is at least as long as the best pair of pieces that would
fit in its place. Where no three others fit and a pair of the partner and one
more fills the bin, the bin of the three dominates if no length lies between the
two: the longer of any pair is at most the one, the shorter at most the other.
Removing pieces spoils none of these proofs, so such bins are fixed as many at
once as the counts allow; a piece beside which nothing fits is fixed alone. Lengths for which the test fails stay in the
instance, and best-fit decreasing packs that remainder.

Edge cases: a null text is an empty one, which is the end id alone; equal rows
and null ids are pieces like any other; an empty table gives no rows; further
columns of the input are not read.
"""

from __future__ import annotations

import re
import sys
import zlib
from array import array
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import materialise, partitions, slices, texts

CAPACITY = 4096
END_ID = 1
#: Distinct words whose ids a worker remembers.
CACHE_WORDS = 600_000

PIECES = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())])


class WordIds(dict):
    """Ids of each word as little-endian bytes, remembered within a bound.

    The tokenizer's normaliser and pre-tokenizer never join text across ASCII
    white space, so a text's ids are those of its words in order. Nor do they join
    letters or digits to the punctuation behind them, so a word that ends in
    punctuation is looked up in two parts. Capitals fold before the look-up, but
    for texts that may hold a special token's name.
    """

    def __init__(self, path: str, bound: int = CACHE_WORDS):
        from tokenizers import Tokenizer

        super().__init__()
        self.encode, self.bound = Tokenizer.from_file(path).encode, bound
        self.ends_in_marks = re.compile(rb"([a-z0-9]+)([!-/:-@\[-`{-~]+)").fullmatch

    def __missing__(self, word: bytes) -> bytes:
        if parts := self.ends_in_marks(word):
            return self[parts[1]] + self[parts[2]]
        ids = array("I", self.encode(word.decode(), add_special_tokens=False).ids)
        if sys.byteorder == "big":
            ids.byteswap()
        ids = ids.tobytes()
        if len(self) >= self.bound:
            self.clear()
        if len(word) <= 64:
            self[word] = ids
        return ids

    def of(self, text: bytes) -> bytes:
        return b"".join(map(self.__getitem__, (text if b"<|" in text else text.lower()).split()))


_WORDS: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """The tokenizer at path, read and remembered once by each Python worker."""
    if path not in _WORDS:
        _WORDS[path] = WordIds(path)
    return _WORDS[path]


def cut_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece of each document: doc_id, piece, start, length, ids_crc32."""
    tail = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = word_ids(tokenizer)
        for batch in slices(batches, "text"):
            rows, start, piece, length, crc = [], [], [], [], []
            for row, text in enumerate(texts(batch.column("text"))):
                data = ids.of(text) + tail
                for k, at in enumerate(range(0, len(data), 4 * capacity)):
                    part = data[at : at + 4 * capacity]
                    rows.append(row)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))], names=PIECES.names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(cut, PIECES)


@dataclass
class Run:
    """`count` pieces of `length`, from rank `rank` on: `per_bin` to a sequence, from sequence `bin` and offset `offset` on."""

    length: int
    rank: int
    count: int
    bin: int
    per_bin: int
    offset: int


def reduce_dominated(counts: dict[int, int], capacity: int) -> tuple[dict[int, int], list[tuple[list[int], int]]]:
    """The counts left, and the fixed bins as (lengths, how many of them)."""
    left, fixed = {n: c for n, c in counts.items() if c > 0}, []
    lengths = sorted(left)

    def longest(limit: int, less: dict[int, int]) -> int:
        """The longest length of at most limit that has a piece beside those in less; 0 if none."""
        at = bisect_left(lengths, limit + 1) - 1
        while at >= 0 and left[lengths[at]] - less.get(lengths[at], 0) <= 0:
            at -= 1
        return lengths[at] if at >= 0 else 0

    for item in sorted(left, reverse=True):
        while left.get(item, 0):
            room = capacity - item
            partner = longest(room, {item: 1})
            if not partner:
                fixed.append(([item], left.pop(item)))
                lengths.remove(item)
                break
            found = [item, partner]
            if partner < room:
                least = [n for n in lengths[:4] for _ in range(min(left[n] - (n == item), 3))][:3]
                if len(least) == 3 and sum(least) <= room:
                    break
                pair, parts = 0, [0, 0]
                for a in reversed(lengths[: bisect_left(lengths, room)]):
                    if 2 * a < pair:
                        break
                    if left[a] - (a == item) > 0 and (b := longest(min(a, room - a), Counter([item, a]))) and a + b > pair:
                        pair, parts = a + b, [a, b]
                if partner < pair:
                    if pair < room or parts[0] != partner or longest(partner - 1, {item: 1}) > parts[1]:
                        break
                    found = [item, *parts]
            need = Counter(found)
            times = min(left[n] // k for n, k in need.items())
            fixed.append((found, times))
            for n, k in need.items():
                left[n] -= times * k
                if not left[n]:
                    del left[n]
                    lengths.remove(n)
    return left, fixed


def best_fit(counts: dict[int, int], capacity: int) -> Iterator[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing on a histogram: (length, count, first bin, per bin, offset, bins so far).

    A piece of equal length follows its forerunner into the same bin while that
    fits, so a group of equal bins takes a whole number of pieces each.
    """
    rooms: list[int] = []  # of the groups below, ascending
    groups: dict[int, list[tuple[int, int]]] = {}  # room -> (first bin, bins)
    bins = 0

    def put(room: int, first: int, many: int) -> None:
        if room and many:
            at = bisect_left(rooms, room)
            if at == len(rooms) or rooms[at] != room:
                rooms.insert(at, room)
                groups[room] = []
            groups[room].append((first, many))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, many = groups[room].pop(0)
                if not groups[room]:
                    del groups[room], rooms[at]
            else:
                room, first, many = capacity, bins, -(-left // (capacity // length))
                bins += many
            per = room // length
            full = min(many, left // per)
            if full:
                yield length, full * per, first, per, capacity - room, bins
                put(room - per * length, first, full)
                left -= full * per
            if full < many:
                if left:  # fewer than fill a bin
                    yield length, left, first + full, left, capacity - room, bins
                    put(room - left * length, first + full, 1)
                    full, left = full + 1, 0
                put(room, first + full, many - full)


def plan_runs(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[Run], int]:
    """Where the pieces of each length go, and the number of sequences."""
    rest, fixed = reduce_dominated(counts, capacity)
    used: dict[int, int] = {}
    runs: list[Run] = []

    def add(length: int, count: int, first: int, per: int, offset: int) -> None:
        runs.append(Run(length, used.get(length, 0), count, first, per, offset))
        used[length] = used.get(length, 0) + count

    bins = 0
    for lengths, times in fixed:
        if len(lengths) == 2 and lengths[0] == lengths[1]:
            add(lengths[0], 2 * times, bins, 2, 0)
        else:
            for k, n in enumerate(lengths):
                add(n, times, bins, 1, sum(lengths[:k]))
        bins += times
    base = bins
    for length, count, first, per, offset, so_far in best_fit(rest, capacity):
        add(length, count, base + first, per, offset)
        bins = base + so_far
    return sorted(runs, key=lambda r: (r.length, r.rank)), bins


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """pieces (doc_id, piece, start, length, ids_crc32), with sequence_id and offset.

    Pieces are ranked within their length in two steps, so that a length that
    most of them share is spread over all tasks: within a bucket of the row's
    hash, then over the buckets' counts.
    """
    spark = pieces.sparkSession
    buckets = partitions(spark)
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)).cast("int"))
    sums = materialise(dealt.groupBy("length", "bucket").agg(F.count("*").alias("n")), "lengths")
    runs, _ = plan_runs({r.length: r.n for r in sums.groupBy("length").agg(F.sum("n").alias("n")).collect()}, capacity)
    ahead = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select("length", "bucket", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"))
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = dealt.withColumn("inside", F.row_number().over(inside) - 1).join(before, ["length", "bucket"]).withColumn("rank", F.col("before") + F.col("inside"))
    table = np.array([(r.length, r.rank, r.bin, r.per_bin, r.offset) for r in runs], dtype=np.int64).reshape(-1, 5)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = np.searchsorted(table[:, 0], np.arange(capacity + 2))
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            lo, hi = first[length], first[length + 1]
            while (hi - lo > 1).any():  # the last run of the length that starts at the rank or before
                mid = (lo + hi) // 2
                down = table[np.minimum(mid, len(table) - 1), 1] > rank
                hi, lo = np.where(down & (hi - lo > 1), mid, hi), np.where(~down & (hi - lo > 1), mid, lo)
            run = table[lo]
            step = rank - run[:, 1]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in PIECES.names), pa.array(run[:, 2] + step // run[:, 3]), pa.array(run[:, 4] + step % run[:, 3] * length)], names=[*PIECES.names, "sequence_id", "offset"])

    out = T.StructType([*PIECES.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return ranked.select(*PIECES.names, "rank").mapInArrow(place, out)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Tokenise, cut and pack the documents; one row per piece."""
    return pack(materialise(cut_pieces(docs, tokenizer, capacity, end_id), "pieces"), capacity)
