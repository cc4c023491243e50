"""Removal of repeated byte strings by suffix arrays, built by bucket-pointer refinement.

A byte goes if it lies in a string of LENGTH bytes that also starts anywhere
else. Strings are judged on the input, and none crosses documents.

Bringing equal strings together. Of the GRAM-byte grams that start in a string of
LENGTH bytes, the one of the least hash is its anchor. Equal strings have equal
anchors at equal places, so only strings whose anchor occurs twice can repeat.
Neighbouring strings mostly share an anchor: they form a run, which needs one
row. Runs of anchors that occur once are dropped by count; of the others the
text is fetched, equal texts (one `type`) are merged into one with a weight, and
all types of an anchor meet.

Suffix arrays. A task concatenates the types it gets and puts the suffixes into
buckets by their first Q bytes. Buckets are then refined by sorting on the
bucket pointers of later offsets: a suffix known to depth d is sorted by its own
pointer and that of the suffix d bytes on, and the updated pointers serve the next
pass, so the depth doubles until it is LENGTH. Only suffixes that still share a
bucket are sorted again. A bucket left at full depth with two positions, or with
one of weight two, is a string that repeats.

Hot anchors. Where more than TYPES types share an anchor (a passage in very many
contexts), each run is split into runs of fewer strings (SPLITS), and the text
that all strings of such a run have in common takes the anchor's place. The last
split has one string a run, so its types have one member each, and no task ever
gets more than TYPES types of one anchor.

Words instead of bytes. `remove_repeated_words` runs the same search over texts in
which CODE bytes of a hash stand for each word, so that a string of `words` words
is a string of `words * CODE` bytes whatever its language and white space. What it
finds is turned back into whole words. WORDS is 51, the shortest passage of over
50 words, less its first and last word, which may be joined to what surrounds them.

Edge cases: a null text is empty; texts shorter than LENGTH (or WORDS) lose nothing;
equal rows are copies of each other; a removal may cut a character in two, which
counts by bytes and, where text is returned, drops what is left of it; removed words
take the white space after them along; a text without white space is one word, which
only the search by bytes can cut; further columns are carried by `remove_repeats` and
`remove_repeated_words`, whose own are named `hf_*` while they work.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialise, partitions, release, row_key, slices, texts

LENGTH = 400
GRAM = 100
#: Words of a repeated passage and of a gram, and the bytes that stand for a word.
WORDS = 49
GRAM_WORDS = 12
CODE = 6
Q = 8
#: Types of one anchor that a task takes.
TYPES = 256
#: Strings in a run, after each split of hot anchors.
SPLITS = (32, 4, 1)
#: Bytes of text that are turned into anchors, or into a suffix array, at once.
BUFFER = 1 << 20
POSITION_BITS = 22

_IN_WORD = ~np.isin(np.arange(256), list(b" \t\n\v\f\r"))
_WEIGHT = (np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.int64).astype(np.uint64) << np.uint64(1)) | np.uint64(1)
_STEP = 0x9E3779B97F4A7C15
_BACK = pow(_STEP, -1, 1 << 64)
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> list[np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        m = max(n, BUFFER + 1)
        _powers[:] = [np.multiply.accumulate(np.r_[np.uint64(1), np.full(m - 1, base, np.uint64)]) for base in (_STEP, _BACK)]
    return _powers


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of the `size` bytes from each position on, by content alone."""
    up, down = _power_tables(len(data))
    sums = np.r_[np.uint64(0), np.cumsum(_WEIGHT[data] * up[: len(data)])]
    h = (sums[size:] - sums[:-size]) * down[: len(data) - size + 1]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` neighbours."""
    n = len(x)
    full = -(-n // width) * width
    grid = np.full(full, np.iinfo(x.dtype).max, x.dtype)
    grid[:n] = x
    grid = grid.reshape(-1, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def anchor_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Runs of strings of one anchor in data[starts:ends]: first string, number of strings, anchor's place from there, anchor's hash."""
    none = np.empty(0, np.int64)
    if len(data) < length:
        return none, none, none, none
    h = gram_hashes(data, gram)
    mask = np.uint64((1 << POSITION_BITS) - 1)
    least = sliding_least((h & ~mask) | np.arange(len(h), dtype=np.uint64), length - gram + 1)
    edge = np.zeros(len(least) + 1, np.int32)
    some = ends - starts >= length
    edge[starts[some]] += 1
    edge[ends[some] - length + 1] -= 1
    valid = np.cumsum(edge[:-1]) > 0
    new = valid & np.r_[True, ~valid[:-1] | (least[1:] != least[:-1])]
    first = np.flatnonzero(new)
    number = np.cumsum(new)
    count = np.bincount(number[valid] - 1, minlength=len(first)) if len(first) else none
    place = (least[first] & mask).astype(np.int64)
    return first, count.astype(np.int64), place - first, h[place].view(np.int64)


def word_codes(text: bytes) -> bytes:
    """CODE bytes of the hash of each word."""
    codes = np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, text.split())), np.uint8)
    return codes.reshape(-1, 8)[:, :CODE].tobytes()


def word_starts(text: bytes) -> np.ndarray:
    inside = np.r_[False, _IN_WORD[np.frombuffer(text, np.uint8)]]
    return np.flatnonzero(inside[1:] & ~inside[:-1])


def cut(batches: Iterator[pa.RecordBatch], column: str, length: int, code: Callable[[bytes], bytes] = bytes) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Buffers of text: the batch, its bytes, and the row, place in the text and bounds of each stretch; long texts come in stretches that overlap by length - 1."""
    for batch in slices(batches, column, BUFFER):
        found = [code(x) for x in texts(batch.column(column))]
        if len(found) == 1 and len(found[0]) > BUFFER:
            data = np.frombuffer(found[0], np.uint8)
            for at in range(0, len(data) - length + 1, BUFFER - length + 1):
                part = data[at : at + BUFFER]
                yield batch, part, np.array([0]), np.array([at]), np.array([[0, len(part)]])
            continue
        ends = np.cumsum([len(x) for x in found])
        yield batch, np.frombuffer(b"".join(found), np.uint8), np.arange(len(found)), np.zeros(len(found), np.int64), np.c_[ends - [len(x) for x in found], ends]


def find_runs(docs: DataFrame, length: int, gram: int, code: Callable[[bytes], bytes]) -> DataFrame:
    """Per run of strings of one anchor: the text's key, the place of its first string, their number, the anchor."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, row, at, bounds in cut(batches, "hf_text", length, code):
            first, count, place, anchor = anchor_runs(data, bounds[:, 0], bounds[:, 1], length, gram)
            part = np.searchsorted(bounds[:, 0], first, side="right") - 1
            rows = pa.array(row[part])
            yield pa.RecordBatch.from_arrays([batch.column("key_a").take(rows), batch.column("key_b").take(rows), pa.array(first - bounds[part, 0] + at[part]), pa.array(count), pa.array(place), pa.array(anchor)], names=["key_a", "key_b", "first", "count", "place", "anchor"])

    return docs.mapInArrow(runs, "key_a long, key_b long, first long, count long, place long, anchor long")


def _type(text: bytes) -> tuple[int, int]:
    h = xxhash.xxh3_128_intdigest(text)
    return int(np.uint64(h >> 64).view(np.int64)), int(np.uint64(h & (1 << 64) - 1).view(np.int64))


SEGMENTS = "anchor long, type_a long, type_b long, place long, key_a long, key_b long, first long, segment binary"


def fetch_segments(docs: DataFrame, runs: DataFrame, length: int, code: Callable[[bytes], bytes]) -> DataFrame:
    """For each run: anchor, type, where it stands, and its text (null if the same worker has sent that type just before)."""
    lists = runs.groupBy("key_a", "key_b").agg(F.collect_set(F.struct("first", "count", "place", "anchor")).alias("runs"))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "hf_text", BUFFER):
            out, seen = [], set()
            for a, b, text, found in zip(batch.column("key_a").to_pylist(), batch.column("key_b").to_pylist(), map(code, texts(batch.column("hf_text"))), batch.column("runs").to_pylist()):
                for r in found:
                    part = text[r["first"] : r["first"] + r["count"] + length - 1]
                    kind = _type(part)
                    out.append((r["anchor"], *kind, r["place"], a, b, r["first"], None if kind in seen else part))
                    seen.add(kind)
                    if len(out) >= 5000:
                        yield _batch(out, SEGMENTS)
                        out = []
            yield _batch(out, SEGMENTS)

    return docs.join(lists, ["key_a", "key_b"]).select("key_a", "key_b", "hf_text", "runs").mapInArrow(fetch, SEGMENTS)


def _batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    schema = pa.schema([(name, pa.binary() if kind == "binary" else pa.int64()) for name, kind in (x.split() for x in ddl.split(", "))])
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows) if rows else [[]] * len(schema), schema)], schema=schema)


def refine(data: np.ndarray, left: np.ndarray, length: int) -> np.ndarray:
    """Bucket pointers, at depth `length`, of the positions that share a bucket; -1 for all others.

    left: the bytes from each position to its stretch's end. A pointer is the
    bucket's first place in the suffix array; the parts of a refined bucket take
    pointers within its old range, so no two buckets ever meet.
    """
    n = len(data)
    pointer = np.full(n, -1, np.int64)
    depth = min(Q, length)
    at = np.flatnonzero(left >= depth)
    word = np.zeros(len(at), np.uint64)
    for k in range(depth):
        word = (word << np.uint64(8)) | data[at + k]
    _, bucket, size = np.unique(word, return_inverse=True, return_counts=True)
    pointer[at] = (np.cumsum(size) - size)[bucket]
    shared = at[size[bucket] > 1]
    while depth < length:
        step = min(depth, length - depth)
        shared = shared[left[shared] >= depth + step]
        key = pointer[shared].astype(np.uint64) * np.uint64(n + 1) + pointer[shared + step].astype(np.uint64)
        order = np.argsort(key, kind="stable")
        key, shared = key[order], shared[order]
        old, place = pointer[shared], np.arange(len(shared))
        whole = _first_places(old, place)
        part = _first_places(key, place)
        pointer[shared] = old + part - whole
        shared = shared[np.bincount(part, minlength=len(part))[part] > 1]
        depth += step
    out = np.full(n, -1, np.int64)
    out[shared] = pointer[shared]
    return out


def _first_places(x: np.ndarray, place: np.ndarray) -> np.ndarray:
    """For each of the sorted x, the first place of its value."""
    return np.maximum.accumulate(np.where(np.r_[True, x[1:] != x[:-1]][: len(x)], place, 0))


def marked_strings(parts: list[bytes], weights: list[int], length: int) -> list[list[tuple[int, int]]]:
    """Of each part, the ranges of starts of strings that occur twice or more among all parts, each part counting `weight` times."""
    sizes = np.array([len(x) for x in parts])
    data = np.frombuffer(b"".join(parts), np.uint8)
    ends = np.cumsum(sizes)
    left = np.repeat(ends, sizes) - np.arange(len(data))
    repeated = refine(data, left, length) >= 0
    repeated |= np.repeat(np.array(weights) > 1, sizes)
    repeated &= left >= length
    out = []
    for e, s in zip(ends, sizes):
        edge = np.flatnonzero(np.diff(np.r_[False, repeated[e - s : e], False].astype(np.int8)))
        out.append(list(zip(edge[::2].tolist(), edge[1::2].tolist())))
    return out


MARKS = "type_a long, type_b long, start long, stop long"


def mark_types(types: DataFrame, length: int) -> DataFrame:
    """types (anchor, type_a, type_b, weight, segment), few of an anchor, to the ranges of repeated strings of each type."""

    def solve(held: list[tuple]) -> pa.RecordBatch:
        found = marked_strings([r[4] for r in held], [r[3] for r in held], length)
        return _batch([(r[1], r[2], s, e) for r, ranges in zip(held, found) for s, e in ranges], MARKS)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for r in zip(*(batch.column(c).to_pylist() for c in ("anchor", "type_a", "type_b", "weight", "segment"))):
                if size >= BUFFER and held[-1][0] != r[0]:  # an anchor's types stay together
                    yield solve(held)
                    held, size = [], 0
                held.append(r)
                size += len(r[4])
        if held:
            yield solve(held)

    dealt = types.select("anchor", "type_a", "type_b", "weight", "segment").repartition(partitions(types.sparkSession), "anchor").sortWithinPartitions("anchor")
    return dealt.mapInArrow(mark, MARKS)


SPLIT = "anchor long, type_a long, type_b long, place long, weight long, parent_a long, parent_b long, offset long, segment binary"


def split_types(types: DataFrame, strings: int, length: int) -> DataFrame:
    """The types' runs in runs of `strings`, aligned at the anchor's place; the text common to a run's strings becomes its anchor."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for a, b, weight, text, place in zip(*(batch.column(c).to_pylist() for c in ("type_a", "type_b", "weight", "segment", "place"))):
                start, count = 0, len(text) - length + 1
                while start < count:
                    first = place + (start - place) // strings * strings  # of the whole run, which may begin before the text
                    stop = min(count, first + strings)
                    part, core = text[start : stop + length - 1], first + strings - 1
                    out.append((_type(text[core : first + length])[0], *_type(part), core - start, weight, a, b, start, part))
                    start = stop
                    if len(out) >= 2000:
                        yield _batch(out, SPLIT)
                        out = []
            yield _batch(out, SPLIT)

    return types.select("type_a", "type_b", "weight", "segment", "place").mapInArrow(split, SPLIT)


def repeated_ranges(docs: DataFrame, length: int, gram: int, most_types: int, splits: tuple[int, ...], code: Callable[[bytes], bytes]) -> DataFrame:
    """docs (key_a, key_b, hf_text) to the ranges (start, stop) to remove of the coded text: key_a, key_b, spans; ranges may touch or overlap."""
    runs = materialise(find_runs(docs, length, gram, code), "runs")
    twice = materialise(runs.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"), "anchors")
    segments = materialise(fetch_segments(docs, runs.join(twice, "anchor"), length, code), "segments")
    release(runs, twice)
    types = segments.groupBy("anchor", "type_a", "type_b").agg(F.count("*").alias("weight"), F.max("place").alias("place"), F.max("segment").alias("segment"))
    levels: list[tuple[DataFrame, DataFrame | None]] = []  # marks of a level, and its types' places in those above
    places, used = None, []
    for strings in (*splits, None):
        types = materialise(types, "types")
        hot = materialise(types.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > most_types), "hot")
        marks = materialise(mark_types(types.join(hot, "anchor", "left_anti"), length), "marks")
        levels.append((marks, places))
        used.append(marks)
        if strings is None or hot.isEmpty():
            release(types, hot)
            break
        parts = materialise(split_types(types.join(hot, "anchor", "left_semi"), strings, length), "parts")
        used.append(parts)
        release(types, hot)
        places = parts.select("type_a", "type_b", "parent_a", "parent_b", "offset").distinct()
        types = parts.groupBy("anchor", "type_a", "type_b").agg(F.sum("weight").alias("weight"), F.max("place").alias("place"), F.max("segment").alias("segment"))
    marks = None
    for own, above in reversed(levels):
        marks = own if marks is None else own.union(marks)
        if above is not None:
            marks = marks.join(above, ["type_a", "type_b"]).select(F.col("parent_a").alias("type_a"), F.col("parent_b").alias("type_b"), (F.col("start") + F.col("offset")).alias("start"), (F.col("stop") + F.col("offset")).alias("stop"))
    where = segments.select("type_a", "type_b", "key_a", "key_b", "first").distinct()
    ranges = where.join(marks, ["type_a", "type_b"]).select("key_a", "key_b", (F.col("first") + F.col("start")).alias("start"), (F.col("first") + F.col("stop") - 1 + length).alias("stop"))
    lists = ranges.groupBy("key_a", "key_b").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    found = materialise(lists, "spans")
    release(segments, *used)
    return found


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select("*", *(c.alias(f"hf_{k}") for k, c in zip(("key_a", "key_b"), row_key("doc_id", "text"))))


def _spans(docs: DataFrame, length: int, gram: int, most_types: int, splits: tuple[int, ...], code: Callable[[bytes], bytes] = bytes) -> DataFrame:
    """docs with hf_spans, the ranges to remove (null: none)."""
    keys = docs.select(F.col("hf_key_a").alias("key_a"), F.col("hf_key_b").alias("key_b"), F.col("text").cast("string").alias("hf_text"))
    lists = repeated_ranges(keys, length, gram, most_types, splits, code)
    return docs.join(lists.select(*(F.col(c).alias(f"hf_{c}") for c in lists.columns)), ["hf_key_a", "hf_key_b"], "left")


def merged_spans(spans: list[dict] | None) -> list[tuple[int, int]]:
    """The maximal runs that the ranges cover."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted((r["start"], r["stop"]) for r in spans or []):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], stop))
        else:
            out.append((start, stop))
    return out


def kept_bytes(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    return b"".join(text[a:b] for a, b in zip([0, *(b for _, b in spans)], [*(a for a, _ in spans), len(text)]))


def dedup_suffixes(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, most_types: int = TYPES, splits: tuple[int, ...] = SPLITS) -> DataFrame:
    """Per row of docs: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    narrow = keyed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")))

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = []
            for text, found in zip(texts(batch.column("text")), batch.column("hf_spans").to_pylist()):
                spans = merged_spans(found)
                rows.append((len(text), sum(b - a for a, b in spans), len(spans), hashlib.sha256(kept_bytes(text, spans)).hexdigest()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(x) for x in zip(*rows))], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    spans = _spans(narrow, length, gram, most_types, splits)
    return spans.select("doc_id", "text", "hf_spans").mapInArrow(report, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def word_spans(text: bytes, spans: list[dict] | None) -> list[tuple[int, int]]:
    """The bytes of the words whose codes the ranges cover, up to the next word."""
    starts = np.r_[word_starts(text), len(text)]
    return [(int(starts[-(-a // CODE)]), int(starts[b // CODE])) for a, b in merged_spans(spans)]


def _cut_out(docs: DataFrame, spans: DataFrame, ranges: Callable[[bytes, list[dict]], list[tuple[int, int]]]) -> DataFrame:
    """The rows of docs, with the ranges of hf_spans taken out of the text."""
    schema = docs.schema

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            kept = []
            for text, found in zip(batch.column("text").to_pylist(), batch.column("hf_spans").to_pylist()):
                data = None if found is None else text.encode()
                kept.append(text if data is None else kept_bytes(data, ranges(data, found)).decode(errors="ignore"))
            yield pa.RecordBatch.from_arrays([pa.array(kept, pa.string()) if c == "text" else batch.column(c) for c in schema.names], names=schema.names)

    return spans.select(*schema.names, "hf_spans").mapInArrow(remove, T.StructType([T.StructField(f.name, f.dataType) for f in schema]))


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, most_types: int = TYPES, splits: tuple[int, ...] = SPLITS) -> DataFrame:
    """The rows of docs, their repeated strings of `length` bytes taken out of the text."""
    return _cut_out(docs, _spans(keyed(docs), length, gram, most_types, splits), lambda _, found: merged_spans(found))


def remove_repeated_words(docs: DataFrame, words: int = WORDS, gram: int = GRAM_WORDS, most_types: int = TYPES, splits: tuple[int, ...] = SPLITS) -> DataFrame:
    """The rows of docs, their repeated runs of `words` words taken out of the text."""
    return _cut_out(docs, _spans(keyed(docs), words * CODE, gram * CODE, most_types, splits, word_codes), word_spans)
