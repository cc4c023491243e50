"""Language-model scoring with an Elias-Fano n-gram trie.

The model is a trigram model with Dirichlet smoothing,

    p(w | u v) = (c(uvw) + MASS * p(w | v)) / (c(uv.) + MASS),
    p(w | v)   = (c(vw) + MASS * p(w)) / (c(v) + MASS),
    p(w)       = (c(w) + 1) / (N + V + 1),

over words and the end of a text, which is also the context of the next first word;
c(uv.) counts the places where a token follows u v in its text. A text's first token
has the bigram context alone, an unseen context hands on to the shorter one.

The trie's levels are files of the shared folder, memory-mapped by the workers and
cut into shards, so that no task builds or holds a whole level:

* the vocabulary, by hash: the sorted hashes of the words and the running sum of
  their counts, both Elias-Fano, and quantised p(w) and back-off weights. A word's
  number is its place;
* bigrams and trigrams, by their first word: sorted contexts u, monotone pointers to
  their first successors, the successors' numbers v, and for each bigram so found a
  monotone pointer to its first successor w on the next level. Each number is stored
  above the last one of the context before it, which makes a whole level monotone; it
  is searched for relative to its context. Beside them stand quantised p(v | u), a
  trigram's own share c(uvw) / (c(uv.) + MASS) and its context's weight
  MASS / (c(uv.) + MASS), by which p(w | v), of another shard, is mixed in.

Probabilities are quantised to 16 bits over [-QUANTISED_RANGE, 0]. Counts are
exact, over all training texts, and the base score is computed from them.

Training and scoring both turn a text into rows (u, v, w), a token with the one before
and the one after it: one row stands for a bigram and for the trigram that goes on
from it, so either side visits a shard once for both. Words that make up a large part of
all tokens have very many successors: their rows are dealt by (u, v) instead of by u,
so no shard holds a hot word's successors alone. Rows are counted in each task before
they are dealt. A scoring task sorts some millions of rows by shard, opens each shard
once for them, and keeps at most a fixed number open. A shard's file has a name that
follows from its number and is put in place whole, by a rename: no list of files
reaches the driver or a task, and a second attempt replaces like by like.

Edge cases: a null or wordless text is one end token; a null id is in no held-out
fold, so its text is learnt from; equal rows count as often as they occur;
without training texts every token is unknown; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .classifier import remainder
from .common import materialise, release, scratch, slices
from .elias_fano import EliasFano, load, named, save, sequence

FOLDS, HELD_OUT = 7, 2
END = b"\n"
MASS = 8.0
QUANTISED_RANGE = 24.0
#: Words in a vocabulary shard and training tokens to a shard of n-grams, about.
SHARD_WORDS = 500_000
SHARD_TOKENS = 2_000_000
#: Words, and rows, that a task counts before it hands counts on, and rows that it looks up together.
HELD_WORDS = 1_000_000
HELD_ROWS = 1_000_000
#: Bytes of text that share a list of distinct words.
SLICE = 4 << 20


class Tokens:
    """The texts of a batch as places in a list of distinct words, END first; a text's tokens are its words and one END."""

    def __init__(self, column: pa.Array):
        parts = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(column, "")))
        flat = parts.flatten().dictionary_encode()
        place = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1
        lengths = parts.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        text = np.repeat(np.arange(len(parts)), lengths)
        if (void := pc.index(flat.dictionary, "").as_py()) >= 0:  # before leading and after trailing white space
            words = place != void + 1
            place, text = place[words], text[words]
            lengths = np.bincount(text, minlength=len(parts))
        self.lengths = lengths + 1
        self.stops = np.cumsum(self.lengths)
        self.starts = self.stops - self.lengths
        self.index = np.zeros(len(place) + len(parts), np.int64)
        self.index[np.arange(len(place)) + text] = place  # an END after each text before
        distinct = flat.dictionary.cast(pa.binary())
        _, ends, data = distinct.buffers()
        ends = np.frombuffer(ends, np.int32)[distinct.offset : distinct.offset + len(distinct) + 1].tolist() if len(distinct) else [0]
        data = data.to_pybytes() if data else b""
        self.words = [END, *(data[a:b] for a, b in zip(ends, ends[1:]))]


def hashes(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each word, in two halves."""
    both = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), ">u8").reshape(-1, 2)
    return both[:, 0].astype(np.uint64), both[:, 1].astype(np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def quantise(log10p: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(-log10p * (65535 / QUANTISED_RANGE)), 0, 65535).astype("<u2")


def dequantise(code: np.ndarray) -> np.ndarray:
    return code * (-QUANTISED_RANGE / 65535)


#: The probability of each code.
POWERS = 10 ** dequantise(np.arange(65536))


@dataclass(frozen=True)
class Vocabulary:
    """The vocabulary's shards in a folder; find() and of() are for workers."""

    folder: str
    shards: int
    total: int  # tokens
    size: int  # distinct tokens

    def file(self, k: int) -> str:
        return f"{self.folder}/words-{k:06d}.level"

    def known(self, name: str) -> np.ndarray:
        """`starts`: the number of each shard's first word, and of words in all; `hot`: sorted numbers of hot words."""
        return load(f"{self.folder}/vocabulary.level")[name]

    def find(self, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number (or -1) and count of each word."""
        number, count, starts = np.full(len(low), -1, np.int64), np.zeros(len(low), np.int64), self.known("starts")
        shard = (high % np.uint64(self.shards)).astype(np.int64)
        for k, at in _groups(shard):
            level = load(self.file(k))
            if level is None:
                continue
            order = at[np.argsort(low[at])]
            found = sequence(level, "words").find(low[order])
            hit = found >= 0
            order, found = order[hit], found[hit]
            sums = sequence(level, "counts")
            number[order] = starts[k] + found
            count[order] = (sums.get(found + 1) - sums.get(found)).astype(np.int64)
        return number, count

    def of(self, number: np.ndarray, field: str) -> np.ndarray:
        """Per word number, its count (as a double) or a quantised field."""
        out, starts = np.zeros(len(number), np.float64), self.known("starts")
        shard = np.searchsorted(starts, number, side="right") - 1
        for k, at in _groups(shard):
            level, place = load(self.file(k)), number[at] - starts[k]
            if field == "counts":
                sums = sequence(level, "counts")
                out[at] = sums.get(place + 1) - sums.get(place)
            else:
                out[at] = dequantise(level[field][place])
        return out


def _groups(shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    if len(shard) and shard.max() < 1 << 16:
        shard = shard.astype(np.uint16)  # sorted by counting
    order = np.argsort(shard, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1):
        if len(part):
            yield int(shard[part[0]]), part


def count_words(docs: DataFrame) -> DataFrame:
    """(high, low, n): how often each token occurs in docs(text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def out() -> pa.RecordBatch:
            high, low, n = (np.concatenate(x) for x in zip(*held))
            held.clear()
            order = np.lexsort((high, low))
            high, low = high[order], low[order]
            first = np.flatnonzero(np.r_[True, (low[1:] != low[:-1]) | (high[1:] != high[:-1])])
            return pa.RecordBatch.from_arrays([pa.array(high[first].view(np.int64)), pa.array(low[first].view(np.int64)), pa.array(np.add.reduceat(n[order], first))], names=["high", "low", "n"])

        for batch in slices(batches, "text", SLICE):
            x = Tokens(batch.column("text"))
            n = np.bincount(x.index, minlength=len(x.words))
            some = np.flatnonzero(n)
            held.append((*hashes([x.words[k] for k in some.tolist()]), n[some]))
            if sum(len(n) for _, _, n in held) >= HELD_WORDS:
                yield out()
        if held:
            yield out()

    return docs.select("text").mapInArrow(count, "high long, low long, n long").groupBy("high", "low").agg(F.sum("n").alias("n"))


def build_vocabulary(counts: DataFrame, folder: str, hot_of: Callable[[int], int]) -> Vocabulary:
    """The vocabulary's shards; words of more than hot_of(tokens in all) tokens are hot."""
    total, size = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    made, hot = Vocabulary(folder, max(1, -(-size // SHARD_WORDS)), int(total), int(size)), hot_of(total)
    shards = made.shards
    # as numpy's remainder of the unsigned half
    shard = F.pmod(F.pmod(F.shiftrightunsigned("high", 1) % shards * 2 + F.col("high").bitwiseAND(F.lit(1)), F.lit(shards)), F.lit(shards)).cast("int")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, low, n in _whole(batches, "shard", ("low", "n")):
            low = low.view(np.uint64)
            order = np.argsort(low)
            low, n = low[order], n[order]
            save(made.file(k), named("words", EliasFano.build(low)) | named("counts", EliasFano.build(np.r_[0, np.cumsum(n)])) | {"unigram": quantise(np.log10((n + 1) / (total + size + 1))), "backoff": quantise(np.log10(MASS / (n + MASS)))})
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([len(low)], pa.int64()), pa.array([np.flatnonzero(n > hot).tolist()], pa.list_(pa.int64()))], names=["shard", "words", "hot"])

    dealt = counts.withColumn("shard", shard).repartition(shards, "shard").sortWithinPartitions("shard")
    words, numbers = np.zeros(shards + 1, np.int64), []
    found = dealt.select("shard", "low", "n").mapInArrow(build, "shard int, words long, hot array<long>").collect()  # a number to a shard, and at most total / hot hot words
    for r in found:
        words[r.shard + 1] = r.words
    starts = np.cumsum(words)
    for r in found:
        numbers += [starts[r.shard] + x for x in r.hot]
    save(f"{folder}/vocabulary.level", {"starts": starts, "hot": np.sort(np.array(numbers, np.int64))})
    return made


def _whole(batches: Iterator[pa.RecordBatch], key: str, columns: tuple[str, ...]) -> Iterator[tuple]:
    """(key, arrays) of consecutive rows of one key, over the batches' bounds."""
    now, held = None, []
    for batch in batches:
        keys = batch.column(key).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if held and keys[a] != now:
                yield now, *(np.concatenate(x) for x in zip(*held))
                held = []
            now = int(keys[a])
            held.append(tuple(batch.column(c).to_numpy(zero_copy_only=False)[a:b] for c in columns))
    if held:
        yield now, *(np.concatenate(x) for x in zip(*held))


class Numbered(Tokens):
    """Tokens, and the numbers of the distinct words (-1: unknown) and how often each was counted."""

    def __init__(self, column: pa.Array, vocabulary: Vocabulary):
        super().__init__(column)
        self.numbers, self.counts = vocabulary.find(*hashes(self.words))
        self.end = int(self.numbers[0])


def rows_of(number: np.ndarray, lengths: np.ndarray, end: int, none: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each token between the one before it, `end` at the start of a text, and the one after it, `none` at its end."""
    stops = np.cumsum(lengths)
    before, after = np.r_[end, number[:-1]], np.r_[number[1:], none]
    before[stops - lengths], after[stops - 1] = end, none
    return before, number, after


def row_order(u: np.ndarray, v: np.ndarray, w: np.ndarray, top: int) -> np.ndarray:
    """An order by u, v and w, numbers from 0 to top; in one key where 64 bits hold it."""
    bits = int(top).bit_length()
    if 3 * bits <= 63:
        return np.argsort((u << (2 * bits)) | (v << bits) | w)
    if 2 * bits > 63:
        return np.lexsort((w, v, u))
    less = 3 * bits - 63  # low bits of w that find no room: rows alike but for them are sorted by them after
    key = (u << (2 * bits - less)) | (v << (bits - less)) | (w >> less)
    order = np.argsort(key)
    key, w = key[order], w[order]
    alike = np.r_[False, key[1:] == key[:-1], False]
    if (alike[1:-1] & (w[1:] < w[:-1])).any():
        some = np.flatnonzero(alike[1:] | alike[:-1])
        order[some] = order[some[np.lexsort((w[some], key[some]))]]
    return order


def counted(u: np.ndarray, v: np.ndarray, w: np.ndarray, top: int, n: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Distinct rows, ascending, and how often each occurs."""
    order = row_order(u, v, w, top)
    u, v, w = u[order], v[order], w[order]
    first = np.flatnonzero(np.r_[True, (u[1:] != u[:-1]) | (v[1:] != v[:-1]) | (w[1:] != w[:-1])])
    n = np.diff(np.r_[first, len(u)]) if n is None else np.add.reduceat(n[order], first)
    return u[first], v[first], w[first], n


def counted_ranks(numbers: list[np.ndarray], index: list[np.ndarray], lengths: list[np.ndarray], end: int, size: int) -> tuple[np.ndarray, ...]:
    """counted() of the rows of some batches' known tokens: places in the batches' lists of numbers. Rows are sorted by places among the numbers that occur, which take fewer bits."""
    held = np.unique(np.concatenate([*numbers, np.array([end, size])]))
    number = np.concatenate([np.searchsorted(held, x)[k] for x, k in zip(numbers, index)])
    u, v, w = rows_of(number, np.concatenate(lengths), int(np.searchsorted(held, end)), len(held) - 1)
    bits = len(held).bit_length()
    if 3 * bits > 63:
        return counted(held[u], held[v], held[w], size)
    key = (u << (2 * bits)) | (v << bits) | w
    key.sort()
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    n, key, low = np.diff(np.r_[first, len(key)]), key[first], (1 << bits) - 1
    return held[key >> (2 * bits)], held[(key >> bits) & low], held[key & low], n


@dataclass(frozen=True)
class Trie:
    vocabulary: Vocabulary
    shards: int  # of bigrams and trigrams

    def file(self, k: int) -> str:
        return f"{self.vocabulary.folder}/grams-{k:07d}.level"

    def shard(self, u: np.ndarray, v: np.ndarray) -> np.ndarray:
        """The shard of each row: by its first word, or for hot ones by the first two."""
        x, hot = mixed(u.astype(np.uint64)), self.vocabulary.known("hot")
        if len(hot):
            x = np.where(hot[np.minimum(np.searchsorted(hot, u), len(hot) - 1)] == u, mixed(x + v.astype(np.uint64)), x)
        return (x % np.uint64(self.shards)).astype(np.int64)

    def look_up(self, u: np.ndarray, v: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each row of known u and v: p(v | u) (nan: not held), the share of (u, v, w) and the weight of what is shorter."""
        out = np.full(len(u), np.nan), np.zeros(len(u)), np.ones(len(u))
        bits = int(self.vocabulary.size).bit_length()
        for k, at in _groups(self.shard(u, v)):
            level = load(self.file(k))
            if level is not None:
                rows = at[np.argsort((u[at] << bits) | v[at]) if 2 * bits <= 63 else np.lexsort((v[at], u[at]))]
                for to, x in zip(out, find_rows(level, u[rows], v[rows], w[rows], self.vocabulary.size)):
                    to[rows] = x
        return out


def stacked(context: np.ndarray, number: np.ndarray, contexts: int) -> np.ndarray:
    """Sorted numbers of sorted contexts, each above the last one of the context before."""
    last = np.zeros(contexts, np.int64)
    last[context] = number + 1  # the greatest comes last
    return (np.cumsum(last) - last)[context] + number


def build_level(u: np.ndarray, v: np.ndarray, w: np.ndarray, n: np.ndarray, vocabulary: Vocabulary) -> dict[str, np.ndarray]:
    """The arrays of a shard of sorted distinct rows; a row whose w is the vocabulary's size ends a text."""
    new = np.r_[True, (u[1:] != u[:-1]) | (v[1:] != v[:-1])]
    first = np.flatnonzero(new)
    one, two, times = u[first], v[first], np.add.reduceat(n, first)
    start = np.flatnonzero(np.r_[True, one[1:] != one[:-1]])
    context = np.repeat(np.arange(len(start)), np.diff(np.r_[start, len(one)]))
    words = np.unique(two)
    p = (vocabulary.of(words, "counts") + 1) / (vocabulary.total + vocabulary.size + 1)
    smoothed = (times + MASS * p[np.searchsorted(words, two)]) / (vocabulary.of(one[start], "counts")[context] + MASS)
    follows = w < vocabulary.size
    followed = np.add.reduceat(n * follows, first)
    node, third, times = (np.cumsum(new) - 1)[follows], w[follows], n[follows]
    return (
        named("contexts", EliasFano.build(one[start]))
        | named("pointers", EliasFano.build(np.r_[start, len(one)]))
        | named("successors", EliasFano.build(stacked(context, two, len(start))))
        | {"bigram": quantise(np.log10(smoothed)), "weight": quantise(np.log10(MASS / (followed + MASS)))}
        | named("next_pointers", EliasFano.build(np.r_[0, np.cumsum(np.bincount(node, minlength=len(one)))]))
        | named("next_successors", EliasFano.build(stacked(node, third, len(one))))
        | {"share": quantise(np.log10(times / (followed[node] + MASS)))}
    )


def _ranges(pointers: EliasFano, successors: EliasFano, context: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each context: where its successors begin and end, and above what their numbers are stored."""
    start, stop = (pointers.get(context + k).astype(np.int64) for k in (0, 1))
    base, later = np.zeros(len(context), np.int64), start > 0
    base[later] = successors.get(start[later] - 1).astype(np.int64) + 1
    return start, stop, base


def _within(successors: EliasFano, number: np.ndarray, start: np.ndarray, stop: np.ndarray, base: np.ndarray) -> np.ndarray:
    """The place of each number among its context's successors, or -1."""
    return successors.find(base + number, start, stop)


def find_rows(level: dict[str, np.ndarray], u: np.ndarray, v: np.ndarray, w: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Trie.look_up of the rows of one shard, sorted by u and v; no w below 0 or from size on has a trigram."""
    new = np.r_[True, (u[1:] != u[:-1]) | (v[1:] != v[:-1])]
    first, back = np.flatnonzero(new), np.cumsum(new) - 1
    one, two = u[first], v[first]
    start = np.r_[True, one[1:] != one[:-1]]
    context = sequence(level, "contexts").find(one[start])
    successors = sequence(level, "successors")
    ranges = np.zeros((3, len(context)), np.int64)
    have = context >= 0
    ranges[:, have] = _ranges(sequence(level, "pointers"), successors, context[have])
    node = _within(successors, two, *ranges[:, np.cumsum(start) - 1])
    held = np.flatnonzero(node >= 0)
    bigram, weight, share = np.full(len(two), np.nan), np.ones(len(two)), np.zeros(len(u))
    bigram[held], weight[held] = POWERS[level["bigram"][node[held]]], POWERS[level["weight"][node[held]]]
    if len(level["share"]):
        successors = sequence(level, "next_successors")
        ranges = np.zeros((3, len(two)), np.int64)
        ranges[:, held] = _ranges(sequence(level, "next_pointers"), successors, node[held])
        ask = np.flatnonzero((w >= 0) & (w < size) & (ranges[1] > ranges[0])[back])
        place = _within(successors, w[ask], *ranges[:, back[ask]])
        hit = place >= 0
        share[ask[hit]] = POWERS[level["share"][place[hit]]]
    return bigram[back], share, weight[back]


def _planes(x: np.ndarray, width: int) -> bytes:
    """The low `width` bytes of each number, all first bytes before all second ones."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _pack(u: np.ndarray, v: np.ndarray, w: np.ndarray, n: np.ndarray, top: int) -> bytes:
    """Sorted rows and their counts; of u the differences."""
    width = -(-int(top).bit_length() // 8)
    return zstandard.ZstdCompressor(level=1).compress(_planes(np.diff(u, prepend=0), width) + _planes(v, width) + _planes(w, width) + _planes(n, 5))


def _unpack(data: bytes, top: int) -> tuple[np.ndarray, ...]:
    width = -(-int(top).bit_length() // 8)
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    rows, at, out = len(raw) // (3 * width + 5), 0, []
    for bytes_each in (width, width, width, 5):
        whole = np.zeros((rows, 8), np.uint8)
        whole[:, :bytes_each] = raw[at : at + rows * bytes_each].reshape(bytes_each, rows).T
        out.append(whole.view("<i8").ravel())
        at += rows * bytes_each
    out[0] = np.cumsum(out[0])
    return tuple(out)


def train(docs: DataFrame) -> Trie:
    """The model of docs(text)."""
    folder = scratch(docs.sparkSession, "trie")
    counts = materialise(count_words(docs), "words")
    shards = lambda total: max(1, -(-total // SHARD_TOKENS))
    vocabulary = build_vocabulary(counts, folder, lambda total: max(1, total // (4 * shards(total))))
    release(counts)
    trie, size = Trie(vocabulary, shards(vocabulary.total)), vocabulary.size
    if not size:
        return trie

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        end = -1

        def out() -> pa.RecordBatch:
            numbers, index, lengths = zip(*held)
            u, v, w, n = counted_ranks(numbers, index, lengths, end, size)
            held.clear()
            packed = [(k, _pack(u[at], v[at], w[at], n[at], size)) for k, at in _groups(trie.shard(u, v))]
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in packed], pa.int32()), pa.array([r[1] for r in packed], pa.binary())], names=["shard", "rows"])

        for batch in slices(batches, "text", SLICE):
            x = Numbered(batch.column("text"), vocabulary)
            end = x.end
            held.append((x.numbers, x.index, x.lengths))
            if sum(len(k) for _, k, _ in held) >= HELD_ROWS:
                yield out()
        if held:
            yield out()

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def level(k: int, held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
            u, v, w, n = (np.concatenate(x) for x in zip(*held))
            save(trie.file(k), build_level(*counted(u, v, w, size, n), vocabulary))
            return pa.RecordBatch.from_arrays([pa.array([k], pa.int32())], names=["shard"])

        now, held = None, []
        for batch in batches:
            for k, data in zip(batch.column("shard").to_pylist(), batch.column("rows")):
                if held and k != now:
                    yield level(now, held)
                    held = []
                now = k
                held.append(_unpack(data.as_py(), size))
        if held:
            yield level(now, held)

    dealt = docs.select("text").mapInArrow(rows, "shard int, rows binary").repartition(trie.shards, "shard").sortWithinPartitions("shard")
    dealt.mapInArrow(build, "shard int").write.format("noop").mode("overwrite").save()
    return trie


SCORES = "doc_id long, n_tokens long, n_known long, base_score double, score double"


class Round:
    """Texts whose rows are looked up together."""

    def __init__(self):
        self.ids, self.lengths, self.known, self.base = [], [], [], []
        self.number, self.unigram, self.backoff = [], [], []
        self.end = -1
        self.rows = 0

    def add(self, ids: pa.Array, found: pa.Array, vocabulary: Vocabulary) -> None:
        x = Numbered(found, vocabulary)
        least = vocabulary.total + vocabulary.size + 1
        known = x.numbers >= 0
        unigram, backoff = np.full(len(known), 1 / least), np.ones(len(known))
        unigram[known], backoff[known] = 10 ** vocabulary.of(x.numbers[known], "unigram"), 10 ** vocabulary.of(x.numbers[known], "backoff")
        before = np.r_[0, x.index[:-1]]
        before[x.starts] = 0  # the end of a text is the first of the distinct words
        base = np.log10((x.counts + 1) / least)
        self.ids.append(ids)
        self.lengths.append(x.lengths)
        self.known.append(np.add.reduceat(known[x.index].astype(np.int64), x.starts))
        self.base.append(np.add.reduceat(base[x.index], x.starts))
        self.number.append(x.numbers[x.index])
        self.unigram.append(unigram[x.index])
        self.backoff.append(backoff[before])
        self.end = x.end
        self.rows += len(x.index)

    def scores(self, trie: Trie) -> pa.RecordBatch:
        lengths, number = np.concatenate(self.lengths), np.concatenate(self.number)
        u, v, w = rows_of(number, lengths, self.end, trie.vocabulary.size)
        both = np.flatnonzero((u >= 0) & (v >= 0))
        bigram, share, weight = np.full(len(u), np.nan), np.zeros(len(u)), np.ones(len(u))
        bigram[both], share[both], weight[both] = trie.look_up(u[both], v[both], w[both])
        p = np.where(np.isnan(bigram), np.concatenate(self.unigram) * np.concatenate(self.backoff), bigram)
        starts = np.cumsum(lengths) - lengths
        mixed_in = share[:-1] + weight[:-1] * p[1:]  # a text's first token has the bigram alone
        first = p[starts]
        p[1:] = mixed_in
        p[starts] = first
        logp = np.log10(p)
        return pa.RecordBatch.from_arrays([pa.concat_arrays(self.ids), pa.array(lengths), pa.array(np.concatenate(self.known)), pa.array(np.concatenate(self.base)), pa.array(np.add.reduceat(logp, starts))], names=["doc_id", "n_tokens", "n_known", "base_score", "score"])


def score(docs: DataFrame, trie: Trie) -> DataFrame:
    """docs(doc_id, text) scored: doc_id, n_tokens, n_known, base_score, score."""

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = Round()
        for batch in slices(batches, "text", SLICE):
            now.add(batch.column("doc_id"), batch.column("text"), trie.vocabulary)
            if now.rows >= HELD_ROWS:
                yield now.scores(trie)
                now = Round()
        if now.rows:
            yield now.scores(trie)

    return docs.select("doc_id", "text").mapInArrow(rate, SCORES)


def score_documents(docs: DataFrame) -> DataFrame:
    """Per row of docs: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score; learnt from the rows that are not held out."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    held_out = remainder(F.col("doc_id"), FOLDS) == HELD_OUT
    trie = train(rows.where(~held_out))
    return score(rows, trie).select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(trie.vocabulary.total).cast("long").alias("train_tokens"), "base_score", "score")
