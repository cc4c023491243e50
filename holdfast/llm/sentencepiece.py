"""SentencePiece encoding and decoding by a streaming Viterbi search.

The search walks the characters once and keeps, for each boundary, the piece
that ends there on the best path. A later piece can start no further back than
the longest piece is long, so only that many boundaries survive; whenever all
their backpointer paths run through one boundary, the ids before it are final,
are handed on, and their part of the window is dropped.

A unigram model ranks paths by the sum of piece scores. In a BPE model a path is
the encoding exactly if each two neighbours on it are what their joint text
encodes to, so a path counts if all its neighbouring pairs do, and every
boundary has one such path. Both give the ids of the reference library.

No piece joins a word's end to the next word's space, and none holds a line
break, so all paths converge at these points and the search may begin anew
there: encodings between them are remembered by their text, within a bound.
A BPE model's words that a batch of texts brings are searched side by side, all
at a boundary as far from their start at once, and remembered before its texts
are put together.

Edge cases: a null text is an empty one and has no ids; characters outside the
vocabulary become their bytes, or the unknown id in a model without bytes; the
word-boundary mark itself decodes to a space, as in every such model; null ids
and repeated rows are rows like any other; further columns are not read.
"""

from __future__ import annotations

import re
import sys
from array import array
from bisect import insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, texts

MARK = "▁"
CACHE_WORDS = 300_000
#: Characters of a word that is remembered; characters of words that are searched side by side.
WORD, BLOCK = 48, 1 << 17
MOST_NEIGHBOURS = 2000
#: Pairs of pieces whose verdict the search of many words keeps.
MOST_PAIRS = 1 << 20
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNKNOWN_PENALTY = 10.0


class Memory(dict):
    """At least the last CACHE_WORDS entries and at most twice as many: when it is full, its entries grow old, and those not asked for again go."""

    def __init__(self):
        super().__init__()
        self.before: dict[str, bytes] = {}

    def old(self, key: str) -> bytes | None:
        found = self.before.get(key)
        if found is not None:
            self.add(key, found)
        return found

    def add(self, key: str, value: bytes) -> None:
        if len(self) >= CACHE_WORDS:
            self.before = dict(self)
            self.clear()
        self[key] = value


class Codes:
    """Numbers by keys that are not negative: a table by open addressing, asked for many keys at a time."""

    def __init__(self, bits: int = 12):
        self.bits, self.n = bits, 0
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int32)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).view(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, or -1."""
        at = self._slot(keys)
        held = self.keys[at]
        out = np.where(held == keys, self.values[at], -1)
        more = np.flatnonzero((held != keys) & (held >= 0))
        while len(more):
            at[more] = (at[more] + 1) & (len(self.keys) - 1)
            held = self.keys[at[more]]
            hit = held == keys[more]
            out[more[hit]] = self.values[at[more[hit]]]
            more = more[~hit & (held >= 0)]
        return out

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Add distinct keys that are not held."""
        self.n += len(keys)
        if 2 * self.n > len(self.keys):
            held = self.keys >= 0
            keys, values, self.bits = np.r_[self.keys[held], keys], np.r_[self.values[held], values], (2 * self.n).bit_length()
            self.keys, self.values = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits, np.int32)
        at = self._slot(keys)
        while len(keys):
            free = self.keys[at] < 0
            self.keys[at[free]] = keys[free]  # of two that want a place one has it
            won = self.keys[at] == keys
            self.values[at[won]] = values[won]
            keys, values, at = keys[~won], values[~won], (at[~won] + 1) & (len(self.keys) - 1)


class Trie:
    """The pieces' beginnings as numbered nodes, for the search of many words of a BPE model."""

    def __init__(self, model: PieceModel):
        nodes = {x: k for k, x in enumerate(["", *sorted(model.beginnings)])}
        letters = sorted(p for p in model.ids if len(p) == 1)
        self.letter = np.zeros(sys.maxunicode + 1, np.int32)  # 0: no piece by itself
        self.letter[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.letters, self.steps = len(letters) + 1, Codes()
        steps = [(nodes[x[:-1]] * self.letters + int(self.letter[ord(x[-1])]), k) for x, k in nodes.items() if x and self.letter[ord(x[-1])]]
        self.steps.put(np.array([x[0] for x in steps], np.int64), np.array([x[1] for x in steps], np.int32))
        self.piece = np.array([model.ids[x] if x in model.whole else -1 for x in nodes], np.int32)
        self.text = {k: x for x, k in model.ids.items()}
        self.length = np.zeros(max(self.text, default=0) + 1, np.int32)
        for k, x in self.text.items():
            self.length[k] = len(x)
        self.pairs = Codes()  # 1: the two may stand side by side


class PieceModel:
    """Pieces, scores and kind of a model file; encodes and decodes single texts."""

    def __init__(self, proto: bytes):
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        model.ParseFromString(proto)
        if model.normalizer_spec.name not in ("", "identity") or model.normalizer_spec.remove_extra_whitespaces:
            raise ValueError("only models with the identity normaliser are supported")
        self.kind = model.trainer_spec.model_type
        self.prefix = MARK if model.normalizer_spec.add_dummy_prefix else ""
        self.scores: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.bytes, self.unknown = {}, 0
        self.out: list[bytes] = []
        for k, p in enumerate(model.pieces):
            self.out.append(b"" if p.type == CONTROL else p.piece.replace(MARK, " ").encode())
            if p.type in (NORMAL, USER):
                self.ids[p.piece], self.scores[p.piece] = k, p.score
            elif p.type == BYTE:
                self.bytes[int(p.piece[3:5], 16)] = k
                self.out[-1] = bytes([int(p.piece[3:5], 16)])
            elif p.type == UNKNOWN:
                self.unknown = k
                self.out[-1] = " ⁇ ".encode()
        self.longest = max(map(len, self.ids), default=1)
        self.least = min((s for s in self.scores.values()), default=0.0) - UNKNOWN_PENALTY
        self.beginnings = {p[:k] for p in self.ids for k in range(1, len(p) + 1)}
        self.joined = {p[k : k + 2] for p in self.ids for k in range(len(p) - 1)}
        self.pairs: dict[str, dict[str, bool]] = {}
        self.whole = {p for p in self.ids if self.kind != BPE or len(p) == 1 or self.merged(p) == [p]}
        self.splits = not any(re.search(f"[^{MARK}]{MARK}|\n", p) for p in self.ids)
        self.after_space, self.plain = Memory(), Memory()  # ids of words behind a mark, keyed without it, and of other runs
        self.trie: Trie | None = None

    def merged(self, text: str, bound: int = 0) -> list[str] | None:
        """The pieces of a short text by its merges: highest score first, then leftmost; None once a merge spans the bound."""
        score = self.scores.get
        parts = list(text)
        ranks = [score(a + b) for a, b in zip(parts, parts[1:])]
        while True:
            best, at = None, -1
            for k, r in enumerate(ranks):
                if r is not None and (best is None or r > best):
                    best, at = r, k
            if best is None:
                return parts
            if bound and at == bound - 1:
                return None
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            bound -= at < bound
            del ranks[at]
            if at:
                ranks[at - 1] = score(parts[at - 1] + parts[at])
            if at < len(ranks):
                ranks[at] = score(parts[at] + parts[at + 1])

    def fits(self, a: str, b: str) -> bool:
        """Whether the BPE pieces a and b may stand side by side."""
        try:
            return self.pairs[a][b]
        except KeyError:
            after = self.pairs.setdefault(a, {})
            if len(after) > MOST_NEIGHBOURS:
                after.clear()
            found = after[b] = self.merged(a + b, len(a)) is not None
            return found

    def search(self, text: str) -> Iterator[str]:
        """The pieces of the best path, each as soon as it is final."""
        base, bpe, n, longest = 0, self.kind == BPE, len(text), self.longest
        beginnings, whole, fits, score = self.beginnings, self.whole, self.fits, self.scores.get
        room = min(n, 8 * longest) + 1
        last: list[str] = [""] * room  # the piece that ends at boundary base + k; none yet: empty
        cost: list[float] = [0.0] * (0 if bpe else room)
        for i in range(n):  # every piece that can start at boundary i
            here = i - base
            if here + longest >= len(last):
                last += [""] * (8 * longest)
                cost += [0.0] * (0 if bpe else 8 * longest)
            before = last[here]
            if i and not before:
                raise LookupError(text)
            stop = i + 1
            piece = text[i:stop]
            while True:
                if piece in whole or stop == i + 1:
                    if not bpe:
                        total = cost[here] + score(piece, self.least)
                        if not last[stop - base] or total > cost[stop - base]:
                            last[stop - base], cost[stop - base] = piece, total
                    elif not before or fits(before, piece):
                        last[stop - base] = piece
                stop += 1
                if stop > n:
                    break
                piece = text[i:stop]
                if piece not in beginnings:
                    break
            if here >= 4 * longest:
                ends = [base + k for k in range(here + 1, here + longest + 1) if last[k]]
                while len(ends) > 1:  # walk the furthest path back until all are one
                    back = ends.pop()
                    insort(ends, back - len(last[back - base]))
                    ends = list(dict.fromkeys(ends))
                if ends and ends[0] > base:
                    yield from self._path(last, ends[0] - base)
                    last, cost, base = last[ends[0] - base :], cost[ends[0] - base :], ends[0]
        if n and not last[n - base]:
            raise LookupError(text)
        yield from self._path(last, n - base)

    def _fit(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """fits() of many pairs of ids."""
        trie = self.trie
        keys = a.astype(np.int64) * len(trie.length) + b
        found = trie.pairs.get(keys)
        new = np.flatnonzero(found < 0)
        if len(new):
            fresh, back = np.unique(keys[new], return_inverse=True)
            text = trie.text
            made = np.array([self.merged(text[x] + text[y], len(text[x])) is not None for x, y in zip(*(k.tolist() for k in np.divmod(fresh, len(trie.length))))], np.int32)
            if trie.pairs.n + len(fresh) > MOST_PAIRS:
                trie.pairs = Codes()
            trie.pairs.put(fresh, made)
            found[new] = made[back]
        return found > 0

    def search_all(self, words: list[str]) -> list[bytes | None]:
        """search() of many short texts of a BPE model, as encode_run() returns it; None for what it cannot search: characters that are no piece, boundaries without a path."""
        if self.trie is None:
            self.trie = Trie(self)
        trie = self.trie
        letter = trie.letter[np.frombuffer("".join(x + "\0" for x in words).encode("utf-32-le"), "<u4")]
        size = np.fromiter(map(len, words), np.int64, len(words)) + 1
        stop = np.cumsum(size) - 1  # where each word's last boundary is
        start = stop - size + 1
        letter[stop] = 0  # nothing goes on beyond
        place = np.arange(len(letter)) - np.repeat(start, size)
        at, node = np.flatnonzero(letter), np.zeros(1, np.int64)
        begins, pieces, k = [], [], 0
        while len(at):  # every piece from every boundary
            node = trie.steps.get(node * trie.letters + letter[at + k])
            some = node >= 0
            at, node, k = at[some], node[some].astype(np.int64), k + 1
            piece = trie.piece[node]
            some = piece >= 0
            begins.append(at[some])
            pieces.append(piece[some])
        last = np.full(len(letter), -1, np.int32)  # the piece that ends at a boundary; none yet: -1
        if begins:
            begin, piece = np.concatenate(begins), np.concatenate(pieces)
            order = np.argsort(place[begin], kind="stable")
            begin, piece = begin[order], piece[order]
            bounds = np.searchsorted(place[begin], np.arange(size.max() + 1)).tolist()
            for k, (a, b) in enumerate(zip(bounds, bounds[1:])):  # from the boundaries after k characters
                at, here = begin[a:b], piece[a:b]
                if k:
                    before = last[at]
                    fit = before >= 0
                    fit[fit] = self._fit(before[fit], here[fit])
                    at, here = at[fit], here[fit]
                last[at + trie.length[here]] = here
        good = (np.add.reduceat(last < 0, start) == 1) & (np.add.reduceat(letter == 0, start) == 1)
        on_path, at, least = np.zeros(len(last), bool), stop[good], start[good]
        while len(at):  # all paths back
            on_path[at] = True
            at = at - trie.length[last[at]]
            some = at > least
            at, least = at[some], least[some]
        ids = last[on_path].astype("<u4").tobytes()
        ends = (4 * np.cumsum(np.add.reduceat(on_path, start, dtype=np.int64))).tolist()
        return [ids[a:b] if x else None for a, b, x in zip([0, *ends], ends, good.tolist())]

    def learn(self, found: list[str]) -> None:
        """Search the words of some texts that are not in memory, many at a time."""
        if self.kind != BPE or not self.splits or not self.bytes:
            return
        behind, first = set(), set()
        for text in found:
            lines = text.split("\n")
            for k, line in enumerate(lines):
                word, _, rest = line.partition(" ")
                (behind if self.prefix and not k else first).add(word)
                behind.update(rest.split(" "))
        for memory, words, mark in ((self.after_space, behind, MARK), (self.plain, first, "")):
            new, held = [], 0
            for word in words:
                if word and len(word) <= WORD and word not in memory and memory.old(word) is None:
                    new.append(word)
                    held += len(word) + 2
                if held >= BLOCK:
                    self._remember(memory, new, mark)
                    new, held = [], 0
            self._remember(memory, new, mark)

    def _remember(self, memory: Memory, words: list[str], mark: str) -> None:
        if words:
            for word, ids in zip(words, self.search_all([mark + x for x in words])):
                if ids:
                    memory.add(word, ids)

    @staticmethod
    def _path(last: list[str], end: int) -> list[str]:
        found = []
        while end:
            found.append(last[end])
            end -= len(last[end])
        return found[::-1]

    def encode_run(self, text: str) -> bytes:
        """Ids, as little-endian 32-bit words, of a text whose spaces are marks already."""
        ids: list[int] = []
        try:
            pieces = list(self.search(text))
        except LookupError:
            pieces = self.merged(text)
        for piece in pieces:
            if piece in self.ids:
                ids.append(self.ids[piece])
            elif self.bytes:
                ids.extend(self.bytes[b] for b in piece.encode())
            elif not ids or ids[-1] != self.unknown or self.kind == BPE:
                ids.append(self.unknown)
        packed = array("I", ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def _word(self, word: str, marked: bool) -> bytes:
        """The ids of a word, kept in memory; it falls apart where no piece joins two characters."""
        memory = self.after_space if marked else self.plain
        if (ids := memory.old(word)) is not None:
            return ids
        at, parts = 0, []
        for k in range(1, len(word)):
            if word[k - 1 : k + 1] not in self.joined:
                parts.append(word[at:k])
                at = k
        if at and not (marked and MARK + word[0] not in self.joined):
            ids = b"".join([(self.after_space if marked else self.plain).get(parts[0]) or self._word(parts[0], marked), *(self.plain.get(x) or self._word(x, False) for x in (*parts[1:], word[at:]))])
        else:
            ids = self.encode_run(MARK + word if marked else word)
        if len(word) <= WORD:
            memory.add(word, ids)
        return ids

    def encode(self, text: str) -> bytes:
        """The ids of a text."""
        if not text:
            return b""
        if not self.splits or not self.bytes:
            return self.encode_run(self.prefix + text.replace(" ", MARK))
        out: list[bytes] = []
        newline = np.array([self.bytes[10]], dtype="<u4").tobytes() if "\n" not in self.ids else np.array([self.ids["\n"]], dtype="<u4").tobytes()
        for k, line in enumerate(text.split("\n")):
            if k:
                out.append(newline)
            start = "" if k else self.prefix
            if "  " in line or line[-1:] == " " or line[:1] == " " or MARK in line or (not line and not k):
                out.append(self.encode_run(start + line.replace(" ", MARK)))
                continue
            words = line.split(" ")
            if words[0]:
                marked = start == MARK
                out.append((self.after_space if marked else self.plain).get(words[0]) or self._word(words[0], marked))
            known = self.after_space.get
            out += [known(word) or self._word(word, True) for word in words[1:]]
        return b"".join(out)

    def decode(self, ids: list[int]) -> bytes:
        """UTF-8 bytes of a text's ids."""
        text = b"".join(map(self.out.__getitem__, ids))
        return text[1:] if self.prefix and text[:1] == b" " else text


_MODELS: dict[str, PieceModel] = {}


def load(path: str) -> PieceModel:
    """The model at path, read once by each Python worker."""
    if path not in _MODELS:
        with open(path, "rb") as f:
            _MODELS[path] = PieceModel(f.read())
    return _MODELS[path]


def encode_documents(docs: DataFrame, model: str) -> DataFrame:
    """Per row of docs: doc_id and the ids of its text."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(model)
        for batch in slices(batches, "text"):
            found = [x.decode() for x in texts(batch.column("text"))]
            pieces.learn(found)
            found = [pieces.encode(x) for x in found]
            ends = np.cumsum([0, *(len(x) // 4 for x in found)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(found), "<i4")))], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(encode, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, model: str) -> DataFrame:
    """The rows of encoded(doc_id, ids), with their text; null ids are an empty text."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(model)
        for whole in batches:
            for start in range(0, whole.num_rows, 500):
                batch = whole.slice(start, 500)
                column = batch.column("ids")
                ends = np.cumsum(np.r_[0, column.value_lengths().fill_null(0).to_numpy()]).tolist()
                flat = column.flatten().to_numpy().tolist()
                found = [pieces.decode(flat[a:b]).decode(errors="replace") for a, b in zip(ends, ends[1:])]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("ids"), pa.array(found, pa.string())], names=["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(decode, "doc_id long, ids array<int>, text string")


def round_trip(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, ids, n_ids, and the bytes and SHA-256 of the text decoded from the ids."""
    decoded = decode_documents(encode_documents(docs, model), model)
    return decoded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_ids"), F.octet_length("text").cast("long").alias("decoded_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))
