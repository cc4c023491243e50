"""Elias-Fano sequences over numpy arrays, searched many queries at a time, and the files that hold them."""

from __future__ import annotations

import json
import uuid
from collections import OrderedDict

import numpy as np
import pyarrow.fs

U64 = np.uint64


def _words(bits: np.ndarray, more: int = 1) -> np.ndarray:
    """0/1 bytes as 64-bit words, lowest bit first, and `more` zero words."""
    packed = np.packbits(bits, bitorder="little")
    return np.frombuffer(packed.tobytes() + bytes(-len(packed) % 8 + 8 * more), "<u8")


_BYTES = U64(0x0101010101010101)
_TOPS = U64(0x8080808080808080)
#: The place of the set bit of rank r in byte b, at 256 * r + b.
_IN_BYTE = np.array([([k for k in range(8) if b >> k & 1] + 8 * [0])[r] for r in range(8) for b in range(256)], np.uint8)


def select_in_word(word: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The place of the set bit of that rank, from 0."""
    rank = rank.astype(U64)
    ones = word - ((word >> U64(1)) & U64(0x5555555555555555))
    ones = (ones & U64(0x3333333333333333)) + ((ones >> U64(2)) & U64(0x3333333333333333))
    ones = ((ones + (ones >> U64(4))) & U64(0x0F0F0F0F0F0F0F0F)) * _BYTES  # set bits up to and with each byte
    before = np.bitwise_count(((rank * _BYTES | _TOPS) - ones) & _TOPS).astype(U64) << U64(3)  # bits of bytes that end before it
    rank -= (ones << U64(8)) >> before & U64(255)
    return (before + _IN_BYTE[(word >> before & U64(255)) | (rank << U64(8))]).astype(np.int64)


def _low_bits(values: np.ndarray, bits: int) -> np.ndarray:
    """The low bits of each number, one after the other, in 64-bit words and two zero words; 64 numbers fill `bits` words."""
    blocks = -(-len(values) // 64) if bits else 0
    columns = np.zeros((64, blocks), "<u8")
    if bits:
        padded = np.zeros(64 * blocks, U64)
        padded[: len(values)] = values & U64((1 << bits) - 1)
        columns[:] = padded.reshape(blocks, 64).T
    out = np.zeros((bits, blocks), "<u8")
    for k in range(64 if bits else 0):
        word, shift = divmod(k * bits, 64)
        out[word] |= columns[k] << U64(shift)
        if shift + bits > 64:
            out[word + 1] |= columns[k] >> U64(64 - shift)
    return np.r_[out.T.ravel(), np.zeros(2, "<u8")]


class EliasFano:
    """A non-decreasing sequence of whole numbers: low bits packed, high bits in unary."""

    FIELDS = ("head", "low", "high", "ones", "zeros")

    def __init__(self, head, low, high, ones, zeros):
        self.n, self.bits, self.top = (int(x) for x in head)
        self.low, self.high, self.ones, self.zeros = low, high, ones, zeros

    @classmethod
    def build(cls, values: np.ndarray) -> dict[str, np.ndarray]:
        """The arrays of a sequence, by FIELDS."""
        values, n = values.astype(U64), len(values)
        bits = max(0, int(values[-1]).bit_length() - max(n, 1).bit_length()) if n else 0
        upper = (values >> U64(bits)).astype(np.int64)
        top = int(upper[-1]) if n else 0
        unary = np.zeros(top + n + 1, np.uint8)
        unary[upper + np.arange(n)] = 1
        high = _words(unary, 0)
        ones = np.r_[0, np.cumsum(np.bitwise_count(high), dtype=np.int64)]
        zeros = 64 * np.arange(len(ones), dtype=np.int64) - ones
        return {"head": np.array([n, bits, top], "<i8"), "low": _low_bits(values, bits), "high": high, "ones": ones.astype("<u4"), "zeros": zeros.astype("<u4")}

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(i), U64)
        at = i.astype(np.int64) * self.bits
        word, shift = at >> 6, (at & 63).astype(U64)
        value = self.low[word] >> shift
        value |= (self.low[word + 1] << U64(1)) << (shift ^ U64(63))
        value &= U64((1 << self.bits) - 1)
        return value

    def get(self, i: np.ndarray) -> np.ndarray:
        """Elements by index."""
        word = np.searchsorted(self.ones, i.astype(np.uint32), side="right") - 1
        at = 64 * word + select_in_word(self.high[word], i - self.ones[word].astype(np.int64))
        return ((at - i).astype(U64) << U64(self.bits)) | self._low(i)

    def _ended(self, upper: np.ndarray) -> np.ndarray:
        """How many elements have high bits of at most `upper` (-1: none)."""
        out = np.zeros(len(upper), np.int64)
        out[upper >= self.top] = self.n
        inside = np.flatnonzero((upper >= 0) & (upper < self.top))
        rank = upper[inside]
        word = np.searchsorted(self.zeros, rank.astype(np.uint32), side="right") - 1
        out[inside] = 64 * word + select_in_word(~self.high[word], rank - self.zeros[word].astype(np.int64)) - rank
        return out

    def _group(self, upper: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the elements of high bits `upper`, at most the top ones, begin and end: the ones between two zeros."""
        start = self._ended(upper - 1)
        bit = start + upper  # behind the zero before them
        word, shift = bit >> 6, (bit & 63).astype(U64)
        after = np.minimum(word + 1, len(self.high) - 1)  # the last word ends in a zero or in the end of all
        run = (self.high[word] >> shift) | ((self.high[after] << U64(1)) << (shift ^ U64(63)))
        run = np.bitwise_count(run ^ (run + U64(1))).astype(np.int64) - 1
        stop = start + run
        unsure = np.flatnonzero((run >= 63) | (word == len(self.high) - 1))
        stop[unsure] = self._ended(upper[unsure])
        return start, stop

    def find(self, x: np.ndarray, least: np.ndarray | None = None, most: np.ndarray | None = None) -> np.ndarray:
        """The index of the first element equal to each x, or -1; where given, from index `least` on and before `most`."""
        out = np.full(len(x), -1, np.int64)
        x = x.astype(U64)
        upper = (x >> U64(self.bits)).astype(np.int64)
        active = np.flatnonzero((upper <= self.top) & (self.n > 0))
        if not len(active):
            return out
        upper, low = upper[active], x[active] & U64((1 << self.bits) - 1)
        # a group of equal high bits lies between two zeros; its low bits ascend, and it may be long
        start, stop = self._group(upper)
        if least is not None:
            start, stop = np.maximum(start, least[active]), np.minimum(stop, most[active])
        some = np.flatnonzero(start < stop)
        active, start, stop, low = active[some], start[some], stop[some], low[some]
        open_ = np.flatnonzero(stop - start > 1)
        while len(open_):  # until one element is left, the first that is not less
            middle = (start[open_] + stop[open_] - 1) >> 1
            less = self._low(middle) < low[open_]
            start[open_[less]] = middle[less] + 1
            stop[open_[~less]] = middle[~less] + 1
            open_ = open_[stop[open_] - start[open_] > 1]
        hit = self._low(start) == low
        out[active[hit]] = start[hit]
        return out


def save(uri: str, arrays: dict[str, np.ndarray]) -> None:
    """Write named arrays to one file that `load` maps; it appears whole, by a rename, and like replaces like."""
    places, at = {}, 0
    for name, x in arrays.items():
        places[name] = [x.dtype.str, at, len(x)]
        at += -(-x.nbytes // 8) * 8
    head = json.dumps(places).encode()
    head += b" " * (-len(head) % 8)
    fs, path = pyarrow.fs.FileSystem.from_uri(uri)
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    part = f"{path}.{uuid.uuid4().hex}"
    with fs.open_output_stream(part, compression=None) as out:
        out.write(len(head).to_bytes(8, "little") + head)
        for x in arrays.values():
            data = np.ascontiguousarray(x).tobytes()
            out.write(data + bytes(-len(data) % 8))
    try:
        fs.move(part, path)
    except OSError:  # some stores do not rename onto a file, which another attempt has put there
        if fs.get_file_info(path).type != pyarrow.fs.FileType.File:
            raise
        fs.delete_file(part)


#: Files that a worker keeps open, and bytes of those that it cannot map.
OPEN, READ_BYTES = 512, 256 << 20
_open: OrderedDict[str, tuple[dict[str, np.ndarray] | None, int]] = OrderedDict()  # the arrays, and the bytes that were read for them


def _mounted(fs: pyarrow.fs.FileSystem) -> bool:
    return isinstance(fs, pyarrow.fs.LocalFileSystem)


def load(uri: str) -> dict[str, np.ndarray] | None:
    """The arrays of a file, memory-mapped where the store is a mounted file system, else read; None if there is no such file."""
    if uri in _open:
        _open.move_to_end(uri)
        return _open[uri][0]
    fs, path = pyarrow.fs.FileSystem.from_uri(uri)
    found, read = None, 0
    if fs.get_file_info(path).type == pyarrow.fs.FileType.File:
        if _mounted(fs):
            raw = np.memmap(path, np.uint8, "r")
        else:
            with fs.open_input_file(path) as file:
                raw = np.frombuffer(file.read_buffer(), np.uint8)
            read = len(raw)
        size = int.from_bytes(raw[:8].tobytes(), "little")
        places = json.loads(raw[8 : 8 + size].tobytes())
        body = np.asarray(raw[8 + size :])
        found = {name: body[at : at + n * np.dtype(kind).itemsize].view(kind) for name, (kind, at, n) in places.items()}
    _open[uri] = found, read
    while len(_open) > OPEN or len(_open) > 1 and sum(n for _, n in _open.values()) > READ_BYTES:
        _open.popitem(last=False)
    return found


def sequence(arrays: dict[str, np.ndarray], name: str) -> EliasFano:
    return EliasFano(*(arrays[f"{name}.{f}"] for f in EliasFano.FIELDS))


def named(name: str, arrays: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    return {f"{name}.{k}": v for k, v in arrays.items()}
