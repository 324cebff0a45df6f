"""Words, lines and hashes of whole texts, as arrays over Arrow batches.

A ``Chunk`` holds the UTF-8 bytes of some documents one after the other, each followed by one newline, so that no
word and no line crosses documents. Chunks are cut at document borders; a document longer than ``CHUNK_BYTES`` is a
chunk of its own. All hashes are 64 bits wide and depend on content alone, so every task computes the same ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2_000_000
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_SHINGLE = np.uint64(0xD6E8FEB86659FD93)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every input bit over all 64 bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: One random number a byte, so that words of similar bytes have unrelated hashes.
_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
#: ``[\x20\x09-\x0D]``
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        full = np.full(max(n, 1 << 16), base, np.uint64)
        full[0] = 1
        have = _powers[base] = np.multiply.accumulate(full)
    return have[:n]


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """The weights of ``n`` places in sums that hash runs of values, or their inverses."""
    return _power(_INVERSE if inverse else _BASE, n)


class Chunk:
    """Bytes of documents ``first .. first + n - 1`` of a batch; ``starts[i]`` and ``ends[i]`` bound text i."""

    def __init__(self, first: int, data: np.ndarray, offsets: np.ndarray):
        self.first, self.n = first, len(offsets) - 1
        self.data = np.insert(data, offsets[1:], 10)
        step = np.arange(self.n)
        self.starts, self.ends = offsets[:-1] + step, offsets[1:] + step
        self._sums = None

    def lowered(self) -> Chunk:
        """The same chunk with A-Z as a-z; words and lines stay where they are."""
        self.data, self._sums = _LOWER[self.data], None
        return self

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First byte and end of each word, and where each document's words begin (n + 1 numbers)."""
        space = _SPACE[self.data]
        before = np.concatenate(([True], space[:-1]))
        begin = np.flatnonzero(before & ~space)
        end = np.flatnonzero(space & ~before)
        return begin, end, np.append(np.searchsorted(begin, self.starts), len(begin))

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First byte and end of each line, and where each document's lines begin (n + 1 numbers)."""
        end = np.flatnonzero(self.data == 10)
        begin = np.concatenate(([0], end[:-1] + 1)) if len(end) else end
        return begin, end, np.append(np.searchsorted(begin, self.starts), len(begin))

    def hashes(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A hash of the bytes from ``begin`` to ``end``."""
        if self._sums is None:
            n = len(self.data)
            self._sums = np.zeros(n + 1, np.uint64)
            np.cumsum(_BYTE[self.data] * _power(_BASE, n), out=self._sums[1:])
        raw = (self._sums[end] - self._sums[begin]) * _power(_INVERSE, len(self.data) + 1)[begin]
        return mixed(raw + (end - begin).astype(np.uint64))


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """256 flags, true for the bytes in any of the ranges, both ends included."""
    flags = np.zeros(256, bool)
    for low, high in ranges:
        flags[low:high + 1] = True
    return flags


def runs(chunk: Chunk, outside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``Chunk.words`` for maximal runs of bytes that are not ``outside``, to which the newline must belong."""
    cut = outside[chunk.data]
    before = np.concatenate(([True], cut[:-1]))
    begin, end = np.flatnonzero(before & ~cut), np.flatnonzero(cut & ~before)
    return begin, end, np.append(np.searchsorted(begin, chunk.starts), len(begin))


def owners(bounds: np.ndarray) -> np.ndarray:
    """The document of each element, from where each document's elements begin."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def shingles(words: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words within a document, and the first word of each."""
    if len(words) < size:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    run = np.zeros(len(words) - size + 1, np.uint64)
    for k in range(size):
        run = run * _SHINGLE + words[k:len(words) - size + 1 + k]
    own = owners(bounds)
    at = np.flatnonzero(own[:len(run)] == own[size - 1:])
    return mixed(run[at]), at


def per_document(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of the elements of each document."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def raw_text(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow string or binary column; null counts as empty."""
    if pa.types.is_dictionary(column.type):
        column = column.dictionary_decode()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), at


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The column's texts in chunks of at most ``limit`` bytes, or of one longer text."""
    if not len(column):
        return
    data, at = raw_text(column)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(at, at[first] + limit, "right")) - 1)
        yield Chunk(first, data[at[first]:at[last]], at[first:last + 1] - at[first])
        first = last
