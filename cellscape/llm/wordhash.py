"""Word positions and 64-bit word hashes of Arrow text columns, without a Python loop over words.

The hash of a word is a polynomial in its bytes; all words of a chunk come from one running sum.  Equal
words have equal hashes in every task, partition and run.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 21
_BASE = 0x9E3779B97F4A7C15
_STEP = np.uint64(0xD6E8FEB86659FD93)

_byte = np.arange(256)
WHITE = (_byte == 32) | ((_byte >= 9) & (_byte <= 13))
NOT_ALNUM = (_byte < 128) & ~(
    ((_byte >= 48) & (_byte <= 57)) | ((_byte >= 65) & (_byte <= 90)) | ((_byte >= 97) & (_byte <= 122)))
_LOWER = np.where((_byte >= 65) & (_byte <= 90), _byte + 32, _byte)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTES = mix((_byte.astype(np.uint64) + np.uint64(1)) * np.uint64(_BASE))
_BYTES_LOWER = _BYTES[_LOWER]
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """Powers 0..n-1 of an odd number, modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        factors = np.full(max(n, CHUNK_BYTES + (1 << 17)), base, dtype=np.uint64)
        factors[0] = 1
        have = np.multiply.accumulate(factors)
        if n <= 8 * CHUNK_BYTES:
            _powers[base] = have
    return have


_INVERSE = pow(_BASE, -1, 1 << 64)


@dataclass
class Words:
    """Words of some texts: hashes, byte ranges, and the first word of each text (one more than texts)."""

    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts())


def scan(data: np.ndarray, bounds: np.ndarray, separators: np.ndarray = WHITE, lower: bool = False,
         cut: int | None = None) -> Words:
    """Words of the texts that lie one after another in ``data``; ``cut`` hashes only so many leading bytes."""
    n = len(data)
    word = ~separators[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[bounds] = True
    opens = word.copy()
    opens[1:] &= ~word[:-1] | edge[1:n]
    closes = word.copy()
    closes[:-1] &= ~word[1:] | edge[1:n]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    first = np.searchsorted(start, bounds)
    if not len(start):
        return Words(np.empty(0, np.uint64), start, end, first)
    sums = np.zeros(n + 1, dtype=np.uint64)
    values = (_BYTES_LOWER if lower else _BYTES)[data]
    values *= _power(_BASE, n)[:n]
    np.cumsum(values, out=sums[1:])
    last = end if cut is None else np.minimum(end, start + cut)
    h = sums[last] - sums[start]
    h *= _power(_INVERSE, n)[start]
    return Words(mix(h), start, end, first)


def chunks(column: pa.Array | pa.ChunkedArray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Pieces of a text column: number of the first row, bytes, and text bounds in them.  Null is empty.

    A piece holds whole texts; it is larger than ``limit`` only if it is a single text.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    if not len(column):
        return
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[column.offset: column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    row = 0
    while row < len(column):
        stop = max(row + 1, int(np.searchsorted(bounds, bounds[row] + limit, side="right")) - 1)
        yield row, data[bounds[row]: bounds[stop]], bounds[row: stop + 1] - bounds[row]
        row = stop


def fold(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` neighbours, one for each start."""
    n = len(hashes) - size + 1
    out = np.zeros(max(n, 0), dtype=np.uint64)
    if n <= 0:
        return out
    for k in range(size):
        out *= _STEP
        out += hashes[k: k + n]
    return mix(out)


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes in text order and the first of each text; a shorter text gives one shingle of all its words."""
    counts = words.counts()
    n = len(words.hash)
    out = np.zeros(n, dtype=np.uint64)
    full = fold(words.hash, size)
    out[: len(full)] = full
    number = np.where(counts >= size, counts - size + 1, (counts > 0).astype(counts.dtype))
    for t in np.flatnonzero((counts > 0) & (counts < size)):
        a, b = words.first[t], words.first[t + 1]
        out[a] = mix(fold(words.hash[a:b], b - a) + np.uint64(b - a))[0]
    keep = np.arange(n) < np.repeat(words.first[:-1] + number, counts)
    return out[keep], np.concatenate([[0], np.cumsum(number)])
