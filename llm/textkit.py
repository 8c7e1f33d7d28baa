"""Vectorised text kernels shared by the Arrow-based operators of this subpackage.

Every kernel works on a whole Arrow string column at once: the UTF-8 bytes of
all rows lie in one buffer, so words, word hashes and shingles come from a few
numpy passes and no Python loop runs per word.  Null texts count as empty ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_U = np.uint64
#: Bytes of text that one numpy pass handles; bounds the memory of a task.
SLICE_BYTES = 4 << 20
#: An odd multiplier and its inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
#: A random 64-bit value for each byte value.
_BYTE_VALUE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
#: A-Z to a-z, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: True at the bytes 0x09-0x0D and 0x20.
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

_powers = {1: np.ones(1, _U), -1: np.ones(1, _U)}


def powers(n: int, sign: int = 1) -> np.ndarray:
    """The first n powers of the base (sign 1) or of its inverse (sign -1)."""
    have = _powers[sign]
    if len(have) < n:
        full = np.full(max(n, SLICE_BYTES + 1), _U(_BASE if sign == 1 else _BASE_INV))
        full[0] = 1
        have = _powers[sign] = np.multiply.accumulate(full)
    return have[:n]


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit values that scatters them (the splitmix64 finaliser)."""
    x = x + _U((0x9E3779B97F4A7C15 * (seed + 1)) & (2**64 - 1))
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the len+1 offsets of its rows; nulls become empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = column.buffers()[2]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about `most` bytes of text each (one row at least)."""
    _, offsets = buffers(batch.column(column))
    first, n = 0, batch.num_rows
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield batch.slice(first, last - first)
        first = last


def byte_sums(data: np.ndarray) -> np.ndarray:
    """Prefix sums from which `span_hash` derives the hash of any byte range."""
    out = np.zeros(len(data) + 1, _U)
    np.cumsum(_BYTE_VALUE[data] * powers(len(data)), out=out[1:])
    return out


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes [start, end), the same wherever they lie."""
    return (sums[end] - sums[start]) * powers(len(sums), -1)[start]


def words(data: np.ndarray, offsets: np.ndarray, apart: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and the number of words before each row (len+1 counts).

    `apart` marks the bytes that no word contains.  Rows never share a word.
    """
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~apart[data]
    opens = inside[1:-1] & ~inside[:-2]
    closes = inside[1:-1] & ~inside[2:]
    edge = offsets[1:-1]
    edge = edge[(edge > 0) & (edge < len(data))]
    opens[edge] = inside[1:-1][edge]
    closes[edge - 1] = inside[1:-1][edge - 1]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return start, end, np.searchsorted(start, offsets)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix(span_hash(byte_sums(data), start, end) + (end - start).astype(_U))


_SHINGLE = np.random.default_rng(77).integers(1, 1 << 63, 64, dtype=np.uint64) * _U(2) + _U(1)


def shingles(hashes: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each run of `width` words of a row, and their len+1 bounds.

    A row of fewer words, but not none, has its whole sequence as its one run.
    """
    count = np.diff(bounds)
    runs = np.where(count >= width, count - width + 1, np.minimum(count, 1))
    at = np.zeros(len(runs) + 1, np.int64)
    np.cumsum(runs, out=at[1:])
    first = np.arange(at[-1]) - np.repeat(at[:-1] - bounds[:-1], runs)
    length = np.repeat(np.minimum(count, width), runs)
    out = np.zeros(len(first), _U)
    padded = np.concatenate([hashes, np.zeros(width, _U)])
    short = length.min() < width if len(length) else False
    for j in range(width):
        part = padded[first + j] * _SHINGLE[j]
        out += np.where(j < length, part, _U(0)) if short else part
    return mix(out + length.astype(_U)), at


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each run of `width` values."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


#: 0: white space and control bytes, 1: digits, letters and bytes beyond ASCII, 2: other ASCII.
KIND = np.full(256, 2, np.uint8)
KIND[:33] = 0
KIND[127] = 0
KIND[128:] = 1
KIND[[*range(48, 58), *range(65, 91), *range(97, 123)]] = 1


def runs(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray = KIND) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each run of bytes of one kind (0 left out), and the number of runs before each row."""
    k = kind[data]
    changes = np.ones(len(k) + 1, bool)
    changes[1:-1] = k[1:] != k[:-1]
    edge = offsets[1:-1]
    changes[edge] = True
    at = np.flatnonzero(changes)
    start, end = at[:-1], at[1:]
    some = k[start] != 0 if len(start) else np.zeros(0, bool)
    start, end = start[some], end[some]
    return start, end, np.searchsorted(start, offsets)
