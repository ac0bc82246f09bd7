"""Word boundaries and 64-bit hashes of UTF-8 text as array operations over Arrow buffers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes handled at once; a longer text is handled by itself.
SLICE = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: every input bit reaches every output bit."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_ODD))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("") if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else column
    width = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(offsets: np.ndarray, limit: int = SLICE) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, or one longer row."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = j


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every run of non-space bytes; runs never cross rows."""
    if not len(data):
        return (np.zeros(0, np.int64),) * 3
    full = ~_SPACE[data]
    first = np.empty(len(data) + 1, bool)  # a row begins here
    first[:] = False
    first[offsets] = True
    starts = full.copy()
    starts[1:] &= ~full[:-1] | first[1:-1]
    ends = full.copy()
    ends[:-1] &= ~full[1:] | first[1:-1]
    begin = np.flatnonzero(starts)
    return begin, np.flatnonzero(ends) + 1, np.searchsorted(offsets, begin, "right") - 1


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) > n:
        return _powers[0], _powers[1]
    made = []
    for base in (_ODD, _INVERSE):
        run = np.full(n + 1, base, np.uint64)
        run[0] = 1
        made.append(np.cumprod(run))
    if n <= 4 * SLICE:  # those of a longer text go with it
        _powers[:] = made
    return made[0], made[1]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each byte range, from running sums of a polynomial modulo 2^64."""
    up, down = _power(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUE[data] * up[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(_ODD))


def sequence_hash(hashes: list[np.ndarray]) -> np.ndarray:
    """An order-aware hash of aligned hashes."""
    out = np.full_like(hashes[0], len(hashes))
    for h in hashes:
        out = mix(out * np.uint64(_ODD) + h)
    return out
