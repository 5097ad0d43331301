"""Words of whole Arrow text columns as numpy arrays: no Python object per word.

Words are runs of bytes other than space and 0x09-0x0D, with A-Z lower-cased. A word's hash is a polynomial of random
64-bit values of its bytes, taken from one running sum over the column, and then mixed; hashes of equal words are
equal everywhere, and two different words collide with a chance of about 2**-64.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_draw = np.random.default_rng(20240501)
_VALUES = _draw.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_draw.integers(1, 1 << 62)) * 2 + 1
_BACK = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Separators that leave letters, digits and all non-ASCII bytes in words.
PUNCTUATION = np.array([b < 0x80 and not chr(b).isalnum() for b in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
#: Bytes handled at once, unless a single text is longer.
SLICE_BYTES = 1 << 20


class _Powers(dict):
    """Powers by base. Task functions travel with their globals: this one goes empty, each task makes its own."""

    def __reduce__(self):
        return _Powers, ()


_powers = _Powers()


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers_of(base: int, n: int) -> np.ndarray:
    known = _powers.get(base)
    if known is None or len(known) < n:
        steps = np.full(max(n, SLICE_BYTES + 1), base, dtype=np.uint64)
        steps[0] = 1
        known = np.multiply.accumulate(steps)
        if len(known) <= 1 << 23:  # those of very long texts are not kept
            _powers[base] = known
    return known


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; nulls count as empty."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    if column.null_count:
        column = column.fill_null("")
    _, offsets, values = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(values, dtype=np.uint8) if values is not None else np.empty(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def slices(column: pa.Array):
    """The column in runs of rows of some SLICE_BYTES, to bound memory: (first row, column)."""
    _, at = text_bytes(column)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(at, at[first] + SLICE_BYTES, side="right")) - 1)
        yield first, column.slice(first, last - first)
        first = last


def word_bounds(data: np.ndarray, at: np.ndarray, separators: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word; for each row the first word's number (one more than rows)."""
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[at] = True
    inside = ~separators[data]
    before = np.empty(len(data), dtype=bool)
    if len(data):
        before[0] = False
        before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.zeros(len(data), dtype=bool)
    if len(data):
        after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, at)


def hashed_words(column: pa.Array, separators: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of a column; for each row the first word's number (one more than rows)."""
    data, at = text_bytes(column)
    starts, ends, first = word_bounds(data, at, separators)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_VALUES[_LOWER[data]] * _powers_of(_BASE, len(data))[: len(data)], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * _powers_of(_BACK, len(data) + 1)[starts]
    return mix(hashes + (ends - starts).astype(np.uint64)), first


def hashed_shingles(words: np.ndarray, first: np.ndarray, n: int) -> list[np.ndarray]:
    """Per row the sorted distinct hashes of its ``n``-word shingles; of a shorter row, of the whole sequence."""
    many = len(words)
    rolled = np.zeros(max(0, many - n + 1), dtype=np.uint64)
    for i in range(n):
        rolled = mix(rolled * np.uint64(3) + words[i : many - n + 1 + i])
    found = []
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= n:
            found.append(np.unique(rolled[a : b - n + 1]))
        elif b > a:
            whole = np.zeros(1, dtype=np.uint64)
            for w in words[a:b]:
                whole = mix(whole * np.uint64(3) + w)
            found.append(mix(whole + np.uint64(b - a)))
        else:
            found.append(np.empty(0, dtype=np.uint64))
    return found
