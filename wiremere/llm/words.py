"""Words and shingles of whole Arrow batches as NumPy arrays.

A batch's texts lie one after the other in a byte buffer. Words are found and hashed over that buffer
with array operations; Python loops run per document at most, never per word.
"""

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 21

# Bytes that separate words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
# Bytes of words made of digits, letters and everything beyond ASCII.
ALNUM = np.array([48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)])
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)

_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about `limit` bytes of text each; one text may be longer than that."""
    _, offsets = utf8(texts)
    start = 0
    while start < len(texts):
        end = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        end = min(max(end, start + 1), len(texts))
        yield start, end
        start = end


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of an array of texts; null counts as empty."""
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, at, data = texts.buffers()
    offsets = np.frombuffer(at, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    buffer = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buffer[offsets[0] : offsets[-1]], offsets - offsets[0]


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each run of `inside`, and per row the number of runs before it."""
    if not inside.any():
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    begins = offsets[:-1][offsets[:-1] < len(inside)]
    ends = offsets[1:][offsets[1:] > 0] - 1
    first[begins] = inside[begins]
    last[ends] = inside[ends]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


@cache
def _tables() -> tuple[np.ndarray, int]:
    rng = np.random.default_rng(20240501)
    return rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1), pow(_BASE, -1, 1 << 64)


_powers: list[np.ndarray] = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least n of each."""
    if len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        for i, base in enumerate((_BASE, _tables()[1])):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps)
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span, wherever it lies. Spans ascend; a long buffer is done in parts."""
    if len(data) <= 2 * SLICE_BYTES:
        return _hashes(data, starts, ends)
    out, i = [np.zeros(0, np.uint64)], 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + SLICE_BYTES)))
        low, high = starts[i], ends[j - 1]
        out.append(_hashes(data[low:high], starts[i:j] - low, ends[i:j] - low))
        i = j
    return np.concatenate(out)


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A polynomial over each span, from differences of prefix sums."""
    table, _ = _tables()
    up, down = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table[data] * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def hash_word(word: str) -> int:
    data = np.frombuffer(word.encode(), np.uint8)
    return int(hashes(data, np.array([0]), np.array([len(data)]))[0])


def chain(words: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
    """Hash of `size` words in a row from each first position."""
    total = np.full(len(first), size, np.uint64)
    for step in range(size):
        total = mix(total * np.uint64(_BASE) + words[first + step])
    return total


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every text, one after the other, and their offsets.

    Words are runs of non-space bytes, A-Z lower-cased. A text of fewer than `width` words has its
    whole word sequence as one shingle, a text without words has none.
    """
    data, offsets = utf8(texts)
    starts, ends, before = spans(~SPACES[data], offsets)
    words = hashes(LOWER[data], starts, ends) if len(starts) else np.zeros(0, np.uint64)
    counts = np.diff(before)
    long = np.repeat(counts >= width, counts)
    tail = np.repeat(before[1:], counts)
    at = np.arange(len(words))
    first = at[long & (at + width <= tail)]
    values = chain(words, first, width)
    bounds = np.searchsorted(first, before)
    sets = []
    for row, n in enumerate(counts):
        if n >= width:
            sets.append(np.unique(values[bounds[row] : bounds[row + 1]]))
        elif n:
            sets.append(chain(words, before[row : row + 1], int(n)))
        else:
            sets.append(np.zeros(0, np.uint64))
    sizes = np.array([len(s) for s in sets], np.int64)
    joined = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    return joined, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def lists(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A list column from concatenated 64-bit values and row offsets."""
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values.view(np.int64)))
