"""Words and word hashes of many texts at once, on the bytes of Arrow columns, in numpy.

Used inside tasks.  Words end at ASCII separators only, so cutting UTF-8 bytes there is safe.
Hashes are multilinear over a word's bytes with fixed pseudo-random coefficients, then mixed to 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 21  # bytes of text handled at once; a longer text is a block of its own

SPACE_BYTES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[list(SPACE_BYTES)] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective mixing of 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _coefficients(n: int, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(np.arange(seed, seed + n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


TABLE = 4096
NEAR, FAR = _coefficients(TABLE, 1), _coefficients(TABLE, 10**6)
FAR[0] = 1
OTHER = _coefficients(TABLE, 3 * 10**6)  # in place of NEAR, for a second hash
GRAM = _coefficients(64, 2 * 10**6)


def blocks(texts: pa.Array, limit: int = BLOCK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, bounds) of consecutive texts; NULL is empty; bounds count bytes from 0."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        end = max(first + 1, int(np.searchsorted(at, at[first] + limit, side="right")) - 1)
        end = min(end, len(texts))
        yield first, end, whole[at[first] : at[end]], at[first : end + 1] - at[first]
        first = end


def spans(data: np.ndarray, bounds: np.ndarray, inside: np.ndarray = NOT_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and for each text the number of words before it (one more at the end)."""
    word = inside[data]
    cuts = bounds[(bounds > 0) & (bounds < len(data))]
    before = np.zeros(len(data), bool)
    before[1:] = word[:-1]
    before[cuts] = False
    after = np.zeros(len(data), bool)
    after[:-1] = word[1:]
    after[cuts - 1] = False
    starts = np.flatnonzero(word & ~before)
    ends = np.flatnonzero(word & ~after) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, near: np.ndarray = NEAR) -> np.ndarray:
    """A 64-bit hash for each span of bytes (no span may be empty)."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum()), dtype=np.int64) - np.repeat(first, lengths)
    value = data[place + np.repeat(starts, lengths)].astype(np.uint64) + np.uint64(1)
    with np.errstate(over="ignore"):
        value *= near[place & (TABLE - 1)]
        if int(lengths.max()) > TABLE:
            value *= FAR[(place // TABLE) % TABLE]
        return mix(np.add.reduceat(value, first) + lengths.astype(np.uint64) * near[7])


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values, by sorting (numpy's hashed ``unique`` is slower on these)."""
    ordered = np.sort(values)
    return ordered[np.concatenate(([True], ordered[1:] != ordered[:-1]))] if len(ordered) else ordered


def gram_hash(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n words (over text borders too; the caller keeps those inside a text)."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(words) - n + 1, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            total += words[k : len(words) - n + 1 + k] * GRAM[k]
    return mix(total + np.uint64(n))
