"""Words of many texts at once, as numpy arrays over the bytes of an Arrow column."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes handled at a time; one longer text is handled alone.
BLOCK_BYTES = 1 << 21

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MIX = np.uint64(0xD6E8FEB86659FD93)

#: ASCII letters and digits, and every byte of a character beyond ASCII.
WORD_BYTES = np.zeros(256, bool)
WORD_BYTES[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True

_powers: dict[str, np.ndarray] = {}


def blocks(
    texts: pa.Array, limit: int = BLOCK_BYTES
) -> Iterator[tuple[int, int, pa.Array]]:
    """Runs of rows with about ``limit`` bytes of text: first row, end row, texts (NULL: empty)."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(texts):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, "right")))
        yield start, stop, texts.slice(start, stop - start)
        start = stop


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and where each text begins; the last entry is the end."""
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if data is None or offsets[0] == offsets[-1]:
        return np.zeros(0, np.uint8), np.zeros(len(offsets), np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def word_bounds(
    data: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray = WORD_BYTES
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words, and for each text the number of words before it."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = word_bytes[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def _power(kind: str, base: np.uint64, n: int) -> np.ndarray:
    known = _powers.get(kind)
    if known is None or len(known) < n:
        steps = np.full(max(n, BLOCK_BYTES), base, np.uint64)
        steps[0] = 1
        known = np.multiply.accumulate(steps)
        if n <= 4 * BLOCK_BYTES:
            _powers[kind] = known
    return known[:n]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash of each word, from running sums modulo 2**64."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    terms = (data.astype(np.uint64) + np.uint64(1)) * _power("up", _BASE, len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(terms, out=sums[1:])
    hashed = (sums[ends] - sums[starts]) * _power("down", _INVERSE, len(data))[starts]
    return mixed(hashed)


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * _MIX
    return values ^ (values >> np.uint64(29))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of n consecutive words, one for each start."""
    total = np.zeros(max(0, len(words) - n + 1), np.uint64)
    for k in range(n):
        total = total * _BASE + words[k:len(words) - n + 1 + k]
    return mixed(total)
