"""Vectorised text helpers that run inside Arrow tasks: slices of a batch, token runs and token hashes.

A batch of texts is seen as one byte buffer and an array of offsets.  Tokens are runs of bytes of one class, and a
token's hash is a difference of prefix sums, so a task does no work per word in Python.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; a longer text is a slice of its own.
SLICE_BYTES = 1 << 19

_GAPS = [9, 10, 11, 12, 13, 32]


def _classes(words_only: bool) -> np.ndarray:
    """0: gap, 1: letters, digits and non-ASCII bytes, 2: other visible bytes (a gap if words_only)."""
    out = np.full(256, 0 if words_only else 2, np.uint8)
    out[128:] = 1
    for a, b in ((48, 58), (65, 91), (97, 123)):
        out[a:b] = 1
    out[_GAPS] = 0
    return out


WORDS = _classes(True)
WORDS_AND_MARKS = _classes(False)
SPACED = np.ones(256, np.uint8)
SPACED[_GAPS] = 0

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (xor-shift and odd multiplications)."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_STEP = 0x5851F42D4C957F2D
_BACK = pow(_STEP, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept for the next slice."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, SLICE_BYTES + 1), base, np.uint64)
        steps[0] = 1
        have = np.cumprod(steps, dtype=np.uint64)
        if n <= 4 * SLICE_BYTES:
            _powers[base] = have
    return have[:n]


def tidy() -> None:
    """Give back what Arrow holds and does not use: an executor has several Python workers, and some of them wait."""
    pa.default_memory_pool().release_unused()


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and their n + 1 offsets; a null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, where, data = texts.buffers()
    offsets = np.frombuffer(where, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(texts: pa.Array, most: int | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) for runs of rows of about ``most`` bytes."""
    most = most or SLICE_BYTES
    data, offsets = buffers(texts)
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, "right")) - 1)
        b = min(b, n)
        yield a, b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        a = b


def runs(data: np.ndarray, offsets: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each token, and for each text the index of its first token (n + 1 of them)."""
    n = len(data)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    kind = classes[data]
    new = np.empty(n, bool)
    new[0] = True
    np.not_equal(kind[1:], kind[:-1], out=new[1:])
    new[offsets[:-1][offsets[:-1] < n]] = True
    start = np.flatnonzero(new)
    end = np.append(start[1:], n)
    keep = kind[start] != 0
    start, end = start[keep], end[keep]
    return start, end, np.searchsorted(start, offsets)


def token_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, fold: bool = True) -> np.ndarray:
    """A 64-bit hash of each token's bytes, alike wherever the token stands; fold lower-cases A-Z."""
    if not len(start):
        return np.empty(0, np.uint64)
    values = (_BYTE[LOWER] if fold else _BYTE)[data]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values * _power(_STEP, len(data)), out=sums[1:])
    return mix((sums[end] - sums[start]) * _power(_BACK, len(data))[start])


def per_text(values: np.ndarray, first: np.ndarray, how: np.ufunc, empty: float) -> np.ndarray:
    """``how`` over the values of each text (rows of a 2-D array too); ``empty`` for texts without any."""
    kind = values.dtype if how is np.maximum else np.float64
    out = np.full((len(first) - 1, *values.shape[1:]), empty, kind)
    full = first[1:] > first[:-1]
    if full.any():
        out[full] = how.reduceat(values, first[:-1][full], axis=0, dtype=kind)
    return out
