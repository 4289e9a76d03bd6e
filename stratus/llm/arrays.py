"""Texts of an Arrow batch as flat numpy arrays.

A batch is cut into slices of a bounded number of text bytes, so that the arrays
derived from a slice (8 bytes per text byte each) stay small whatever the batch
size is; a single text longer than the bound makes a larger slice or, where an
operator can work on overlapping pieces, several slices.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19
SLICE_TEXTS = 1 << 15
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))

#: Bytes that separate words: space and 09 to 0D.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: ASCII lower case; other bytes stay.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (bijective)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(kind: str, n: int) -> np.ndarray:
    """The first n powers of the hash base, or of its inverse, modulo 2**64."""
    if len(_powers[kind]) < n:
        steps = np.full(max(n, SLICE_BYTES + 4096), _BASE if kind == "up" else _BASE_INV, np.uint64)
        steps[0] = 1
        _powers[kind] = np.cumprod(steps, dtype=np.uint64)
    return _powers[kind][:n]


@dataclass
class Texts:
    """Consecutive texts: ``data`` holds their bytes end to end, text i is ``data[ends[i]:ends[i+1]]``.

    ``base`` is the number of bytes that a single text has before the piece of it that ``data`` is.
    """

    rows: slice
    data: np.ndarray
    ends: np.ndarray
    base: int = 0

    def __len__(self) -> int:
        return len(self.ends) - 1

    def lengths(self) -> np.ndarray:
        return np.diff(self.ends)


def text_slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES, overlap: int | None = None) -> Iterator[Texts]:
    """Slices of about ``most`` bytes of a string or binary column; a null counts as empty.

    With ``overlap`` a longer text comes in pieces, each with so many bytes of the next: a window of one byte
    more lies in exactly one piece by its start.
    """
    col = batch.column(batch.schema.get_field_index(column)).cast(pa.large_binary())
    if col.null_count:
        col = col.fill_null(b"")
    n = len(col)
    if not n:
        return
    _, offsets, data = col.buffers()
    ends = np.frombuffer(offsets, np.int64)[col.offset : col.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = min(max(at + 1, int(np.searchsorted(ends, ends[at] + most, "right")) - 1), at + SLICE_TEXTS)
        size = int(ends[to] - ends[at])
        if overlap is not None and to == at + 1 and size > most + overlap:
            for first in range(0, size - overlap, most):
                last = min(first + most + overlap, size)
                yield Texts(slice(at, to), raw[ends[at] + first : ends[at] + last], np.array([0, last - first], np.int64), first)
        else:
            yield Texts(slice(at, to), raw[ends[at] : ends[to]], (ends[at : to + 1] - ends[at]).astype(np.int64))
        at = to


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """H with H[i] the polynomial hash of ``data[:i]``; see :func:`span_hash`."""
    h = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power("up", len(data)), out=h[1:])
    return h


def span_hash(h: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of ``data[start:end]`` that depend on the bytes alone."""
    return mix((h[end] - h[start]) * _power("down", len(h))[start] + (end - start).astype(np.uint64))


def words(t: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+`` and the text each is in."""
    inside = ~_SPACE[t.data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cut = t.ends[1:-1][(t.ends[1:-1] > 0) & (t.ends[1:-1] < len(t.data))]
    first[cut] = inside[cut]  # no word crosses two texts
    last[cut - 1] = inside[cut - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(t.ends, start, "right") - 1


#: Odd multipliers of the words of a shingle by their place.
_STEP = np.frombuffer(blake2b(b"shingle steps").digest(), np.uint64) | np.uint64(1)
_LENGTH = np.uint64(0xC2B2AE3D27D4EB4F)
_LANE = np.array([(1 << 8 * i) - 1 for i in range(8)] + [(1 << 64) - 1], np.uint64)
_DIGEST_FROM = 64


def word_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words ``data[start:end]``, eight bytes at a time, each mixed in by a bijection.

    Words collide by chance alone, not by their structure as with a polynomial modulo 2**64, whose weights
    repeat their low bits. Words beyond ``_DIGEST_FROM`` bytes take a digest instead.
    """
    size = end - start
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    lanes = np.ndarray((len(padded) - 7,), "<u8", padded, 0, (1,))  # the eight bytes from each place on
    h = mix((lanes[start] & _LANE[np.minimum(size, 8)]) + size.astype(np.uint64) * _LENGTH)
    at, k = np.flatnonzero(size > 8), 8
    while len(at) and k < _DIGEST_FROM:
        h[at] = mix(h[at] + (lanes[start[at] + k] & _LANE[np.minimum(size[at] - k, 8)]))
        k += 8
        at = at[size[at] > k]
    for i in at:
        h[i] = int.from_bytes(blake2b(data[start[i] : end[i]].tobytes(), digest_size=8).digest(), "little")
    return h


def shingles(t: Texts, n: int = 5, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-word shingles and the text each is in, in text order.

    A text of fewer words, but not none, has its whole word sequence as one
    shingle. Words are joined by their order only, so white space does not count.
    """
    data = LOWER[t.data] if lower else t.data
    start, end, own = words(t)
    w = word_hash(data, start, end)
    if not len(w):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    count = np.bincount(own, minlength=len(t))
    m = len(w)
    h = np.zeros(m, np.uint64)
    full = np.zeros(m, bool)
    if m >= n:
        k = m - n + 1
        full[:k] = own[:k] == own[n - 1 :]
        acc = w[:k] * _STEP[0]
        for j in range(1, n):
            acc += w[j : j + k] * _STEP[j]
        h[:k] = mix(acc)
    short = np.flatnonzero((count > 0) & (count < n))
    if len(short):
        at = np.searchsorted(own, short)
        for i, (a, c) in enumerate(zip(at, count[short])):
            acc = np.uint64(c) + (w[a : a + c] * _STEP[:c]).sum(dtype=np.uint64)
            h[a] = mix(np.array([acc]))[0]
        full[at] = True
    return h[full], own[full]
