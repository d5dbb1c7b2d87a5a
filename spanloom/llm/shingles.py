"""Words and rolling word hashes of whole Arrow batches, without a Python step per word.

Words are runs of ASCII digits and letters and of all bytes from 0x80 on, A-Z lower-cased.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True
_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_P), -1, 1 << 64))
#: Bytes of text that are worked on at a time.
SLICE = 1 << 22


class Words(NamedTuple):
    data: np.ndarray  # lower-cased bytes
    starts: np.ndarray  # of each word in data
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray  # of each text, its first word's number; one more at the end


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (public, from splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int, kept: dict = {}) -> np.ndarray:  # noqa: B006
    if len(kept.get(int(base), ())) < n:
        size = 1 << max(16, (n - 1).bit_length())
        p = np.full(size, base, np.uint64)
        p[0] = 1
        kept[int(base)] = np.multiply.accumulate(p)
    return kept[int(base)][:n]


def fresh(texts: pa.Array) -> pa.Array:
    """As large_string whose offsets begin at 0 (some of pyarrow's kernels misread arrays that begin elsewhere); texts aren't copied."""
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    if not len(texts):
        return pa.array([], pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = data.slice(offsets[0], offsets[-1] - offsets[0]) if data is not None else pa.py_buffer(b"")
    return pa.Array.from_buffers(pa.large_string(), len(texts), [None, pa.py_buffer(offsets - offsets[0]), data])


def slices(texts: pa.Array, most: int = SLICE) -> Iterator[pa.Array]:
    """An array without nulls in slices of some `most` bytes; a longer text is a slice of its own."""
    texts = fresh(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64) if len(texts) else np.zeros(1, np.int64)
    at = 0
    while at < len(texts):
        n = max(1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1 - at)
        yield fresh(texts.slice(at, min(n, len(texts) - at)))
        at += n


def words(texts: pa.Array) -> Words:
    """Of a large_string array without nulls."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    size = int(offsets[-1] - offsets[0])
    raw = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if size else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    data = _LOWER[raw]
    inside = np.zeros(size + 2, bool)
    inside[1:-1] = _WORD[data]
    begins = np.zeros(size + 1, bool)
    begins[offsets] = True
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | begins))
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | begins))
    total = np.zeros(size + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_P, size), out=total[1:])
    hashes = mix((total[ends] - total[starts]) * _powers(_INVERSE, size + 1)[starts] + (ends - starts).astype(np.uint64))
    return Words(data, starts, ends, hashes, np.searchsorted(starts, offsets))


def grams(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first word) of every run of k words that lies within one text."""
    n = len(w.hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = w.hashes[:n].copy()
    for j in range(1, k):
        h = h * np.uint64(0xD6E8FEB86659FD93) + w.hashes[j : n + j]
    text = np.repeat(np.arange(len(w.first) - 1), np.diff(w.first))
    at = np.flatnonzero(text[:n] == text[k - 1 :])
    return mix(h[at]), at
