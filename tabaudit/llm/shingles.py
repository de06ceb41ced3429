"""Sets of hashed word shingles, computed from Arrow text columns array by array.

Words are what stands between white space, with A-Z in lower case. A document's set has its distinct runs of ``width``
words; a shorter text counts as one run; a text without words has the empty set. A shingle is held as a 64-bit hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from tabaudit.llm.common import SLICE_BYTES, mixed, row_slices, text_buffers

_BASE = np.uint64(0x9E3779B97F4A7C15)
_PLACES = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F], np.uint64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _word_hashes(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes, starts)`` of the words in ``data``; no word goes over an edge (the start of a text)."""
    solid = ~_SPACE[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    inner = edges[(edges > 0) & (edges < len(data))]
    begins[inner] = solid[inner]
    starts = np.flatnonzero(begins)
    if not starts.size:
        return np.zeros(0, np.uint64), starts
    at = np.flatnonzero(solid)
    word = np.cumsum(begins)[at] - 1
    place = at - starts[word]
    value = (_LOWER[data[at]].astype(np.uint64) + np.uint64(1)) * _powers(int(place.max()) + 1)[place]
    heads = np.searchsorted(at, starts)
    return mixed(np.add.reduceat(value, heads)), starts


def _long_text(data: np.ndarray) -> np.ndarray:
    """Word hashes of one long text, piece by piece; pieces end at white space."""
    out, start = [], 0
    while start < len(data):
        stop = min(start + SLICE_BYTES, len(data))
        while stop < len(data):
            gaps = np.flatnonzero(_SPACE[data[stop : stop + 65536]])
            if gaps.size:
                stop += int(gaps[0])
                break
            stop = min(stop + 65536, len(data))
        out.append(_word_hashes(data[start:stop], np.zeros(0, np.int64))[0])
        start = stop
    return np.concatenate(out)


def _set_of(words: np.ndarray, width: int) -> np.ndarray:
    n = len(words)
    if n == 0:
        return np.zeros(0, np.uint64)
    if n < width:
        return mixed((words * _PLACES[:n]).sum(keepdims=True) + np.uint64(n))
    runs = words[: n - width + 1] * _PLACES[0]
    for k in range(1, width):
        runs = runs + words[k : n - width + 1 + k] * _PLACES[k]
    runs = mixed(runs)
    runs.sort()
    return runs[np.concatenate(([True], runs[1:] != runs[:-1]))]


def shingle_sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """For each text of the column its sorted set of shingle hashes."""
    data, at = text_buffers(column)
    with np.errstate(over="ignore"):
        for first, last in row_slices(at):
            if last == first + 1 and at[last] - at[first] > SLICE_BYTES:
                yield _set_of(_long_text(data[at[first] : at[last]]), width)
                continue
            part = at[first : last + 1] - at[first]
            hashes, starts = _word_hashes(data[at[first] : at[last]], part)
            bounds = np.searchsorted(starts, part)
            for k in range(last - first):
                yield _set_of(hashes[bounds[k] : bounds[k + 1]], width)


def set_print(shingles: np.ndarray) -> int:
    """One 64-bit number for a whole set, as a signed integer."""
    with np.errstate(over="ignore"):
        total = mixed(shingles ^ np.uint64(0x2545F4914F6CDD1D)).sum(dtype=np.uint64)
    return int(mixed(np.array([total], np.uint64)).view(np.int64)[0])
