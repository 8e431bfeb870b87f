"""Windows of a text grouped by minimiser, in numpy: the shared ground of exact substring operators."""

from __future__ import annotations

import numpy as np

from ledgerflow.llm.shingles import _powers, mix64

_BASE = 0x2545F4914F6CDD1D
_CHUNK = 1 << 18
_VALUES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_PLACE_BITS = np.uint64(20)
_PLACE = np.uint64((1 << 20) - 1)


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    size = 1
    while size * 2 <= w:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[: len(x) - (w - size)], x[w - size :]) if w > size else x


def runs(b: np.ndarray, length: int, k: int, up: np.ndarray, down: np.ndarray):
    """For bytes b: the windows of `length` bytes, grouped into runs that share one minimiser (the k-byte string
    with the least hash, the leftmost of equals). Equal windows have equal minimisers at equal places.

    Returns first and last window of each run, the place of its minimiser, the minimiser's hash, and a
    hash of all the bytes that the run's windows cover.
    """
    n = len(b)
    v = _VALUES[b]
    v *= up[:n]
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(v, out=sums[1:])
    h = mix64((sums[k:] - sums[:-k]) * down[: n - k + 1])
    key = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
    best = _sliding_min(key, length - k + 1)
    place = (best & _PLACE).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    last = np.concatenate([first[1:] - 1, [len(place) - 1]])
    at = place[first]
    whole = mix64((sums[last + length] - sums[first]) * down[first] + (last - first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return first, last, at, h[at], whole


def tables(n: int = _CHUNK + 4096):
    return _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)


def text_runs(data: bytes, length: int, k: int, tabs):
    """runs() of a whole text, taken in overlapping chunks so that memory stays bounded; places count from its start.

    Yields (offset, bytes of the chunk, runs).
    """
    up, down = tabs
    b = np.frombuffer(data, np.uint8)
    start = 0
    while start == 0 or start + length <= len(b):
        part = b[start : start + _CHUNK + length - 1]
        if len(part) < length:
            return
        yield start, part, runs(part, length, k, up, down)
        start += _CHUNK
