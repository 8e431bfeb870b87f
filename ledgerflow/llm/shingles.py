"""Word and shingle hashes in numpy, the same in every process."""

from __future__ import annotations

import re

import numpy as np

SPACE_BYTES = b" \t\n\x0b\x0c\r"
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_STEP = 1 << 16
_BASE = 0x5851F42D4C957F2D
_MIX = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    if n > 1:
        out[1:] = np.uint64(base)
        np.multiply.accumulate(out, out=out)
    return out


_BYTES = mix64(np.arange(1, 257, dtype=np.uint64) * _MIX)
for _b in SPACE_BYTES:
    _BYTES[_b] = 0
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACE_BYTES)] = True
_UP = _powers(_BASE, _STEP)
_DOWN = _powers(pow(_BASE, -1, 1 << 64), _STEP)


def slices(data: bytes, step: int = _STEP):
    """Consecutive parts of data of about step bytes, cut after white space; only a single word makes one longer."""
    start = 0
    while start < len(data):
        end = min(start + step, len(data))
        if end < len(data):
            cut = max(data.rfind(bytes([c]), start, end) for c in SPACE_BYTES)
            if cut < start:
                found = re.compile(rb"[\x20\x09-\x0D]").search(data, end)
                cut = found.start() if found else len(data) - 1
            end = cut + 1
        yield data[start:end]
        start = end


def word_hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash of each word (maximal run without ASCII white space)."""
    out = []
    for part in slices(data):
        b = np.frombuffer(part, np.uint8)
        space = _IS_SPACE[b]
        begins = ~space
        begins[1:] &= space[:-1]
        starts = np.flatnonzero(begins)
        if not len(starts):
            continue
        up, down = (_UP, _DOWN) if len(b) <= _STEP else (_powers(_BASE, len(b)), _powers(pow(_BASE, -1, 1 << 64), len(b)))
        sums = np.add.reduceat(_BYTES[b] * up[: len(b)], starts)
        out.append(mix64(sums * down[starts]))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def shingle_set(text: str | None, n: int = 4) -> np.ndarray:
    """Sorted distinct hashes of the n-word shingles of a text with A-Z in lower case; of a shorter text, of all its words."""
    if not text:
        return np.zeros(0, np.uint64)
    words = word_hashes(text.encode("utf-8", "surrogatepass").translate(LOWER))
    if not len(words):
        return words
    size = min(n, len(words))
    count = len(words) - size + 1
    rolled = np.full(count, np.uint64(size))
    for i in range(size):
        rolled = mix64(rolled * _MIX + words[i : i + count])
    return np.unique(rolled)
