"""Words of whole texts as 64-bit hashes, computed for a text at once."""

from __future__ import annotations

import numpy as np

# The six ASCII white-space bytes between words.
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20]] = True

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_POWERS = np.ones(1, dtype=np.uint64)


def _powers(n: int) -> np.ndarray:
    """The first n powers of an odd base, modulo 2^64."""
    global _POWERS
    if len(_POWERS) < n:
        grown = np.full(max(n, 2 * len(_POWERS)), _BASE, dtype=np.uint64)
        grown[0] = 1
        _POWERS = np.multiply.accumulate(grown)
    return _POWERS[:n]


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (a bijection)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def word_hashes(text: str | None) -> np.ndarray:
    """One hash for each word (a run of anything but ASCII white space), A-Z read in lower case."""
    return word_hashes_and_ends(text)[0]


def word_hashes_and_ends(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The words' hashes, and the last two bytes of each word as one number."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass").lower(), dtype=np.uint8)
    inside = ~_BLANK[raw]
    edges = np.diff(inside.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    lengths = ends - starts
    letters = raw[inside].astype(np.uint64) + np.uint64(1)
    first = np.cumsum(lengths) - lengths
    place = np.arange(len(letters)) - np.repeat(first, lengths)
    tails = raw[ends - 1].astype(np.int64) + 256 * np.where(lengths > 1, raw[ends - 2].astype(np.int64), 0)
    return mix(np.add.reduceat(letters * _powers(int(lengths.max()))[place], first)), tails


def rolled(hashes: np.ndarray, n: int) -> np.ndarray:
    """One hash for each run of n successive words; empty if there are fewer."""
    if len(hashes) < n:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(len(hashes) - n + 1, dtype=np.uint64)
    for i in range(n):
        total = total * _BASE + hashes[i : len(hashes) - n + 1 + i]
    return mix(total)


def shingles(text: str | None, n: int = 5) -> np.ndarray:
    """The sorted set of a text's n-word shingles; a text of fewer words is one shingle of all of them."""
    hashes = word_hashes(text)
    if 0 < len(hashes) < n:
        n = len(hashes)
    return np.unique(rolled(hashes, n)) if len(hashes) else hashes
