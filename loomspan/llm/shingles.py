"""Word shingles of whole texts as sorted 64-bit hashes, in numpy."""

from __future__ import annotations

import numpy as np

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, np.uint64) | np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]  # A-Z read as a-z
_BASE = np.uint64(0x9E3779B97F4A7C15)
_powers = np.ones(1, np.uint64)


def _power(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        size = max(n, 64)
        _powers = np.concatenate([[np.uint64(1)], np.cumprod(np.full(size, _BASE, np.uint64))])
    return _powers


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every output bit hangs on every input bit."""
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def word_hashes(text: bytes) -> np.ndarray:
    """A hash of each word (A-Z as a-z), in order."""
    data = np.frombuffer(text, np.uint8)
    letter = ~_SPACE[data]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], letter, [False]]).view(np.int8)))
    if not len(edges):
        return np.zeros(0, np.uint64)
    lengths = edges[1::2] - edges[::2]
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    within = np.arange(int(lengths.sum())) - np.repeat(starts, lengths)
    values = _BYTE[data[letter]] * _power(int(lengths.max()))[within]
    return mixed(np.add.reduceat(values, starts) + lengths.astype(np.uint64))


def shingle_set(text: bytes | None, words: int = 5) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``words`` words; of fewer words the whole run; of none nothing."""
    h = word_hashes(text or b"")
    if not len(h):
        return h
    k = min(words, len(h))
    total = np.zeros(len(h) - k + 1, np.uint64)
    for j in range(k):
        total = total * _BASE + h[j : len(h) - k + 1 + j]
    return np.unique(mixed(total + np.uint64(k)))


def bitmap(hashes: np.ndarray) -> np.ndarray:
    """Hashed bitmap, two to four bits for each element, a power of two and 64 at least: little-endian 64-bit words."""
    size = max(64, 1 << int(2 * max(len(hashes), 1) - 1).bit_length())
    bits = np.zeros(size, np.uint8)
    bits[(hashes >> np.uint64(20)) & np.uint64(size - 1)] = 1
    return np.packbits(bits, bitorder="little").view("<u8")
