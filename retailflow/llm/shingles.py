"""Sets of word shingles as 64-bit hashes, for many texts at once."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers = np.array([pow(_BASE, i, 1 << 64) for i in range(1024)], np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def powers(n: int) -> np.ndarray:
    """Powers of the hash base, as many as the longest word needs."""
    global _powers
    while len(_powers) < n:
        _powers = np.concatenate([_powers, _powers * np.uint64(pow(_BASE, len(_powers), 1 << 64))])
    return _powers


def words(raw: bytes) -> np.ndarray:
    """Hashes of the words [^\\x20\\x09-\\x0D]+ of a text, with A-Z as a-z."""
    data = np.frombuffer(raw.lower(), np.uint8)  # bytes: lowers A-Z alone
    space = _SPACE[data]
    inside = ~space
    start = np.flatnonzero(inside & np.concatenate([[True], space[:-1]]))
    if not len(start):
        return np.empty(0, np.uint64)
    stop = np.flatnonzero(inside & np.concatenate([space[1:], [True]])) + 1
    size = stop - start
    at = np.arange(int(size.sum()))
    place = at - np.repeat(np.cumsum(size) - size, size)
    value = (data[inside].astype(np.uint64) + np.uint64(1)) * powers(int(size.max()))[place]
    return mixed(np.add.reduceat(value, np.cumsum(size) - size) + size.astype(np.uint64))


def shingle_set(raw: bytes, n: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of ``n`` words; of fewer words, the whole sequence is one."""
    w = words(raw)
    if not len(w):
        return w
    n = min(n, len(w))
    h = np.full(len(w) - n + 1, n, np.uint64)
    for i in range(n):
        h = mixed(h * np.uint64(0xD6E8FEB86659FD93) + w[i: len(w) - n + 1 + i])
    return np.unique(h)
