"""Vectorised 64-bit hashing inside tasks."""

from __future__ import annotations

import numpy as np

U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit (two xor-shift-multiply rounds); wraps around on purpose."""
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> U(29))) * U(0xA0761D6478BD642F)
    return x ^ (x >> U(32))


_powers = np.ones(1, U)


def powers(n: int) -> np.ndarray:
    """base^0 .. base^(n-1), modulo 2^64."""
    global _powers
    if len(_powers) < n:
        steps = np.full(max(n, 2 * len(_powers)), _BASE & (2 ** 64 - 1), U)
        steps[0] = 1
        _powers = np.multiply.accumulate(steps)
    return _powers[:n]


_inverses = np.ones(1, U)


def inverse_powers(n: int) -> np.ndarray:
    """base^0, base^-1, .. modulo 2^64 (the base is odd)."""
    global _inverses
    if len(_inverses) < n:
        steps = np.full(max(n, 2 * len(_inverses)), pow(_BASE, -1, 2 ** 64), U)
        steps[0] = 1
        _inverses = np.multiply.accumulate(steps)
    return _inverses[:n]


_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, in order, and the number of words of each text."""
    data = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    blank = _BLANK[data]
    before = np.concatenate(([True], blank[:-1]))
    starts = np.flatnonzero(~blank & before)
    bounds = np.cumsum([len(t) + 1 for t in texts])
    counts = np.diff(np.concatenate(([0], np.searchsorted(starts, bounds))))
    if not len(starts):
        return np.zeros(0, U), counts
    at = np.flatnonzero(~blank)
    firsts = np.searchsorted(at, starts)
    lengths = np.diff(np.append(firsts, len(at)))
    place = at - np.repeat(starts, lengths)
    values = (data[at].astype(U) + U(1)) * powers(int(lengths.max()))[place]
    return mix(np.add.reduceat(values, firsts) + lengths.astype(U)), counts


def windows(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of ``size`` consecutive words; of all of them where there are fewer, none for none."""
    if not len(words):
        return words
    n = max(1, len(words) - size + 1)
    out = np.full(n, U(min(len(words), size)), U)
    for k in range(min(size, len(words))):
        out = mix(out * U(_BASE & (2 ** 64 - 1)) + words[k:k + n])
    return out


def groups(texts: list[bytes], limit: int = 1 << 20):
    """Slices of a list of texts of about ``limit`` bytes together (longer texts alone)."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)
