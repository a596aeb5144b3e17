"""Content-chosen first digits of suffixes (numpy helpers of ``suffix_dedup``).

Every string of ``width`` bytes is given one anchor: the position of the
smallest hash among its ``k``-byte substrings (the leftmost one on ties). The
choice depends on the string's bytes only, so equal strings have equal anchors
at equal offsets, wherever they stand. Neighbouring strings mostly share their
anchor; such a stretch of strings is a *run*.
"""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xD6E8FEB86659FD93)
_POS_BITS = 20
#: Buffers are at most this long, so that a position fits beside its hash.
MAX_BUFFER = 1 << _POS_BITS


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


def substring_hashes(buf: np.ndarray, k: int) -> np.ndarray:
    """64-bit hashes of all k-byte substrings of ``buf`` (k a power of two), by
    doubling: the hash of 2n bytes is made from the hashes of its halves."""
    h, n = buf.astype(np.uint64) + np.uint64(1), 1
    base = _BASE
    while n < k:
        h = h[:-n] * np.uint64(base) + h[n:]
        base = base * base & 0xFFFFFFFFFFFFFFFF
        n *= 2
    return _mix(h)


def sliding_min(a: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w neighbours, by doubling."""
    n = 1
    while 2 * n <= w:
        a = np.minimum(a[:-n], a[n:])
        n *= 2
    if n < w:
        a = np.minimum(a[: len(a) - (w - n)], a[w - n:])
    return a


def runs(buf: np.ndarray, width: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of the ``width``-byte strings of one buffer: (anchor hash, first
    string's start, number of strings). Needs ``width <= len(buf) <= MAX_BUFFER``."""
    h = substring_hashes(buf, k)
    low = np.uint64((1 << _POS_BITS) - 1)
    keys = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    at = (sliding_min(keys, width - k + 1) & low).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    return h[at[first]], first, np.diff(np.append(first, len(at)))
