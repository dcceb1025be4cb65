"""Word and window hashes shared by the operators on word windows.

Words are hashed with xxh3 (64 bits); a window of L words is a sum of its word hashes
times odd multipliers, passed through a bijective finaliser.  Windows of many documents
are computed in one numpy pass; windows that cross a document's end are masked.
"""

from __future__ import annotations

import numpy as np
import xxhash

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser, a bijection on 64 bits."""
    x = x ^ (x >> np.uint64(30))
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def multipliers(n: int) -> np.ndarray:
    return mix64(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, count=len(words))


def window_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n consecutive entries of h; empty if h is shorter."""
    m = len(h) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(m, np.uint64)
    for j, c in enumerate(multipliers(n)):
        out += h[j : j + m] * c
    return mix64(out)


def pack_rows(items, cost, limit: int):
    """Groups of consecutive items whose costs sum to about limit; one alone may exceed it."""
    group, total = [], 0
    for x in items:
        group.append(x)
        total += cost(x)
        if total >= limit:
            yield group
            group, total = [], 0
    if group:
        yield group
