"""Word shingles of a text as 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

#: Odd multipliers that mix hashes; any others would do.
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


def words_of(text: str) -> list[bytes]:
    """A-Z lower-cased, split at ASCII white space: what bytes do."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX[1]
    return x ^ (x >> np.uint64(29))


def shingle_set(text: str | None, width: int = 4) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``width`` words; all words if they are fewer."""
    words = words_of(text or "")
    if not words:
        return np.empty(0, np.uint64)
    each = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(width, len(each))
    count = len(each) - width + 1
    out = np.full(count, width, np.uint64)
    for i in range(width):
        out = mixed(out * _MIX[0] + each[i : i + count])
    return np.unique(out)


def set_id(hashes: np.ndarray) -> bytes:
    """16 bytes that name a set: equal for equal sets."""
    return xxhash.xxh3_128_digest(hashes.tobytes())


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())
