"""Word shingles and MinHash signatures of texts, in numpy inside tasks."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import xxhash

SYMBOLS, CHUNK = 48, 4  # signature symbols of 16 bits, symbols in a chunk
_MIX = np.uint64(0xFF51AFD7ED558CCD)


@lru_cache(maxsize=4)
def _multipliers(n: int) -> np.ndarray:
    return np.random.default_rng(17).integers(1, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles.

    A-Z is lower-cased; words are runs of anything but ASCII white space.  A text with fewer words than
    a shingle has its whole sequence as the only one, a text without words has none.
    """
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, found), dtype=np.uint64, count=len(found))
    n = min(words, len(h))
    mult, out = _multipliers(words), np.zeros(len(h) - n + 1, dtype=np.uint64)
    for i in range(n):
        x = h[i:len(h) - n + 1 + i] * mult[i]
        out += x ^ (x >> np.uint64(29))
    out ^= out >> np.uint64(33)
    out *= _MIX
    return np.unique(out ^ (out >> np.uint64(33)) ^ np.uint64(n))


def signature(shingles: np.ndarray) -> np.ndarray:
    """SYMBOLS symbols of 16 bits: the low bits of the smallest value under each hash function."""
    mult = _multipliers(SYMBOLS + 1)[1:]
    out = np.empty(SYMBOLS, dtype=np.uint16)
    for i in range(SYMBOLS):
        out[i] = (int((shingles * mult[i]).min()) * int(_MIX) >> 40) & 0xFFFF
    return out


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, for sorted distinct arrays (empty sets never are)."""
    if not len(a) or not len(b) or 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)
