"""Words of texts as 64-bit hashes."""

from __future__ import annotations

import numpy as np
from xxhash import xxh3_64_intdigest

MIX = np.uint64(0xFF51AFD7ED558CCD)
SHIFT = np.uint64(32)
STEP = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> list[bytes]:
    """The runs of characters other than ASCII white space, A-Z in lower case."""
    return text.encode().lower().split() if text else []


def hashes(items: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxh3_64_intdigest, items), np.uint64, len(items))


def mixed(h: np.ndarray) -> np.ndarray:
    """Hashes whose bits all depend on all bits of ``h``."""
    h = (h ^ (h >> SHIFT)) * MIX
    h = (h ^ (h >> SHIFT)) * STEP
    return h ^ (h >> SHIFT)


def shingles(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct hashes of ``n`` consecutive words, or of all words where there are fewer."""
    h = hashes(words(text))
    if not len(h):
        return h
    runs = max(len(h) - n + 1, 1)
    total = np.full(runs, min(n, len(h)), np.uint64)
    for k in range(min(n, len(h))):
        total = mixed(total * STEP + h[k : k + runs])
    total.sort()
    return total[np.concatenate(([True], total[1:] != total[:-1]))]
