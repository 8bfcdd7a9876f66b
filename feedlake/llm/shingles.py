"""Word shingles as 64-bit hashes, computed a whole text at a time."""

from __future__ import annotations

import numpy as np
import xxhash

#: Words whose hashes a task remembers at once.
CACHE_WORDS = 300_000
#: Odd multipliers of the rolling combination and of its last mix.
_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


class WordHashes(dict):
    """Word (bytes) -> 64-bit hash; emptied when it is full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def combined(hashes: np.ndarray, size: int) -> np.ndarray:
    """One hash for every run of ``size`` words, in text order."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, size, np.uint64)
    for k in range(size):
        out = out * _STEP + hashes[k : k + n]
    out ^= out >> np.uint64(32)
    out *= _MIX
    return out ^ (out >> np.uint64(29))


def shingle_list(text: str | None, cache: WordHashes, size: int = 5) -> np.ndarray:
    """The shingles of a whole text in its order; a shorter text is one shingle, one without words has none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # A-Z only; splits at six characters
    if not words:
        return np.zeros(0, np.uint64)
    return combined(cache.of(words), min(size, len(words)))


def shingle_set(text: str | None, cache: WordHashes, size: int = 5) -> np.ndarray:
    """The distinct shingles of a whole text, ascending."""
    return np.unique(shingle_list(text, cache, size))
