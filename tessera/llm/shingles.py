"""Word shingles as 64-bit numbers."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import xxhash

_PRIME = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


class WordHashes(dict):
    """Hash of each word seen; emptied when it grows past a bound."""

    BOUND = 200_000

    def __missing__(self, word: str) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[str]) -> np.ndarray:
        if len(self) > self.BOUND:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


@lru_cache(maxsize=1)
def word_hashes() -> WordHashes:
    return WordHashes()


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def runs(hashes: np.ndarray, n: int) -> np.ndarray:
    """A number for each run of n consecutive hashes; none if there are fewer."""
    if len(hashes) < n:
        return np.empty(0, np.uint64)
    out = np.zeros(len(hashes) - n + 1, np.uint64)
    for i in range(n):
        out = out * _PRIME + hashes[i : len(hashes) - n + 1 + i]
    return mixed(out)
