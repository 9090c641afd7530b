"""Word shingles of whole texts as 64-bit hashes, for use inside tasks."""

from __future__ import annotations

import numpy as np

MEMO_WORDS = 300_000
# Odd multipliers of a polynomial and of a finishing mix (public domain "splitmix64").
STEP, MIX1, MIX2 = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB


class WordHashes(dict):
    """word (bytes) -> 64-bit hash, remembering recent words."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > MEMO_WORDS:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(MIX1)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(MIX2)
    return h ^ (h >> np.uint64(31))


def ascii_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def shingle_set(hashes: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of all k-word runs; of the whole if it is shorter; none of none."""
    n = len(hashes)
    if n == 0:
        return hashes
    m = min(n, k)
    total = np.full(n - m + 1, m, np.uint64)
    for j in range(m):
        total = total * np.uint64(STEP) + hashes[j:n - m + 1 + j]
    return np.unique(mixed(total))


def least_overlap(n: np.ndarray | int, percent: int):
    """Smallest overlap with which a set of n can reach the similarity with any other set."""
    return -(-n * percent // 100)
