"""Words of texts as 64-bit hashes, for operators on word sequences. Used inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

from .worker_cache import held

#: Distinct words a worker remembers; others are hashed again.
REMEMBERED = 300_000
#: Odd multipliers of the running combinations.
MULTIPLIERS = np.random.default_rng(20_240_607).integers(1 << 62, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(self) < REMEMBERED:
            self[word] = value
        return value


def word_hashes(text: str) -> np.ndarray:
    """Hashes of the words ``[^\\x20\\x09-\\x0D]+`` of a text, A-Z in lower case."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    return np.fromiter(map(held("words", _Hashes).__getitem__, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit (the finaliser of a 64-bit generator)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """The set of hashed shingles, sorted. Fewer words than ``size`` make one shingle, none make none."""
    if not len(words):
        return words
    count = min(size, len(words))
    total = np.zeros(len(words) - count + 1, np.uint64)
    for i in range(count):
        total += words[i:len(words) - count + 1 + i] * MULTIPLIERS[i]
    return np.unique(mixed(total + np.uint64(count)))
