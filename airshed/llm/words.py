"""Words, word hashes and shingle hashes of a text, for tasks that work on Arrow batches."""

from __future__ import annotations

import numpy as np
import xxhash

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
REMEMBERED = 500_000
PIECE = 1 << 20
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = 0x9E3779B97F4A7C15
ALL = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = value
        return value

    def of(self, text: str, lower: bool = False) -> np.ndarray:
        """Hashes of the words between ASCII white space, in order.

        Long texts are split in pieces, so that their words are never held all at once.
        """
        data = text.encode("utf-8", "replace")
        return self.of_bytes(data.translate(LOWER) if lower else data)

    def of_bytes(self, data: bytes) -> np.ndarray:
        if len(data) <= PIECE:
            words = data.split()
            return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))
        parts, start = [], 0
        while start < len(data):
            end = start + PIECE
            while end < len(data) and data[end] not in b" \t\n\x0b\x0c\r":
                end += 1
            words = data[start:end].split()
            parts.append(np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words)))
            start = end
        return np.concatenate(parts)


def windows(hashes: np.ndarray, size: int, base: int = _BASE) -> np.ndarray:
    """Hashes of all runs of ``size`` consecutive words (none for fewer words)."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for i in range(size):
        out *= np.uint64(base)
        out += hashes[i:i + n]
    return mix(out)


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of runs of ``size`` words; fewer words are one run."""
    if len(hashes) == 0:
        return np.zeros(0, dtype=np.uint64)
    if len(hashes) < size:
        return mix(windows(hashes, len(hashes)) + np.uint64(len(hashes)))
    return np.unique(windows(hashes, size))
