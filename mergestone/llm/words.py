"""Words and 64-bit hashes of words and shingles, over UTF-8 bytes."""

from __future__ import annotations

import numpy as np
import xxhash

#: Bytes that belong to words of letters and digits: 0-9, a-z and all of a non-ASCII character.
_NOT_ALNUM = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))
_MASK = 0xFFFFFFFFFFFFFFFF
GOLDEN = 0x9E3779B97F4A7C15


def space_words(text: bytes) -> list[bytes]:
    """Words between ASCII white space; A-Z in lower case."""
    return text.lower().split()


def alnum_words(text: bytes) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z became a-z."""
    return text.lower().translate(_NOT_ALNUM).split()


class WordHashes(dict):
    """64-bit hash of each word; forgets all when it has grown to ``most`` words."""

    def __init__(self, most: int = 100_000) -> None:
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every input bit (splitmix64's finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words; of the whole sequence if it is shorter; none of no words."""
    n = len(hashes)
    width = min(size, n)
    if not n:
        return hashes
    out = mix(hashes[: n - width + 1] + np.uint64(width * GOLDEN & _MASK))
    for i in range(1, width):
        out = mix(out * np.uint64(3) + hashes[i : n - width + 1 + i])
    return out


def shingle_set(text: bytes | None, size: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct shingle hashes of a text; null and blank texts have none."""
    return np.unique(shingles(hashes.of(space_words(text or b"")), size))
