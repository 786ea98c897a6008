"""Words, shingles and small fixed-size summaries that several operators share.

A word is a run of characters other than space and \\x09-\\x0D, with A-Z lower-cased. A shingle is five neighbouring
words; a text with fewer words has its whole word sequence as its only shingle, a text without words has none.
Shingles are handled as 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import xxhash

SHINGLE = 5
_MIX_A, _MIX_B, _STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """Word -> 64-bit hash, filled on demand and emptied when it holds ``most`` words, so its memory is bounded."""

    def __init__(self, most: int = 300_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def words(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8 bytes; bytes.lower and bytes.split touch ASCII letters and ASCII white space only."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    values = (values ^ (values >> np.uint64(30))) * _MIX_A
    values = (values ^ (values >> np.uint64(27))) * _MIX_B
    return values ^ (values >> np.uint64(31))


def sequence_hashes(text: str | None, known: WordHashes, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words, in order; of the whole sequence if there are fewer words; empty without words."""
    tokens = words(text)
    if not tokens:
        return np.zeros(0, np.uint64)
    hashed = np.fromiter(map(known.__getitem__, tokens), np.uint64, len(tokens))
    width = min(size, len(tokens))
    n = len(tokens) - width + 1
    out = np.full(n, width, np.uint64)
    for k in range(width):
        out = mixed(out * _STEP + hashed[k : k + n])
    return out


def shingle_set(text: str | None, known: WordHashes, size: int = SHINGLE) -> np.ndarray:
    """Distinct shingle hashes of a text in ascending order."""
    return np.unique(sequence_hashes(text, known, size))
