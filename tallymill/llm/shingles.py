"""Sets of word shingles as sorted 64-bit hashes (helpers for tasks)."""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash

# A shingle has so many words; a shorter text is one shingle.
WORDS = 5
CACHED = 100_000


class _Codes(dict):
    def __missing__(self, word: bytes) -> int:
        code = self[word] = xxhash.xxh3_64_intdigest(word)
        return code


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers evenly (one to one)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Shingler:
    """Turns texts into sets; remembers the hashes of words."""

    def __init__(self) -> None:
        self.codes = _Codes()

    def __call__(self, text: str | None) -> np.ndarray:
        """Distinct shingles, ascending.  Words are what ASCII white space parts; A-Z count as a-z."""
        words = (text or "").encode("utf-8").lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        if len(self.codes) > CACHED:
            self.codes = _Codes()
        codes = np.fromiter(map(self.codes.__getitem__, words), np.uint64, len(words))
        size = min(WORDS, len(words))
        spread, factor = np.uint64(0x9E3779B97F4A7C15), np.uint64(size)
        h = np.zeros(len(words) - size + 1, np.uint64)
        for k in range(size):
            h = h * spread + mixed(codes[k:len(words) - size + 1 + k] + factor)
        return np.unique(mixed(h))


def set_key(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set."""
    digest = hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)
