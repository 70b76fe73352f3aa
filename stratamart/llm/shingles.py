"""Word shingles of whole texts as 64-bit hashes."""

from __future__ import annotations

import hashlib

import numpy as np

WORDS = 5
MOST_KEPT = 400_000  # word hashes remembered by a task

# Odd multipliers, one per place in a shingle.
_PLACES = [
    np.uint64(m)
    for m in (
        0x9E3779B97F4A7C15,
        0xC2B2AE3D27D4EB4F,
        0x165667B19E3779F9,
        0xD6E8FEB86659FD93,
        0xA0761D6478BD642F,
    )
]


class Shingler(dict):
    """Hashes of words, and through them the sets of shingles of texts."""

    def __missing__(self, word: bytes) -> int:
        found = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        if len(self) >= MOST_KEPT:
            self.clear()
        self[word] = found
        return found

    def shingles(self, text: str | None) -> np.ndarray:
        """Sorted hashes of the distinct five-word shingles of a text.

        ASCII capitals are lowered; words end at bytes 0x20 and 0x09-0x0D. A
        text of fewer words is one shingle as a whole; one without words has none.
        """
        words = (text or "").encode().lower().split()
        if not words:
            return np.empty(0, np.uint64)
        hashes = np.fromiter(map(self.__getitem__, words), np.uint64, len(words))
        width = min(WORDS, len(hashes))
        n = len(hashes) - width + 1
        mixed = np.full(n, width, np.uint64)
        for k in range(width):
            mixed += hashes[k : k + n] * _PLACES[k]
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(32)
        return np.unique(mixed)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= ``percent`` * union of two sets that are not empty."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common > 0 and 100 * common >= percent * (len(a) + len(b) - common)


def common_counts(left: list[np.ndarray], right: list[np.ndarray], columns: int = 8192) -> np.ndarray:
    """How many elements each set of ``left`` shares with each of ``right``."""
    counts = np.zeros((len(left), len(right)), np.int64)
    if not left or not right:
        return counts
    both = np.intersect1d(np.concatenate(left), np.concatenate(right))

    def table(sets: list[np.ndarray], some: np.ndarray) -> np.ndarray:
        cells = np.zeros((len(sets), len(some)), np.float32)
        for row, elements in zip(cells, sets):
            row[np.isin(some, elements, assume_unique=True)] = 1
        return cells

    for start in range(0, len(both), columns):
        some = both[start : start + columns]
        counts += (table(left, some) @ table(right, some).T).astype(np.int64)
    return counts
