"""Sets of hashed n-grams of whole texts, as sorted numbers."""

from __future__ import annotations

import numpy as np

from stemma.llm import shingles

#: Bytes taken at a time.
SLICE = 1 << 20


class Marks:
    """A set of numbers below ``2**bits`` that is filled, read and emptied again and again."""

    def __init__(self, bits: int) -> None:
        self.bits, self.on = bits, np.zeros(1 << bits, bool)

    def add(self, sequence: np.ndarray, sizes: range, kind: int) -> None:
        """The hashes of all n-grams of a sequence of small numbers, for n in ``sizes``; ``kind`` keeps families apart."""
        step = max(sizes) - 1
        for at in range(0, len(sequence), SLICE):
            part = sequence[at : at + SLICE + step].astype(np.uint32)
            gram = np.full(len(part), kind * 2654435761 & 0xFFFFFFFF, np.uint32)
            for n in range(1, max(sizes) + 1):
                if len(part) < n:
                    break
                gram = (gram[: len(part) - n + 1] ^ part[n - 1 :]) * np.uint32(0x01000193) + np.uint32(0x9E3779B9)
                if n in sizes:
                    self.on[((gram ^ gram >> np.uint32(15)) * np.uint32(0x85EBCA6B)) >> np.uint32(32 - self.bits)] = True

    def take(self) -> np.ndarray:
        found = np.flatnonzero(self.on)
        self.on[found] = False
        return found


def as_bytes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode(), np.uint8)


def _kinds() -> np.ndarray:
    """A kind for each byte: lower, upper and digit are one each, every other ASCII byte is its own."""
    kinds = np.arange(256, dtype=np.uint8)
    kinds[ord("a") : ord("z") + 1] = ord("a")
    kinds[ord("A") : ord("Z") + 1] = ord("A")
    kinds[ord("0") : ord("9") + 1] = ord("0")
    kinds[0x80:0xA0] = ord("A")  # second bytes of accented capitals
    kinds[0xA0:0xC0] = ord("a")
    return kinds


_KIND = _kinds()


def outline(raw: np.ndarray) -> np.ndarray:
    """The kinds of a text's bytes, runs of one kind taken together; lead bytes of longer characters are left out."""
    kinds = _KIND[raw[raw < 0xC0]]
    return kinds[np.flatnonzero(np.diff(kinds, prepend=0))] if len(kinds) else kinds


def repeats(raw: np.ndarray) -> np.ndarray:
    """For each word but the first, 1 if it is the one before it again, else 0."""
    words = shingles.word_hashes(raw)[0]
    return (words[1:] == words[:-1]).astype(np.uint8)
