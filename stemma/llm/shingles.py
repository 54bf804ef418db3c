"""Word shingles of whole texts as sorted sets of 64-bit hashes, computed for many words at a time.

Words are runs of bytes other than blank, tab, line feed, vertical tab, form feed
and carriage return, with A-Z in lower case. A shingle is ``WORDS`` words in a row;
a text of fewer words is one shingle of all its words, one without words has none.
"""

from __future__ import annotations

import hashlib

import numpy as np

WORDS = 5
#: Bytes hashed at a time.
SLICE = 1 << 20
_MULTIPLIER = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit numbers (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256)
_LOWER[ord("A") : ord("Z") + 1] += 32
#: A number for each byte, the same for A-Z and a-z.
_VALUE = mixed(_LOWER.astype(np.uint64) * np.uint64(_MULTIPLIER) + np.uint64(1))
_PLACES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _places(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse, for at least ``n`` places."""
    size = 1 << max(16, n.bit_length())
    if size not in _PLACES:
        _PLACES.clear()
        both = []
        for base in (_MULTIPLIER, pow(_MULTIPLIER, -1, 1 << 64)):
            powers = np.empty(size, np.uint64)
            powers[0], done = 1, 1
            while done < size:
                step = np.uint64(pow(base, done, 1 << 64))
                powers[done : 2 * done] = powers[:done] * step
                done *= 2
            both.append(powers)
        _PLACES[size] = both[0], both[1]
    return _PLACES[size]


def _hash_words(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and start offsets of the words in one slice of bytes."""
    space = _SPACE[raw]
    edges = np.flatnonzero(np.diff(space, prepend=True, append=True))
    starts, ends = edges[0::2], edges[1::2]
    power, inverse = _places(len(raw) + 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_VALUE[raw] * power[: len(raw)], out=total[1:])
    return mixed((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), starts


def word_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and start offsets of all words, a slice at a time; slices end at white space."""
    if len(raw) <= SLICE:
        return _hash_words(raw)
    found, at = [], 0
    while at < len(raw):
        end = min(at + SLICE, len(raw))
        while end < len(raw):
            gap = np.flatnonzero(_SPACE[raw[end : end + 4096]])
            if len(gap):
                end += int(gap[0])
                break
            end += min(4096, len(raw) - end)
        hashes, starts = _hash_words(raw[at:end])
        found.append((hashes, starts + at))
        at = end
    return np.concatenate([h for h, _ in found]), np.concatenate([s for _, s in found])


def sets(texts: list[str], words: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    encoded = [t.encode() for t in texts]
    out: list[np.ndarray] = []
    at = 0
    while at < len(encoded):
        end, size = at, 0
        while end < len(encoded) and (end == at or size + len(encoded[end]) < SLICE):
            size += len(encoded[end]) + 1
            end += 1
        group = encoded[at:end]
        hashes, starts = word_hashes(np.frombuffer(b"\n".join(group), np.uint8))
        bounds = np.cumsum([0, *(len(x) + 1 for x in group)])
        firsts = np.searchsorted(starts, bounds).tolist()
        grams = hashes[: max(0, len(hashes) - words + 1)].copy()
        for k in range(1, words):
            grams = mixed(grams) + hashes[k : k + len(grams)]
        grams = mixed(grams)
        for a, b in zip(firsts, firsts[1:], strict=False):
            if b - a >= words:
                out.append(np.unique(grams[a : b - words + 1]))
            elif b > a:
                short = hashes[a : a + 1]
                for k in range(a + 1, b):
                    short = mixed(short) + hashes[k : k + 1]
                out.append(mixed(short + np.uint64(b - a)))
            else:
                out.append(np.empty(0, np.uint64))
        at = end
    return out


def signature(shingles: np.ndarray) -> bytes | None:
    """128 bits that name a set; None for the empty set."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None


def short_name(name: bytes) -> int:
    """The first 64 bits of a signature, signed."""
    return int.from_bytes(name[:8], "little", signed=True)
