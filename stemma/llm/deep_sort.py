"""Deep-shallow sorting of many short byte strings.

Multikey quicksort orders strings by their first words of eight bytes, all ranges
of a round at once; ranges that still share ``SHALLOW`` words are ordered by blind
tries, which look at branching bytes only and compare each string once.
"""

from __future__ import annotations

import numpy as np

#: Words of eight bytes that quicksort looks at.
SHALLOW = 4


class BlindTrie:
    """Strings that share a long prefix. An inner node is ``[depth, {byte: node}]``, a leaf a list of strings' numbers."""

    def __init__(self, strings: list[bytes], size: int) -> None:
        self.strings, self.size, self.root = strings, size, None
        self.whole = [int.from_bytes(s.ljust(size, b"\0"), "big") for s in strings]

    def insert(self, i: int) -> None:
        if self.root is None:
            self.root = (None, [i])
            return
        string, size = self.strings[i], self.size
        node = self.root
        while node[0] is not None:  # blindly down by the branching bytes alone
            depth, below = node
            node = below.get(string[depth] if depth < len(string) else 0) or next(iter(below.values()))
        apart = self.whole[i] ^ self.whole[node[1][0]]
        if not apart:
            node[1].append(i)
            return
        shared = size - (apart.bit_length() + 7) // 8
        byte = string[shared] if shared < len(string) else 0
        parent, node = None, self.root
        while node[0] is not None and node[0] < shared:
            parent, at = node, string[node[0]] if node[0] < len(string) else 0
            node = node[1][at]
        if node[0] == shared:
            node[1][byte] = (None, [i])
            return
        other = self._any(node)
        new = (shared, {(other[shared] if shared < len(other) else 0): node, byte: (None, [i])})
        if parent is None:
            self.root = new
        else:
            parent[1][at] = new

    def _any(self, node: tuple) -> bytes:
        while node[0] is not None:
            node = next(iter(node[1].values()))
        return self.strings[node[1][0]]

    def ordered(self) -> list[int]:
        out, stack = [], [self.root]
        while stack:
            depth, below = stack.pop()
            if depth is None:
                out += sorted(below, key=lambda i: len(self.strings[i]))
            else:
                stack += [below[b] for b in sorted(below, reverse=True)]
        return out


def _multikey(words: np.ndarray, group: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """An order by group and then by ``depth`` words, and the number of each place's range of equals."""
    n = len(group)
    order = np.argsort(group, kind="stable")
    ranges = np.concatenate([[0], np.cumsum(np.diff(group[order]) != 0)]) if n else np.empty(0, np.int64)
    level = np.zeros(n, np.int64)  # by place: how many words its range shares
    while True:
        sizes = np.bincount(ranges, minlength=1)
        active = np.flatnonzero((sizes[ranges] > 1) & (level < depth))
        if not len(active):
            return order, ranges
        begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        of = ranges[active]
        middle = begins[of] + sizes[of] // 2  # the pivot of each range
        own, pivot = words[order[active], level[active]], words[order[middle], level[active]]
        side = 1 + (own > pivot).astype(np.int64) - (own < pivot)
        by = np.argsort(of * 3 + side, kind="stable")  # ranges keep their places
        order[active], side, of = order[active[by]], side[by], of[by]
        level[active] = level[active][by] + (side == 1)
        key = ranges * 3 + 1
        key[active] = of * 3 + side
        ranges = np.concatenate([[0], np.cumsum(np.diff(key) != 0)])


def common_prefixes(words: np.ndarray, lengths: np.ndarray, order: np.ndarray, group: np.ndarray) -> np.ndarray:
    """For each place, how many bytes its string shares with the one before; -1 where a group begins."""
    if not len(order):
        return np.empty(0, np.int64)
    before, here = words[order[:-1]], words[order[1:]]
    differ = before != here
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), words.shape[1])
    rows, at = np.arange(len(first)), np.minimum(first, words.shape[1] - 1)
    apart = before[rows, at] ^ here[rows, at]
    same = np.full(len(first), 8)
    for k in range(8):  # the highest byte that differs
        same = np.where((same == 8) & (apart >> np.uint64(56 - 8 * k) & np.uint64(255) != 0), k, same)
    shared = np.where(first == words.shape[1], words.shape[1] * 8, first * 8 + same)
    shared = np.minimum(shared, np.minimum(lengths[order[:-1]], lengths[order[1:]]))
    return np.concatenate([[-1], np.where(group[order[:-1]] == group[order[1:]], shared, -1)])


def sort(strings: list[bytes], group: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the strings (of at most ``size`` bytes) within their groups, and the bytes each shares with the one before.

    Equal strings stand shorter first where one only lacks zero bytes at the end.
    """
    size = -(-max(8, size) // 8) * 8
    words = np.frombuffer(b"".join([s.ljust(size, b"\0") for s in strings]), ">u8").astype(np.uint64).reshape(len(strings), size // 8)
    lengths = np.array([len(s) for s in strings], np.int64)
    order, ranges = _multikey(words, group, min(SHALLOW, words.shape[1]))
    sizes = np.bincount(ranges, minlength=1)
    begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    for begin, n in zip(begins[sizes > 1].tolist(), sizes[sizes > 1].tolist(), strict=True):
        own = order[begin : begin + n]
        trie = BlindTrie([strings[i] for i in own.tolist()], size)
        for k in range(n):
            trie.insert(k)
        order[begin : begin + n] = own[trie.ordered()]
    return order, common_prefixes(words, lengths, order, group)
