"""Persistent strings: each is a node that shares its prefix with the others, compared by their longest common prefix.

A node knows its last letter, a rolling hash of the whole string, and its ancestors
1, 2, 4, … letters up. Two strings are compared by lifting both to the first place
where their hashes part; equal hashes are checked letter by letter up to the
node they share, so a collision can't change an order.
"""

from __future__ import annotations

_BASE, _PRIME = 1_000_003, (1 << 61) - 1


class Node:
    __slots__ = ("up", "depth", "hash", "letter")

    def __init__(self, parent: Node | None = None, letter=None) -> None:
        self.letter = letter
        if parent is None:
            self.up, self.depth, self.hash = [], 0, 0
            return
        self.depth = parent.depth + 1
        self.hash = (parent.hash * _BASE + hash_of(letter)) % _PRIME
        up = [parent]
        while len(above := up[-1].up) >= len(up):
            up.append(above[len(up) - 1])
        self.up = up

    def letters(self) -> list:
        out, node = [], self
        while node.up:
            out.append(node.letter)
            node = node.up[0]
        return out[::-1]


def hash_of(letter) -> int:
    return (letter if isinstance(letter, int) else ord(letter)) + 1


def lifted(node: Node, depth: int) -> Node:
    """The ancestor of ``node`` at ``depth``."""
    while (over := node.depth - depth) > 0:
        node = node.up[over.bit_length() - 1]
    return node


def same(a: Node, b: Node) -> bool:
    """Whether two strings of one length are equal, letter by letter."""
    while a is not b:
        if a.letter != b.letter:
            return False
        a, b = a.up[0], b.up[0]
    return True


def less(a: Node, b: Node) -> bool:
    """Whether the string of ``a`` comes before that of ``b``; a prefix comes before what it begins."""
    if a is b:
        return False
    depth = min(a.depth, b.depth)
    x, y = lifted(a, depth), lifted(b, depth)
    if x.hash == y.hash and same(x, y):
        return a.depth < b.depth
    at, other = x, y
    for j in range(len(x.up) - 1, -1, -1):
        if j < len(x.up) and x.up[j].hash != y.up[j].hash:
            x, y = x.up[j], y.up[j]
    if x.hash != y.hash and same(x.up[0], y.up[0]):
        return x.letter < y.letter
    first, second = at.letters(), other.letters()  # hashes that agree without the letters: compare these
    return first < second
