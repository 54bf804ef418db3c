"""Byte-level BPE by a lazily determinised transducer, and streaming decoding.

A sequence of tokens is what the merges give exactly if each token gives itself
and each two neighbours, taken alone, stay as they are. So each prefix of a
string has one encoding, and its last token is the one that reaches back to a
prefix whose own last token it may follow. A transducer reads bytes and keeps, for
every token that may be under way, its node in the vocabulary's trie and the
tokens before it; tokens on which all of these agree are emitted. How far it looks
ahead is bounded by the longest token. States and transitions are made when first
met and remembered. Many strings are read side by side, a byte of each at a time;
states and transitions new to them are then made together, in arrays.
"""

from __future__ import annotations

import array
import base64
import functools
import struct
import sys
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from stemma.llm.common import arrow_of, batch_of, held, no_cycles, rows_of, small_batches, texts

#: Entries a worker remembers of each kind, twice where the older half is kept.
REMEMBERED = 350_000
#: Transitions a worker remembers of strings read one by one.
STEPS = 100_000
#: States and tokens of their chains that a worker remembers of strings read side by side, and the slots (a power of two) for transitions.
STATES, CHAINS, SLOTS = 300_000, 8_000_000, 20
#: Bytes of strings read side by side at a time; they make as many states at most.
READ = 1 << 18
#: Strings of more bytes, and strings of which fewer are at hand, are read one by one.
SIDE_BY_SIDE_BYTES, SIDE_BY_SIDE = 256, 48
#: Characters of texts whose new parts are encoded together.
TOGETHER = 1 << 21
#: Bytes of ids decoded at a time.
CHUNK = 1 << 16
#: Parts of this many characters or more are encoded anew each time.
LONGEST = 100
_NONE = -1
#: Packs ids as 32-bit numbers; where that isn't little-endian the slower way is taken.
_packed = functools.partial(array.array, "I")
_NATIVE = sys.byteorder == "little" and array.array("I").itemsize == 4
_LATIN_END = "\u0250"
_BYTES = [bytes((b,)) for b in range(256)]
_IDS = arrow_of("doc_id long, ids binary")
_DECODED = arrow_of("doc_id long, ids binary, decoded binary")


def _bytes_of(ids: list[int]) -> bytes:
    return _packed(ids).tobytes() if _NATIVE else struct.pack(f"<{len(ids)}I", *ids)


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def merge(piece: bytes, ranks: dict[bytes, int], below: int = 1 << 40) -> list[int]:
    """The definition: merge the leftmost neighbours of lowest rank, while it is under ``below``."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        rank, at = min((ranks.get(parts[i] + parts[i + 1], below), i) for i in range(len(parts) - 1))
        if rank >= below:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


def double_array(children: list[dict[int, int]]) -> tuple[array.array, array.array, list[int]]:
    """A trie as two arrays, and the place of each node in them: a child lies at its parent's base plus its byte."""
    used, bases, at = bytearray(2 * len(children) + 1024), [0] * len(children), 256
    last = 0
    for node in sorted((n for n, own in enumerate(children) if own), key=lambda n: -len(children[n])):
        own = sorted(children[node])
        if len(own) == 1 < last:
            at = 256  # nodes of one child fill what the others have left
        last = len(own)
        at = used.find(0, at)
        while any([used[at - own[0] + byte] for byte in own]):
            at = used.find(0, at + 1)
        bases[node] = at - own[0]
        for byte in own:
            used[bases[node] + byte] = 1
        if len(used) - at < 1024:
            used += bytes(1 << 16)
    place = [0] * len(children)
    base, check = array.array("i", bytes(4 * len(used))), array.array("i", [_NONE]) * len(used)
    for node, own in enumerate(children):
        for byte, child in own.items():
            place[child] = bases[node] + byte
    for node, own in enumerate(children):
        base[place[node]] = bases[node]
        for child in own.values():
            check[place[child]] = place[node]
    return base, check, place


class MergeTransducer:
    """Encodes byte strings; a state is a number, its meaning is in ``states``."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks, self.bytes_of = ranks, {r: b for b, r in ranks.items()}
        self.split: dict[int, tuple[int, int] | None] = {}
        children: list[dict[int, int]] = [{}]
        at = {}
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                if byte not in children[node]:
                    children[node][byte] = len(children)
                    children.append({})
                node = children[node][byte]
            if len(token) == 1 or self.halves(rank):  # a token that its own bytes don't give is never a part
                at[node] = rank
        #: the vocabulary's trie: from node ``n`` a byte leads to ``base[n] + byte`` if ``check`` has ``n`` there
        self.base, self.check, place = double_array(children)
        self.ends, self.grows = array.array("i", [_NONE]) * len(self.check), bytearray(len(self.check))
        for node, token in at.items():
            self.ends[place[node]] = token  # the token that ends at a node
        for node, own in enumerate(children):
            self.grows[place[node]] = bool(own)  # whether a longer token goes on from it
        self.follows: dict[int, bool] = {}
        self.forget()

    def forget(self) -> None:
        start = (_NONE, b"")
        self.states, self.keys, self.number, self.steps = [[(0, ())]], [start], {start: 0}, {}

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge gives ``token``; None for a byte or a token that its bytes don't give."""
        if token not in self.split:
            raw = self.bytes_of[token]
            parts = merge(raw, self.ranks, token)
            self.split[token] = (parts[0], parts[1]) if len(parts) == 2 else None
        return self.split[token]

    def may_follow(self, a: int, b: int) -> bool:
        """Whether ``a`` and ``b`` side by side stay apart under the merges.

        Their last merges are undone, the later one first. At each step the tokens
        that touch could have merged instead; that happened if their merge comes
        before the one just undone (in a tie the one on the left comes first).
        """
        left, right, before = a, b, 1 << 40
        known = True
        while True:
            joint = self.ranks.get(self.bytes_of[left] + self.bytes_of[right])
            if joint is not None and joint < before:
                known = False
                break
            x, y = self.halves(left), self.halves(right)
            if x is None and y is None:
                break
            if y is None or x is not None and left > right:
                before, left = left, x[1]
            else:
                before, right = right + 1, y[0]
        if len(self.follows) > REMEMBERED:
            self.follows.clear()
        self.follows[a << 32 | b] = known
        return known

    def step(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        """The next state and the tokens that are certain now.

        A state's name is the last token emitted and the bytes since; what may be
        under way, pairs of a node and the tokens before it, follows from these.
        """
        after, base, check, ends, grows, follows = [], self.base, self.check, self.ends, self.grows, self.follows
        last, pending = self.keys[state]
        whole = None  # the one encoding of all bytes so far
        for node, chain in self.states[state]:
            child = base[node] + byte
            if check[child] != node:
                continue
            if grows[child]:
                after.append((child, chain))
            if whole is None and (token := ends[child]) >= 0:
                before = chain[-1] if chain else last
                if before >= 0:
                    known = follows.get(before << 32 | token)
                    if known is None:
                        known = self.may_follow(before, token)
                    if not known:
                        continue
                whole = (*chain, token)
        after.append((0, whole))
        pending += bytes((byte,))
        certain: tuple[int, ...] = ()
        first = after[0][1]
        if first:  # the tokens on which all agree
            n = len(first)
            for _, chain in after:
                while chain[:n] != first[:n]:
                    n -= 1
                if not n:
                    break
            if n:
                certain = first[:n]
                after = [(node, chain[n:]) for node, chain in after]
                last, pending = certain[-1], pending[sum([len(self.bytes_of[t]) for t in certain]) :]
        number = self.number.get((last, pending))
        if number is None:
            number = self.number[last, pending] = len(self.states)
            self.states.append(after)
            self.keys.append((last, pending))
        self.steps[state << 8 | byte] = found = (number, certain)
        return found

    def encode(self, piece: bytes) -> list[int]:
        """Ids of ``piece`` by the merges alone."""
        if len(self.steps) > STEPS:
            self.forget()
        state, out, steps = 0, [], self.steps
        for byte in piece:
            found = steps.get(state << 8 | byte) or self.step(state, byte)
            state = found[0]
            if found[1]:
                out += found[1]
        # what is pending ends at the root, which stands last: the encoding of the whole
        out += self.states[state][-1][1]
        return out


class _Grown:
    """An array that grows at its end."""

    def __init__(self, kind: type) -> None:
        self.all, self.size = np.empty(1024, kind), 0

    def extend(self, more: np.ndarray) -> None:
        end = self.size + len(more)
        if end > len(self.all):
            self.all = np.concatenate([self.all[: self.size], np.empty(max(end, self.size * 3 // 2) - self.size, self.all.dtype)])
        self.all[self.size : end] = more
        self.size = end


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places ``start, start + 1, ...`` of each run, one run after another."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


def slots_of(keys: np.ndarray) -> np.ndarray:
    return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOTS)).astype(np.int64)


class SideBySide:
    """The states and transitions of a transducer in arrays, for many strings at a time.

    A state's items (a node of the trie and the tokens before it) lie one after
    another, the root's last; tokens are a start and a size in ``pool``, so that
    emitted ones are cut off by moving the start. A transition's slot is told by
    its hash and holds the whole key; one that another has taken is made again.
    """

    def __init__(self, transducer: MergeTransducer) -> None:
        t = transducer
        self.base, self.check, self.ends = (np.frombuffer(x, np.int32) for x in (t.base, t.check, t.ends))
        self.grows = np.frombuffer(t.grows, bool)
        size = max(t.bytes_of) + 1
        self.sizes, self.left, self.right = np.zeros(size, np.int64), np.full(size, _NONE, np.int64), np.full(size, _NONE, np.int64)
        joint = {}
        for token, raw in t.bytes_of.items():
            self.sizes[token] = len(raw)
            if len(raw) > 1 and (halves := t.halves(token)):
                self.left[token], self.right[token] = halves
            for cut in range(1, len(raw)):
                x, y = t.ranks.get(raw[:cut]), t.ranks.get(raw[cut:])
                if x is not None and y is not None:
                    joint[x << 32 | y] = token
        #: pairs of tokens whose bytes together are a token, and that token; the last pair is none
        self.pairs = np.array([*sorted(joint), 1 << 62], np.int64)
        self.joint = np.array([*(joint[k] for k in sorted(joint)), 0], np.int64)
        self.forget()

    def forget(self) -> None:
        n = 1 << SLOTS
        self.key, self.to, self.out_at, self.out_size = np.full(n, _NONE, np.int64), np.zeros(n, np.int32), np.zeros(n, np.int32), np.zeros(n, np.int32)
        self.pair, self.known = np.full(n, _NONE, np.int64), np.zeros(n, bool)
        self.number, self.pending = {(_NONE, b""): 0}, [b""]
        self.pool, self.node, self.chain, self.length = _Grown(np.int32), _Grown(np.int32), _Grown(np.int32), _Grown(np.int32)
        #: of each state: its last token emitted, where its items start, how many they are
        self.last, self.first, self.count = _Grown(np.int32), _Grown(np.int32), _Grown(np.int32)
        for array_, start in ((self.node, 0), (self.chain, 0), (self.length, 0), (self.last, _NONE), (self.first, 0), (self.count, 1)):
            array_.extend(np.array([start]))

    def stay_apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``may_follow`` of many pairs."""
        known, at = np.ones(len(a), bool), np.arange(len(a))
        left, right, before = a.astype(np.int64), b.astype(np.int64), np.full(len(a), 1 << 40)
        while len(at):
            pair = left << 32 | right
            found = np.searchsorted(self.pairs, pair)
            merged = (self.pairs[found] == pair) & (self.joint[found] < before)
            known[at[merged]] = False
            x, y = self.right[left], self.left[right]
            on = ~merged & ((x >= 0) | (y >= 0))
            at, left, right, x, y = at[on], left[on], right[on], x[on], y[on]
            undo = (y < 0) | (x >= 0) & (left > right)
            before = np.where(undo, left, right + 1)
            left, right = np.where(undo, x, left), np.where(undo, right, y)
        return known

    def follows(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether each ``a`` (none: -1) and ``b`` stay apart; pairs are remembered."""
        pair = a.astype(np.int64) << 32 | b
        slot = slots_of(pair)
        known = self.known[slot]
        new = np.flatnonzero((self.pair[slot] != pair) & (a >= 0))
        if len(new):
            own, back = np.unique(pair[new], return_inverse=True)
            made = self.stay_apart(own >> 32, own & 0xFFFFFFFF)
            slot = slots_of(own)
            self.pair[slot], self.known[slot] = own, made
            # of pairs for one slot the last written stays in both arrays
            known[new] = made[back]
        known[a < 0] = True
        return known

    def make(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """New transitions: the state each leads to, and the start and size in ``pool`` of the tokens certain then."""
        state, byte = keys >> 8, keys & 255
        pool = self.pool.all
        count, last = self.count.all[state], self.last.all[state]
        of = np.repeat(np.arange(len(keys)), count)
        item = ragged(self.first.all[state], count)
        node, chain, length = self.node.all[item], self.chain.all[item], self.length.all[item]
        child = self.base[node] + byte[of]
        live = np.flatnonzero(self.check[child] == node)
        of, child, chain, length = of[live], child[live], chain[live], length[live]
        # the one encoding of all bytes so far: the first item that may end here
        whole = np.full(len(keys), _NONE)
        token = self.ends[child]
        left = np.flatnonzero(token >= 0)
        while len(left):
            ahead = np.ones(len(left), bool)
            ahead[1:] = of[left[1:]] != of[left[:-1]]
            tried = left[ahead]
            before = np.where(length[tried] > 0, pool[np.maximum(chain[tried] + length[tried] - 1, 0)], last[of[tried]])
            good = tried[self.follows(before, token[tried])]
            whole[of[good]] = good
            left = left[~ahead & (whole[of[left]] < 0)]
        if (whole < 0).any():
            raise KeyError(bytes(byte[whole < 0][:1].tolist()))
        size = length[whole] + 1
        start = self.pool.size + np.cumsum(size) - size
        new = np.empty(int(size.sum()), np.int32)
        ends = start + size - 1 - self.pool.size
        new[ends] = token[whole]
        within = np.ones(len(new), bool)
        within[ends] = False
        new[within] = pool[ragged(chain[whole], size - 1)]
        self.pool.extend(new)
        pool = self.pool.all
        # the tokens on which all that go on agree with it
        on = np.flatnonzero(self.grows[child])
        of, child, chain, length = of[on], child[on], chain[on], length[on]
        alike = np.zeros(len(of), np.int64)
        same = np.arange(len(of))
        while len(same):
            k = alike[same]
            same, k = (x[(k < length[same]) & (k < size[of[same]])] for x in (same, k))
            same = same[pool[chain[same] + k] == pool[start[of[same]] + k]]
            alike[same] += 1
        certain = size.copy()
        np.minimum.at(certain, of, alike)
        last = np.where(certain > 0, pool[start + np.maximum(certain, 1) - 1], last)
        gone = np.concatenate([[0], np.cumsum(self.sizes[pool[ragged(start, certain)]])])
        ends = np.cumsum(certain)
        gone = gone[ends] - gone[ends - certain]
        # states by their names; what is new is kept
        to, fresh = [], []
        number, pending = self.number, self.pending
        for i, (s, b, n, x) in enumerate(zip(state.tolist(), byte.tolist(), gone.tolist(), last.tolist(), strict=True)):
            name = (x, (pending[s] + _BYTES[b])[n:])
            found = number.get(name)
            if found is None:
                found = number[name] = len(pending)
                pending.append(name[1])
                fresh.append(i)
            to.append(found)
        fresh = np.array(fresh, np.int64)
        mine = np.zeros(len(keys), bool)
        mine[fresh] = True
        kept = np.flatnonzero(mine[of])
        count = np.bincount(of[kept], minlength=len(keys))[fresh] + 1
        root = np.cumsum(count) - 1
        cut = certain[of[kept]]
        for grown, items, roots in ((self.node, child[kept], 0), (self.chain, chain[kept] + cut, (start + certain)[fresh]), (self.length, length[kept] - cut, (size - certain)[fresh])):
            both = np.empty(len(kept) + len(fresh), np.int64)
            place = np.ones(len(both), bool)
            place[root] = False
            both[place], both[root] = items, roots
            if grown is self.node:
                self.first.extend(self.node.size + root + 1 - count)
            grown.extend(both)
        self.last.extend(last[fresh])
        self.count.extend(count)
        return np.array(to, np.int32), start, certain

    def encode(self, strings: list[bytes]) -> list[bytes]:
        """Little-endian 32-bit ids of each string."""
        found, start, size = [], 0, 0
        for i, string in enumerate(strings, 1):
            size += len(string)
            if size >= READ or i == len(strings):
                found += self.read(strings[start:i])
                start, size = i, 0
        return found

    def read(self, strings: list[bytes]) -> list[bytes]:
        if len(self.pending) > STATES or self.pool.size > CHAINS:
            self.forget()
        sizes = np.array(list(map(len, strings)))
        order = np.argsort(-sizes, kind="stable")
        data = np.frombuffer(b"".join(strings), np.uint8)
        starts, falling = (np.cumsum(sizes) - sizes)[order], -sizes[order]
        state = np.zeros(len(strings), np.int64)
        outs = []
        for i in range(-int(falling[0])):
            n = np.searchsorted(falling, -i)  # the strings that have a byte here
            keys = state[:n] << 8 | data[starts[:n] + i]
            slot = slots_of(keys)
            to, out_at, out_size = self.to[slot], self.out_at[slot], self.out_size[slot]
            new = np.flatnonzero(self.key[slot] != keys)
            if len(new):
                own, back = np.unique(keys[new], return_inverse=True)
                made = self.make(own)
                slot = slots_of(own)
                for array_, values in ((self.key, own), *zip((self.to, self.out_at, self.out_size), made, strict=True)):
                    array_[slot] = values
                to[new], out_at[new], out_size[new] = (x[back] for x in made)
            state[:n] = to
            some = np.flatnonzero(out_size)
            outs.append((some, out_at[some], out_size[some]))
        # what is pending ends at the root, which stands last: the encoding of the whole
        root = self.first.all[state] + self.count.all[state] - 1
        outs.append((np.arange(len(strings)), self.chain.all[root], self.length.all[root]))
        of, at, size = map(np.concatenate, zip(*outs, strict=True))
        by = np.argsort(order[of], kind="stable")
        ids = self.pool.all[ragged(at[by], size[by])].astype("<u4").tobytes()
        ends = (4 * np.cumsum(np.bincount(order[of], size, len(strings)).astype(np.int64))).tolist()
        return [ids[a:b] for a, b in zip([0, *ends], ends, strict=False)]


class _Memory:
    """Ids of strings; half is forgotten when it is full, long ones when a round is over."""

    def __init__(self) -> None:
        self.ids: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def lacks(self, wanted: set[str]) -> set[str]:
        """Those of ``wanted`` that are not remembered; the others are in ``ids`` from now on."""
        lacking = wanted.difference(self.ids)
        if self.older:
            again = [key for key in lacking if key in self.older]
            self.ids.update(zip(again, map(self.older.__getitem__, again), strict=True))
            lacking.difference_update(again)
        return lacking

    def over(self, new: Iterable[str]) -> None:
        for key in new:
            if len(key) >= LONGEST:
                del self.ids[key]
        if len(self.ids) > REMEMBERED:
            self.older, self.ids = self.ids, {}


class ByteIds:
    """Ids of texts by ranks and a pattern; parts between single blanks are remembered.

    A part that neither begins nor ends with white space is matched by the pattern
    in the same way wherever it stands after one blank; texts with other parts are
    matched whole. What is new in the texts of a round is encoded together.
    """

    def __init__(self, path: str, pattern: str) -> None:
        self.ranks = load_ranks(path)
        self.transducer = MergeTransducer(self.ranks)
        self.side_by_side = SideBySide(self.transducer)
        self.pattern = regex.compile(pattern)
        self.parts, self.pieces = _Memory(), _Memory()

    def by_merges(self, raws: list[bytes]) -> list[bytes]:
        """Ids of strings that are no tokens."""
        short = [raw for raw in raws if len(raw) <= SIDE_BY_SIDE_BYTES]
        found = dict(zip(short, self.side_by_side.encode(short), strict=True)) if len(short) >= SIDE_BY_SIDE else {}
        return [found[raw] if raw in found else _bytes_of(self.transducer.encode(raw)) for raw in raws]

    def cut(self, part: str) -> list[str]:
        """The pieces of a part and the blank before it."""
        if max(part) < _LATIN_END:  # plain words, without or with a mark after: no need to match
            if part.isalpha():
                return [" " + part]
            if part[-1] in ",." and part[:-1].isalpha():
                return [" " + part[:-1], part[-1]]
        return self.pattern.findall(" " + part)

    def round(self, texts: list[str]) -> list[bytes]:
        rests = [text.split(" ") for text in texts]
        heads = [words.pop(0) for words in rests]
        new = self.parts.lacks(set().union(*rests))
        odd = {part for part in new if not part or part[0].isspace() or part[-1].isspace()}
        new = list(new - odd)
        for i, (head, rest) in enumerate(zip(heads, rests, strict=True)):
            if not head or head[-1].isspace() or odd and not odd.isdisjoint(rest):
                heads[i], rests[i] = texts[i], ()
        heads, cuts = list(map(self.pattern.findall, heads)), list(map(self.cut, new))
        pieces = list(self.pieces.lacks(set().union(*heads, *cuts)))
        raws = [piece.encode() for piece in pieces]
        whole = list(map(self.ranks.get, raws))
        merged = iter(self.by_merges([raw for raw, token in zip(raws, whole, strict=True) if token is None]))
        self.pieces.ids.update(zip(pieces, [next(merged) if token is None else _bytes_of([token]) for token in whole], strict=True))
        ids_of = self.pieces.ids.__getitem__
        self.parts.ids.update(zip(new, [ids_of(x[0]) if len(x) == 1 else b"".join(map(ids_of, x)) for x in cuts], strict=True))
        known = self.parts.ids.__getitem__
        found = [b"".join([*map(ids_of, head), *map(known, rest)]) for head, rest in zip(heads, rests, strict=True)]
        self.pieces.over(pieces)
        self.parts.over(new)
        return found

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of whole texts."""
        found, start, size = [], 0, 0
        for i, text in enumerate(texts, 1):
            size += len(text)
            if size >= TOGETHER or i == len(texts):
                found += self.round(texts[start:i])
                start, size = i, 0
        return found

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]


class Utf8Stream:
    """Decodes UTF-8 as it comes; bytes of a character that is not over are kept for the next call.

    The state is what is kept: the bytes from the last lead byte on, while fewer
    have come than it announces. Bytes that can't belong to a character become
    U+FFFD, as do kept bytes when the stream ends.
    """

    def __init__(self) -> None:
        self.kept = b""

    def feed(self, data: bytes) -> str:
        data = self.kept + data
        cut = len(data)
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte >= 0xC0:  # a lead byte; it announces 2 to 4 bytes
                if back < (2 if byte < 0xE0 else 3 if byte < 0xF0 else 4):
                    cut = len(data) - back
                break
            if byte < 0x80:
                break
        self.kept = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def end(self) -> str:
        kept, self.kept = self.kept, b""
        return kept.decode("utf-8", "replace")


class TokenBytes:
    """The bytes of all tokens in one array, so that ids are turned to bytes many at a time."""

    def __init__(self, bytes_of: dict[int, bytes]) -> None:
        self.sizes = np.zeros(max(bytes_of, default=-1) + 1, np.int64)
        for token, raw in bytes_of.items():
            self.sizes[token] = len(raw)
        self.known = np.zeros(len(self.sizes), bool)
        self.known[list(bytes_of)] = True
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.all = np.frombuffer(b"".join(bytes_of[token] for token in sorted(bytes_of)), np.uint8)

    def __call__(self, ids: bytes) -> bytes:
        """Bytes of little-endian 32-bit ids."""
        tokens = np.frombuffer(ids, "<u4")
        if not self.known[tokens].all():
            raise KeyError(int(tokens[~self.known[tokens]][0]))
        sizes = self.sizes[tokens]
        ends = np.cumsum(sizes)
        return self.all[np.repeat(self.starts[tokens] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)].tobytes()


def decode_stream(chunks: Iterable[bytes], bytes_of: Callable[[bytes], bytes]) -> Iterator[str]:
    """Text of a stream of little-endian 32-bit ids, a string for each chunk; ``bytes_of`` gives the bytes of ids."""
    stream = Utf8Stream()
    for chunk in chunks:
        yield stream.feed(bytes_of(chunk))
    yield stream.end()


def _known(ranks: str, pattern: str) -> ByteIds:
    return held(("byte ids", ranks, pattern), lambda: ByteIds(ranks, pattern))


def encode(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """``doc_id`` and ``ids`` (32-bit, little-endian) of every whole text.

    ``ranks`` is a path each worker can read. Each match of ``pattern`` is encoded
    by itself: as one token if it is in the vocabulary, else by the merges. Null
    and empty texts give no ids; null and repeated ``doc_id`` stay separate rows.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _known(ranks, pattern)
        for ids, bodies in rows_of(batches, "doc_id", "text"):
            with no_cycles():
                found = known.encode_all(bodies)
            yield batch_of(_IDS, ids, found)

    return texts(docs).mapInArrow(run, "doc_id long, ids binary")


def decode(ids: DataFrame, ranks: str) -> DataFrame:
    """``decoded`` bytes of ``ids(doc_id, ids)``, beside both."""
    small_batches(ids.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bytes_of = TokenBytes({r: b for b, r in load_ranks(ranks).items()})
        for docs, found in rows_of(batches, "doc_id", "ids"):
            yield batch_of(_DECODED, docs, found, list(map(bytes_of, found)))

    return ids.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, decoded binary")


def round_trip(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """``doc_id, ids, decoded``: as ``decode`` of ``encode``, in one pass.

    Ids are decoded as a stream of chunks; what the stream's states hold back at a
    chunk's end comes with the next.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _known(ranks, pattern)
        bytes_of = TokenBytes(known.transducer.bytes_of)
        for docs_in, bodies in rows_of(batches, "doc_id", "text"):
            with no_cycles():
                found = known.encode_all(bodies)
            decoded = ["".join(decode_stream((x[i : i + CHUNK] for i in range(0, len(x), CHUNK)), bytes_of)).encode() for x in found]
            yield batch_of(_DECODED, docs_in, found, decoded)

    return texts(docs).mapInArrow(run, "doc_id long, ids binary, decoded binary")
