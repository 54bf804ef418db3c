"""Phrases whose words stand together more often than their parts alone, found by Rabin-Karp fingerprints.

A prefix polynomial over the bytes of many texts gives the fingerprint of every
n-gram of words at once. Level by level each task counts the fingerprints of n-grams both of whose
shorter parts may be frequent, and after the shuffle the counts are added up; those that
are frequent enough set bits of a filter of fixed size, which
tells the tasks of the next level what to count. Fingerprints only prune: in a last
pass each task keeps with every fingerprint that the filters let through a pointer
to its first occurrence, compares all others with the text there, and only then
writes these phrases out with exact counts, so a collision can't merge two of
them. Pointers are followed where the text is: after the shuffle that would move every text again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stemma.llm.common import arrow_of, batch_of, letting_go, small_batches
from stemma.llm.shingles import mixed
from stemma.session import write_out

#: Bytes of text hashed at a time.
SLICE = 1 << 20
#: Bits of a filter (its size, whatever the corpus), and of the fingerprints that are counted for it (whole bytes).
BITS, PRINT_BITS = 26, 40
#: Ranges of fingerprints in which found phrases are added up, at least; as many as shuffle partitions if those are more.
LEAST_BUCKETS = 64
#: Fingerprints or phrases that a task gathers before it hands them on.
GATHERED = 1 << 21
_BASE = 0x9E6C63D0876A9A47
_FULL = (1 << 64) - 1
_BREAKS = b".,;:!?\n\x0b\x0c\r"
_KIND = np.zeros(256, np.uint8)
_KIND[list(b" \t")] = 1
_KIND[list(_BREAKS)] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_VALUE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n``."""
    size = 1 << max(20, n.bit_length())
    if size not in _POWERS:
        _POWERS.clear()
        both = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            found = np.ones(size, np.uint64)
            done = 1
            while done < size:
                found[done : 2 * done] = found[:done] * np.uint64(pow(base, done, 1 << 64))
                done *= 2
            both.append(found)
        _POWERS[size] = both[0], both[1]
    return _POWERS[size]


def salt(lang: str) -> int:
    """What sets the fingerprints of a language apart."""
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


class Chunk(NamedTuple):
    """Bytes of one text; its first ``known`` words were counted with the chunk before and only begin phrases."""

    lang: str
    raw: bytes
    known: int


def chunks(lang: str, raw: bytes, longest: int, size: int | None = None) -> Iterator[Chunk]:
    """A text, or parts of a long one that end at a separator and begin with the last words of the part before."""
    size = size or SLICE
    at, begin, known = 0, 0, 0
    while at < len(raw):
        end = min(at + size, len(raw))
        while end < len(raw):
            gap = np.flatnonzero(_KIND[np.frombuffer(raw[end : end + 4096], np.uint8)])
            if len(gap):
                end += int(gap[0])
                break
            end = min(end + 4096, len(raw))
        yield Chunk(lang, raw[begin:end], known)
        if end < len(raw):
            word = _KIND[np.frombuffer(raw[begin:end], np.uint8)] == 0
            starts = np.flatnonzero(np.diff(word, prepend=False) & word)
            known = min(longest - 1, len(starts))
            begin = begin + int(starts[len(starts) - known]) if known else end
        at = end


class Block(NamedTuple):
    """Phrases in ascending order of fingerprint; each one's bytes lie in ``text``, which has eight bytes more."""

    prints: np.ndarray
    langs: np.ndarray
    words: np.ndarray
    counts: np.ndarray
    text: np.ndarray
    start: np.ndarray
    sizes: np.ndarray


class Grams:
    """Words of some chunks, one after another, and the fingerprints of their n-grams."""

    def __init__(self, parts: list[Chunk]) -> None:
        raw = np.frombuffer(b"\n".join([*(p.raw for p in parts), b""]), np.uint8)
        kind = _KIND[raw]
        word = kind == 0
        edges = np.flatnonzero(np.diff(word, prepend=False, append=False))
        starts, ends = edges[0::2], edges[1::2]
        sizes = ends - starts
        piece = np.cumsum(kind == 2, dtype=np.int64)[starts]
        low = _LOWER[raw]
        low[ends] = 0x20
        word[ends] = True
        #: the words with one blank after each, and eight bytes more
        self.text = np.concatenate([low[word], np.zeros(8, np.uint8)])
        self.start = np.cumsum(sizes + 1) - sizes - 1
        self.end = self.start + sizes
        firsts = np.cumsum([0, *(len(p.raw) + 1 for p in parts)])[:-1]
        #: the chunk of each word
        self.chunk = np.searchsorted(firsts, starts, "right") - 1
        first_word = np.searchsorted(starts, firsts)
        self.fresh = np.arange(len(starts)) - first_word[self.chunk] >= np.array([p.known for p in parts])[self.chunk]
        self.piece = piece
        self.langs = np.array([salt(p.lang) for p in parts], np.uint64)[self.chunk]
        power, self.inverse = _powers(len(self.text))
        self.total = np.zeros(len(self.text) + 1, np.uint64)
        np.cumsum(_VALUE[self.text] * power[: len(self.text)], out=self.total[1:])

    def fingerprints(self, n: int) -> np.ndarray:
        """Of the ``n`` words from each word on; those that are no phrase have one too."""
        count = max(0, len(self.start) - n + 1)
        start, end = self.start[:count], self.end[n - 1 :][:count]
        return mixed((self.total[end] - self.total[start]) * self.inverse[start] + self.langs[:count])

    def phrases(self, n: int) -> np.ndarray:
        """Whether the ``n`` words from each word on stand in one piece and aren't all known."""
        count = max(0, len(self.start) - n + 1)
        return (self.piece[:count] == self.piece[n - 1 :][:count]) & self.fresh[n - 1 :][:count]

    def block(self, n: int, at: np.ndarray, times: np.ndarray) -> Block:
        """The phrases of ``n`` words at ``at``, each found ``times``."""
        return Block(self.fingerprints(n)[at], self.langs[at], np.full(len(at), n), times, self.text, self.start[at], self.end[at + n - 1] - self.start[at])


def _eights(text: np.ndarray) -> np.ndarray:
    """Eight bytes from each place of ``text`` on, which has eight bytes more than are used."""
    return np.ndarray(max(0, len(text) - 7), "<u8", text, strides=(1,))


def same_text(one: np.ndarray, start: np.ndarray, other: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether ``sizes`` bytes of ``one`` from ``start`` on equal those of ``other`` from ``first`` on, eight at a time."""
    equal = np.ones(len(start), bool)
    left, at, a, b = np.arange(len(start)), 0, _eights(one), _eights(other)
    while len(left):
        rest = sizes[left] - at
        mask = np.where(rest >= 8, np.uint64(_FULL), (np.uint64(1) << (np.minimum(rest, 7) * 8).astype(np.uint64)) - np.uint64(1))
        differ = (a[start[left] + at] ^ b[first[left] + at]) & mask != 0
        equal[left[differ]] = False
        at += 8
        left = left[~differ & (rest > 8)]
    return equal


def _gathered(batches: Iterable[pa.RecordBatch], longest: int) -> Iterator[tuple[list[Chunk], Grams]]:
    """Texts of a task in groups of about a slice."""
    group, size = [], 0
    for batch in batches:
        for lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            for chunk in chunks(lang, text.encode(), longest):
                if group and size + len(chunk.raw) > SLICE:
                    yield group, Grams(group)
                    group, size = [], 0
                group.append(chunk)
                size += len(chunk.raw) + 1
    if group:
        yield group, Grams(group)


def _in_filter(bits: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Whether a filter has the bits that the highest bits of fingerprints name."""
    at = (found >> np.uint64(64 - (len(bits) * 8).bit_length() + 1)).astype(np.int64)
    return bits[at >> 3] >> (at & 7).astype(np.uint8) & 1 == 1


def _added(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts of equal keys added up."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    at = np.flatnonzero(np.diff(keys, prepend=keys[:1] - np.uint64(1)))
    return keys[at], np.add.reduceat(counts, at) if len(at) else counts


_COUNTED = arrow_of("bucket long, prints binary, counts binary")
_BITS = arrow_of("bucket long, bits binary")
_FOUND = arrow_of("lang string, phrase string, words long, n long")


def _planes(numbers: np.ndarray, size: int) -> bytes:
    """The lowest ``size`` bytes of numbers, first all lowest ones and so on: sorted numbers compress well so."""
    return numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size].T.tobytes()


def _from_planes(raw: bytes, size: int) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8).reshape(size, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :size] = planes.T
    return out.view("<u8").ravel()


def _filter(docs: DataFrame, n: int, shorter, longest: int, least: int, bits: int, buckets: int):
    """A broadcast filter of the n-grams that occur ``least`` times and both of whose parts of one word less may do so.

    It has ``2**bits`` bits however many they are. Tasks count the highest ``PRINT_BITS`` bits of
    fingerprints and send them sorted, in ranges; a range's counts are added up where its bits are set. Fingerprints
    that agree in these bits can only let more through.
    """
    buckets = 1 << min(buckets.bit_length() - 1, bits - 3)
    shift = np.uint64(PRINT_BITS - buckets.bit_length() + 1)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letting_go()
        keys, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
        new, size = [], 0

        def handed() -> Iterator[pa.RecordBatch]:
            bounds = np.searchsorted(keys, np.arange(1, buckets, dtype=np.uint64) << shift).tolist()
            for bucket, (a, b) in enumerate(zip([0, *bounds], [*bounds, len(keys)], strict=True)):
                if b > a:
                    yield batch_of(_COUNTED, [bucket], [_planes(keys[a:b], PRINT_BITS // 8)], [_planes(np.minimum(counts[a:b], least), 4)])

        for _, grams in _gathered(batches, longest):
            wanted = grams.phrases(n)
            if n > 1:
                maybe = _in_filter(shorter.value, grams.fingerprints(n - 1))
                wanted &= maybe[:-1][: len(wanted)] & maybe[1:][: len(wanted)]
            new.append(grams.fingerprints(n)[wanted] >> np.uint64(64 - PRINT_BITS))
            size += len(new[-1])
            if size > GATHERED // 2:
                keys, counts = _added(np.concatenate([keys, *new]), np.concatenate([counts, np.ones(size, np.int64)]))
                new, size = [], 0
                if len(keys) > GATHERED:
                    yield from handed()
                    keys, counts = keys[:0], counts[:0]
        keys, counts = _added(np.concatenate([keys, *new]), np.concatenate([counts, np.ones(size, np.int64)]))
        yield from handed()

    def added(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letting_go()
        now, keys, counts, size = None, [], [], 0

        def own() -> Iterator[pa.RecordBatch]:
            if now is None:
                return
            found, n = _added(np.concatenate(keys), np.concatenate(counts))
            at = (found[n >= least] >> np.uint64(PRINT_BITS - bits)).astype(np.int64) - now * (1 << bits) // buckets
            on = np.zeros((1 << bits) // buckets, bool)
            on[at] = True
            yield batch_of(_BITS, [now], [np.packbits(on, bitorder="little").tobytes()])

        for batch in batches:
            for bucket, prints, times in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bucket != now:
                    yield from own()
                    now, keys, counts, size = bucket, [], [], 0
                keys.append(_from_planes(prints, PRINT_BITS // 8))
                counts.append(_from_planes(times, 4).astype(np.int64))
                size += len(keys[-1])
                if size > 2 * GATHERED:  # those of many tasks are added up as they come
                    key, n = _added(np.concatenate(keys), np.concatenate(counts))
                    keys, counts, size = [key], [n], 0
        yield from own()

    placed = docs.mapInArrow(run, "bucket long, prints binary, counts binary").repartition("bucket").sortWithinPartitions("bucket")
    whole = np.zeros((buckets, (1 << bits) // buckets // 8), np.uint8)
    for bucket, own in placed.mapInArrow(added, "bucket long, bits binary").toLocalIterator():  # at most 2**bits bits in all
        whole[bucket] = np.frombuffer(own, np.uint8)
    return docs.sparkSession.sparkContext.broadcast(whole.ravel())


def verified(grams: Grams, n: int, bits: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pointers to the first occurrence of each phrase of ``n`` words that a filter lets through, and how often its text occurs."""
    prints = grams.fingerprints(n)
    at = np.flatnonzero(grams.phrases(n) & _in_filter(bits, prints))
    while len(at):  # more than once only where fingerprints collide
        _, pointer, which, times = np.unique(prints[at], return_index=True, return_inverse=True, return_counts=True)
        start, sizes = grams.start[at], grams.end[at + n - 1] - grams.start[at]
        alike = (sizes == sizes[pointer][which]) & (grams.langs[at] == grams.langs[at][pointer][which])
        alike[alike] = same_text(grams.text, start[alike], grams.text, start[pointer][which][alike], sizes[alike])
        if not alike.all():
            times = np.bincount(which[alike], minlength=len(times))
        yield at[pointer], times
        at = at[~alike]


class Table:
    """Phrases that a task has found: fingerprint, count, and where each one's text lies among the texts kept."""

    def __init__(self) -> None:
        self.prints, self.langs = np.empty(0, np.uint64), np.empty(0, np.uint64)
        self.counts, self.words, self.start, self.sizes = (np.empty(0, np.int64) for _ in range(4))
        self.text, self.used = np.zeros(1 << 16, np.uint8), 0
        #: phrases whose fingerprint another one has: counts by fingerprint, language, words and text
        self.others: dict[tuple[int, int, int, bytes], int] = {}

    def add(self, block: Block) -> None:
        """Add the counts of phrases that differ in fingerprint."""
        place = np.searchsorted(self.prints, block.prints)
        known = np.zeros(len(block.prints), bool)
        inside = place < len(self.prints)
        known[inside] = self.prints[place[inside]] == block.prints[inside]
        alike = known.copy()
        there = place[known]
        alike[known] = (self.sizes[there] == block.sizes[known]) & (self.langs[there] == block.langs[known])
        there = place[alike]
        alike[alike] = same_text(block.text, block.start[alike], self.text, self.start[there], block.sizes[alike])
        self.counts[place[alike]] += block.counts[alike]
        for i in np.flatnonzero(known & ~alike).tolist():
            key = (int(block.prints[i]), int(block.langs[i]), int(block.words[i]), block.text[block.start[i] :][: block.sizes[i]].tobytes())
            self.others[key] = self.others.get(key, 0) + int(block.counts[i])
        new = ~known
        sizes, put = block.sizes[new], place[new]
        total = int(sizes.sum())
        while self.used + total + 8 > len(self.text):
            self.text = np.concatenate([self.text, np.zeros(len(self.text), np.uint8)])
        self.text[self.used : self.used + total] = _joined(block.text, block.start[new], sizes)
        starts = self.used + np.cumsum(sizes) - sizes
        self.used += total
        self.prints, self.langs = np.insert(self.prints, put, block.prints[new]), np.insert(self.langs, put, block.langs[new])
        self.counts, self.words = np.insert(self.counts, put, block.counts[new]), np.insert(self.words, put, block.words[new])
        self.start, self.sizes = np.insert(self.start, put, starts), np.insert(self.sizes, put, sizes)

    def blocks(self, names: dict[int, str], buckets: int) -> Iterator[pa.RecordBatch]:
        """All phrases as blocks, one for each range of fingerprints; those with a fingerprint of another come alone."""
        bounds = np.array([(b << 64) // buckets for b in range(buckets)], np.uint64)
        ends = [*np.searchsorted(self.prints, bounds[1:]).tolist(), len(self.prints)]
        for bucket, (a, b) in enumerate(zip([0, *ends[:-1]], ends, strict=True)):
            if b > a:
                part = slice(a, b)
                yield _row(names, bucket, Block(self.prints[part], self.langs[part], self.words[part], self.counts[part], self.text, self.start[part], self.sizes[part]))
        for (print_, lang, words, phrase), n in self.others.items():
            text = np.frombuffer(phrase + bytes(8), np.uint8)
            yield _row(names, int(np.searchsorted(bounds, np.uint64(print_), "right")) - 1, Block(np.array([print_], np.uint64), np.array([lang], np.uint64), *(np.array([x], np.int64) for x in (words, n)), text, *(np.array([x], np.int64) for x in (0, len(phrase)))))

    def rows(self, names: dict[int, str], least: int) -> Iterator[pa.RecordBatch]:
        """``lang, phrase, words, n`` of the phrases that occur ``least`` times, and of those of no words."""
        wanted = np.flatnonzero((self.counts >= least) | (self.words == 0))
        for i in range(0, len(wanted), 1 << 15):
            at = wanted[i : i + (1 << 15)]
            texts = [self.text[a : a + n].tobytes().decode() for a, n in zip(self.start[at].tolist(), self.sizes[at].tolist(), strict=True)]
            yield batch_of(_FOUND, [names[x] for x in self.langs[at].tolist()], texts, self.words[at], self.counts[at])
        others = [(names[lang], phrase.decode(), words, n) for (_, lang, words, phrase), n in self.others.items() if n >= least]
        if others:
            yield batch_of(_FOUND, *zip(*others, strict=True))


def _joined(text: np.ndarray, start: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Pieces of ``text`` one after another."""
    total = int(sizes.sum())
    return text[np.repeat(start - np.cumsum(sizes) + sizes, sizes) + np.arange(total)]


_BLOCK = "bucket long, names array<string>, prints binary, langs binary, words binary, counts binary, sizes binary, text binary"
_BLOCKS = pa.schema([("bucket", pa.int64()), ("names", pa.list_(pa.string())), *((n, pa.binary()) for n in ("prints", "langs", "words", "counts", "sizes", "text"))])


def _row(names: dict[int, str], bucket: int, block: Block) -> pa.RecordBatch:
    own = [names[x] for x in np.unique(block.langs).tolist()]
    arrays = (block.prints, block.langs, block.words.astype(np.uint8), block.counts, block.sizes.astype("<u4"), _joined(block.text, block.start, block.sizes))
    return batch_of(_BLOCKS, [bucket], [own], *([x.tobytes()] for x in arrays))


def _block(prints: bytes, langs: bytes, words: bytes, counts: bytes, sizes: bytes, text: bytes) -> Block:
    size = np.frombuffer(sizes, "<u4").astype(np.int64)
    return Block(np.frombuffer(prints, "<u8"), np.frombuffer(langs, "<u8"), np.frombuffer(words, np.uint8), np.frombuffer(counts, "<i8"), np.frombuffer(text + bytes(8), np.uint8), np.cumsum(size) - size, size)


def _exact(docs: DataFrame, filters: list, longest: int, least: int, buckets: int) -> DataFrame:
    """``lang, phrase, words, n``: phrases that the filters let through and that occur ``least`` times.

    Each task hands its phrases on in blocks by range of fingerprints; blocks of one range are added up
    as they come, so a task holds each of the range's phrases once. All words of a language are
    counted under a phrase of no words.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letting_go()
        table, names, total = Table(), {}, {}
        for group, grams in _gathered(batches, longest):
            names |= {salt(c.lang): c.lang for c in group}
            for chunk, n in zip(group, np.bincount(grams.chunk[grams.fresh], minlength=len(group)).tolist(), strict=True):
                total[salt(chunk.lang)] = total.get(salt(chunk.lang), 0) + n
            for n, bits in enumerate(filters, 1):
                for at, times in verified(grams, n, bits.value):
                    table.add(grams.block(n, at, times))
            if len(table.prints) + len(table.others) > GATHERED:
                yield from table.blocks(names, buckets)
                table = Table()
        yield from table.blocks(names, buckets)
        for lang, n in total.items():  # a language's words lie in a bucket of their own choice
            none = np.zeros(1, np.int64)
            yield _row(names, lang * buckets >> 64, Block(np.array([lang], np.uint64), np.array([lang], np.uint64), none, np.array([n]), np.zeros(8, np.uint8), none, none))

    def added(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letting_go()
        now, table, names = None, Table(), {}
        for batch in batches:
            for bucket, own, *arrays in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bucket != now:
                    yield from table.rows(names, least)
                    now, table, names = bucket, Table(), {}
                names |= {salt(x): x for x in own}
                table.add(_block(*arrays))
        yield from table.rows(names, least)

    blocks = docs.mapInArrow(run, _BLOCK).repartition("bucket").sortWithinPartitions("bucket")
    return blocks.mapInArrow(added, "lang string, phrase string, words long, n long")


def frequent(docs: DataFrame, longest: int = 4, least: int = 30, bits: int = BITS) -> DataFrame:
    """``lang, phrase, words, n``: every phrase of up to ``longest`` words that occurs ``least`` times in its language, written once.

    The row of no words counts all words of the language. Null texts are empty, null languages ``und``.
    """
    small_batches(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col("lang"), F.lit("und")).alias("lang"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    buckets = max(LEAST_BUCKETS, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    filters: list = []
    for n in range(1, longest + 1):
        filters.append(_filter(texts, n, filters[-1] if filters else None, longest, least, bits, buckets))
    return write_out(_exact(texts, filters, longest, least, buckets), "phrases")


def collocations(docs: DataFrame, longest: int = 4, least: int = 30, share: int = 80, top: int = 2000, bits: int = BITS) -> DataFrame:
    """The ``top`` phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    A phrase of two words or more that occurs ``a >= least`` times is cut in two where
    ``floor(2000000 a / (l + r))`` is least, ``l`` and ``r`` being how often its
    parts occur (of equal scores the first cut counts). It is dropped when its words stand inside a longer
    phrase that occurs at least ``share`` per cent as often. Ties in score are ranked by
    ``a``, then by the phrase's bytes. ``n`` counts all words of the language. Equal documents count each.
    Without a frequent phrase, or without documents, there is no row.
    """
    table = frequent(docs, longest, least, bits)
    counts = table.where("words > 0").select("lang", "phrase", F.col("words").cast("int").alias("words"), F.col("n").alias("a"))
    words = F.split("phrase", " ")
    part = lambda first, n: F.array_join(F.slice(words, first, n), " ")
    cuts = counts.where("words > 1").withColumn("k", F.explode(F.expr("sequence(1, words - 1)")))
    cuts = cuts.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, F.col("words")).alias("right"))
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("left"), F.col("a").alias("l")), ["lang", "left"])
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("right"), F.col("a").alias("r")), ["lang", "right"])
    cuts = cuts.withColumn("score", F.expr("cast(cast(a as decimal(20,0)) * cast(2000000 as decimal(7,0)) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0))) as long)"))
    best = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    spans = F.expr("flatten(transform(sequence(2, words - 1), n -> transform(sequence(1, words - n + 1), i -> array_join(slice(split(phrase, ' '), i, n), ' '))))")
    inside = counts.where("words > 2").select("lang", "a", F.explode(F.array_distinct(spans)).alias("phrase")).groupBy("lang", "phrase").agg(F.max("a").alias("above"))
    kept = best.join(inside, ["lang", "phrase"], "left").where(F.col("above").isNull() | (F.lit(100).cast("decimal(3,0)") * F.col("above").cast("decimal(20,0)") < F.lit(share).cast("decimal(3,0)") * F.col("a").cast("decimal(20,0)")))
    rows = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    totals = table.where("words = 0").select("lang", "n")
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
