"""Document fingerprints: one-permutation MinHash with optimal densification, low bits kept.

Each shingle hash falls into one of ``BINS`` bins by its top bits, and a bin keeps
the least of the rest. An empty bin takes the value of another, found by a fixed
sequence of bins of its own, so sets that agree there agree here too. ``BITS`` low
bits of each bin are packed; of two fingerprints, bins that differ agree by chance
once in ``2**BITS``, which the likeness takes off.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stemma.llm import shingles
from stemma.llm.common import arrow_of, batch_of, rows_of, texts
from stemma.session import write_out

#: Bins (a power of two) and bits kept of each (4 or 8).
BINS, BITS = 256, 4
#: Bins tried in place of an empty one; beyond these the rest is searched in order.
TRIES = 64
_ROWS = "part int, kind int, doc_id long, n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double, text string"
_SCHEMA = arrow_of(_ROWS)
_DONE, _FIRST, _LAST = 0, 1, 2


def _detours() -> np.ndarray:
    """For each bin the bins that stand in for it, one after another."""
    k, t = np.meshgrid(np.arange(BINS, dtype=np.uint64), np.arange(1, TRIES + 1, dtype=np.uint64), indexing="ij")
    drawn = (shingles.mixed(k * np.uint64(0x9E3779B97F4A7C15) + t * np.uint64(0xC2B2AE3D27D4EB4F)) % np.uint64(BINS)).astype(np.int64)
    return np.concatenate([drawn, (np.arange(BINS)[:, None] + np.arange(BINS)) % BINS], axis=1)


_DETOURS = _detours()
_SALTS = np.arange(BINS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def fingerprint(own: np.ndarray) -> np.ndarray | None:
    """The low bits of each bin for a sorted set of 64-bit hashes; None for the empty set."""
    if not len(own):
        return None
    own = np.sort(shingles.mixed(own))
    shift = np.uint64(64 - BINS.bit_length() + 1)
    at = (own >> shift).astype(np.int64)
    first = np.flatnonzero(np.diff(at, prepend=-1))  # the least of a bin comes first
    values = np.zeros(BINS, np.uint64)
    values[at[first]] = own[first]
    if len(first) < BINS:
        full = np.zeros(BINS, bool)
        full[at[first]] = True
        empty = np.flatnonzero(~full)
        taken = _DETOURS[empty, np.argmax(full[_DETOURS[empty]], axis=1)]
        values[empty] = values[taken]
    # mixed with the bin's number, so where one value fills many bins, low bits of unlike values still agree by chance in each
    return (shingles.mixed(values + _SALTS) & np.uint64((1 << BITS) - 1)).astype(np.uint8)


def packed(bins: np.ndarray | None) -> bytes:
    """A fingerprint's bytes; none for the empty set."""
    if bins is None:
        return b""
    return (bins if BITS == 8 else bins[0::2] << 4 | bins[1::2]).tobytes()


def likeness(a: np.ndarray | None, b: np.ndarray | None) -> float:
    """Estimated Jaccard similarity, 0 to 1; two empty sets are alike, an empty and another are not."""
    if a is None or b is None:
        return float(a is b)
    chance = 0.5**BITS
    return max(0.0, (float(np.mean(a == b)) - chance) / (1 - chance))


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint`` of every row; null texts count as empty."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_of("doc_id long, fingerprint string")
        for ids, bodies in rows_of(batches, "doc_id", "text"):
            yield batch_of(schema, ids, [packed(fingerprint(x)).hex() for x in shingles.sets(bodies)])

    return texts(docs).mapInArrow(run, "doc_id long, fingerprint string")


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as much of what follows, or all of it."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Each document beside its edited text and the next document, by ``doc_id`` (nulls first, then by text).

    Returns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next``. Documents are placed by range and stream through in
    order; only the first and last text of each part are held over and meet the
    neighbouring parts' in a small join. After the last comes the first. Null texts
    count as empty; repeated rows are documents of their own; a single row follows
    itself; an empty table gives none.
    """

    def work(docs: list, bodies: list[str], following: list[str], sets: list) -> pa.RecordBatch:
        """Rows for texts and what follows each; ``sets`` has one more than the texts."""
        changed = [edited(a, b) for a, b in zip(bodies, following, strict=True)]
        prints, others = [fingerprint(x) for x in sets], [fingerprint(x) for x in shingles.sets(changed)]
        n, none = len(docs), [None] * len(docs)
        near = [likeness(a, b) for a, b in zip(prints, others, strict=False)], [likeness(a, b) for a, b in zip(prints, prints[1:], strict=False)]
        return batch_of(_SCHEMA, none, [_DONE] * n, docs, [len(x) for x in bodies], [hashlib.sha256(x.encode()).digest() for x in changed], [packed(x) for x in prints[:n]], [packed(x) for x in others], *near, none)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = TaskContext.get().partitionId(), None
        edge = lambda kind, doc, text: batch_of(_SCHEMA, [part], [kind], [doc], *[[None]] * 6, [text])
        for ids, bodies in rows_of(batches, "doc_id", "text"):
            for at in range(0, len(ids), 200):
                docs, here = ids[at : at + 200], bodies[at : at + 200]
                if held is None:
                    yield edge(_FIRST, docs[0], here[0])
                else:
                    docs, here = [held[0], *docs], [held[1], *here]
                if len(docs) > 1:
                    yield work(docs[:-1], here[:-1], here[1:], shingles.sets(here))
                held = docs[-1], here[-1]
        if held is not None:
            yield edge(_LAST, *held)

    def meet(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, bodies, following in rows_of(batches, "doc_id", "text", "following"):
            for doc, a, b in zip(ids, bodies, following, strict=True):
                yield work([doc], [a], [b], shingles.sets([a, b]))

    ordered = texts(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    rows = write_out(ordered.mapInArrow(run, _ROWS), "fingerprints")
    # parts that hold rows, in order: a number each, no more than there are tasks
    parts = sorted(r[0] for r in rows.where(F.col("kind") == _FIRST).select("part").collect())
    after = docs.sparkSession.createDataFrame([(a, b) for a, b in zip(parts, [*parts[1:], *parts[:1]], strict=True)], "part int, next_part int")
    first = rows.where(F.col("kind") == _FIRST).select(F.col("part").alias("next_part"), F.col("text").alias("following"))
    last = rows.where(F.col("kind") == _LAST).select("part", "doc_id", "text").join(F.broadcast(after), "part").join(first, "next_part")
    columns = [F.lower(F.hex(c)).alias(c) if c.endswith(("sha256", "fingerprint")) else c for c in _SCHEMA.names[2:-1]]
    joined = last.select("doc_id", "text", "following").mapInArrow(meet, _ROWS)
    return rows.where(F.col("kind") == _DONE).select(columns).unionByName(joined.select(columns))
