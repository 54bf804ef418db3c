"""Token ids as canonical length-limited Huffman codes in independently readable blocks.

A file set has two tables below its path. ``codebook`` (id, n, length) gives each
id's code length; codes are canonical, so lengths say all. ``blocks`` has a row
per block: ``part`` and ``seq`` order the blocks, ``before`` counts the part's ids
before the block, ``doc_ids`` and ``sizes`` list its documents, ``bits`` holds the
codes (first bit highest) and ``marks`` the bit offset of every ``STEP``-th code.
A block is decoded without any other, all its stretches between marks at a time.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stemma.llm.common import arrow_of, batch_of, letting_go, rows_of, small_batches
from stemma.llm.word_ids import as_array

#: Longest code in bits. A vocabulary of more than 2**LIMIT used ids is refused.
LIMIT = 16
#: Ids from which a block is closed, and ids between two marks.
BLOCK, STEP = 1 << 18, 128
_COUNTS = arrow_of("id long, n long")
_BLOCKS = arrow_of("part int, seq long, before long, doc_ids array<long>, sizes array<long>, bits binary, marks binary")
_READ = arrow_of("doc_id long, start long, ids binary")


def code_lengths(weights: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits for positive weights, by package-merge."""
    n = len(weights)
    if n > 1 << limit:
        raise ValueError(f"{n} symbols don't fit codes of {limit} bits")
    if n < 2:
        return np.ones(n, dtype=np.int64)
    order = np.argsort(weights, kind="stable")
    leaves = weights[order].astype(np.int64)
    row, rows = leaves, []
    for _ in range(limit - 1):
        packages = row[: len(row) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([leaves, packages])
        at = np.argsort(both, kind="stable")
        rows.append(at < n)
        row = both[at]
    lengths, take = np.zeros(n, dtype=np.int64), 2 * n - 2
    for is_leaf in reversed(rows):
        own = int(is_leaf[:take].sum())
        lengths[:own] += 1
        take = 2 * (take - own)
    lengths[:take] += 1
    out = np.empty(n, dtype=np.int64)
    out[order] = lengths
    return out


class Codes:
    """Canonical codes from ids and lengths: for encoding by id, for decoding by the next ``limit`` bits."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, limit: int = LIMIT) -> None:
        order = np.lexsort((ids, lengths))
        ids, lengths = ids[order], lengths[order]
        spans = 1 << (limit - lengths)
        first = np.cumsum(spans) - spans
        size = int(ids.max()) + 1 if len(ids) else 0
        self.limit, self.lengths, self.codes = limit, np.zeros(size, np.int64), np.zeros(size, np.uint64)
        self.lengths[ids], self.codes[ids] = lengths, (first >> (limit - lengths)).astype(np.uint64)
        self.next_id, self.next_length = np.zeros(1 << limit, np.uint32), np.ones(1 << limit, np.int64)
        used = int(spans.sum())
        self.next_id[:used], self.next_length[:used] = np.repeat(ids, spans), np.repeat(lengths, spans)

    def encode(self, ids: np.ndarray) -> tuple[bytes, bytes]:
        """The codes' bits, and the bit offset of every ``STEP``-th."""
        if not len(ids):
            return b"", b""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        starts = ends - lengths
        wide = self.codes[ids] << (64 - (starts & 31) - lengths).astype(np.uint64)
        word = starts >> 5
        cut = np.flatnonzero(np.diff(word, prepend=-1))
        out = np.zeros(int(ends[-1] >> 5) + 3, np.uint64)
        out[word[cut]] += np.add.reduceat(wide >> np.uint64(32), cut)
        out[word[cut] + 1] += np.add.reduceat(wide & np.uint64(0xFFFFFFFF), cut)
        return out.astype(">u4").tobytes()[: (int(ends[-1]) + 7) // 8], starts[::STEP].astype("<u4").tobytes()

    def decode(self, bits: bytes, marks: bytes, n: int) -> np.ndarray:
        """The first ``n`` ids; all stretches between marks advance together, an id each a step."""
        at = np.frombuffer(marks, "<u4").astype(np.int64)
        b = np.frombuffer(bits + bytes(4), np.uint8).astype(np.uint32)
        three = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
        out, last = np.empty((STEP, len(at)), np.uint32), len(three) - 1
        mask, top = (1 << self.limit) - 1, 24 - self.limit
        for k in range(STEP):
            window = (three[np.minimum(at >> 3, last)] >> (top - (at & 7)).astype(np.uint32)) & mask
            out[k] = self.next_id[window]
            at += self.next_length[window]
        return out.T.reshape(-1)[:n]


def count_ids(ids: DataFrame) -> DataFrame:
    """``id``, ``n``: how often each id occurs in all rows; each task sends a row per id at most."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letting_go()  # what the encoder remembers
        total = np.zeros(1, np.int64)
        for found, widths in rows_of(batches, "ids", "width"):
            for width in set(widths):
                new = np.bincount(as_array(b"".join(x for x, w in zip(found, widths, strict=True) if w == width), width))
                low, high = sorted((total, new), key=len)
                total = high.astype(np.int64)
                total[: len(low)] += low
        at = np.flatnonzero(total)
        yield batch_of(_COUNTS, at, total[at])

    return ids.select("ids", "width").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write(ids: DataFrame, path: str, limit: int = LIMIT, block: int = BLOCK) -> None:
    """Write ``ids(doc_id, width, ids)`` below ``path`` in ascending ``doc_id`` order (nulls first).

    The codebook comes from counts over all rows; it has one row per used id, at
    most ``2**limit``, and is the only thing that is collected. An empty table
    gives empty tables. Blocks hold whole documents.
    """
    spark = ids.sparkSession
    small_batches(spark)
    counted = sorted(count_ids(ids).collect())
    symbols, weights = (np.array([r[i] for r in counted], dtype=np.int64) for i in (0, 1))
    lengths = code_lengths(weights, limit)
    spark.createDataFrame([(int(i), int(n), int(k)) for i, n, k in zip(symbols, weights, lengths, strict=True)], "id long, n long, length int").coalesce(1).write.parquet(f"{path}/codebook")
    book = spark.sparkContext.broadcast((symbols, lengths))

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letting_go()
        codes, part = Codes(*book.value, limit), TaskContext.get().partitionId()
        docs, held, size, seq, before = [], [], 0, 0, 0

        def close() -> pa.RecordBatch:
            bits, marks = codes.encode(np.concatenate(held))
            return batch_of(_BLOCKS, [part], [seq], [before], [docs], [[len(x) for x in held]], [bits], [marks])

        for doc_ids, found, widths in rows_of(batches, "doc_id", "ids", "width"):
            for doc, x, width in zip(doc_ids, found, widths, strict=True):
                docs.append(doc)
                held.append(as_array(x, width))
                size += len(held[-1])
                if size >= block:
                    yield close()
                    docs, held, seq, before, size = [], [], seq + 1, before + size, 0
        if docs:
            yield close()

    ordered = ids.select("doc_id", "ids", "width").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "ids")
    ordered.mapInArrow(encode, "part int, seq long, before long, doc_ids array<long>, sizes array<long>, bits binary, marks binary").write.parquet(f"{path}/blocks")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it) and ``ids`` (32-bit, little-endian) from the files.

    What each part holds is summed from its last block, one small row per part;
    the running total over parts is the only thing made on the driver.
    """
    small_batches(spark)
    book = spark.read.parquet(f"{path}/codebook").select("id", "length").collect()
    blocks = spark.read.parquet(f"{path}/blocks")
    totals = sorted(blocks.groupBy("part").agg(F.max(F.col("before") + F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).collect())
    before = dict(zip([p for p, _ in totals], np.cumsum([0, *(n for _, n in totals)]).tolist(), strict=False))
    shared = spark.sparkContext.broadcast((np.array([r[0] for r in book], np.int64), np.array([r[1] for r in book], np.int64), before))

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letting_go()
        ids, lengths, offsets = shared.value
        codes = Codes(ids, lengths, max(LIMIT, int(lengths.max(initial=0))))
        for rows in rows_of(batches, *_BLOCKS.names):
            for part, _, first, docs, sizes, bits, marks in zip(*rows, strict=True):
                found = codes.decode(bits, marks, sum(sizes))
                ends = np.cumsum(sizes)
                starts = ends - sizes
                yield batch_of(_READ, docs, starts + offsets[part] + first, [found[a:b].astype("<u4").tobytes() for a, b in zip(starts, ends, strict=True)])

    return blocks.mapInArrow(decode, "doc_id long, start long, ids binary")
