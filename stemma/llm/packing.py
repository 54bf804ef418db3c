"""Packing token ids into sequences of a fixed capacity by minimum bin slack.

Every document is cut into full pieces, each a sequence of its own, and one
remainder. Remainders are dealt into windows; a window keeps how many remainders
it has of each length, and fills one sequence after another: the longest left is
set, and a bitset dynamic programme over the lengths finds the multiset whose sum
comes closest to the room left, backtracked to counts. The same filling is
repeated as often as the counts allow.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stemma.llm.common import arrow_of, batch_of, letting_go, rows_of, small_batches
from stemma.session import write_out

CAPACITY = 2048
#: Remainders of a window, on average; their number grows with the documents, not the windows' size.
WINDOW = 1 << 14
_PIECES = "row_id long, start long, length long, sequence_id long, offset long"
_FULL = arrow_of("row_id long, start long, length long, offset long")
_CUT = arrow_of("doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def fill(counts: dict[int, int], capacity: int = CAPACITY) -> Iterator[tuple[dict[int, int], int]]:
    """Fillings ``{length: how many}`` with the times each is used, until ``counts`` is used up.

    Each filling holds the longest length left and, beside it, a multiset whose
    sum is as near to the room left as any. Lengths run from 1 to ``capacity``.
    """
    counts = {k: n for k, n in counts.items() if n}
    order = sorted(counts, reverse=True)
    while counts:
        order = [k for k in order if k in counts]
        for seed in order:
            while seed in counts:
                used = _beside(counts, order, seed, capacity - seed)
                used[seed] = used.get(seed, 0) + 1
                times = min(counts[k] // n for k, n in used.items())
                for k, n in used.items():
                    counts[k] -= n * times
                    if not counts[k]:
                        del counts[k]
                yield used, times


def _beside(counts: dict[int, int], order: list[int], seed: int, room: int) -> dict[int, int]:
    """The multiset, besides one ``seed``, with the largest sum that fits ``room``."""
    reach, mask, steps = 1, (1 << (room + 1)) - 1, []
    for k in order[_first_below(order, room) :]:
        n = min(counts.get(k, 0) - (k == seed), room // k)
        chunk = 1
        while n > 0:  # binary splitting of n copies
            chunk = min(chunk, n)
            steps.append((k, chunk, reach))
            reach |= (reach << (k * chunk)) & mask
            n, chunk = n - chunk, chunk * 2
        if reach >> room:
            break
    used, total = {}, reach.bit_length() - 1
    for k, chunk, earlier in reversed(steps):
        if not earlier >> total & 1:
            used[k] = used.get(k, 0) + chunk
            total -= k * chunk
    return used


def _first_below(order: list[int], room: int) -> int:
    low, high = 0, len(order)
    while low < high:
        mid = (low + high) // 2
        low, high = (mid + 1, high) if order[mid] > room else (low, mid)
    return low


def pack_window(rows: list[int], lengths: list[int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """``(row, start in the remainder, length, sequence, offset)`` of a window's remainders.

    Sequences left short at the end are laid end to end and cut anew into full
    sequences and sequences whose sizes are powers of two, so nothing is padded.
    """
    stacks: dict[int, list[int]] = {}
    for row, k in sorted(zip(rows, lengths, strict=True), reverse=True):
        stacks.setdefault(k, []).append(row)
    out, short, seq = [], [], 0
    for used, times in fill({k: len(v) for k, v in stacks.items()}, capacity):
        size = sum(k * n for k, n in used.items())
        for _ in range(times):
            taken = [(stacks[k].pop(), k) for k, n in used.items() for _ in range(n)]
            if size < capacity:
                short += taken
                continue
            at = 0
            for row, k in taken:
                out.append((row, 0, k, seq, at))
                at += k
            seq += 1
    left, at, room = sum(k for _, k in short), 0, 0
    for row, k in short:
        begun = 0
        while begun < k:
            if not room:
                room = capacity if left >= capacity else 1 << (left.bit_length() - 1)
                at, seq, size = 0, seq + 1, room
            n = min(room, k - begun)
            out.append((row, begun, n, seq - 1, at))
            begun, at, room, left = begun + n, at + n, room - n, left - n
    return out


def plan(ids: DataFrame, capacity: int = CAPACITY, window: int = WINDOW) -> DataFrame:
    """Pieces ``row_id, start, length, sequence_id, offset`` of ``ids(row_id, n_tokens)``, written once.

    Rows without ids give no piece. Sequence ids of full pieces are odd, those of
    windows even; they are unique, not consecutive.
    """

    def full(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letting_go()  # what the encoder remembers
        for rows, sizes in rows_of(batches, "row_id", "n_tokens"):
            n = np.array(sizes, np.int64) // capacity
            rank = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            yield batch_of(_FULL, np.repeat(np.array(rows, np.int64), n), rank * capacity, np.full(len(rank), capacity), np.zeros(len(rank), np.int64))

    def packed(key, rows: pd.DataFrame) -> pd.DataFrame:
        letting_go()
        base = dict(zip(rows["row_id"], rows["base"], strict=True))
        found = pack_window(rows["row_id"].tolist(), rows["length"].tolist(), capacity)
        return pd.DataFrame([(r, base[r] + a, n, 2 * ((int(key[0]) << 31) + s), at) for r, a, n, s, at in found], columns=["row_id", "start", "length", "sequence_id", "offset"], dtype="int64")

    rows = ids.count()
    windows = max(1, -(-rows // window))
    short = ids.where(F.col("n_tokens") % capacity > 0).select("row_id", (F.col("n_tokens") % capacity).alias("length"), (F.col("n_tokens") - F.col("n_tokens") % capacity).alias("base"), F.pmod(F.xxhash64("row_id"), F.lit(windows)).alias("window"))
    # numbered while they are written, so the numbers are fixed from then on
    alone = ids.select("row_id", "n_tokens").mapInArrow(full, "row_id long, start long, length long, offset long").withColumn("sequence_id", 2 * F.monotonically_increasing_id() + 1)
    return write_out(alone.unionByName(short.groupBy("window").applyInPandas(packed, _PIECES)), "pieces")


def pack(ids: DataFrame, capacity: int = CAPACITY, window: int = WINDOW) -> DataFrame:
    """Pieces with their ids: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``.

    ``ids(row_id, doc_id, width, ids)`` comes from ``token_ids``. Each id lies in
    exactly one piece; pieces of a sequence leave no gap. ``ids`` is 32-bit,
    little-endian. Null and repeated ``doc_id`` stay separate documents.
    """
    small_batches(ids.sparkSession)
    sized = ids.select("row_id", (F.length("ids") / F.col("width")).cast("long").alias("n_tokens"))
    pieces = plan(sized, capacity, window)
    cuts = pieces.groupBy("row_id").agg(F.array_sort(F.collect_list(F.struct("start", "length", "sequence_id", "offset"))).alias("cuts"))

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letting_go()
        for docs, found, widths, all_cuts in rows_of(batches, "doc_id", "ids", "width", "cuts"):
            out = []
            for doc, x, width, own in zip(docs, found, widths, all_cuts, strict=True):
                wide = np.frombuffer(x, f"<u{width}").astype("<u4")
                out += [(doc, c["start"], c["length"], wide[c["start"] : c["start"] + c["length"]].tobytes(), len(wide), c["sequence_id"], c["offset"]) for c in own]
            if out:
                yield batch_of(_CUT, *zip(*out, strict=True))

    return ids.join(cuts, "row_id").select("doc_id", "ids", "width", "cuts").mapInArrow(cut, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
