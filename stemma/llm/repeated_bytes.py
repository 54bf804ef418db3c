"""Removal of every byte that a repeated string of ``LENGTH`` bytes covers.

Each string of ``LENGTH`` bytes has an anchor: the place of the least hash of
``GRAM`` bytes in it. Equal strings have equal anchors at equal places, so only
strings whose anchors' bytes occur more than once can repeat. Around such anchors
the bytes go to one task per anchor; there the strings that start at anchors are
sorted to both sides by deep-shallow sorting, and strings whose two sides agree as
far as they reach repeat. Texts that occur more than once take part once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stemma.llm.common import annotate, arrow_of, batch_of, letting_go, rows_of, small_batches
from stemma.llm.deep_sort import sort
from stemma.llm.shingles import _places, mixed
from stemma.session import write_out

LENGTH, GRAM = 200, 32
#: Bytes searched for anchors at a time.
SLICE = 1 << 20
#: Anchors that a task compares with each other before it sends them on, and that it solves together.
CHUNK, TOGETHER = 200_000, 20_000
#: An anchor that more texts have than this is not taken to one task; its strings are compared by hash instead.
HOT = 20_000
_ANCHORS_COLUMNS = "spot long, anchor long, sure boolean, key binary, doc_id long, at int, low int, high int"
_ANCHORS = arrow_of(_ANCHORS_COLUMNS)
_AROUND_COLUMNS = "spot long, kind int, key binary, at int, low int, high int, body binary"
_AROUND = arrow_of(_AROUND_COLUMNS)
_COVERED_COLUMNS = "key binary, low long, high long"
_COVERED = arrow_of(_COVERED_COLUMNS)
_BYTES, _HASHES, _DONE = 0, 1, 2
#: Bytes have their own values here, capitals unlike small letters.
_OWN = mixed(np.arange(256, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(5))


def _gram_hashes(raw: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` bytes from each place on."""
    power, inverse = _places(len(raw) + 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_OWN[raw] * power[: len(raw)], out=total[1:])
    return mixed((total[size:] - total[:-size]) * inverse[: len(raw) - size + 1])


def anchors(raw: np.ndarray, size: int = SLICE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(hash, at, low, high)``: the strings that start from ``low`` to ``high`` have their anchor at ``at``."""
    found = []
    for begin in range(0, max(0, len(raw) - LENGTH + 1), size):
        part = raw[begin : begin + size + LENGTH - 1]
        hashes = _gram_hashes(part, GRAM)
        least = (hashes & ~np.uint64((1 << 24) - 1)) | np.arange(len(hashes), dtype=np.uint64)  # ties: the first
        width, reach = LENGTH - GRAM + 1, 1
        while 2 * reach <= width:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        rest = width - reach
        least = np.minimum(least[: len(least) - rest], least[rest:])
        at = (least & np.uint64((1 << 24) - 1)).astype(np.int64)
        low = np.flatnonzero(np.diff(at, prepend=-1))
        high = np.append(low[1:], len(at)) - 1
        found.append((hashes[at[low]], at[low] + begin, low + begin, high + begin))
    if not found:
        return (np.empty(0, np.uint64), *[np.empty(0, np.int64)] * 3)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def solve(groups: np.ndarray, at: np.ndarray, low: np.ndarray, high: np.ndarray, bodies: list[bytes]) -> list[tuple[int, int, int]]:
    """``(member, first, last)``: runs of string starts of a member that some other member of its group has too.

    ``bodies[i]`` holds the bytes from ``low[i]`` to ``high[i] + LENGTH``.
    """
    reach = (at - low).tolist()
    right, right_shared = sort([b[r:] for b, r in zip(bodies, reach, strict=True)], groups, LENGTH)
    left, left_shared = sort([b[:r][::-1] for b, r in zip(bodies, reach, strict=True)], groups, LENGTH - GRAM)
    nearest, farthest = at - high, at - low  # how far before its anchor a string of the member may start
    members, starts = [], []
    for before in range(int(nearest.min()), int(farthest.max()) + 1):
        own = np.flatnonzero((nearest <= before) & (before <= farthest))
        if len(own) < 2:
            continue
        side = np.empty((2, len(at)), np.int64)
        side[0, right] = np.cumsum(right_shared < LENGTH - before)
        side[1, left] = np.cumsum(left_shared < before)
        both = side[0, own] * (len(at) + 1) + side[1, own]
        order = np.argsort(both, kind="stable")
        same = both[order][1:] == both[order][:-1]
        hit = own[order[np.append(same, False) | np.append(False, same)]]
        members.append(hit)
        starts.append(at[hit] - before)
    if not members:
        return []
    return _runs(np.concatenate(members), np.concatenate(starts))


def _runs(members: np.ndarray, starts: np.ndarray) -> list[tuple[int, int, int]]:
    if not len(members):
        return []
    order = np.lexsort((starts, members))
    members, starts = members[order], starts[order]
    new = np.flatnonzero(np.concatenate([[True], (np.diff(members) != 0) | (np.diff(starts) > 1)]))
    return list(zip(members[new].tolist(), starts[new].tolist(), starts[np.append(new[1:], len(starts)) - 1].tolist(), strict=True))


def _keyed(docs: DataFrame) -> DataFrame:
    small_batches(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.unhex(F.md5(text.cast("binary"))).alias("key"))


def _repeated_anchors(keyed: DataFrame) -> DataFrame:
    """``anchor, key, doc_id, at, low, high`` of anchors whose bytes occur more than once.

    Where a task finds an anchor twice, all but one go straight on, so an anchor
    that very many texts have reaches its place from each task once.
    """

    def listed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letting_go()
        held, names, size, seen = [], [], 0, set()

        def close() -> pa.RecordBatch:
            hashes, at, low, high = (np.concatenate(x) for x in zip(*held, strict=True))
            owner = np.repeat(np.arange(len(names)), [len(x[0]) for x in held])
            order = np.argsort(hashes, kind="stable")
            hashes, at, low, high, owner = (x[order] for x in (hashes, at, low, high, owner))
            first = np.diff(hashes, prepend=hashes[:1] ^ np.uint64(1)) != 0
            many = ~first | np.append(~first[1:], False)
            spot = np.where(first, hashes, mixed(hashes + mixed(owner.astype(np.uint64) + at.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))))
            keys, ids = zip(*names, strict=True)
            owner = owner.tolist()
            return batch_of(_ANCHORS, spot.view(np.int64), hashes.view(np.int64), many, [keys[i] for i in owner], [ids[i] for i in owner], at.astype(np.int32), low.astype(np.int32), high.astype(np.int32))

        for keys, ids, bodies in rows_of(batches, "key", "doc_id", "text"):
            for key, doc, text in zip(keys, ids, bodies, strict=True):
                if key in seen:
                    continue
                if len(seen) < CHUNK:
                    seen.add(key)
                held.append(anchors(np.frombuffer(text.encode(), np.uint8), SLICE))
                names.append((key, doc))
                size += len(held[-1][0])
                if size >= CHUNK:
                    yield close()
                    held, names, size = [], [], 0
        if size:
            yield close()

    def repeated(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the row before, with whether it is out
        for batch in batches:
            table = pa.Table.from_batches([batch] if last is None else [last[0], batch]).combine_chunks()
            anchor, sure = (table.column(c).to_numpy() for c in ("anchor", "sure"))
            key, at = table.column("key").to_pylist(), table.column("at").to_numpy()
            same = anchor[1:] == anchor[:-1]
            other = np.array([a != b for a, b in zip(key, key[1:], strict=False)], bool) | (at[1:] != at[:-1])
            # an anchor repeats if one is sure or two of its rows differ; rows are sorted, so this looks at neighbours
            joined = same & (other | sure[1:] | sure[:-1])
            out = sure | np.append(joined, False) | np.append(False, joined)
            if last is not None and last[1]:
                out[0] = False  # already out
                if len(out) > 1 and same[0] and (other[0] or sure[1]):
                    out[1] = True
            done = bool(out[-1]) or (last is not None and last[1] and len(out) == 1)
            tail = table.slice(len(out) - 1, 1).to_batches()[0]
            if np.any(out):
                yield from table.filter(pa.array(out)).to_batches()
            last = (tail, done)

    rows = keyed.mapInArrow(listed, _ANCHORS_COLUMNS).repartition("spot").sortWithinPartitions("spot", "anchor", "key", "at")
    found = rows.mapInArrow(repeated, _ANCHORS_COLUMNS)
    return write_out(found.select("anchor", "key", "doc_id", "at", "low", "high"), "anchors")


def _covered(keyed: DataFrame, found: DataFrame) -> DataFrame:
    """``key, low, high``: bytes of each text that repeated strings cover."""
    hot = found.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT).select("anchor", F.lit(True).alias("hot"))
    marked = found.join(hot, "anchor", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    wanted = marked.groupBy("key").agg(F.min("doc_id").alias("wanted_id"), F.collect_set(F.struct("at", "low", "high", "anchor", "hot")).alias("places")).withColumnRenamed("key", "wanted")
    rows = keyed.join(wanted, (keyed["key"] == wanted["wanted"]) & keyed["doc_id"].eqNullSafe(wanted["wanted_id"])).select("key", "text", "places")

    def around(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, bodies, all_places in rows_of(batches, "key", "text", "places"):
            out, hot = [], {}
            for key, text, places in zip(keys, bodies, all_places, strict=True):
                raw = text.encode()
                for p in places:
                    at, low, high = p["at"], p["low"], p["high"]
                    if not p["hot"]:
                        out.append((p["anchor"], _BYTES, key, at, low, high, raw[low : high + LENGTH]))
                        continue
                    for start in range(low, high + 1):
                        name = hashlib.blake2b(raw[start : start + LENGTH], digest_size=16).digest()
                        hot.setdefault(name, []).append((key, start))
                if len(out) >= 20_000:
                    yield batch_of(_AROUND, *zip(*out, strict=True))
                    out = []
            for name, where in hot.items():  # of strings found twice here, one goes on and all are done
                where = sorted(set(where))
                spot = int.from_bytes(name[:8], "little", signed=True)
                out += [(spot, _HASHES, where[0][0], where[0][1], int(len(where) > 1), 0, name)]
                out += [(hash((name, k)) & (1 << 62) - 1, _DONE, key, start, start, start, b"") for k, (key, start) in enumerate(where) if len(where) > 1]
            if out:
                yield batch_of(_AROUND, *zip(*out, strict=True))

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        last = None

        def close(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
            if len(rows) < 2:
                return
            spots = np.array([r[0] for r in rows])
            groups = np.concatenate([[0], np.cumsum(np.diff(spots) != 0)])
            alone = np.bincount(groups)[groups] < 2
            rows = [r for r, x in zip(rows, alone.tolist(), strict=True) if not x]
            if rows:
                at, low, high = (np.array([r[i] for r in rows], np.int64) for i in (2, 3, 4))
                runs = solve(groups[~alone], at, low, high, [r[5] for r in rows])
                if runs:
                    yield batch_of(_COVERED, [rows[m][1] for m, _, _ in runs], [a for _, a, _ in runs], [b + LENGTH for _, _, b in runs])

        for columns in rows_of(batches, "spot", "kind", "key", "at", "low", "high", "body"):
            ready = []
            for spot, kind, key, at, low, high, body in zip(*columns, strict=True):
                if kind == _DONE:
                    ready.append((key, at, at + LENGTH))
                elif kind == _HASHES:
                    if last is not None and last[0] == body and last[1:3] != (key, at):
                        ready.append((key, at, at + LENGTH))
                        if not last[3]:
                            ready.append((last[1], last[2], last[2] + LENGTH))
                        last = (body, key, at, True)
                    elif last is None or last[0] != body:
                        last = (body, key, at, bool(low))
                else:
                    if len(held) >= TOGETHER and held[-1][0] != spot:
                        yield from close(held)
                        held = []
                    if not held or held[-1][:4] != (spot, key, at, low):  # else a repeated row; slices cut an anchor into rows of other lows
                        held.append((spot, key, at, low, high, body))
            if ready:
                yield batch_of(_COVERED, *zip(*ready, strict=True))
        yield from close(held)

    placed = rows.mapInArrow(around, _AROUND_COLUMNS).repartition("spot").sortWithinPartitions("spot", "kind", "body", "key", "at")
    return write_out(placed.mapInArrow(compare, _COVERED_COLUMNS), "covered")


def spans(docs: DataFrame) -> DataFrame:
    """``key, copies, spans`` of each distinct text: how many rows have it, and the byte ranges to remove (null: none).

    ``spans`` holds 64-bit pairs of begin and end, in order, apart from each other.
    A text that occurs more than once is covered whole, if it has ``LENGTH`` bytes.
    """
    keyed = _keyed(docs)
    copies = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("copies"), F.max(F.octet_length("text")).cast("long").alias("size"))
    covered = _covered(keyed, _repeated_anchors(keyed))

    def merged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_of("key binary, spans binary")
        for keys, runs in rows_of(batches, "key", "runs"):
            out = []
            for own in runs:
                low, high = np.array([r["low"] for r in own]), np.array([r["high"] for r in own])
                order = np.argsort(low)
                low, high = low[order], np.maximum.accumulate(high[order])
                new = np.append(True, low[1:] > high[:-1])
                out.append(np.stack([low[new], high[np.append(np.flatnonzero(new)[1:], len(low)) - 1]], axis=1).astype("<i8").tobytes())
            yield batch_of(schema, keys, out)

    runs = covered.groupBy("key").agg(F.collect_list(F.struct("low", "high")).alias("runs"))
    joined = copies.join(runs.mapInArrow(merged, "key binary, spans binary"), "key", "left")
    return joined.select("key", "copies", "size", "spans")


def remove(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` with ``n_bytes, n_removed, n_spans, kept`` (the bytes left) in place of equally named columns.

    Null texts count as empty and lose nothing, like all texts under ``LENGTH``
    bytes. Null and repeated ids are no matter: repeated texts are copies of each
    other whatever their ids. An empty table gives an empty result.
    """
    found = spans(docs)
    own = [c for c in docs.columns if c not in ("n_bytes", "n_removed", "n_spans", "kept", "_key", "_spans")]
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    whole = found.where((F.col("copies") > 1) & (F.col("size") >= LENGTH))
    rest = found.where(~((F.col("copies") > 1) & (F.col("size") >= LENGTH)) & F.col("spans").isNotNull())
    marks = whole.select(F.col("key").alias("_key"), F.lit(b"").alias("_spans")).unionByName(rest.select(F.col("key").alias("_key"), F.col("spans").alias("_spans")))
    rows = docs.select(*own, F.unhex(F.md5(text)).alias("_key")).join(marks, "_key", "left")
    out_schema = rows.drop("_key", "_spans").schema.add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long").add("kept", "binary")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            texts, marks = (batch.column(names.index(c)).to_pylist() for c in ("text", "_spans"))
            sizes, removed, counts, kept = [], [], [], []
            for text, mark in zip(texts, marks, strict=True):
                raw = (text or "").encode()
                ranges = [] if mark is None else [(0, len(raw))] if mark == b"" else np.frombuffer(mark, "<i8").reshape(-1, 2).tolist()
                ends = [0, *(b for _, b in ranges)]
                left = b"".join(raw[a:b] for a, b in zip(ends, [*(a for a, _ in ranges), len(raw)], strict=True))
                sizes.append(len(raw))
                removed.append(len(raw) - len(left))
                counts.append(len(ranges))
                kept.append(left)
            columns = [batch.column(names.index(c)) for c in own]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(counts, pa.int64()), pa.array(kept, pa.binary())], names=[*own, "n_bytes", "n_removed", "n_spans", "kept"])

    return rows.select(*own, "_spans").mapInArrow(cut, out_schema)


def shorten(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` with the text that is left, and ``n_chars`` of it if there is such a column.

    Parts of a character that is cut through go as well. Rows of which nothing is
    left stay, with an empty text; null texts stay null.
    """
    named = docs.withColumn("_was_null", F.col("text").isNull())
    cut = remove(named).drop("text").withColumnRenamed("kept", "text")
    cut = annotate(cut, lambda: lambda kept: [[x.decode("utf-8", "ignore") for x in kept]], "_left string")
    text = F.when(~F.col("_was_null"), F.col("_left"))
    values = {"text": text}
    if "n_chars" in docs.columns:
        values["n_chars"] = F.when(F.col("_was_null"), F.col("n_chars")).otherwise(F.length("_left")).cast(docs.schema["n_chars"].dataType)
    return cut.select(*(values.get(c, F.col(c)).alias(c) for c in docs.columns))
