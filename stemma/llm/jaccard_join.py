"""Documents whose shingle sets have a Jaccard similarity of at least ``SIMILARITY`` per cent, by a prefix-tree join.

First each set learns how many sets have each of its shingles: hashes go to
buckets, packed, and counts come back. A set with fewer shared shingles than any
link needs takes no further part. Shingles are ordered by these counts, rare ones
first, so the order is the same in all tasks. Two sets that link share one of the first
``n - ceil(n * SIMILARITY / 100) + 1`` shingles of each, so each set is listed under
these, and what shares a list is joined to a block. A list's members in one task
are linked there and one of them goes on, so no list is longer than there are
tasks. Each set then goes to its block, where the sets are stored in a trie and
joined with it; blocks too large for a task are cut into groups, and each two
groups meet in a task of their own.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stemma.llm import shingles
from stemma.llm.common import Forest, arrow_of, batch_of, components, letting_go, rows_of, texts
from stemma.session import write_out

SIMILARITY = 75
#: Shingles held at a time.
CHUNK = 1_000_000
#: Shingles whose hashes meet in one bucket, on average, and the bytes of text that give one.
BUCKET, BYTES_EACH = 2_000_000, 6
#: Names of sets a task remembers, so that copies are sent once.
REMEMBERED = 200_000
#: Shingles of a block that one task takes.
BLOCK = 1_000_000
_PACKED_COLUMNS = "bucket long, chunk long, docs array<long>, sizes binary, names binary, hashes binary"
_PACKED = arrow_of(_PACKED_COLUMNS)
_SETS_COLUMNS = "doc_id long, name binary, node long, n_shingles long, times binary"
_SETS = arrow_of(_SETS_COLUMNS)
_LISTED = arrow_of("shingle long, member long, other long")
_LINKS = arrow_of("a long, b long")
_NAMES = arrow_of("a binary, b binary")


def needed(n: int, similarity: int = SIMILARITY) -> int:
    """The least overlap with any set that a set of ``n`` links with."""
    return -(-similarity * n // 100)


def _buckets(bodies: DataFrame) -> int:
    """How many buckets the shingles of all texts need."""
    size = bodies.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    return max(64, -(-size // (BYTES_EACH * BUCKET)))


def _counted(bodies: DataFrame, buckets: int, similarity: int) -> DataFrame:
    """``doc_id, name, node, n_shingles, times`` of every row, written once.

    ``times`` has a byte per shingle, by bucket and hash: how many sets have it, 255
    at most. Hashes are cut to about 40 bits, so a count may be too high but never
    too low, and is the same for all sets. ``times`` is null where too few shingles
    are shared for any link, and for sets that the task has sent before.
    """

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letting_go()
        part, number, held, size, seen = TaskContext.get().partitionId(), 0, [], 0, set()

        def close() -> Iterator[pa.RecordBatch]:
            chunk = part << 32 | number
            ids, names, sets = zip(*held, strict=True)
            sizes = np.array([len(x) for x in sets], "<u4")
            none = b"".join(name or bytes(16) for name in names)
            yield batch_of(_PACKED, [-1 - chunk], [chunk], [list(ids)], [sizes.tobytes()], [none], [b""])
            sent = [x if new else x[:0] for x, new in zip(sets, fresh, strict=True)]
            hashes, owner = np.concatenate(sent), np.repeat(np.arange(len(sent)), list(map(len, sent)))
            bucket = (hashes % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")  # documents stay in order within a bucket
            hashes, owner = (hashes[order] >> np.uint64(32)).astype("<u4"), owner[order]
            ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
            for at in range(0, buckets, 64):
                own = [(k, ends[k], ends[k + 1]) for k in range(at, min(at + 64, buckets)) if ends[k] < ends[k + 1]]
                if own:
                    n = len(own)
                    yield batch_of(_PACKED, [k for k, _, _ in own], [chunk] * n, [None] * n, [np.bincount(owner[a:b], minlength=len(sent)).astype("<u4").tobytes() for _, a, b in own], [None] * n, [hashes[a:b].tobytes() for _, a, b in own])

        fresh: list[bool] = []
        for ids, found in rows_of(batches, "doc_id", "text"):
            for doc, own in zip(ids, shingles.sets(found), strict=True):
                name = shingles.signature(own)
                fresh.append(name is not None and name not in seen)
                if fresh[-1] and len(seen) < REMEMBERED:
                    seen.add(name)
                held.append((doc, name, own))
                size += len(own) + 1
            if size >= CHUNK:
                yield from close()
                held, fresh, size, number = [], [], 0, number + 1
        if held:
            yield from close()

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None

        def close() -> Iterator[pa.RecordBatch]:
            _, back, times = np.unique(np.concatenate([np.frombuffer(x[2], "<u4") for x in held]), return_inverse=True, return_counts=True)
            times, at = np.minimum(times, 255).astype(np.uint8)[back], 0
            for chunk, sizes, hashes in held:
                end = at + len(hashes) // 4
                yield batch_of(_PACKED, [key], [chunk], [None], [sizes], [None], [times[at:end].tobytes()])
                at = end

        for batch in batches:
            for row in batch.to_pylist():
                if row["bucket"] < 0:
                    yield batch_of(_PACKED, *([row[c]] for c in _PACKED.names))
                    continue
                if row["bucket"] != key and held:
                    yield from close()
                    held = []
                key = row["bucket"]
                held.append((row["chunk"], row["sizes"], row["hashes"]))
        if held:
            yield from close()

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, head, owners, counts = None, None, [], []

        def close() -> pa.RecordBatch:
            names = [head["names"][i : i + 16] for i in range(0, len(head["names"]), 16)]
            sizes = np.frombuffer(head["sizes"], "<u4").astype(np.int64)
            names = [name if n else None for name, n in zip(names, sizes.tolist(), strict=True)]
            owner = np.concatenate([np.empty(0, np.int64), *owners])
            order = np.argsort(owner, kind="stable")
            all_times = np.concatenate([np.empty(0, np.uint8), *counts])[order]
            ends = np.searchsorted(owner[order], np.arange(len(sizes) + 1))
            times = [all_times[a:b] for a, b in zip(ends, ends[1:], strict=False)]
            open_to = [len(x) and int((x > 1).sum()) >= needed(n, similarity) for x, n in zip(times, sizes.tolist(), strict=True)]
            return batch_of(_SETS, head["docs"], names, [x and shingles.short_name(x) for x in names], sizes, [x.tobytes() if y else None for x, y in zip(times, open_to, strict=True)])

        for batch in batches:
            for row in batch.to_pylist():
                if row["chunk"] != key:
                    if head is not None:
                        yield close()
                    key, head, owners, counts = row["chunk"], None, [], []
                if row["bucket"] < 0:
                    head = row
                else:
                    own = np.frombuffer(row["sizes"], "<u4")
                    owners.append(np.repeat(np.arange(len(own)), own))
                    counts.append(np.frombuffer(row["hashes"], np.uint8))
        if head is not None:
            yield close()

    by_bucket = bodies.mapInArrow(send, _PACKED_COLUMNS).repartition("bucket").sortWithinPartitions("bucket")
    by_chunk = by_bucket.mapInArrow(count, _PACKED_COLUMNS).repartition("chunk").sortWithinPartitions("chunk", "bucket")
    return write_out(by_chunk.mapInArrow(add, _SETS_COLUMNS), "jaccard-sets")


def _ordered(own: np.ndarray, times: bytes, buckets: int) -> np.ndarray:
    """A set in the global order: by how many sets have a shingle, then by hash."""
    counts = np.empty(len(own), np.uint8)
    counts[np.argsort(own % np.uint64(buckets), kind="stable")] = np.frombuffer(times, np.uint8)
    return own[np.argsort(counts, kind="stable")]


def _block_links(bodies: DataFrame, buckets: int, similarity: int) -> DataFrame:
    """Links ``a, b`` between short names of sets that share a listed shingle, as one forest per task."""
    def listed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, members, size = [], [], 0

        def close() -> pa.RecordBatch:
            grams, owner = np.concatenate(held), np.repeat(np.array(members, np.int64), list(map(len, held)))
            order = np.argsort(grams, kind="stable")
            grams, owner = grams[order], owner[order]
            again = np.concatenate([[False], grams[1:] == grams[:-1]])
            # the first of a list goes on; the others are linked to the one before them
            other = np.where(again, np.concatenate([[0], owner[:-1]]), 0)
            keep = ~again
            pairs = np.unique(np.stack([owner[again], other[again]]), axis=1) if again.any() else np.empty((2, 0), np.int64)
            return batch_of(
                _LISTED,
                np.concatenate([grams[keep].view(np.int64), pairs[0]]),
                np.concatenate([owner[keep], pairs[0]]),
                pa.array(np.concatenate([owner[keep], pairs[1]]), mask=np.concatenate([np.ones(keep.sum(), bool), np.zeros(pairs.shape[1], bool)])),
            )

        for names, found, counts in rows_of(batches, "name", "text", "times"):
            for name, own, times in zip(names, shingles.sets(found), counts, strict=True):
                held.append(_ordered(own, times, buckets)[: len(own) - needed(len(own), similarity) + 1])
                members.append(shingles.short_name(name))
                size += len(held[-1])
            if size >= CHUNK:
                yield close()
                held, members, size = [], [], 0
        if size:
            yield close()

    def linked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, shingle, member = Forest(), None, 0
        for batch in batches:
            grams, members = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            others = batch.column(2)
            local = others.is_valid().to_numpy(zero_copy_only=False)
            pairs = [np.stack([members[local], others.fill_null(0).to_numpy()[local]])]
            grams, members = grams[~local], members[~local]
            if len(grams):
                if shingle is not None:
                    grams, members = np.concatenate([[shingle], grams]), np.concatenate([[member], members])
                again = np.flatnonzero(grams[1:] == grams[:-1])
                pairs.append(np.stack([members[again], members[again + 1]]))
                shingle, member = grams[-1], members[-1]
            both = np.concatenate(pairs, axis=1)
            both = np.unique(both[:, both[0] != both[1]], axis=1)
            for a, b in zip(*both.tolist(), strict=True):
                forest.join(a, b)
        found = [(k, r) for k in list(forest.up) if (r := forest.root(k)) != k]
        for i in range(0, len(found), 100_000):
            yield batch_of(_LINKS, *zip(*found[i : i + 100_000], strict=True))

    rows = bodies.mapInArrow(listed, "shingle long, member long, other long")
    return rows.repartition("shingle").sortWithinPartitions("shingle").mapInArrow(linked, "a long, b long")


class Trie:
    """Sets of a block as paths of a prefix tree, most shared shingles first.

    Paths are held in sorted order with the depth each shares with the one
    before it; a subtree is a run of paths. Shingles of one set only can't overlap
    and are left out of the paths.
    """

    def __init__(self, own: list[np.ndarray]) -> None:
        all_of, back, times = np.unique(np.concatenate(own), return_inverse=True, return_counts=True)
        place = np.empty(len(all_of), np.int64)
        place[np.argsort(-times, kind="stable")] = np.arange(len(all_of))
        self.width = int((times > 1).sum())
        ends = np.cumsum([len(x) for x in own])
        paths = [np.sort(x[x < self.width]) for x in np.split(place[back], ends[:-1])]
        order = sorted(range(len(own)), key=lambda i: paths[i].astype(">u4").tobytes())
        self.order = np.array(order)
        self.paths = [paths[i] for i in order]
        self.sizes = np.array([len(own[i]) for i in order])
        self.depths = np.array([len(p) for p in self.paths])
        self.lcp = np.array([0, *(_same(p, q) for p, q in zip(self.paths, self.paths[1:], strict=False))])

    def links(self, similarity: int, group: np.ndarray | None = None) -> list[tuple[int, int]]:
        """Pairs that link, enough of them to connect all that do.

        ``group``: only pairs of different groups are asked for. Each set walks the
        tree, taking over the overlaps of the depth that two paths share. A path
        already connected to it is passed over, as is every subtree in which
        misses leave too few shingles for the overlap needed.
        """
        part, found = np.arange(len(self.paths)), []
        inside = np.zeros(self.width, bool)
        for x, path in enumerate(self.paths):
            n = self.sizes[x]
            least = -(-similarity * (n + self.sizes) // (100 + similarity))  # overlap that links with each
            open_to = (np.arange(len(part)) > x) & (part != part[x]) & (least <= np.minimum(self.depths, len(path)))
            if group is not None:
                open_to &= group[self.order] != group[self.order[x]]
            todo = np.flatnonzero(open_to)
            if not len(todo):
                continue
            inside[path] = True
            # overlaps[d]: of the first d shingles of the last path walked; valid to depth `known`
            overlaps, known, last, dead = np.zeros(1, np.int64), 0, None, None
            for y in todo.tolist():
                if part[y] == part[x]:
                    continue
                shared = 0 if last is None else int(self.lcp[last + 1 : y + 1].min())
                if dead is not None and shared >= dead[0] and least[y] >= dead[1]:
                    continue  # in the pruned subtree
                known = min(known, shared)
                hits = np.concatenate([overlaps[: known + 1], overlaps[known] + np.cumsum(inside[self.paths[y][known:]])])
                overlaps, known, last, dead = hits, len(hits) - 1, y, None
                if hits[-1] >= least[y]:
                    found.append((int(self.order[x]), int(self.order[y])))
                    part[part == part[y]] = part[x]
                else:  # the depth from which no path below can reach the overlap: x has too few shingles left
                    left = len(path) - np.searchsorted(path, self.paths[y], side="right")
                    short = np.flatnonzero(hits[1:] + left < least[y])
                    if len(short):
                        dead = (int(short[0]) + 1, int(least[y]))
            inside[path] = False
        return found


def _same(p: np.ndarray, q: np.ndarray) -> int:
    n = min(len(p), len(q))
    differ = np.flatnonzero(p[:n] != q[:n])
    return int(differ[0]) if len(differ) else n


def _join_blocks(bodies: DataFrame, members: DataFrame, similarity: int) -> DataFrame:
    """Links between names of sets; ``members``: ``name, n_shingles, block``, one row per set."""
    sizes = members.groupBy("block").agg(F.sum("n_shingles").alias("all_shingles"))
    split = members.join(sizes, "block").withColumn("groups", F.ceil(F.col("all_shingles") / BLOCK).cast("int"))
    split = split.withColumn("own", F.pmod(F.xxhash64("name"), F.col("groups")).cast("int"))
    placed = bodies.join(split, "name").select("name", "text", "block", "own", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("met"))
    rows = placed.select("block", F.least("own", "met").alias("low"), F.greatest("own", "met").alias("high"), "own", "name", "text")
    rows = rows.repartition("block", "low", "high").sortWithinPartitions("block", "low", "high", "name")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, names, own, groups = None, [], [], []

        def close() -> Iterator[pa.RecordBatch]:
            if len(own) > 1:
                of = np.array(groups) if key[1] != key[2] else None
                found = [(names[x], names[y]) for x, y in Trie(own).links(similarity, of)]
                if found:
                    yield batch_of(_NAMES, *zip(*found, strict=True))

        for *keys, in_group, called, bodies in rows_of(batches, "block", "low", "high", "own", "name", "text"):
            for here, group, name, x in zip(zip(*keys, strict=True), in_group, called, shingles.sets(bodies), strict=True):
                if here != key:
                    yield from close()
                    key, names, own, groups = here, [], [], []
                if not names or names[-1] != name:  # else a repeated row
                    names.append(name)
                    own.append(x)
                    groups.append(group)
        yield from close()

    return rows.mapInArrow(run, "a binary, b binary")


_ROW = "_jaccard_row"


def near_duplicates(docs: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs(doc_id, text)``.

    Two documents link when ``100 * intersection >= similarity * union`` of their
    sets; ``component_id`` is the smallest ``doc_id`` reachable by links. Null and
    empty texts have no shingles and link with nothing. A null ``doc_id`` is never
    a component's name unless no other is there; repeated rows stay rows. Other
    columns are ignored; an empty table gives an empty result.
    """
    found = texts(docs)
    buckets = _buckets(found)
    rows = _counted(found, buckets, similarity)
    distinct = rows.where("name is not null").groupBy("name").agg(F.min("doc_id").alias("doc_id"), F.max("n_shingles").alias("n_shingles"), F.max("node").alias("node"), F.max("times").alias("times"))
    # the texts of sets that may link, once each; rows that repeat an id with another text are told apart by name
    open_to = distinct.where(F.col("times").isNotNull()).select("name", F.col("doc_id").alias("key"), "times")
    joined = open_to.join(found, open_to["key"].eqNullSafe(found["doc_id"])).select("name", "text", "times")

    def checked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for names, found, times in rows_of(batches, "name", "text", "times"):
            keep = [i for i, x in enumerate(shingles.sets(found)) if shingles.signature(x) == names[i]]
            yield batch_of(arrow_of("name binary, text string, times binary"), *([x[i] for i in keep] for x in (names, found, times)))

    bodies = write_out(joined.mapInArrow(checked, "name binary, text string, times binary"), "jaccard-texts")
    found = components(_block_links(bodies, buckets, similarity), "jaccard-blocks")
    blocks = found.select("node", "root").unionByName(found.select(F.col("root").alias("node"), "root").distinct())
    members = distinct.join(blocks, "node").select("name", "n_shingles", F.col("root").alias("block"))
    linked = components(write_out(_join_blocks(bodies, write_out(members, "jaccard-members"), similarity), "jaccard-links"), "jaccard")
    owner = distinct.join(linked.withColumnRenamed("node", "name"), "name", "left").select("name", F.coalesce("root", "name").alias("component"), "doc_id")
    least = owner.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = owner.join(least, "component").select("name", "component_id")
    return rows.join(named, "name", "left").select("doc_id", "n_shingles", F.when(F.col("name").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def keep_one(docs: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """One document of each component, that of the smallest ``doc_id`` (null comes last), with its columns.

    Rows are told apart by a number of their own, so where an id repeats with another
    text only one of the rows counts. Of equal ids in a component one row stays; rows without a shingle all stay.
    """
    own = write_out(docs.withColumn(_ROW, F.monotonically_increasing_id()), "jaccard-rows")
    found = near_duplicates(own.select(F.col(_ROW).alias("doc_id"), "text"), similarity).select(F.col("doc_id").alias(_ROW), "component_id")
    first = own.select(_ROW, F.col("doc_id").cast("long").alias("doc_id")).join(found, _ROW).groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", _ROW)).alias("least"))
    kept = write_out(first.select(F.col(f"least.{_ROW}").alias(_ROW)), "jaccard-kept")
    return own.join(kept, _ROW, "left_semi").select(docs.columns)
