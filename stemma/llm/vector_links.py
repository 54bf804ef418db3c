"""Near-duplicate vectors by Euclidean p-stable hashing and exact cosine checks.

Equal vectors of one label count once. Normalised vectors are projected on random
directions; ``PROJECTIONS`` quantised projections together name a bucket in each of
``TABLES`` tables. Vectors that share a bucket are compared exactly, in matrix
products. A pair is counted in the first table where its buckets agree, so no pair
needs to be written out: each bucket gives sums of links and one forest of them.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stemma.llm.common import Forest, arrow_of, batch_of, components, rows_of, small_batches
from stemma.llm.shingles import mixed
from stemma.session import write_out

COSINE = 0.93
#: At the least cosine a pair shares a table's bucket with probability 0.2; in one of 32 tables with 0.999.
TABLES, PROJECTIONS, WIDTH = 32, 10, 2.0
SEED = 7
#: Vectors of a bucket that one task compares with each other; larger buckets are cut into groups that meet in pairs.
GROUP = 2000
_CLASSES = "class_id long, label long, vector binary, copies long"
_HASHED = arrow_of("class_id long, tables binary, bucket array<long>")
_FOUND = arrow_of("a long, b long, links long")


def directions(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Random normal directions and offsets for vectors of one size, the same in every task."""
    draw = np.random.default_rng([SEED, size])
    return draw.standard_normal((size, TABLES * PROJECTIONS)), draw.uniform(0, WIDTH, TABLES * PROJECTIONS)


def buckets(vectors: np.ndarray) -> np.ndarray:
    """A 64-bit bucket name for each vector (rows of length one) and table."""
    normal, offset = directions(vectors.shape[1])
    cells = np.floor((vectors @ normal + offset) / WIDTH).astype(np.int64).astype(np.uint64).reshape(len(vectors), TABLES, PROJECTIONS)
    name = np.broadcast_to(np.arange(TABLES, dtype=np.uint64), (len(vectors), TABLES)) + np.uint64(vectors.shape[1] << 32)
    for k in range(PROJECTIONS):
        name = mixed(name + cells[:, :, k])
    return name


def _classes(vectors: DataFrame, vec_id: str, label: str, vector: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` (row_id, vec_id, label, key) of all vectors and the classes of equal ones among those that can link."""
    x = F.col(vector).cast("array<double>")
    usable = F.col(label).isNotNull() & (F.size(x) > 0) & ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))) & F.exists(x, lambda v: v != 0)
    # -0.0 and 0.0 are one value
    clean = F.when(F.coalesce(usable, F.lit(False)), F.transform(x, lambda v: v + F.lit(0.0)))
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), clean.alias("x")).withColumn("key", F.when(F.col("x").isNotNull(), F.sha2(F.concat_ws(",", F.col("label").cast("string"), F.col("x").cast("array<string>")), 256)))
    rows = write_out(rows.withColumn("row_id", F.monotonically_increasing_id()), "vectors")
    classes = rows.where("key is not null").groupBy("key").agg(F.min("row_id").alias("class_id"), F.first("label").alias("label"), F.first("x").alias("x"), F.count(F.lit(1)).alias("copies"))
    return rows.select("vec_id", "key"), write_out(classes, "vector-classes")


def links(vectors: DataFrame, vec_id: str = "vec_id", label: str = "label", vector: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row.

    Vectors link when their labels are equal and not null, both have the same
    number of components, all finite and not all zero, and their cosine in double
    precision is at least ``cosine``. Others link with nothing. Repeated rows are
    vectors of their own and link with each other. Other columns are ignored; an
    empty table gives an empty result. A hot bucket is cut into groups, of which
    each two are compared by a task of their own.
    """
    small_batches(vectors.sparkSession)
    rows, classes = _classes(vectors, vec_id, label, vector)

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, labels, xs in rows_of(batches, "class_id", "label", "x"):
            for size in {len(x) for x in xs}:
                at = [i for i, x in enumerate(xs) if len(x) == size]
                unit = _unit(np.array([xs[i] for i in at]))
                names = buckets(unit)
                mine = mixed(names + np.array([labels[i] for i in at], np.int64).astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15))
                yield batch_of(_HASHED, [ids[i] for i in at], [n.tobytes() for n in (mine >> np.uint64(32)).astype("<u4")], mine.view(np.int64).tolist())

    keyed = write_out(classes.mapInArrow(hashed, "class_id long, tables binary, bucket array<long>"), "vector-buckets")
    listed = keyed.select("class_id", F.posexplode("bucket").alias("table", "bucket"))
    shared = listed.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    met = listed.join(shared, "bucket").withColumn("groups", F.ceil(F.col("members") / GROUP).cast("int"))
    own = F.pmod(F.xxhash64("class_id"), F.col("groups")).cast("int")
    placed = met.select("class_id", "table", "bucket", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("met"))
    placed = placed.select("class_id", "table", "bucket", "own", F.least("own", "met").alias("low"), F.greatest("own", "met").alias("high"))
    full = placed.join(classes.select("class_id", "x", "copies").join(keyed.select("class_id", "tables"), "class_id"), "class_id")

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def close() -> Iterator[pa.RecordBatch]:
            if len(held) > 1:
                yield from _compared(key, held, cosine)

        for *keys, ids, xs, copies, tables, groups in rows_of(batches, "bucket", "low", "high", "table", "class_id", "x", "copies", "tables", "own"):
            for here, row in zip(zip(*keys, strict=True), zip(ids, xs, copies, tables, groups, strict=True), strict=True):
                if here != key:
                    yield from close()
                    key, held = here, []
                held.append(row)
        yield from close()

    by_bucket = full.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high", "table", "class_id")
    found = write_out(by_bucket.mapInArrow(compare, "a long, b long, links long"), "vector-links")
    sums = found.where("links is not null").groupBy("a").agg(F.sum("links").alias("links"))
    roots = components(found.where("b is not null").select("a", "b"), "vectors")
    named = classes.select("key", "class_id", "copies").join(sums.withColumnRenamed("a", "class_id"), "class_id", "left").join(roots.withColumnRenamed("node", "class_id"), "class_id", "left")
    named = named.select("key", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "class_id").alias("component"))
    joined = rows.join(named, "key", "left")
    least = joined.where("component is not null").groupBy("component").agg(F.min("vec_id").alias("least"))
    out = joined.join(least, "component", "left").select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.when(F.col("component").isNull(), F.col("vec_id")).otherwise(F.col("least")).alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled by the largest component first, so squares neither overflow nor vanish."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _compared(key: tuple, held: list[tuple], cosine: float) -> Iterator[pa.RecordBatch]:
    """Links within one bucket, or between two groups of it, that no earlier table has."""
    _, low, high, table = key
    ids, copies, groups = (np.array([row[i] for row in held], np.int64) for i in (0, 2, 4))
    unit = _unit(np.array([row[1] for row in held]))
    names = np.array([np.frombuffer(row[3], "<u4") for row in held])
    links, forest = np.zeros(len(ids), np.int64), Forest()
    for at in range(0, len(ids), 500):
        alike = unit[at : at + 500] @ unit.T >= cosine
        alike &= np.arange(len(ids)) > np.arange(at, at + len(alike))[:, None]
        if low != high:
            alike &= groups != groups[at : at + len(alike), None]
        i, j = np.nonzero(alike)
        for k in range(0, len(i), 100_000):
            a, b = i[k : k + 100_000] + at, j[k : k + 100_000]
            new = ~(names[a, :table] == names[b, :table]).any(axis=1)
            a, b = a[new], b[new]
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            for x, y in zip(ids[a].tolist(), ids[b].tolist(), strict=True):
                forest.join(x, y)
    some = np.flatnonzero(links)
    if len(some):
        yield batch_of(_FOUND, ids[some], [None] * len(some), links[some])
        stars = [(k, r) for k in list(forest.up) if (r := forest.root(k)) != k]
        yield batch_of(_FOUND, [a for a, _ in stars], [b for _, b in stars], [None] * len(stars))
