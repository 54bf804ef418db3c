"""What the operators of this folder share: reading texts, Arrow batches, components of links."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stemma.session import write_out

#: Rows and bytes of an Arrow batch; texts can be long, so the bytes are what bounds memory.
BATCH_ROWS, BATCH_BYTES = 2000, 4 << 20
#: Bytes that a Parquet writer gathers before it writes them, in each task.
ROW_GROUP = 16 << 20
#: A document whose ``crc32(doc_id as text) mod FOLDS`` is 0 is held out of every fit.
FOLDS = 5


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound Arrow batches and Parquet row groups in bytes, for every Python operator here holds one batch of texts at a time."""
    spark.conf.set("parquet.block.size", ROW_GROUP)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id``, ``text`` (null: empty) and the named columns; every other column is left behind."""
    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).alias("text"), *more)


def held_out(doc_id: str = "doc_id"):
    """True where the document is held out; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


_HELD: dict = {}
#: The C library's call that gives idle memory back to the system, where it has one.
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def held(key, make: Callable):
    """What ``make`` gives, kept in this worker for later tasks of the same operator; another operator's is let go."""
    if key not in _HELD:
        letting_go()
        _HELD[key] = make()
    return _HELD[key]


def letting_go() -> None:
    """An operator that holds nothing lets go of what another has left in this worker, and of memory that lies idle."""
    if _HELD:
        _HELD.clear()
        gc.collect()
    giving_back()


def giving_back() -> None:
    """Memory that lies idle in this worker goes back to the system; what is held stays."""
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


@contextlib.contextmanager
def no_cycles() -> Iterator[None]:
    """Without the collector of cycles, for code that keeps many small objects and makes no cycles."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        gc.freeze()  # or the next collection would go through all that is kept
        if was:
            gc.enable()


def rows_of(batches: Iterable[pa.RecordBatch], *columns: str) -> Iterator[tuple[list, ...]]:
    """The named columns of each batch as lists."""
    for batch in batches:
        yield tuple(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in columns)


def arrow_of(schema: str) -> pa.Schema:
    """An Arrow schema from ``name type`` pairs with the few types used here."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64())}
    return pa.schema([(n, kinds[k]) for n, k in (x.split() for x in schema.split(", "))])


def batch_of(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def annotate(docs: DataFrame, make: Callable[[], Callable[[list], list]], columns: str) -> DataFrame:
    """Every column of ``docs`` and new ``columns`` (``name type`` pairs) computed from its texts.

    ``make`` gives, once per task, a function from a list of texts (or nulls) to a
    list of columns. New columns take the place of equally named ones.
    """
    small_batches(docs.sparkSession)
    added = arrow_of(columns)
    kept = docs.drop(*(n for n in added.names if n != "text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letting_go()
        compute = make()
        for batch in batches:
            new = [pa.array(c, type=f.type) for c, f in zip(compute(batch.column(batch.schema.get_field_index("text")).to_pylist()), added, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*batch.schema.names, *added.names])
            del batch, new  # before the next one comes

    schema = StructType(list(kept.schema.fields))
    for part in columns.split(", "):
        schema = schema.add(*part.split(" "))
    return kept.mapInArrow(run, schema)


class Forest:
    """Union-find over any ordered keys; the smallest key is the root."""

    def __init__(self) -> None:
        self.up: dict = {}

    def root(self, x):
        path = []
        while (y := self.up.get(x, x)) != x:
            path.append(x)
            x = y
        for p in path:
            self.up[p] = x
        return x

    def join(self, a, b) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        low, high = (a, b) if a < b else (b, a)
        self.up[high] = low
        self.up.setdefault(low, low)
        return True


def _contract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of one task as stars: each key with the smallest key its task connects it to."""
    forest, schema = Forest(), None
    for batch in batches:
        schema = batch.schema
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            forest.join(a, b)
    if schema is not None:
        found = [(k, forest.root(k)) for k in list(forest.up)]
        found = [(k, r) for k, r in found if k != r]
        for i in range(0, len(found), 50_000):
            part = found[i : i + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in part], schema.field(0).type), pa.array([r for _, r in part], schema.field(1).type)], schema=schema)


def components(links: DataFrame, name: str) -> DataFrame:
    """Connected components of ``links(a, b)``: ``node``, ``root`` (smallest key reachable) for every key with a link to another.

    Links of one task shrink to stars first. Then each round gives every key its
    smallest neighbour, hooks its other neighbours there and follows one more
    step, so chains halve. Only links between tables move; nothing is brought to
    the driver but the flag that says whether a round changed anything.
    """
    kind = links.schema["a"].dataType
    pairs = links.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("parent"))
    stars = write_out(pairs.mapInArrow(_contract, pairs.select(F.col("node").cast(kind), F.col("parent").cast(kind)).schema).distinct(), f"{name}-stars")
    while True:
        best = stars.groupBy("node").agg(F.min("parent").alias("best"), F.max("parent").alias("other"))
        hooked = stars.join(best, "node")
        moved = F.col("other") != F.col("best")
        hooked = hooked.select("node", F.col("best").alias("parent"), moved.alias("moved")).unionByName(
            hooked.where(F.col("parent") != F.col("best")).select(F.col("parent").alias("node"), F.col("best").alias("parent"), F.lit(True).alias("moved"))
        )
        hooked = hooked.groupBy("node", "parent").agg(F.max("moved").alias("moved"))
        up = hooked.groupBy(F.col("node").alias("parent")).agg(F.min("parent").alias("above"))
        jumped = hooked.join(up, "parent", "left").select("node", F.coalesce("above", "parent").alias("parent"), (F.col("moved") | F.col("above").isNotNull()).alias("moved"))
        stars = write_out(jumped.groupBy("node", "parent").agg(F.max("moved").alias("moved")), f"{name}-stars")
        if not stars.agg(F.max("moved")).first()[0]:
            return stars.select("node", F.col("parent").alias("root"))
        stars = stars.select("node", "parent")
