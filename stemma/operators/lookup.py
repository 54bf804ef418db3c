"""Lookups against rule tables by containment, and name resolution."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from stemma.functions.text import normalise, slugify, strip_accents
from stemma.session import write_out

# Bytes of the longest substrings that patterns are filed under; shorter patterns are filed under 1, 2, 4, ... bytes.
SPAN = 32
# Substrings of a pattern that are looked at, evenly spread over it.
WINDOWS = 4
# Bits of a filter of substrings, whatever their number (16 MB).
BITS = 27
# Bytes of an Arrow batch of texts.
BATCH_BYTES = 4 << 20
# Places that the texts of one substring are spread over.
SALTS = 16
# Bytes of text that are hashed together.
_BLOCK = 1 << 20
_FACTOR = 0x9E3779B97F4A7C15


def _prints(data: np.ndarray, sizes: Sequence[int]) -> Iterator[np.ndarray]:
    """64-bit fingerprints of all substrings of each of ``sizes`` bytes (ascending powers of two); the highest bits are mixed best."""
    h = data.astype(np.uint64) + np.uint64(1)
    step, n = 0xD6E8FEB86659FD93, 1
    for size in sizes:
        while n < size:
            h = h[:-n] * np.uint64(step) + h[n:] if len(h) > n else h[:0]
            step, n = step * step % (1 << 64), n * 2
        mixed = ((h ^ (h >> np.uint64(32))) + np.uint64(size)) * np.uint64(_FACTOR)
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        yield mixed


def _size(n: int, span: int) -> int:
    """The largest power of two up to ``n`` and ``span``."""
    return min(1 << (n.bit_length() - 1), span)


def _filter(prints: DataFrame, bits: int) -> np.ndarray:
    """The ``bits`` highest bits of ``prints(_print)`` as a set; tasks send their own sets, cut into 64 ranges."""
    ranges = 64

    def collect(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        on = np.zeros((1 << bits) // 8, np.uint8)
        for batch in batches:
            at = np.unique(batch.column(0).to_numpy().view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)
            np.bitwise_or.at(on, at >> 3, (1 << (at & 7)).astype(np.uint8))
        for k, part in enumerate(on.reshape(ranges, -1)):
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([part.tobytes()], pa.binary())], ["range", "bits"])

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                part = np.frombuffer(part, np.uint8)
                sums[k] = sums[k] | part if k in sums else part
        for k, part in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([part.tobytes()], pa.binary())], ["range", "bits"])

    schema = "range long, bits binary"
    found = prints.select("_print").mapInArrow(collect, schema).repartition("range").mapInArrow(add, schema)
    whole = np.zeros((ranges, (1 << bits) // ranges // 8), np.uint8)
    for k, part in found.collect():  # of fixed size in all
        whole[k] = np.frombuffer(part, np.uint8)
    return whole.ravel()


def _of_texts(texts: DataFrame, sizes: Sequence[int], filtered: np.ndarray, bits: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[tuple[pa.Array, np.ndarray]]]:
    """A function of batches ``_key, _text`` that gives keys and fingerprints, those of each text that the filter has once."""
    shared = texts.sparkSession.sparkContext.broadcast(filtered)

    def found(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray]]:
        on, longest = shared.value, max(sizes)
        for batch in batches:
            prints = []
            for text in batch.column(1):
                data = np.frombuffer(text.as_buffer(), np.uint8)
                own = [np.zeros(0, np.uint64)]
                for start in range(0, len(data), _BLOCK):  # blocks overlap by the longest substring
                    block = data[start : start + _BLOCK + longest - 1]
                    for h in _prints(block, sizes):
                        at = (h >> np.uint64(64 - bits)).astype(np.int64)
                        own.append(h[on[at >> 3] >> (at & 7).astype(np.uint8) & 1 == 1])
                prints.append(np.unique(np.concatenate(own)))
            if prints:
                yield batch.column(0).take(pa.array(np.repeat(np.arange(len(prints)), list(map(len, prints))))), np.concatenate(prints)

    return found


def _candidates(texts: DataFrame, patterns: DataFrame, span: int = SPAN, bits: int = BITS) -> DataFrame:
    """``_key`` and ``_pattern`` where a text has the rarest of a pattern's substrings.

    ``texts(_key, _text)`` and ``patterns(_pattern)`` are distinct, patterns not empty. A pattern
    is filed under the one of ``WINDOWS`` substrings that the fewest texts have, so a common opening brings no pairs unless
    the whole pattern is common. The substrings have the largest power of two of bytes that fits the pattern, half of it at least,
    so few texts have them by chance; they are known by 64-bit fingerprints. A text sends only fingerprints that
    filters of fixed size let through, first those of any pattern, to be counted, then those that patterns are filed under.
    Only keys and fingerprints move; the texts of a fingerprint are spread over ``SALTS`` places.
    """
    # batches are bounded in bytes, for texts can be long
    texts.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, of = [], []
            for pattern in batch.column(0):
                data = np.frombuffer(pattern.as_buffer(), np.uint8)
                of.append(_size(len(data), span))
                (h,) = _prints(data, [of[-1]])
                found.append(h[np.unique(np.linspace(0, len(h) - 1, WINDOWS).astype(np.int64))])
            if found:
                at = np.repeat(np.arange(len(found)), list(map(len, found)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at)), pa.array(np.array(of)[at]), pa.array(np.concatenate(found).view(np.int64))], ["_pattern", "_size", "_print"])

    spread = patterns.select("_pattern").repartition(texts.sparkSession.sparkContext.defaultParallelism)
    held = write_out(spread.mapInArrow(cut, "_pattern string, _size long, _print long"), "pattern-prints")
    sizes = sorted(r[0] for r in held.select("_size").distinct().collect())  # a row for each power of two
    if not sizes:
        return texts.select("_key", F.lit("").alias("_pattern")).limit(0)
    texts = texts.select("_key", "_text")
    any_of = _of_texts(texts, sizes, _filter(held, bits), bits)

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some, n = [], 0

        def told() -> pa.RecordBatch:
            h, times = np.unique(np.concatenate(some), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(times.astype(np.int64))], ["_print", "_texts"])

        for _, h in any_of(batches):
            some.append(h)
            n += len(h)
            if n >= _BLOCK:
                yield told()
                some, n = [], 0
        if some:
            yield told()

    seen = texts.mapInArrow(counted, "_print long, _texts long").groupBy("_print").agg(F.sum("_texts").alias("_texts"))
    rarest = held.join(seen, "_print").groupBy("_pattern").agg(F.min(F.struct(F.col("_texts").alias("n"), F.col("_print").alias("print"))).alias("_rarest"))
    filed = write_out(rarest.select("_pattern", F.col("_rarest.print").alias("_print")), "filed-patterns")
    filed_under = _of_texts(texts, sizes, _filter(filed, bits), bits)

    def have(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, h in filed_under(batches):
            yield pa.RecordBatch.from_arrays([keys, pa.array(h.view(np.int64))], ["_key", "_print"])

    salted = texts.mapInArrow(have, "_key binary, _print long").withColumn("_salt", F.pmod(F.xxhash64("_key"), F.lit(SALTS)).cast("int"))
    spread = filed.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(spread, ["_print", "_salt"]).select("_key", "_pattern")


def first_contained(
    facts: DataFrame,
    text: str,
    rules: DataFrame,
    pattern: str,
    ord_col: str,
    same: Sequence[str] = (),
    name: str = "hit",
) -> DataFrame:
    """Add ``name``: the first rule whose pattern occurs in ``text``, by ``ord_col`` and then by pattern.

    ``same`` lists columns that must be equal on both sides; nulls are equal to
    nothing. An empty pattern occurs in every text, a null pattern or text in
    none. Each distinct text is looked up once, whatever the number of rules, and
    tested only for patterns whose rarest substring it has. Rules of one pattern (and equal
    ``same`` columns) come down to the first of them before; empty patterns need no lookup.
    """
    rule = F.struct(*[F.col(c) for c in rules.columns])
    own = [f"_same_{c}" for c in same]
    best = rules.filter(F.col(pattern).isNotNull()).select(rule.alias("_rule"), F.col(pattern).alias("_pattern"), *[F.col(c).alias(k) for c, k in zip(same, own)])
    for k in own:
        best = best.filter(F.col(k).isNotNull())
    first = lambda c: F.min_by(c, F.struct(F.col(c)[ord_col], F.col(c)[pattern]))
    best = write_out(best.groupBy("_pattern", *own).agg(first("_rule").alias("_rule")), "rules")
    keyed = facts.withColumn("_key", F.unhex(F.sha2(F.col(text), 256)))
    texts = write_out(keyed.filter(F.col(text).isNotNull()).select("_key", F.col(text).alias("_text")).distinct(), "looked-up")
    named = best.filter("_pattern <> ''")
    pairs = _candidates(texts, named.select("_pattern").distinct())
    asked = pairs.groupBy("_key").agg(F.collect_list("_pattern").alias("_patterns"))
    held = texts.join(asked, "_key").select("_key", F.explode(F.filter("_patterns", lambda p: F.contains(F.col("_text"), p))).alias("_pattern"))
    groups = keyed.filter(F.col(text).isNotNull()).select("_key", *[F.col(c).alias(k) for c, k in zip(same, own)]).distinct()
    hits = held.join(groups, "_key") if same else held
    hits = hits.join(named, ["_pattern", *own]).groupBy("_key", *own).agg(first("_rule").alias("_hit"))
    # rules without a pattern: one row for each value of ``same``
    always = best.filter("_pattern = ''").select("_rule", *own).withColumnRenamed("_rule", "_always")
    out = keyed.select("*", *[F.col(c).alias(k) for c, k in zip(same, own)]).join(hits, ["_key", *own], "left")
    out = out.join(always, own, "left") if same else out.withColumn("_one", F.lit(1)).join(F.broadcast(always.withColumn("_one", F.lit(1))), "_one", "left")
    order = lambda c: F.struct(F.col(c)[ord_col], F.col(c)[pattern])
    # the key is null where the text is, and the text needn't travel for it
    hit = F.when(F.col("_hit").isNull(), F.col("_always")).when(F.col("_always").isNull() | (order("_hit") <= order("_always")), F.col("_hit")).otherwise(F.col("_always"))
    return out.withColumn(name, F.when(F.col("_key").isNotNull(), hit)).select(*facts.columns, name)


# --- names -------------------------------------------------------------------

def _trims(norm: Column, gap: int) -> Column:
    """The name with up to ``gap`` characters cut from its ends: all shorter names it can hold."""
    cuts = [(a, b) for a in range(gap + 1) for b in range(gap + 1 - a) if a + b > 0]
    return F.array_distinct(F.array(*[
        F.substring(norm, F.lit(a + 1), F.greatest(F.length(norm) - (a + b), F.lit(0))) for a, b in cuts
    ]))


def name_key(name: Column) -> Column:
    """Accent-free lower-case name with single blanks."""
    return F.trim(F.regexp_replace(F.lower(strip_accents(name)), r"(?U)\s+", " "))


def resolve_names(names: DataFrame, known: DataFrame, gap: int = 3) -> DataFrame:
    """Map each name to a slug: known name, near name, or a slug of its own.

    ``names(name, ord)`` in arrival order; ``known(name, slug, ord)`` holds the
    registered names and aliases. ``ord`` is a number or, in ``names``, a struct of
    numbers; registered names come before arrivals, ties go by name. A name equal to an earlier one takes its
    slug; else it takes the slug of the earliest name that contains it or that
    it contains, with at most ``gap`` characters between their lengths; else a
    new slug is made, and later names may match it. Blank names are anonymous.

    Returns ``(name, slug, is_new)`` for each distinct name.
    """
    blank = F.coalesce(F.trim("name"), F.lit("")) == ""
    arrivals = names.select(F.when(blank, F.lit("Anonymous")).otherwise(F.col("name")).alias("name"), "ord")
    arrivals = arrivals.withColumn("norm", name_key(F.col("name")))
    spelled = arrivals.select("name", "norm").distinct()
    # registered places have the shape of arrivals, so that both can be compared
    shape = names.schema["ord"].dataType
    if isinstance(shape, StructType):
        at = F.struct(*[(F.col("ord") if i == 0 else F.lit(0)).cast(f.dataType).alias(f.name) for i, f in enumerate(shape)])
    else:
        at = F.col("ord").cast(shape)
    seeds = known.select(name_key(F.col("name")).alias("norm"), "slug", F.struct(at.alias("at"), F.col("slug")).alias("place"))
    seeds = seeds.groupBy("norm").agg(F.min_by("slug", "place").alias("slug"), F.min("place.at").alias("at"))
    fresh = (
        arrivals.groupBy("norm").agg(F.min_by("name", "ord").alias("name"), F.min("ord").alias("at"))
        .join(seeds.select("norm"), "norm", "left_anti")
    )
    entries = write_out(
        seeds.select("norm", F.lit(0).alias("late"), "at", "slug", F.lit(None).cast("string").alias("name"))
        .unionByName(fresh.select("norm", F.lit(1).alias("late"), "at", F.lit(None).cast("string").alias("slug"), "name")),
        "names",
    )
    place = F.struct("late", "at", "norm")
    short = entries.select(F.col("norm").alias("part"), place.alias("short_place"))
    pairs = (
        entries.select("norm", place.alias("long_place"), F.explode(_trims(F.col("norm"), gap)).alias("part"))
        .join(short, "part")
    )
    # the later of the two looks up to the earlier one; registered names look up to nobody
    later, earlier = F.greatest("long_place", "short_place"), F.least("long_place", "short_place")
    up = (
        pairs.select(later.alias("me"), earlier.alias("other"))
        .filter((F.col("me.late") == 1) & (F.col("me") != F.col("other")))
        .groupBy(F.col("me.norm").alias("norm")).agg(F.min("other").alias("other"))
        .select("norm", F.col("other.norm").alias("up"))
    )
    tree = write_out(
        entries.join(up, "norm", "left").select("norm", F.coalesce("up", "norm").alias("up")), "names"
    )
    # follow the links, twice as far in each turn
    while True:
        hop = tree.select(F.col("norm").alias("up"), F.col("up").alias("top"))
        further = write_out(tree.join(hop, "up").select("norm", F.col("top").alias("up"), (F.col("top") != F.col("up")).alias("moved")), "names")
        tree = further.select("norm", "up")
        if further.filter("moved").isEmpty():
            break
    roots = entries.select(
        F.col("norm").alias("up"), F.coalesce("slug", slugify(F.col("name"))).alias("slug"), F.col("slug").isNull().alias("made")
    )
    found = tree.join(roots, "up").select(
        "norm", "slug", (F.col("made") & (F.col("norm") == F.col("up"))).alias("is_new")
    )
    return spelled.join(found, "norm").select("name", "slug", "is_new")
