"""Earliest-first matching of rows whose keys are prefixes of one another.

The rule is sequential: takers come in order, each takes the first offer of its
group still free whose key equals its own or is a prefix of it or the other way
round. Both sides prefer the other's earlier rows, so a taker and an offer that
are each other's first choice are matched by the rule whatever the rest does;
matching all such pairs at once and repeating gives the rule's result.

Groups of few rows follow the rule itself, as a sorted stream of groups. In
others rows of one group and key act alike and are used up in order, so rounds
run over such classes and the pairs of classes that fit, not over rows: a round
matches whole runs of rows, and what is left of a component in which all takers
want one class only (or all offers are wanted by one) is matched by rank, in no
round at all. Components of few rows follow the rule like small groups.
No group of many rows comes together in one task.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from stemma.operators.ordered import carry_forward, number_within, place
from stemma.session import write_out

#: rows of a group or component that a task follows the rule over; the result doesn't depend on it
SMALL = 50_000
#: matches of an Arrow batch
_BATCH = 10_000
_NEVER = 1 << 62


def _key(group: Column | str, key: Column | str) -> Column:
    """The class of a group and key, in 16 bytes."""
    pair = F.struct(F.col(group).alias("g") if isinstance(group, str) else group.alias("g"), F.col(key).alias("k") if isinstance(key, str) else key.alias("k"))
    return F.substring(F.unhex(F.sha2(F.to_json(pair), 256)), 1, 16)


def _ranked(rows: DataFrame, name: str) -> DataFrame:
    """``c, rank, row``: the class of each row and its number there, from 0."""
    named = rows.select(_key("grp", "key").alias("c"), "row", "key")
    return write_out(number_within(named, ["c"], ["row"], "_n").select("c", (F.col("_n") - 1).cast("long").alias("rank"), "row", "key"), name)


def _fitting(takers: DataFrame, offers: DataFrame) -> DataFrame:
    """``l, r``: classes of takers and offers of which one key is a prefix of the other, and the lengths of both."""
    def classes(rows: DataFrame) -> DataFrame:
        return rows.select("grp", "key").distinct()

    def prefixes(long: DataFrame, short: DataFrame, least: int) -> DataFrame:
        # only lengths that occur on the other side: their number grows with the root of its letters
        sizes = short.groupBy("grp").agg(F.collect_set(F.length("key")).alias("_sizes"))
        n = F.length("key")
        rows = long.join(sizes, "grp").select("grp", "key", F.explode(F.filter("_sizes", lambda s: s <= n - least)).alias("_size"))
        return rows.select(_key("grp", "key").alias("a"), n.alias("a_size"), F.col("_size").alias("b_size"),
                           _key(F.col("grp"), F.substring(F.col("key"), F.lit(1), F.col("_size"))).alias("b"))

    left, right = write_out(classes(takers), "takers"), write_out(classes(offers), "offers")
    down = prefixes(left, right, 0).join(right.select(_key("grp", "key").alias("b")), "b").select(
        F.col("a").alias("l"), F.col("b").alias("r"), F.col("a_size").alias("l_size"), F.col("b_size").alias("r_size"))
    up = prefixes(right, left, 1).join(left.select(_key("grp", "key").alias("b")), "b").select(
        F.col("b").alias("l"), F.col("a").alias("r"), F.col("b_size").alias("l_size"), F.col("a_size").alias("r_size"))
    return write_out(down.unionByName(up), "fitting")


def _two_least(edges: DataFrame, side: str, head: str) -> DataFrame:
    """``side, first, second``: the two earliest heads of the classes a class fits."""
    w = Window.partitionBy(side).orderBy(head)
    best = edges.select(side, head, F.row_number().over(w).alias("_n")).filter("_n <= 2")
    return best.groupBy(side).agg(
        F.min(head).alias("first"), F.coalesce(F.max(F.when(F.col("_n") == 2, F.col(head))), F.lit(_NEVER)).alias("second"))


def _heads(edges: DataFrame, used: DataFrame, ranked: DataFrame, side: str) -> DataFrame:
    """Edges with ``<side>_used`` and ``<side>_head``, the next row of the class; those of classes used up go."""
    next_row = edges.select(F.col(side).alias("c")).distinct().join(used, "c", "left").select(
        "c", F.coalesce("used", F.lit(0)).cast("long").alias("rank"))
    next_row = next_row.join(ranked, ["c", "rank"]).select(
        F.col("c").alias(side), F.col("rank").alias(f"{side}_used"), F.col("row").alias(f"{side}_head"))
    return edges.join(next_row, side)


def _run_length(mutual: DataFrame, ranked: DataFrame, side: str) -> DataFrame:
    """``side, <side>_n``: rows of the class from its head on that come before ``<side>_limit``."""
    asked = mutual.select(F.col(side).alias("c"), f"{side}_used", f"{side}_limit")
    inside = ranked.join(asked, "c").filter((F.col("rank") >= F.col(f"{side}_used")) & (F.col("row") < F.col(f"{side}_limit")))
    return inside.groupBy(F.col("c").alias(side)).agg(F.count(F.lit(1)).alias(f"{side}_n"))


def _rooted(edges: DataFrame) -> DataFrame:
    """Edges with ``root``, the class of the shortest key of their component.

    The prefixes of a key are a chain, so a class is at most two steps from it.
    """
    own = {s: F.struct(F.col(f"{s}_size").alias("size"), F.col(s).alias("c")) for s in "lr"}
    near = edges.withColumn("_least", F.least(own["l"], own["r"]))
    for side in "lrl":
        near = near.join(near.groupBy(side).agg(F.min("_least").alias("_m")), side).drop("_least").withColumnRenamed("_m", "_least")
    return near.withColumn("root", F.col("_least.c")).drop("_least")


class _Offers:
    """The free offers of one group, found by the keys of takers.

    The classes that a key is a prefix of are a stretch of the sorted keys, whose
    first free row a tree of least rows tells; those that are prefixes of it are
    looked up, one for each length that occurs. No pair of classes is listed.
    """

    def __init__(self, offers: list[tuple[str, int]]) -> None:
        self.rows: dict[str, list[int]] = {}
        for key, row in offers:
            self.rows.setdefault(key, []).append(row)
        self.keys = sorted(self.rows)
        self.sizes = sorted({len(k) for k in self.keys})
        self.at = {k: i for i, k in enumerate(self.keys)}
        self.used = [0] * len(self.keys)
        self.least = [_NEVER] * len(self.keys) + [self.rows[k][0] for k in self.keys]
        for i in range(len(self.keys) - 1, 0, -1):
            self.least[i] = min(self.least[2 * i], self.least[2 * i + 1])
        self.known: dict[str, tuple[int, int, list[int]]] = {}

    def classes(self, key: str) -> tuple[int, int, list[int]]:
        """The stretch of classes that start with the key, and those it starts with."""
        n = len(key)
        low = bisect_left(self.keys, key)
        high = bisect_right(self.keys, key, low, key=lambda k: k[:n])
        sizes = self.sizes[: bisect_left(self.sizes, n)]
        return low, high, [i for i in (self.at.get(key[:s]) for s in sizes) if i is not None]

    def take(self, key: str) -> int | None:
        """The first free row that fits, which is free no longer."""
        if key not in self.known:
            self.known[key] = self.classes(key)
        low, high, shorter = self.known[key]
        n, least = len(self.keys), self.least
        best, node = _NEVER, 0
        for i in shorter:
            if least[n + i] < best:
                best, node = least[n + i], n + i
        low, high = low + n, high + n
        while low < high:
            if low & 1:
                if least[low] < best:
                    best, node = least[low], low
                low += 1
            if high & 1:
                high -= 1
                if least[high] < best:
                    best, node = least[high], high
            low, high = low >> 1, high >> 1
        if not node:
            return None
        while node < n:  # down to the class that holds it
            node = 2 * node if least[2 * node] == best else 2 * node + 1
        i = node - n
        self.used[i] += 1
        rows = self.rows[self.keys[i]]
        least[node] = rows[self.used[i]] if self.used[i] < len(rows) else _NEVER
        while node > 1:
            node >>= 1
            least[node] = min(least[2 * node], least[2 * node + 1])
        return best


def _rule(rows: Iterable[tuple[int, str, int]]) -> Iterator[tuple[int, int]]:
    """The rule over the rows ``kind, key, row`` of one group, offers (kind 0) before takers, each in order."""
    offers, free = [], None
    for kind, key, row in rows:
        if kind == 0:
            offers.append((key, row))
        elif not offers:
            return
        else:
            free = free or _Offers(offers)
            if (offer := free.take(key)) is not None:
                yield row, offer


def _stream(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True))
    found: list[tuple[int, int]] = []

    def batch() -> pa.RecordBatch:
        columns = [pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)]
        found.clear()
        return pa.RecordBatch.from_arrays(columns, names=["taker", "offer"])

    for _, group in groupby(rows, key=lambda r: r[0]):
        for pair in _rule(r[1:] for r in group):
            found.append(pair)
            if len(found) >= _BATCH:
                yield batch()
    if found:
        yield batch()


def _follow(rows: DataFrame, name: str) -> DataFrame:
    """The rule over rows ``part, kind, key, row``, each part in one task; kind is 0 for offers and 1 for takers."""
    dealt = rows.select("part", "kind", "key", "row").repartition("part").sortWithinPartitions("part", "kind", "row")
    return write_out(dealt.mapInArrow(_stream, "taker long, offer long"), name)


def _small(edges: DataFrame, l_rows: DataFrame, r_rows: DataFrame, small: int) -> tuple[DataFrame, DataFrame]:
    """The matches of components of up to ``small`` rows, and the edges of the others."""
    rooted = write_out(_rooted(edges), "rooted")
    parts = None
    for kind, side, ranked in ((0, "r", r_rows), (1, "l", l_rows)):
        of = rooted.select(F.col("root").alias("part"), F.col(side).alias("c")).distinct()
        rows = ranked.join(of, "c").select("part", F.lit(kind).alias("kind"), "key", "row")
        parts = rows if parts is None else parts.unionByName(rows)
    parts = write_out(parts, "parts")
    few = write_out(parts.groupBy("part").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") <= small).select("part"), "few")
    done = _follow(parts.join(few, "part", "left_semi"), "followed")
    return done, rooted.join(few.withColumnRenamed("part", "root"), "root", "left_anti").select("l", "r")


def prefix_matches(takers: DataFrame, offers: DataFrame, small: int = SMALL) -> DataFrame:
    """``taker, offer``: the rows matched.

    Both have ``row`` (a long, unique on its side, that gives the order),
    ``grp`` and ``key`` (a string). Rows with a null group or key fit nothing;
    an empty key fits every key of its group. Each row is in one pair at most.
    """
    takers, offers = (write_out(d.select("row", "grp", "key").dropna(), "narrow") for d in (takers, offers))
    # groups known by what their classes are made of; those of many rows are few
    part = F.to_json(F.struct("grp"))
    rows = offers.select(part.alias("part"), F.lit(0).alias("kind"), "key", "row").unionByName(
        takers.select(part.alias("part"), F.lit(1).alias("kind"), "key", "row"))
    large = write_out(rows.groupBy("part").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > small).select("part"), "large")
    if large.isEmpty():
        return _follow(rows, "matches")
    done = _follow(rows.join(large, "part", "left_anti"), "matches")
    takers, offers = (d.withColumn("part", part).join(large, "part", "left_semi").drop("part") for d in (takers, offers))
    return done.unionByName(_large_matches(takers, offers, small))


def _large_matches(takers: DataFrame, offers: DataFrame, small: int) -> DataFrame:
    """``prefix_matches`` of groups of more than ``small`` rows."""
    takers, offers = (write_out(d, "many") for d in (takers, offers))
    l_rows, r_rows = _ranked(takers, "takers"), _ranked(offers, "offers")
    edges = _fitting(takers, offers)
    spark = edges.sparkSession
    none = spark.createDataFrame([], "l binary, r binary, l_used long, r_used long, k long, centre string")
    found, l_used, r_used = [none], *(spark.createDataFrame([], "c binary, used long") for _ in range(2))
    done = None
    while True:
        edges = write_out(_heads(_heads(edges, l_used, l_rows, "l"), r_used, r_rows, "r"), "edges")
        # components in which every class of one side fits one class only are left to ranks
        shown = edges.join(edges.groupBy("l").agg(F.count(F.lit(1)).alias("_l")), "l").join(
            edges.groupBy("r").agg(F.count(F.lit(1)).alias("_r")), "r")
        by_r = shown.groupBy("r").agg(F.max("_l").alias("_most_l"))
        by_l = shown.groupBy("l").agg(F.max("_r").alias("_most_r"))
        shown = shown.join(by_r, "r").join(by_l, "l").withColumn(
            "centre", F.when(F.col("_most_l") == 1, "r").when(F.col("_most_r") == 1, "l"))
        shown = write_out(shown.drop("_l", "_r", "_most_l", "_most_r"), "shown")
        found.append(shown.filter("centre IS NOT NULL").select("l", "r", "l_used", "r_used", F.lit(None).cast("long").alias("k"), "centre"))
        edges = shown.filter("centre IS NULL").drop("centre")
        if done is None:
            done, edges = _small(edges, l_rows, r_rows, small)
            edges = _heads(_heads(edges, l_used, l_rows, "l"), r_used, r_rows, "r")
        if edges.isEmpty():
            break
        of_l = _two_least(edges, "l", "r_head").select("l", F.col("first").alias("_r"), F.col("second").alias("r_limit"))
        of_r = _two_least(edges, "r", "l_head").select("r", F.col("first").alias("_l"), F.col("second").alias("l_limit"))
        mutual = edges.join(of_l, "l").join(of_r, "r").filter("r_head = _r AND l_head = _l")
        mutual = write_out(mutual.select("l", "r", "l_used", "r_used", "l_limit", "r_limit"), "mutual")
        runs = mutual.join(_run_length(mutual, l_rows, "l"), "l").join(_run_length(mutual, r_rows, "r"), "r")
        runs = write_out(runs.select("l", "r", "l_used", "r_used", F.least("l_n", "r_n").alias("k"), F.lit(None).cast("string").alias("centre")), "runs")
        found.append(runs)
        l_used, r_used = (write_out(used.unionByName(runs.select(F.col(s).alias("c"), (F.col(f"{s}_used") + F.col("k")).alias("used")))
                                    .groupBy("c").agg(F.max("used").alias("used")), "used") for s, used in (("l", l_used), ("r", r_used)))
        edges = edges.select("l", "r")
    spans = found[0]
    for part in found[1:]:
        spans = spans.unionByName(part)
    spans = write_out(spans, "spans")
    left, right = _offsets(spans, l_rows, "l"), _offsets(spans, r_rows, "r")
    ranked = left.withColumnRenamed("row", "taker").join(right.withColumnRenamed("row", "offer"), ["span", "at"])
    return ranked.select("taker", "offer").unionByName(done)


def _offsets(spans: DataFrame, ranked: DataFrame, side: str) -> DataFrame:
    """``span, at, row``: the place of each row in the span that its rank falls in."""
    # a span is named by its first rows, one about a centre by the centre
    sign = {n: F.lit(n).cast("binary") for n in "lrs"}
    name = F.when(F.col("centre") == "l", F.concat(sign["l"], "l")).when(F.col("centre") == "r", F.concat(sign["r"], "r")).otherwise(
        F.concat(sign["s"], "l", F.col("l_used").cast("string").cast("binary")))
    leaf = F.col("centre").isNotNull() & (F.col("centre") != side)
    opened = spans.select(F.col(side).alias("c"), F.col(f"{side}_used").alias("rank"), F.struct(
        F.col(side).alias("c"), F.col(f"{side}_used").alias("start"), "k", name.alias("span"), leaf.alias("leaf")).alias("opens")).distinct()
    line = ranked.select("c", "rank", "row", F.lit(None).cast(opened.schema["opens"].dataType).alias("opens")).unionByName(
        opened.withColumn("row", F.lit(None).cast("long")))
    told = carry_forward(place(line, ["c", "rank", F.col("row").asc_nulls_first()]), "opens", "in")
    step = F.col("rank") - F.col("in.start")
    told = told.filter(F.col("row").isNotNull() & (F.col("in.c") == F.col("c")) & (F.col("in.k").isNull() | (step < F.col("in.k"))))
    told = write_out(told.select(F.col("in.span").alias("span"), F.col("in.leaf").alias("leaf"), step.alias("at"), "row"), "told")
    leaves = number_within(told.filter("leaf").select("span", "row"), ["span"], ["row"], "_n")
    return told.filter("NOT leaf").select("span", "at", "row").unionByName(
        leaves.select("span", (F.col("_n") - 1).cast("long").alias("at"), "row"))
