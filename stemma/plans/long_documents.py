"""Documents larger than a row: chunks and missing chunks over rows.

No job here holds a document in a row, a group or a task. Rows are placed by
range of document and position, so one document may lie in any number of
ranges, and only narrow rows (numbers and sums) travel between them.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from stemma.functions import text as T
from stemma.operators.ordered import carry_forward, neighbours, place, running_sum
from stemma.plans.segmentation import CHUNK_WORDS
from stemma.session import write_out

#: rows that one task looks at together; the result doesn't depend on it
BLOCK = 1 << 14


def _opens() -> Column:
    """True for the first row of a document, in rows that know ``prev_doc``."""
    return (F.col("row_no") == 1) | ~F.col("prev_doc").eqNullSafe(F.col("doc"))


# --- chunks --------------------------------------------------------------------

def chunk_rows(paragraphs: DataFrame, target: int = CHUNK_WORDS, by: Sequence[str] = ("pos",), block: int = BLOCK) -> DataFrame:
    """Greedy chunks of documents of any length: ``doc, idx, total, words, text``.

    ``paragraphs(doc, text, *by)`` has one row per paragraph, in the order of
    ``by`` (ties by text). Gives the chunks of ``segmentation.chunk``: a
    paragraph opens a new one if the words would pass ``target``. Null and
    blank paragraphs are left out, a document of these alone has no chunk;
    null documents count as one document.

    A chunk's end is found by search in the running sum of words, to which
    each document's first row adds more than ``target``, so that no chunk
    reaches over it. In blocks of rows these hops are followed at once; only
    the few rows at which a block can be entered are linked from block to
    block, and these links are followed in doubling steps.
    """
    rows = paragraphs.select("doc", *by, "text").filter(T.strip_blank(F.col("text")) != "")
    placed = place(rows, ["doc", *by, "text"])
    # words are counted once, after the placing, which evaluates its rows twice
    narrow = write_out(placed.select("_part", "_slot", "row_no", "doc", T.token_count(F.col("text")).cast("long").alias("words")), "narrow")
    sums = neighbours(narrow, ["doc"]).withColumn("opens", _opens()).drop("prev_doc", "next_doc")
    sums = running_sum(sums.withColumn("_step", F.col("words") + F.when(F.col("opens"), target + 1).otherwise(0)), "_step", "upto")
    sums = write_out(sums.drop("_step").withColumn("block", F.floor((F.col("row_no") - 1) / block)), "sums")
    hops = write_out(sums.select("row_no", "words", "opens", "upto", "block").groupBy("block").applyInPandas(
        _hops(target), "row_no long, block long, opens boolean, next long, tail long, reach long"), "hops")
    starts = _starts(hops, _entered(hops, _exits(sums, hops))).withColumn("start", F.lit(1))

    # chunks are numbered over all documents, then from each document's first
    marks = write_out(sums.drop("upto", "block").join(starts, "row_no", "left").fillna(0, ["start"]), "marks")
    marks = running_sum(marks, "start", "chunk")
    marks = carry_forward(marks.withColumn("_head", F.when(F.col("opens"), F.col("chunk"))), "_head", "head")
    marks = marks.select("row_no", "doc", "words", "start", "chunk", (F.col("chunk") - F.col("head")).cast("int").alias("idx"))
    marks = write_out(marks, "chunk_of")
    totals = marks.groupBy(F.col("doc").alias("_doc")).agg((F.max("idx") + 1).alias("total"))
    named = marks.filter("start = 1").join(totals, F.col("doc").eqNullSafe(F.col("_doc"))).select("chunk", "doc", "idx", "total")
    # texts move by row number, then by chunk; names come to the chunks, which stay where they are
    texts = placed.select("row_no", "text").join(marks.select("row_no", "words", "chunk"), "row_no").groupBy("chunk").agg(
        F.sum("words").cast("int").alias("words"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row_no", "text"))), lambda p: p["text"]), "\n\n").alias("text"))
    return texts.join(named, "chunk").select("doc", "idx", "total", "words", "text")


def _hops(target: int):
    """In a block: each row's next start and the last start reached from it (``tail``) with its reach.

    ``next`` is null where it lies beyond the block or opens a document;
    ``tail`` is null where the way ends at such an opening, a start anyway.
    """
    def hops(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("row_no")
        number, upto, opens = rows["row_no"].to_numpy(), rows["upto"].to_numpy(), rows["opens"].to_numpy()
        reach, at, n = upto - rows["words"].to_numpy() + target, np.arange(len(rows)), len(rows)
        after = np.maximum(np.searchsorted(upto, reach, side="right"), at + 1)
        inside = after < n
        ends = inside & opens[np.minimum(after, n - 1)]
        on = inside & ~ends
        tail = np.where(on, after, at)
        while not np.array_equal(further := tail[tail], tail):
            tail = further
        following = pd.Series(number[np.minimum(after, n - 1)], dtype="Int64").mask(~on)
        last = pd.Series(number[tail], dtype="Int64").mask(ends[tail])
        return pd.DataFrame({"row_no": number, "block": rows["block"].to_numpy(), "opens": opens,
                             "next": following, "tail": last, "reach": reach[tail]})
    return hops


def _exits(sums: DataFrame, hops: DataFrame) -> DataFrame:
    """``tail, goto``: the first row of a later block whose sum passes the reach of a block's tail."""
    tails = hops.filter(F.col("tail") == F.col("row_no"))
    # rows and reaches in one order; the rows before a reach are counted
    line = sums.select(F.col("upto").alias("at"), F.lit(1).alias("row"), F.col("row_no").alias("no")).unionByName(
        tails.select(F.col("reach").alias("at"), F.lit(0).alias("row"), F.col("row_no").alias("no")))
    counted = running_sum(place(line, ["at", F.col("row").desc(), "no"]), "row", "below")
    return counted.filter("row = 0").select(F.col("no").alias("tail"), (F.greatest("below", "no") + 1).alias("goto"))


def _entered(hops: DataFrame, exits: DataFrame) -> DataFrame:
    """``row_no`` of the starts at which a document's chunks enter a further block."""
    exits = write_out(exits, "exits")
    inner = hops.filter(~F.col("opens")).join(exits.select(F.col("goto").alias("row_no")).distinct(), "row_no", "left_semi")
    nodes = write_out(hops.filter("opens").unionByName(inner).select("row_no", "opens", "tail"), "nodes")
    links = nodes.join(exits, "tail").select(F.col("row_no").alias("a"), F.col("goto").alias("b"), "opens")
    links = write_out(links.join(nodes.filter(~F.col("opens")).select(F.col("row_no").alias("b")), "b", "left_semi"), "links")
    found, jumps = links.filter("opens").select("a"), links.select("a", "b")
    while not jumps.isEmpty():
        found = write_out(found.unionByName(found.join(jumps, "a").select(F.col("b").alias("a"))), "found")
        jumps = write_out(jumps.join(jumps.select(F.col("a").alias("b"), F.col("b").alias("c")), "b").select("a", F.col("c").alias("b")), "jumps")
    return found.select(F.col("a").alias("row_no"))


def _starts(hops: DataFrame, entered: DataFrame) -> DataFrame:
    """``row_no`` of every chunk's first row: the ways from openings and entries, followed in their blocks."""
    def walk(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("row_no")
        number = rows["row_no"].to_numpy()
        after = (rows["next"].fillna(number[0]) - number[0]).astype("int64").to_numpy()
        marked = rows["marked"].to_numpy().copy()
        for at in np.flatnonzero(marked):
            while (at := after[at]) and not marked[at]:
                marked[at] = True
        return pd.DataFrame({"row_no": number[marked]})

    marks = hops.select("row_no", "block", "opens", "next").join(entered.withColumn("entered", F.lit(True)), "row_no", "left")
    marks = marks.select("row_no", "block", "next", (F.col("opens") | F.coalesce("entered", F.lit(False))).alias("marked"))
    return marks.groupBy("block").applyInPandas(walk, "row_no long")


def missing_chunks(manifest: DataFrame, chunks: DataFrame) -> DataFrame:
    """``doc, idx`` of the chunks of ``manifest(doc, idx)`` that ``chunks(doc, idx, text)`` lacks or has blank only."""
    there = chunks.filter(T.strip_blank(F.col("text")) != "").select("doc", "idx")
    return manifest.select("doc", "idx").distinct().join(there, ["doc", "idx"], "left_anti")
