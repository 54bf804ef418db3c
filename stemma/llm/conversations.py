"""Repair of conversations whose turns are blank, repeated, cut off or out of order.

A conversation must read as an optional system turn and then user and assistant by
turns. Its rows are kept, given another role or deleted, and turns are inserted;
the cheapest such edits are found, and of several the ones whose letters (``D``,
``I``, ``K``, ``R``) come first. The dynamic programme over rows and roles keeps the
edits of each cell as a persistent string, so prefixes are shared.

Narrow rows are placed by range of conversation and turn, so that a long one lies
in many tasks; each cuts its rows into segments and says for every role before and
after what the segment costs at least. Segments are short strings of alternatives
in turn, which the same programme chooses among. Texts move once, to where the
repaired conversation is read out in order.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stemma.llm.audit_trie import Node, less
from stemma.llm.common import arrow_of, batch_of, letting_go, small_batches
from stemma.operators.ordered import neighbours, place

#: Rows of a segment.
SEGMENT = 4096
#: White space of the checks.
BLANKS = " \t\n\x0b\f\r"
_ROLES = ("user", "assistant")
_SEEN = {"s": 1, "u": 2, "a": 3}
#: What a turn's role leads to: before the first turn (0), after system, user, assistant (1, 2, 3).
_LEGAL = {(0, 1), (0, 2), (1, 2), (2, 3), (3, 2)}
_PAIRS = {"su", "ua", "au"}


class Costs(NamedTuple):
    """What an edit costs; an insertion must cost something."""

    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5


def _turned(state: int) -> int:
    """The role that may come next by an edit: a user, or an assistant after a user."""
    return 3 if state == 2 else 2


def _better(cells: list, state: int, cost: int, node: Node, letter) -> None:
    """Put ``node`` and one more letter into a cell if that costs less, or as much and comes first."""
    old = cells[state]
    if old is None or cost < old[0]:
        cells[state] = (cost, Node(node, letter))
    elif cost == old[0] and less(new := Node(node, letter), old[1]):
        cells[state] = (cost, new)


def _inserted(cells: list, costs: Costs) -> list:
    """The cells with turns inserted; a state comes to itself only at a cost, so once through is enough."""
    after = list(cells)
    for state in (0, 1, 3):
        if cells[state]:
            _better(after, 2, cells[state][0] + costs.insert, cells[state][1], "I")
    if after[2]:
        _better(after, 3, after[2][0] + costs.insert, after[2][1], "I")
    return after


def _row(cells: list, initial: str, must_go: bool, cut: bool, costs: Costs) -> list:
    """The cells after one row, before which turns may be inserted."""
    before, after = _inserted(cells, costs), [None] * 4
    more = costs.truncated if cut else 0
    role = _SEEN.get(initial)
    for state, cell in enumerate(before):
        if cell is None:
            continue
        cost, node = cell
        _better(after, state, cost + costs.delete, node, "D")
        if must_go:
            continue
        if (state, role) in _LEGAL:
            _better(after, role, cost + more, node, "K")
        _better(after, _turned(state), cost + more + costs.rerole, node, "R")
    return after


def _ranked(cells: list) -> list[tuple[int, int, int, str]]:
    """``state, cost, rank, letters`` of the cells, ranked by their letters.

    No two are equal and none begins another: a segment's strings end with a row's letter.
    """
    found = [(state, *cell) for state, cell in enumerate(cells) if cell]
    return [(state, cost, sum(less(other, node) for _, _, other in found), "".join(node.letters())) for state, cost, node in found]


class _Segment:
    """Rows of one conversation that follow each other in one task."""

    def __init__(self, starts: Iterable[int], costs: Costs) -> None:
        self.cells = {s: [(0, Node()) if t == s else None for t in range(4)] for s in starts}
        self.costs, self.rows = costs, 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = ""
        self.low = self.high = None

    def add(self, turn: int | None, initial: str, blank: bool, cut: bool, seen: bool) -> None:
        duplicate = seen and not blank
        cut = cut and not blank and not seen
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += cut
        if self.rows:
            self.illegal += self.last + initial not in _PAIRS
        else:
            self.first = initial
        self.last = initial
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low, self.high = turn if self.low is None else self.low, turn
        self.rows += 1
        for start, cells in self.cells.items():
            self.cells[start] = _row(cells, initial, blank or duplicate, cut, self.costs)

    def packed(self) -> bytes:
        counts = [self.blank, self.duplicate, self.truncated, self.illegal, self.turns, self.low, self.high, self.first, self.last]
        return zlib.compress(json.dumps([counts, {s: _ranked(c) for s, c in self.cells.items()}]).encode(), 1)


class _Conversation:
    """Segments of one conversation put together in order."""

    def __init__(self, costs: Costs) -> None:
        self.costs, self.segments, self.counts = costs, [], None
        self.cells: list = [(0, Node()), None, None, None]

    def add(self, packed: bytes) -> None:
        counts, tables = json.loads(zlib.decompress(packed))
        self.segments.append(packed)
        after: list = [None] * 4
        for state, cell in enumerate(self.cells):
            for into, cost, rank, _ in tables.get(str(state), []) if cell else []:
                _better(after, into, cell[0] + cost, cell[1], 4 * rank + into)
        self.cells = after
        if self.counts is None:
            self.counts = counts
            return
        a, b = self.counts, counts
        joint = 1 if a[6] is not None and a[6] == b[5] else 0
        low, high = (b[5] if a[5] is None else a[5]), (a[6] if b[6] is None else b[6])
        self.counts = [a[0] + b[0], a[1] + b[1], a[2] + b[2], a[3] + b[3] + (a[8] + b[7] not in _PAIRS), a[4] + b[4] - joint, low, high, a[7], b[8]]

    def ended(self) -> tuple[int, str]:
        """Cost and letters of the cheapest edits that end well."""
        ends = [(c[0], c[1], "") for c in (self.cells[0], self.cells[3]) if c]
        ends += [(c[0] + n * self.costs.insert, c[1], "I" * n) for c, n in ((self.cells[2], 1), (self.cells[1], 2)) if c]
        best = ends[0]
        for end in ends[1:]:
            if end[0] < best[0] or end[0] == best[0] and less(end[1], best[1]):
                best = end
        state, out = 0, []
        for packed, letter in zip(self.segments, best[1].letters(), strict=True):
            table = json.loads(zlib.decompress(packed))[1][str(state)]
            state = letter % 4
            out.append(next(letters for into, _, _, letters in table if into == state))
        return best[0], "".join(out) + best[2]

    def summary(self) -> list[int]:
        """gaps, blank, duplicate, truncated, illegal"""
        if self.counts is None:
            return [0] * 5
        blank, duplicate, truncated, illegal, turns, low, high, _, _ = self.counts
        return [0 if low is None else high - low + 1 - turns, blank, duplicate, truncated, illegal]


def damage(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copies`` of conversations with planted faults.

    ``crc32(conv_id:turn) mod 20`` says which: 0 drops the row (no copies), 1
    empties its text, 2 takes its ``. ! ?`` away, 3 repeats it, 4 sets its role to user.
    Nulls of any column count as one space.
    """
    one = F.lit(" ")
    kind = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), one), F.lit(":"), F.coalesce(F.col("turn").cast("string"), one)).cast("binary")) % 20
    text = F.coalesce(F.col("text"), one)
    return rows.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.when(kind == 4, F.lit("user")).otherwise(F.coalesce(F.col("role"), one)).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


_SEGMENTS = arrow_of("conv_id long, first long, second long, segment binary")
_SUMMARY = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_TURNS = "conv_id long, position long, edit string, role string, text string"


def _segments(facts: DataFrame, costs: Costs, size: int) -> DataFrame:
    """Segments of ``facts`` (a row for rows that are alike): ``conv_id, first, second, segment`` in order of first and second."""
    keys = ["conv_id", "turn", "role", "digest"]
    ordered = facts.repartitionByRange(*keys).sortWithinPartitions(*keys)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letting_go()
        part, seq, now, open_, begun = TaskContext.get().partitionId(), 0, None, None, False
        out: list[tuple] = []
        for batch in batches:
            for conv, turn, initial, blank, cut, seen, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if begun and conv != now and open_:
                    out.append((now, part, seq, open_.packed()))
                    open_ = None
                if not begun or conv != now:  # the first conversation of a task may have begun in another
                    starts = (0,) if begun else range(4)
                now, begun = conv, True
                for k in range(n):
                    if open_ is None:
                        seq += 1
                        open_ = _Segment(starts, costs)
                    open_.add(turn, initial, blank, cut, seen or k > 0)
                    if open_.rows >= size:
                        out.append((now, part, seq, open_.packed()))
                        open_, starts = None, range(4)
            if len(out) > 1000:
                yield batch_of(_SEGMENTS, *zip(*out, strict=True))
                out = []
        if open_:
            out.append((now, part, seq, open_.packed()))
        if out:
            yield batch_of(_SEGMENTS, *zip(*out, strict=True))

    return ordered.select("conv_id", "turn", F.substring("role", 1, 1).alias("initial"), "blank", "cut", "seen", "n").mapInArrow(run, "conv_id long, first long, second long, segment binary")


def _stream(rows: DataFrame, costs: Costs, size: int) -> DataFrame:
    """All segments and then all rows of each conversation, in order, in one task, read as a stream."""
    small_batches(rows.sparkSession)
    if "copies" not in rows.columns:
        rows = rows.withColumn("copies", F.lit(1))
    one = F.lit(" ")
    rows = rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce("role", one).alias("role"), F.coalesce("text", one).alias("text"), F.col("copies").cast("int"))
    rows = rows.withColumn("digest", F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    end = F.rtrim("text", F.lit(BLANKS))
    facts = rows.where("copies > 0").select("conv_id", "turn", "role", "digest", (end == "").alias("blank"), (~F.substring(end, -1, 1).isin(".", "!", "?")).alias("cut"), "copies")
    facts = facts.groupBy("conv_id", "turn", "role", "digest", "blank", "cut").agg(F.sum("copies").alias("n"))
    near = neighbours(place(facts, ["conv_id", "digest", "turn"]), ["conv_id", "digest"])
    seen = F.col("prev_digest").eqNullSafe(F.col("digest")) & F.col("prev_conv_id").eqNullSafe(F.col("conv_id"))
    segments = _segments(near.select(*facts.columns, seen.alias("seen")), costs, size)
    nothing = F.lit(None)
    both = segments.select("conv_id", F.lit(0).alias("kind"), "first", "second", nothing.cast("string").alias("role"), nothing.cast("string").alias("digest"), nothing.cast("string").alias("text"), F.lit(1).alias("copies"), "segment")
    texts = rows.select("conv_id", F.lit(1).alias("kind"), F.col("turn").isNotNull().cast("long").alias("first"), F.col("turn").alias("second"), "role", "digest", "text", "copies", nothing.cast("binary").alias("segment"))
    return both.unionByName(texts).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "first", "second", "role", "digest").select("conv_id", "kind", "role", "text", "copies", "segment")


class _Reader:
    """Reads a repaired conversation out: its audit first, then its rows, of which one is held at a time."""

    def __init__(self, conv_id: int | None, costs: Costs) -> None:
        self.conv_id, self.conversation = conv_id, _Conversation(costs)
        self.cost, self.audit, self.at, self.state, self.position = 0, None, 0, 0, 0

    def settle(self) -> None:
        if self.audit is None:
            self.cost, self.audit = self.conversation.ended()

    def _turn(self, edit: str, role: str, text: str) -> tuple[str, str, str]:
        if edit in "IR":
            self.state = _turned(self.state)
            role = _ROLES[self.state - 2]
        elif edit == "K":
            self.state = _SEEN[role[0]]
        return edit, role, "" if edit == "I" else text

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            yield self._turn("I", "", "")

    def row(self, role: str, text: str, copies: int) -> Iterator[tuple[str, str, str]]:
        """Edit, role and text of each turn that a row and the insertions before it give; deleted ones too."""
        self.settle()
        for _ in range(copies):
            yield from self.inserted()
            edit = self.audit[self.at]
            self.at += 1
            yield self._turn(edit, role, text)


def _read(batches: Iterable[pa.RecordBatch], costs: Costs) -> Iterator[tuple[_Reader, Iterator[tuple[str, str, str]]]]:
    """Each conversation's reader with its turns as they come; the last, empty piece of turns ends it."""
    reader = None
    for batch in batches:
        for conv, kind, role, text, copies, segment in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if reader is None or conv != reader.conv_id:
                if reader:
                    reader.settle()
                    yield reader, reader.inserted()
                    yield reader, None
                reader = _Reader(conv, costs)
            if kind == 0:
                reader.conversation.add(segment)
            elif copies:
                yield reader, reader.row(role, text, copies)
    if reader:
        reader.settle()
        yield reader, reader.inserted()
        yield reader, None


def repair(rows: DataFrame, costs: Costs = Costs(), segment: int = SEGMENT) -> DataFrame:
    """A row for each ``conv_id``: counts of faults, cost and letters of the cheapest edits, digest of the repaired turns.

    ``rows(conv_id, turn, role, text)`` may say with ``copies`` how often a row
    stands there (0: only its conversation counts). Rows are taken by turn, nulls
    first, then by role and by a digest of role and text, so that equal rows are neighbours;
    null roles and texts count as one space, a null ``conv_id`` is a
    conversation of its own. The first fault of a row counts: blank, duplicate (role and text seen earlier),
    truncated (doesn't end with ``. ! ?``). ``gaps`` counts the turns missing
    between the least and the greatest, ``illegal`` neighbours that can't follow each other. Without rows all is 0 and empty.
    The audit has a letter for each row, so its conversation must fit a row; a
    SHA-256 has no parallel form, so the texts of one conversation pass through one task as a sorted stream.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letting_go()
        schema = arrow_of(_SUMMARY)
        out, digest, some = [], hashlib.sha256(), False
        for reader, turns in _read(batches, costs):
            if turns is None:
                out.append((reader.conv_id, *reader.conversation.summary(), reader.cost, reader.audit, digest.hexdigest()))
                digest, some = hashlib.sha256(), False
                if len(out) >= 1000:
                    yield batch_of(schema, *zip(*out, strict=True))
                    out = []
                continue
            for edit, role, text in turns:
                if edit != "D":
                    digest.update(f"\n{role}:{text}".encode()[not some :])
                    some = True
        if out:
            yield batch_of(schema, *zip(*out, strict=True))

    return _stream(rows, costs, segment).mapInArrow(run, _SUMMARY)


def repaired_turns(rows: DataFrame, costs: Costs = Costs(), segment: int = SEGMENT) -> DataFrame:
    """The turns of the repaired conversations: ``conv_id, position`` (from 0), ``edit, role, text``. Takes what ``repair`` takes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letting_go()
        schema, out = arrow_of(_TURNS), []
        for reader, turns in _read(batches, costs):
            for edit, role, text in turns or ():
                if edit != "D":
                    out.append((reader.conv_id, reader.position, edit, role, text))
                    reader.position += 1
            if len(out) >= 1000:
                yield batch_of(schema, *zip(*out, strict=True))
                out = []
        if out:
            yield batch_of(schema, *zip(*out, strict=True))

    return _stream(rows, costs, segment).mapInArrow(run, _TURNS)
