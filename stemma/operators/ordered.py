"""Row numbers and neighbours over a total order, without a one-task window.

A window without a partition, or over a key that holds a large share of the
rows, sorts everything in one task. Here rows are placed by range of the whole
sort key (a hot key is spread over several ranges), written once, and numbered
by adding each range's offset. Only one row per range is ever brought together.
The sort key must be total, so that a retried task places rows the same way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from stemma.session import write_out

_PLACE, _PART, _SLOT = "_place", "_part", "_slot"


def _columns(by: Sequence[str | Column]) -> list[Column]:
    return [F.col(b) if isinstance(b, str) else b for b in by]


def place(df: DataFrame, by: Sequence[str | Column]) -> DataFrame:
    """Rows in sort order with ``_part`` (range number), ``_slot`` and ``row_no`` (1..n)."""
    keys = _columns(by)
    placed = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn(_PLACE, F.monotonically_increasing_id())
    )
    placed = (
        write_out(placed, "ordered")
        .withColumn(_PART, F.shiftright(_PLACE, 33))
        .withColumn(_SLOT, F.col(_PLACE).bitwiseAND((1 << 33) - 1))
        .drop(_PLACE)
    )
    # one row per range: bounded by the number of shuffle partitions
    sizes = placed.groupBy(_PART).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(_PART, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return placed.join(F.broadcast(offsets), _PART).withColumn(
        "row_no", F.col("_before") + F.col(_SLOT) + 1
    ).drop("_before")


def tidy(placed: DataFrame) -> DataFrame:
    """Drop the placement columns."""
    return placed.drop(_PART, _SLOT, "row_no")


def rank_rows(df: DataFrame, by: Sequence[str | Column], name: str = "rank") -> DataFrame:
    """Exact 1..n rank in the given total order."""
    return place(df, by).withColumnRenamed("row_no", name).drop(_PART, _SLOT)


def neighbours(
    placed: DataFrame, columns: Sequence[str], group: str | None = None
) -> DataFrame:
    """Add ``prev_<c>`` and ``next_<c>`` for each column, within ``group`` if given."""
    row = F.struct(*[F.col(c) for c in columns], *([F.col(group).alias("_group")] if group else []))
    within = Window.partitionBy(_PART).orderBy(_SLOT)
    rows = (
        placed.withColumn("_row", row)
        .withColumn("_prev", F.lag("_row").over(within))
        .withColumn("_next", F.lead("_row").over(within))
    )
    # first and last row of each range, handed to the range next to it
    edges = placed.withColumn("_row", row).groupBy(_PART).agg(
        F.min_by("_row", _SLOT).alias("_first"), F.max_by("_row", _SLOT).alias("_last")
    )
    across = Window.orderBy(_PART)
    edges = edges.select(
        _PART, F.lag("_last").over(across).alias("_before"), F.lead("_first").over(across).alias("_after")
    )
    rows = rows.join(F.broadcast(edges), _PART)
    prev, nxt = F.coalesce("_prev", "_before"), F.coalesce("_next", "_after")
    if group:
        prev = F.when(prev["_group"].eqNullSafe(F.col(group)), prev)
        nxt = F.when(nxt["_group"].eqNullSafe(F.col(group)), nxt)
    rows = rows.withColumn("_p", prev).withColumn("_q", nxt)
    for c in columns:
        rows = rows.withColumn(f"prev_{c}", F.col("_p")[c]).withColumn(f"next_{c}", F.col("_q")[c])
    return rows.drop("_row", "_prev", "_next", "_before", "_after", "_p", "_q")


def number_within(
    df: DataFrame, group: Sequence[str], by: Sequence[str | Column], name: str = "seq"
) -> DataFrame:
    """1..n inside each group; a hot group is spread over several ranges."""
    placed = place(df, [*group, *by])
    starts = placed.groupBy(*group).agg(F.min("row_no").alias("_start"))
    on = [F.col(f"p.{g}").eqNullSafe(F.col(f"s.{g}")) for g in group]
    joined = placed.alias("p").join(starts.alias("s"), on)
    return joined.select(
        *[F.col(f"p.{c}").alias(c) for c in df.columns],
        (F.col("p.row_no") - F.col("s._start") + 1).cast("int").alias(name),
    )


def first_per_group(df: DataFrame, group: Sequence[str], by: Column, n: int) -> DataFrame:
    """The first ``n`` rows of each group with their number ``pos``.

    The limit is applied inside each input partition before the shuffle, so at
    most ``n`` rows per group and partition travel.
    """
    w = Window.partitionBy(*group).orderBy(by)
    return df.withColumn("pos", F.row_number().over(w)).filter(F.col("pos") <= n)


def carry_forward(placed: DataFrame, column: str, name: str) -> DataFrame:
    """Add ``name``: the value of ``column``, or the last one before it that is not null."""
    within = Window.partitionBy(_PART).orderBy(_SLOT).rowsBetween(Window.unboundedPreceding, 0)
    rows = placed.withColumn("_here", F.last(column, ignorenulls=True).over(within))
    lasts = placed.groupBy(_PART).agg(
        F.max_by(column, F.when(F.col(column).isNotNull(), F.col(_SLOT))).alias("_last")
    )
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    carried = lasts.select(_PART, F.last("_last", ignorenulls=True).over(before).alias("_carried"))
    return rows.join(F.broadcast(carried), _PART).withColumn(
        name, F.coalesce("_here", "_carried")
    ).drop("_here", "_carried")


def running_sum(placed: DataFrame, column: str, name: str) -> DataFrame:
    """Add ``name``: the sum of ``column`` over all rows up to this one."""
    within = Window.partitionBy(_PART).orderBy(_SLOT).rowsBetween(Window.unboundedPreceding, 0)
    sums = placed.groupBy(_PART).agg(F.sum(column).alias("_sum"))
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(_PART, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_carried"))
    return placed.withColumn("_here", F.sum(column).over(within)).join(F.broadcast(offsets), _PART).withColumn(
        name, F.col("_here") + F.col("_carried")
    ).drop("_here", "_carried")
