"""Ordered parts back to whole documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def assemble(
    parts: DataFrame,
    key: str,
    pos: str,
    text: str,
    sep: str,
    per_segment: int | None = None,
    extra: dict[str, Column] | None = None,
) -> DataFrame:
    """Join parts in order: ``key, segment, body``, one row per document.

    A document is collected in one task and must fit one row: under 2 GB of text,
    and its parts, sorted and joined, in that task's memory. For larger ones, with ``per_segment``, positions
    (from 0) are cut into numbered segments of so many; joined with ``sep`` they
    give the document.
    """
    segment = F.lit(0) if per_segment is None else F.floor(F.col(pos) / per_segment)
    placed = parts.withColumn("segment", segment.cast("int"))
    return placed.groupBy(key, "segment").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct(F.col(pos), F.col(text)))), lambda p: p[text]), sep
        ).alias("body"),
        *[c.alias(name) for name, c in (extra or {}).items()],
    )


def seam_join(parts: Column) -> Column:
    """Join ordered transcription parts.

    A part ending in a hyphen is glued to a following lower-case letter, a part
    ending without closing punctuation is joined to a lower-case continuation
    with a blank, any other seam is a paragraph break.
    """
    trimmed = F.transform(parts, lambda p: F.trim(p))
    first = F.array_position(F.transform(trimmed, lambda p: p != ""), True).cast("int")  # empty parts before it count for nothing
    trimmed = F.when(first > 0, F.slice(trimmed, F.greatest(first, F.lit(1)), F.greatest(F.size(trimmed), F.lit(1)))).otherwise(F.array().cast("array<string>"))

    def seam(part: Column, following: Column) -> Column:
        lower = following.rlike(r"^\p{Ll}")
        return (
            F.when(following.isNull(), part)
            .when(part.rlike(r"\p{L}-$") & lower, F.regexp_replace(part, "-$", ""))
            .when(~part.rlike(r"[.!?…»:;]$") & lower, F.concat(part, F.lit(" ")))
            .otherwise(F.concat(part, F.lit("\n\n")))
        )

    # a seam depends on the parts beside it alone, so all are set first and joined once
    shifted = F.transform(F.array(trimmed), lambda a: F.array_join(F.zip_with(a, F.slice(a, 2, F.greatest(F.size(a), F.lit(1))), seam), ""))
    return shifted[0]
