"""Sections of issues to pieces over rows: no issue lies in a row, a group or a task."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stemma.functions import text as T
from stemma.operators.greedy import prefix_matches
from stemma.operators.ordered import number_within, place
from stemma.session import write_out


def route_rows(sections: DataFrame, pieces: DataFrame) -> DataFrame:
    """One-to-one routing of section rows: ``cahier, pos, piece_slug, seq, sec, head, body, matched_by``.

    ``sections(cahier, sec, head, body)`` in the order of ``sec``; a null head
    marks the text before the first heading. ``pieces(cahier, pos, piece_slug,
    title)``. The rule is that of ``segmentation.route_sections`` with
    ``one_to_one``: each section in order takes the first piece still empty
    whose slug and its own are equal or one a prefix of the other (``slug``);
    the others fill the empty pieces in order (``order``), what is left goes to
    the last piece (``rest``). An issue's only piece takes everything
    (``single``); without a heading the text goes to the first (``whole``);
    text before the first heading goes nowhere else.

    A row per section, numbered by ``seq`` in its piece, and one with nulls for
    a piece that gets none. Ties in ``sec`` go by head and text, in ``pos`` by
    slug and title. Rows of null or unlisted issues are left out; a title
    or heading that is null or without a letter counts as ``untitled``.
    """
    # slugs are made once, where the rows are written: placing reads its rows twice
    kept = write_out(sections.filter(F.col("cahier").isNotNull()).select(
        F.monotonically_increasing_id().alias("_id"), "cahier", "sec", "head", "body",
        F.when(F.col("head").isNotNull(), T.slugify(F.col("head"))).alias("_key"), F.xxhash64("head", "body").alias("_mark")), "sections")
    lean = place(kept.select("_id", "cahier", "sec", F.col("_key").alias("key"), "_mark"), ["cahier", "sec", "key", "_mark", "_id"]).select(
        F.col("row_no").alias("section"), "_id", "cahier", "key")
    listed = write_out(pieces.filter(F.col("cahier").isNotNull()).select(
        "cahier", "pos", "piece_slug", "title", T.slugify(F.col("title")).alias("key")), "pieces")
    listed = place(listed, ["cahier", "pos", "piece_slug", "title"]).drop("_part", "_slot")
    # what is known of an issue is one narrow row
    count = listed.groupBy("cahier").agg(F.count(F.lit(1)).alias("n"), F.min("row_no").alias("first"), F.max("row_no").alias("last"))
    headings = lean.groupBy("cahier").agg(F.max(F.col("key").isNotNull()).alias("headed"))
    lean = write_out(lean.join(count, "cahier").join(headings, "cahier"), "lean")

    many = lean.filter("n > 1 AND headed AND key IS NOT NULL")
    takers = many.select(F.col("section").alias("row"), F.col("cahier").alias("grp"), "key")
    offers = listed.join(many.select("cahier").distinct(), "cahier", "left_semi").select(
        F.col("row_no").alias("row"), F.col("cahier").alias("grp"), "key")
    offers = write_out(offers, "offers")
    matched = write_out(prefix_matches(takers, offers), "matched")

    rest = many.join(matched.select(F.col("taker").alias("section")), "section", "left_anti").select("section", "cahier", "last")
    rest = number_within(rest, ["cahier"], ["section"], "turn")
    open_ = offers.join(matched.select(F.col("offer").alias("row")), "row", "left_anti").select(F.col("grp").alias("cahier"), F.col("row").alias("piece"))
    open_ = write_out(number_within(open_, ["cahier"], ["piece"], "turn"), "open")
    opened = open_.groupBy("cahier").agg(F.max("turn").alias("_open"))
    # joined by issue and turn, so that no issue is one key
    rest = rest.join(open_, ["cahier", "turn"], "left").join(opened, "cahier", "left").select(
        "section", F.coalesce("piece", "last").alias("piece"),
        F.when(F.col("piece").isNotNull(), 0).otherwise(F.col("turn") - F.coalesce("_open", F.lit(0))).cast("long").alias("seq"),
        F.when(F.col("piece").isNotNull(), "order").otherwise("rest").alias("matched_by"))
    alone = lean.filter("n = 1 OR NOT headed").select("section", "cahier", "n", "first")
    alone = number_within(alone, ["cahier"], ["section"], "turn").select(
        "section", F.col("first").alias("piece"), (F.col("turn") - 1).cast("long").alias("seq"),
        F.when(F.col("n") == 1, "single").otherwise("whole").alias("matched_by"))
    told = matched.select(F.col("taker").alias("section"), F.col("offer").alias("piece"), F.lit(0).cast("long").alias("seq"),
                          F.lit("slug").alias("matched_by")).unionByName(rest).unionByName(alone)
    told = write_out(told.join(lean.select("section", "_id"), "section").drop("section"), "told")

    named = listed.select(F.col("row_no").alias("piece"), "cahier", "pos", "piece_slug")
    routed = told.join(named, "piece").drop("piece").join(kept.select("_id", "sec", "head", "body"), "_id")
    empty = named.join(told.select("piece").distinct(), "piece", "left_anti")
    columns = ["cahier", "pos", "piece_slug", "seq", "sec", "head", "body", "matched_by"]
    return routed.select(*columns).unionByName(empty.select("cahier", "pos", "piece_slug"), allowMissingColumns=True)
