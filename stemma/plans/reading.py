"""Reading views: river, issue, piece, author and work pages as tables.

Pieces of an issue travel exploded, as ``declared(cahier, pos, piece_slug,
title, author, is_notice)``; ``explode_pieces`` makes that from the nested
catalog.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stemma.functions import text as T
from stemma.operators.ordered import carry_forward, neighbours, place, tidy


def explode_pieces(cahiers: DataFrame) -> DataFrame:
    rows = cahiers.select(F.col("slug").alias("cahier"), F.posexplode("pieces").alias("pos", "_p"))
    return rows.select(
        "cahier", "pos", F.col("_p.slug").alias("piece_slug"), F.col("_p.title_fr").alias("title"),
        F.col("_p.author").alias("author"), F.coalesce("_p.is_notice", F.lit(False)).alias("is_notice"),
    )


def language_pivot(pieces: DataFrame) -> DataFrame:
    """Which languages each piece has: ``cahier, piece_slug, fr, en``."""
    return pieces.groupBy("cahier", "piece_slug").agg(
        F.bool_or(F.col("lang") == "fr").alias("fr"), F.bool_or(F.col("lang") == "en").alias("en")
    )


def primary_language(fr: Column, en: Column, chrome: str) -> Column:
    first, second = ("en", "fr") if chrome == "en" else ("fr", "en")
    has = {"fr": fr, "en": en}
    return F.when(has[first], first).when(has[second], second)


def other_language(fr: Column, en: Column, chrome: str) -> Column:
    return F.when(fr & en, "fr" if chrome == "en" else "en")


def with_languages(rows: DataFrame, langs: DataFrame) -> DataFrame:
    """Add ``fr`` and ``en``; a piece without text has neither."""
    return rows.join(langs, ["cahier", "piece_slug"], "left").withColumns({
        "fr": F.coalesce("fr", F.lit(False)), "en": F.coalesce("en", F.lit(False))
    })


def with_author_names(rows: DataFrame, authors: DataFrame) -> DataFrame:
    """Add ``author_name``, falling back to the id."""
    names = authors.select(F.col("slug").alias("author"), F.col("name").alias("author_name"))
    return rows.join(names, "author", "left").withColumn("author_name", F.coalesce("author_name", "author"))


def issue_neighbours(cahiers: DataFrame) -> DataFrame:
    """Previous and next issue in (series, issue) order: ``slug, prev_slug, next_slug``."""
    placed = place(cahiers.select("slug", "series", "issue"), ["series", "issue", "slug"])
    return neighbours(placed, ["slug"]).select("slug", "prev_slug", "next_slug")


def series_overview(cahiers: DataFrame) -> DataFrame:
    """First issue and first dated year of each series in catalog order."""
    at = F.struct("issue", "slug")
    return cahiers.groupBy("series").agg(
        F.min_by("slug", at).alias("first_slug"),
        F.min_by(T.year_of(F.col("date")), F.when(F.col("date").isNotNull(), at)).alias("year"),
    ).withColumn("roman", T.roman(F.col("series")))


def publication_order(cahiers: DataFrame) -> DataFrame:
    """Placed rows in order of (date, series, issue); an undated issue takes the last date before it."""
    if cahiers.filter(F.col("date").isNull()).isEmpty():
        rows = cahiers.withColumn("order_date", F.col("date"))
    else:
        rows = tidy(carry_forward(place(cahiers, ["series", "issue", "slug"]), "date", "order_date"))
    return place(rows, [F.asc_nulls_first("order_date"), "series", "issue", "slug"])


def river(cahiers: DataFrame) -> DataFrame:
    """All issues in publication order with series starts and series years.

    ``cahiers(slug, series, issue, label, title, date, …)``.
    """
    placed = publication_order(cahiers)
    years = placed.filter(F.col("date").isNotNull()).groupBy("series").agg(
        F.min_by(T.year_of(F.col("date")), "row_no").alias("series_year")
    )
    rows = neighbours(placed, ["series"]).join(years, "series", "left")
    keep = [c for c in cahiers.columns if c not in ("series",)]
    return rows.select(
        F.col("row_no").alias("river_no"), "series", *keep,
        (~F.col("prev_series").eqNullSafe(F.col("series"))).alias("is_series_start"),
        T.roman(F.col("series")).alias("series_roman"), "series_year",
    )


def works_of_issues(parts: DataFrame, works: DataFrame) -> DataFrame:
    """Works an issue belongs to, unresolved references dropped: ``cahier, work, title``.

    ``parts(cahier, work)``: the exploded references.
    """
    return parts.join(works.select(F.col("slug").alias("work"), "title"), "work").select("cahier", "work", "title")


def cahier_view(
    cahiers: DataFrame, declared: DataFrame, pieces: DataFrame, authors: DataFrame, chrome: str = "en"
) -> DataFrame:
    """Rows of an issue page: pieces with author, languages and the issues around.

    ``pieces(cahier, piece_slug, lang)`` are the texts there are.
    """
    rows = with_languages(with_author_names(declared, authors), language_pivot(pieces))
    rows = rows.join(
        issue_neighbours(cahiers).select(F.col("slug").alias("cahier"), "prev_slug", "next_slug"), "cahier", "left"
    )
    primary = primary_language(F.col("fr"), F.col("en"), chrome)
    return rows.select(
        "cahier", "pos", "piece_slug", "author_name",
        primary.alias("primary_lang"),
        other_language(F.col("fr"), F.col("en"), chrome).alias("other_lang"),
        (~F.col("fr") & ~F.col("en")).alias("is_pending"),
        F.col("prev_slug").alias("prev"), F.col("next_slug").alias("next"),
    )


def piece_view(pieces: DataFrame, declared: DataFrame, cahiers: DataFrame, authors: DataFrame) -> DataFrame:
    """Rows of a piece page: label, author, other language, pieces before and after.

    ``pieces(cahier, piece_slug, lang, author)``.
    """
    order = neighbours(
        place(declared.select("cahier", "pos", "piece_slug"), ["cahier", "pos", "piece_slug"]), ["piece_slug"], "cahier"
    ).select("cahier", "piece_slug", "prev_piece_slug", "next_piece_slug")
    rows = with_author_names(pieces, authors).join(order, ["cahier", "piece_slug"], "left")
    rows = rows.join(language_pivot(pieces), ["cahier", "piece_slug"])
    rows = rows.join(cahiers.select(F.col("slug").alias("cahier"), "label"), "cahier", "left")
    other = F.when(F.col("lang") == "fr", F.col("en")).otherwise(F.col("fr"))
    return rows.select(
        "cahier", "label", "piece_slug", "lang", "author_name", other.alias("other_lang_exists"),
        F.col("prev_piece_slug").alias("prev_piece"), F.col("next_piece_slug").alias("next_piece"),
    )


def author_index(authors: DataFrame, locale: str = "fr") -> DataFrame:
    """Authors by surname in the locale's order, years cut to four characters or ``?``."""
    key = F.coalesce(F.nullif("name_sort", F.lit("")), F.col("name"))
    dated = F.col("born").isNotNull() | F.col("died").isNotNull()
    years = F.when(dated, F.concat(
        F.coalesce(F.substring("born", 1, 4), F.lit("?")), F.lit("–"), F.coalesce(F.substring("died", 1, 4), F.lit("?"))
    ))
    rows = authors.select("slug", "name", key.alias("sort_key"), "is_editor", years.alias("years"))
    return rows.orderBy(F.collate("sort_key", locale), "slug")


def author_contributions(
    authors: DataFrame, cahiers: DataFrame, declared: DataFrame, pieces: DataFrame
) -> DataFrame:
    """Every author's pieces in catalog order; authors without one keep a row.

    Returns ``author, kind, series, issue, cahier, pos, piece_slug, fr, en``,
    sorted by author, series, issue and position. The large side is joined to the authors, not the other way
    round, so a prolific author can be split over tasks.
    """
    known = authors.select(F.col("slug").alias("author"), "is_editor")
    rows = declared.join(known, "author")
    rows = with_languages(rows, language_pivot(pieces))
    rows = rows.join(cahiers.select(F.col("slug").alias("cahier"), "series", "issue"), "cahier")
    kind = F.when(F.col("is_editor") & F.col("is_notice"), "notice").otherwise("writing")
    rows = rows.select("author", kind.alias("kind"), "series", "issue", "cahier", "pos", "piece_slug", "fr", "en")
    idle = known.join(declared.select("author").distinct(), "author", "left_anti").select("author")
    return rows.unionByName(idle, allowMissingColumns=True).orderBy("author", "series", "issue", "pos")


def contribution_counts(contributions: DataFrame) -> DataFrame:
    """Pieces per author and kind; 0 for authors without any."""
    return contributions.groupBy("author").agg(
        F.count("piece_slug").alias("n"),
        F.count(F.when(F.col("kind") == "notice", 1)).alias("n_notices"),
    )


def notice_targets(pieces: DataFrame, declared: DataFrame) -> DataFrame:
    """Piece each notice introduces, in the same issue: ``cahier, piece_slug, target, target_title``."""
    notices = pieces.filter(F.col("introduces_piece").isNotNull()).select(
        "cahier", "piece_slug", F.col("introduces_piece").alias("target")
    ).distinct()
    targets = declared.select("cahier", F.col("piece_slug").alias("target"), F.col("title").alias("target_title"))
    return notices.join(targets, ["cahier", "target"]).select("cahier", "piece_slug", "target", "target_title")


def work_view(parts: DataFrame, cahiers: DataFrame, declared: DataFrame, pieces: DataFrame) -> DataFrame:
    """Instalments of each work in order; unresolved ones stay.

    ``parts(work, pos, cahier, piece_slug, label)``. Returns ``work, part_no,
    title, cahier_label, cahier, piece_slug, fr, en``.
    """
    rows = parts.join(declared.select("cahier", "piece_slug", "title"), ["cahier", "piece_slug"], "left")
    rows = with_languages(rows, language_pivot(pieces))
    rows = rows.join(
        cahiers.select(F.col("slug").alias("cahier"), F.col("label").alias("cahier_label")), "cahier", "left"
    )
    return rows.select(
        "work", (F.col("pos") + 1).alias("part_no"), F.coalesce("label", "title", "piece_slug").alias("title"),
        "cahier_label", "cahier", "piece_slug", "fr", "en",
    )


def explode_parts(works: DataFrame) -> DataFrame:
    """Parts of the nested works table for ``work_view``."""
    return works.select(F.col("slug").alias("work"), F.posexplode("parts").alias("pos", "_p")).select(
        "work", "pos", F.col("_p.cahier").alias("cahier"), F.col("_p.piece").alias("piece_slug"),
        F.col("_p.label").alias("label"),
    )
