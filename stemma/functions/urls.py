"""URL columns: bilingual paths, entity links, page titles."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from stemma.functions.patterns import SECTION_SEGMENTS


def is_fr_path(path: Column) -> Column:
    return (path == "/fr") | path.startswith("/fr/")


def _swap_first(path: Column, table: dict[str, str]) -> Column:
    parts = F.filter(F.split(path, "/"), lambda s: s != "")
    first = F.get(parts, F.lit(0))
    swapped = first
    for old, new in table.items():
        swapped = F.when(first == old, F.lit(new)).otherwise(swapped)
    rest = F.slice(parts, 2, F.greatest(F.size(parts), F.lit(1)))
    return F.when(F.size(parts) == 0, "").otherwise(F.array_join(F.concat(F.array(swapped), rest), "/"))


def to_fr(path: Column) -> Column:
    """French mirror of an English path."""
    return (
        F.when(path.isin("/", ""), "/fr/")
        .when(is_fr_path(path), path)
        .otherwise(F.concat(F.lit("/fr/"), _swap_first(path, SECTION_SEGMENTS)))
    )


def to_en(path: Column) -> Column:
    """English mirror of a French path."""
    back = {fr: en for en, fr in SECTION_SEGMENTS.items()}
    bare = F.regexp_replace(path, "^/fr", "")
    return (
        F.when(~is_fr_path(path), path)
        .when(bare.isin("", "/"), "/")
        .otherwise(F.concat(F.lit("/"), _swap_first(bare, back)))
    )


def nav_url(section: str, fr: bool) -> str:
    return f"/fr/{SECTION_SEGMENTS[section]}" if fr else f"/{section}"


def _prefix(fr: Column) -> Column:
    return F.when(fr, "/fr").otherwise("")


def cahier_url(cahier: Column, fr: Column) -> Column:
    return F.concat(_prefix(fr), F.lit("/cahiers/"), cahier)


def piece_url(cahier: Column, piece: Column, lang: Column, fr: Column) -> Column:
    return F.concat(cahier_url(cahier, fr), F.lit("/"), piece, F.lit("/"), lang)


def author_url(author: Column, fr: Column) -> Column:
    return F.concat(F.when(fr, "/fr/auteurs/").otherwise("/authors/"), author)


def work_url(work: Column, fr: Column) -> Column:
    return F.concat(F.when(fr, "/fr/oeuvres/").otherwise("/works/"), work)


def page_title(url: Column) -> Column:
    """Decoded page title after ``/wiki/``; a plus sign stays a plus sign."""
    part = F.substring(url, F.locate("/wiki/", url) + 6, F.length(url))
    return F.when(url.contains("/wiki/"), F.url_decode(F.replace(part, F.lit("+"), F.lit("%2B"))))


def switch_label(lang: Column) -> Column:
    """Label of the link to the other language of a piece."""
    return F.when(lang == "fr", "Read in English").otherwise("Lire en français")
