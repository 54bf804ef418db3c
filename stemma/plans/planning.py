"""Source planning: inventory, tiers and URLs, candidate verdicts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from stemma.functions import patterns as P, text as T
from stemma.operators.lookup import first_contained

_LOW = P.LOWER_FR


def text_stats(text: Column) -> dict[str, Column]:
    """Quality counts of one source text."""
    return {
        "lines": F.size(T.non_blank(T.any_lines_of(text))),
        "hyph_end": F.regexp_count(text, F.lit(rf"(?dmU)[{_LOW}]-[^\S\n]*$")),
        "pgnum_end": F.regexp_count(text, F.lit(rf"(?dmU)[{_LOW}]\d{{1,4}}[^\S\n]*$")),
        "weird": F.regexp_count(text, F.lit(rf"(?<!{P.PY_WORD})[{_LOW}]+['\"\\][a-zA-Z0-9]")),
        "qmark": F.regexp_count(text, F.lit(r"\[\?\]")),
        "bytes": F.octet_length(text),
    }


def source_inventory(*sources: DataFrame, skip: str | None = P.SOURCE_SKIP, skip_type: str = "slug-fallback") -> DataFrame:
    """All candidate sources with their counts; duplicates stay.

    Each source has ``cahier, type, path, text``. Paths of ``skip_type`` that
    match ``skip`` are left out.
    """
    rows = reduce(DataFrame.unionByName, sources)
    if skip:
        name = F.regexp_replace(F.regexp_extract("path", r"([^/]*)$", 1), r"\.[^.]*$", "")
        rows = rows.filter((F.col("type") != skip_type) | ~name.rlike(skip))
    stats = text_stats(F.col("text"))
    return rows.select("cahier", "type", *[c.alias(n) for n, c in stats.items()], "path")


def author_tiers(docs: DataFrame, tiers: DataFrame) -> DataFrame:
    """Add ``tier``; authors without one are T3."""
    unique = tiers.groupBy("author").agg(F.min("tier").alias("tier"))
    return docs.join(unique, "author", "left").withColumn("tier", F.coalesce("tier", F.lit("T3")))


def source_plan(
    docs: DataFrame, tiers: DataFrame, url_rules: DataFrame, skip_titles: DataFrame, defaults: DataFrame,
    base: str = "",
) -> DataFrame:
    """Decide URL, status and action per document.

    ``docs(doc, cahier, piece_slug, author, title)``; ``url_rules(author, key,
    match, url, status, action, ord)`` with match ``exact`` (slug), ``contains``
    (part of the slug) or ``issue``; ``skip_titles(author, words, ord)``;
    ``defaults(author, action)``. The first that applies decides: exact slug,
    skipped title, part of slug, issue, author default, tier default.
    """
    rule = F.struct("url", "status", "action")

    def keyed(match: str, column: str) -> DataFrame:
        return url_rules.filter(F.col("match") == match).groupBy("author", F.col("key").alias(column)).agg(
            F.min_by(rule, "ord").alias(f"_{match}")
        )

    rows = author_tiers(docs, tiers)
    rows = rows.join(keyed("exact", "piece_slug"), ["author", "piece_slug"], "left")
    rows = rows.join(keyed("issue", "cahier"), ["author", "cahier"], "left")
    rows = rows.join(
        defaults.groupBy("author").agg(F.min("action").alias("_default")), "author", "left"
    )
    rows = first_contained(rows, "title", skip_titles, "words", "ord", same=["author"], name="_skip")
    part = url_rules.filter(F.col("match") == "contains").select("author", "key", "url", "status", "action", "ord")
    rows = first_contained(rows, "piece_slug", part, "key", "ord", same=["author"], name="_part")

    none = F.lit("")
    choice = (
        F.when(F.col("_exact").isNotNull(), F.col("_exact"))
        .when(F.col("_skip").isNotNull(), F.struct(none.alias("url"), none.alias("status"), F.lit("skip-editorial").alias("action")))
        .when(F.col("_part").isNotNull(), F.struct("_part.url", "_part.status", "_part.action"))
        .when(F.col("_issue").isNotNull(), F.col("_issue"))
        .otherwise(F.struct(
            none.alias("url"), none.alias("status"),
            F.coalesce("_default", F.when(F.col("tier") == "T2", "check-wikisource").otherwise("skip")).alias("action"),
        ))
    )
    rows = rows.withColumn("_c", choice)
    url = F.when(F.col("_c.url") == "", "").otherwise(F.concat(F.lit(base), F.col("_c.url")))
    return rows.select(
        "doc", "cahier", "piece_slug", "author", "tier", url.alias("url"),
        F.col("_c.status").alias("status"), F.col("_c.action").alias("action"),
    )


def category_counts(rows: DataFrame, *columns: str) -> DataFrame:
    """Counts per value of each column: ``category, value, n``."""
    pairs = F.array(*[F.struct(F.lit(c).alias("category"), F.col(c).cast("string").alias("value")) for c in columns])
    return rows.select(F.explode(pairs).alias("_p")).groupBy("_p.category", "_p.value").agg(
        F.count(F.lit(1)).alias("n")
    )


VERDICT_ORDER = ["FOUND-validated", "FOUND-proofread", "FOUND-maybe", "NONE"]


def candidate_verdicts(
    wanted: DataFrame, candidates: DataFrame, min_overlap: float = 0.5, min_words: int = 300
) -> DataFrame:
    """First acceptable candidate of each wanted title.

    ``wanted(wanted, title)``; ``candidates(wanted, rank, title, word_count,
    categories)``. Returns ``wanted, verdict, best, verdict_order``, best verdicts first.
    """
    joined = candidates.select(
        "wanted", "rank", F.col("title").alias("best"), "word_count", "categories"
    ).join(wanted.select("wanted", "title"), "wanted")
    want = T.title_words(F.col("title"))
    share = T.overlap(want, T.title_words(F.col("best"))) / F.greatest(F.size(want), F.lit(1))
    good = joined.filter((F.col("word_count") > min_words) & (share >= min_overlap))
    cats = F.array_join("categories", " ")
    level = F.when(cats.contains("validés"), "validated").when(cats.contains("corrigés"), "proofread").otherwise("maybe")
    first = good.groupBy("wanted").agg(F.min_by(F.struct("best", level.alias("level")), "rank").alias("_hit"))
    verdict = F.coalesce(F.concat(F.lit("FOUND-"), F.col("_hit.level")), F.lit("NONE"))
    order = F.array_position(F.array(*[F.lit(v) for v in VERDICT_ORDER]), verdict)
    return wanted.join(first, "wanted", "left").select(
        "wanted", verdict.alias("verdict"), F.coalesce("_hit.best", F.lit("")).alias("best"),
        (F.when(order > 0, order).otherwise(10) - 1).cast("int").alias("verdict_order"),
    ).orderBy("verdict_order", "wanted")
