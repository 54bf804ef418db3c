"""Cleaning jobs: denoising scanned text and importing stored pages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from stemma.functions import html as H, noise as N, patterns as P, text as T
from stemma.functions.urls import page_title
from stemma.operators.assembly import assemble
from stemma.operators.upsert import last_per_key, size_guard
from stemma.session import write_out


def denoise(docs: DataFrame, passes: int = 1) -> DataFrame:
    """Heal broken words, drop noise lines, strip margin marks, collapse blank lines.

    ``docs(doc, body)`` → ``doc, body, kept, dropped``. A header block stays as
    it is. Everything happens inside the document's row. A word broken around a
    noise line is healed only after that line is gone, hence ``passes``; the
    texts are written out between passes.
    """
    out = _denoise_once(docs)
    for _ in range(passes - 1):
        out = write_out(out, "denoise")
        out = _denoise_once(out.select("doc", "body", F.col("dropped").alias("_before")), ["_before"]).select(
            "doc", "body", "kept", (F.col("dropped") + F.col("_before")).alias("dropped")
        )
    return out


def _denoise_once(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    keep = keep or []
    # staged, so that no step is computed twice
    rows = docs.select("doc", *keep, "body", T.header_of(F.col("body")).alias("_head"))
    text = F.substring("body", F.length("_head") + 1, F.length("body"))
    rows = rows.select("doc", *keep, "_head", F.regexp_replace(text, P.ANY_LINE_BREAK, "\n").alias("_text"))
    rows = rows.select("doc", *keep, "_head", N.heal_page_numbers(F.col("_text")).alias("_text"))
    rows = rows.select("doc", *keep, "_head", N.heal_hyphens(F.col("_text")).alias("_text"))
    lines = F.split(F.regexp_replace("_text", r"\n\z", ""), "\n")
    marked = rows.select("doc", *keep, "_head", N.split_noise(lines).alias("_marked"))
    clean = F.array_join(
        F.transform(F.filter("_marked", lambda m: ~m["noise"]), lambda m: N.repair_line(m["line"])), "\n"
    )
    clean = F.regexp_replace(F.regexp_replace(clean, r"\n{3,}", "\n\n"), r"\A\n+|\n+\z", "")
    rows = marked.select(
        "doc", *keep, "_head", clean.alias("_clean"), F.size(F.filter("_marked", lambda m: m["noise"])).alias("dropped")
    )
    return rows.select(
        "doc", *keep,
        F.concat("_head", "_clean", F.lit("\n")).alias("body"),
        F.when(F.col("_clean") == "", 0).otherwise(F.size(F.split("_clean", "\n"))).alias("kept"),
        "dropped",
    )


def denoise_preview(docs: DataFrame) -> DataFrame:
    """Dry run: line and word counts before and after, nothing written."""
    before = docs.select(
        "doc", "body", F.size(F.split("body", "\n")).alias("lines_before"), T.word_count(F.col("body")).alias("words_before")
    )
    return _denoise_once(before, ["lines_before", "words_before"]).select(
        "doc", "lines_before", "words_before", F.col("kept").alias("lines_after"),
        T.word_count(F.col("body")).alias("words_after"), "dropped",
    )


def heal_report(docs: DataFrame) -> DataFrame:
    """Healed text with the number of joins of each kind."""
    staged = docs.select("doc", F.regexp_replace("body", P.ANY_LINE_BREAK, "\n").alias("_raw"))
    staged = staged.withColumn("_first", N.heal_page_numbers(F.col("_raw")))
    return staged.select(
        "doc",
        N.heal_hyphens(F.col("_first")).alias("body"),
        N.count_number_breaks(F.col("_raw")).alias("number_joins"),
        N.count_hyphen_breaks(F.col("_first")).alias("hyphen_joins"),
    )


def provenance(site: str, title: Column, status: Column, pulled: str, note: Column | None = None) -> Column:
    parts = [F.lit(f"{site} ("), title, F.lit(", status="), status]
    if note is not None:
        parts += [F.lit("; split "), note]
    return F.concat(*parts, F.lit(f"); pulled {pulled}"))


def page_texts(
    pages: DataFrame, nested: bool = False, div_classes: list[str] | None = None, publisher: str | None = None
) -> DataFrame:
    """Stored pages as text: replaces ``html`` by ``text``.

    ``nested`` follows nested subtrees; the default is a chain of patterns.
    """
    html = H.drop_blocked_subtrees(F.col("html")) if nested else H.drop_page_furniture(F.col("html"), div_classes)
    text = H.html_to_text(html)
    if publisher:
        text = H.drop_leading_lines(text, publisher)
    return pages.withColumn("text", text).drop("html")


def import_pages(
    docs: DataFrame,
    pages: DataFrame,
    plan: DataFrame,
    pulled: str,
    actions: tuple[str, ...] = ("use-wikisource",),
    force: bool = False,
    site: str = "Wikisource",
    to_text: Callable[[DataFrame], DataFrame] = page_texts,
    sep: str = "\n\n* * *\n\n",
) -> DataFrame:
    """Replace documents by the text of their stored pages, with a size guard.

    ``docs(doc, word_count)``, ``pages(doc, pos, html)``, ``plan(doc, url,
    status, action)``, of a document's rows with such an action the last by an
    optional ``ord`` (else the greatest). One row per planned document and text segment: ``doc,
    segment, body, word_count, status, message, provenance``. A document of
    several pages, or ``force``, is exempt from the guard.
    """
    todo = last_per_key(plan.filter(F.col("action").isin(*actions)), "doc", ["url", "status"]).withColumnRenamed("status", "level")
    wanted = pages.join(todo.select("doc"), "doc", "left_semi")
    # written once: the texts serve the totals and the bodies
    texts = write_out(to_text(wanted).withColumn("_words", T.word_count(F.col("text"))), "pages")
    totals = texts.groupBy("doc").agg(F.sum("_words").alias("word_count"), F.count(F.lit(1)).alias("_pages"))
    held = docs.select("doc", F.col("word_count").alias("_old"), F.lit(True).alias("_exists"))
    rows = todo.join(totals, "doc", "left").join(held, "doc", "left")
    guarded = size_guard(
        F.coalesce("_old", F.lit(0)), F.col("word_count"), F.lit(force) | (F.col("_pages") > 1)
    )
    status = (
        F.when(F.coalesce("url", F.lit("")) == "", F.struct(F.lit("skip").alias("s"), F.lit("no URL").alias("m")))
        .when(F.col("_exists").isNull(), F.struct(F.lit("error").alias("s"), F.lit("no existing document").alias("m")))
        .when(F.col("word_count").isNull(), F.struct(F.lit("error").alias("s"), F.lit("no stored page").alias("m")))
        .when(guarded, F.struct(F.lit("skip").alias("s"), F.concat(
            F.lit("size guard: new="), F.col("word_count").cast("string"), F.lit("w vs existing="),
            F.col("_old").cast("string"), F.lit("w (<30%)")).alias("m")))
        .otherwise(F.struct(F.lit("ok").alias("s"), F.concat(
            F.lit("wrote "), F.col("word_count").cast("string"), F.lit("w")).alias("m")))
    )
    rows = rows.withColumn("_s", status)
    title = F.coalesce(page_title(F.col("url")), F.col("url"))
    good = F.col("_s.s") == "ok"
    rows = rows.select(
        "doc", "word_count", F.col("_s.s").alias("status"), F.col("_s.m").alias("message"),
        F.when(good, provenance(site, title, F.col("level"), pulled)).alias("provenance"),
    )
    bodies = assemble(texts, "doc", "pos", "text", sep)
    kept = bodies.join(rows.filter(F.col("status") == "ok").select("doc"), "doc", "left_semi")
    return rows.join(kept, "doc", "left").select(
        "doc", F.coalesce("segment", F.lit(0)).alias("segment"), "body", "word_count", "status", "message", "provenance"
    )


def job_totals(statuses: DataFrame) -> DataFrame:
    """Documents per status."""
    return statuses.select("doc", "status").distinct().groupBy("status").agg(F.count(F.lit(1)).alias("n"))
