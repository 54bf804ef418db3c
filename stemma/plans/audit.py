"""Corpus audits: noise ledger, line flags, worklist, document audit, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stemma.functions import noise as N, patterns as P, text as T
from stemma.operators.lookup import first_contained
from stemma.operators.ordered import first_per_group, rank_rows
from stemma.operators.upsert import last_per_key
from stemma.session import write_out


# --- ledger and worklist -----------------------------------------------------

def with_line_counts(docs: DataFrame, broad_marks: bool = False) -> DataFrame:
    """Add ``n_lines`` and one count per line flag (``f_0`` … ``f_5``)."""
    out = docs.withColumn("_lines", T.non_blank(T.lines_of(F.col("_body")))).withColumn(
        "n_lines", F.greatest(F.size("_lines"), F.lit(1))
    )
    for i, pattern in enumerate(N.ledger_line_patterns(broad_marks).values()):
        out = out.withColumn(f"f_{i}", N.count_lines_matching(F.col("_lines"), pattern))
    return out.drop("_lines")


def _flag_sum() -> Column:
    total = F.col("f_0")
    for i in range(1, len(P.NOISE_FLAGS)):
        total = total + F.col(f"f_{i}")
    return total


def noise_scores(docs: DataFrame, mode: str = "reference") -> DataFrame:
    """One row per document with line density, garble share and score.

    ``docs`` has ``doc`` and ``body``; other columns pass through, the body
    does not. Nothing is shuffled: each document is scored in its own row.
    """
    keep = [c for c in docs.columns if c != "body"]
    scored = docs.withColumn("_body", T.drop_header(F.col("body"))).withColumn(
        "has_provenance", F.col("body").contains("sourceProvenance") | F.col("body").contains("vision re-OCR")
    )
    scored = with_line_counts(scored).withColumns({
        "words": F.greatest(N.garble_token_count(F.col("_body")), F.lit(1)),
        "_garbled": F.size(F.filter(N.suspect_tokens(F.col("_body")), lambda t: N.is_garbled(t, mode))),
    })
    density = _flag_sum() / F.col("n_lines") * 100
    garble = F.col("_garbled") / F.col("words") * 100
    counts = [F.col(f"f_{i}") for i in range(len(P.NOISE_FLAGS))]
    return scored.select(
        *keep,
        "has_provenance",
        F.col("n_lines").alias("lines"),
        "words",
        F.bround(density + garble * 3, 1).alias("score"),
        F.bround(garble, 2).alias("garble_pct"),
        F.bround(density, 1).alias("line_pct"),
        N.top_flags(P.NOISE_FLAGS, counts).alias("top_flags"),
    )


def source_status(has_provenance: Column, action: Column) -> Column:
    """What source a document is on now."""
    return (
        F.when(has_provenance | (action == "done-reocr"), "reocr")
        .when(action.isin("use-wikisource", "use-wikisource-jc"), "wikisource")
        .when(action == "filter-blocked", "filter-blk")
        .when(action.isin("skip", "skip-editorial"), "skip")
        .otherwise("old-ocr")
    )


def noise_ledger(
    docs: DataFrame,
    actions: DataFrame,
    scanned: DataFrame,
    back_matter: list[str] | None = None,
    mode: str = "reference",
    ranked: bool = True,
) -> DataFrame:
    """Worst-first ledger of all documents.

    ``docs(doc, cahier, piece_slug, body)``, ``actions(doc, action)`` with an
    optional ``ord``, of which a document's last counts, ``scanned(cahier)``. ``bucket`` sorts the documents still to be redone into
    ``scanned``, ``unscanned`` and ``back-matter``; it is null for the others.
    """
    held = scanned.select("cahier").distinct().withColumn("_held", F.lit(True))
    rows = (
        noise_scores(docs, mode)
        .join(last_per_key(actions, "doc", ["action"]), "doc", "left")
        .withColumn("status", source_status(F.col("has_provenance"), F.coalesce("action", F.lit("?"))))
        .join(held, "cahier", "left")
    )
    bucket = F.when(
        F.col("status").isin("old-ocr", "filter-blk"),
        F.when(T.back_matter_slug(F.col("piece_slug"), back_matter), "back-matter")
        .when(F.col("_held"), "scanned")
        .otherwise("unscanned"),
    )
    rows = rows.withColumn("bucket", bucket).select(
        "score", "garble_pct", "line_pct", "status", "bucket", "doc", "cahier", "piece_slug",
        "lines", "words", "top_flags",
    )
    # written first: placing rows by range evaluates its input twice, the texts are read once
    return rank_rows(write_out(rows, "ledger"), [F.desc("score"), "doc"]) if ranked else rows


def ledger_totals(ledger: DataFrame) -> DataFrame:
    """Documents scored, to be redone, and per bucket."""
    todo = F.col("status").isin("old-ocr", "filter-blk")

    def count(cond: Column) -> Column:
        return F.count(F.when(cond, 1))

    return ledger.agg(
        F.count(F.lit(1)).alias("scored"),
        count(todo).alias("todo"),
        count(F.col("bucket") == "scanned").alias("scanned"),
        count(F.col("bucket") == "unscanned").alias("unscanned"),
        count(F.col("bucket") == "back-matter").alias("back_matter"),
    )


def worst_documents(ledger: DataFrame, n: int = 20) -> DataFrame:
    """Top ``n`` of the documents to be redone."""
    return (
        ledger.filter(F.col("status").isin("old-ocr", "filter-blk"))
        .orderBy(F.desc("score"), "doc").limit(n)
    )


def review_worklist(
    wanted: DataFrame, docs: DataFrame, penalty: float = 15.0, ranked: bool = True
) -> DataFrame:
    """Listed documents worst-first; a listed document without text scores -1.

    ``wanted(doc, action, …)`` is filtered by the caller; ``docs(doc, body)``.
    """
    listed = docs.join(wanted.select("doc").distinct(), "doc", "left_semi")  # only these are scored
    scored = with_line_counts(listed.select("doc", T.drop_header(F.col("body")).alias("_body")), True)
    counts = [F.col(f"f_{i}") for i in range(len(P.NOISE_FLAGS))]
    back = F.col(f"f_{P.NOISE_FLAGS.index('BACK-MATTER')}")
    score = _flag_sum() / F.col("n_lines") * 100 + F.when(back >= 2, penalty).otherwise(0.0)
    scored = scored.select(
        "doc",
        F.bround(score, 1).alias("score"),
        F.col("n_lines").alias("lines"),
        N.top_flags(P.NOISE_FLAGS, counts).alias("flags"),
    )
    rows = wanted.join(scored, "doc", "left").withColumns({
        "score": F.coalesce("score", F.lit(-1.0)),
        "lines": F.coalesce("lines", F.lit(0)),
        "flags": F.coalesce("flags", F.lit("MISSING")),
    })
    return rank_rows(write_out(rows, "worklist"), [F.desc("score"), "doc"]) if ranked else rows


# --- lines -------------------------------------------------------------------

def flag_lines(docs: DataFrame) -> DataFrame:
    """Suspect lines: ``doc, line_no, flags, text``; header lines are passed over."""
    lines = docs.select(
        "doc",
        F.size(F.split(T.header_of(F.col("body")), "\n")).alias("_head"),
        F.posexplode(T.any_lines_of(F.col("body"))).alias("line_no", "text"),
    )
    lines = lines.filter((F.col("line_no") >= F.col("_head") - 1) & F.col("text").rlike(P.NOT_BLANK))
    # exploding an array of none or one keeps the flags from being computed twice
    found = F.filter(F.array(N.line_flags(F.col("text"))), lambda f: F.size(f) > 0)
    return lines.select("doc", "line_no", "text", F.explode(found).alias("_flags")).select(
        "doc",
        (F.col("line_no") + 1).alias("line_no"),
        F.array_join("_flags", ",").alias("flags"),
        F.regexp_replace("text", r"(?U)\s+$", "").alias("text"),
    )


def flagged_line_counts(docs: DataFrame) -> DataFrame:
    """Flagged lines per document: ``doc, n``; clean documents have no row.

    Lines of a document sit in one partition, so they are counted before the shuffle.
    """
    return flag_lines(docs).groupBy("doc").agg(F.count(F.lit(1)).alias("n"))


# --- prose audit -------------------------------------------------------------

def prose_stats(docs: DataFrame) -> DataFrame:
    """Add non-blank lines, prose lines and their ratio; drops the body.

    ``docs`` has ``lang`` and ``body``. French lists apply to ``fr``, English
    ones to any other language.
    """
    keep = [c for c in docs.columns if c != "body"]
    staged = docs.withColumn("_lines", T.non_blank(T.any_lines_of(T.body_of(F.col("body")))))
    staged = staged.withColumn("n_lines", F.size("_lines")).withColumn(
        "prose_lines", F.size(F.filter("_lines", lambda l: N.is_prose_line(l, F.col("lang") == "fr")))
    )
    ratio = F.when(F.col("n_lines") == 0, 0.0).otherwise(F.col("prose_lines") / F.col("n_lines"))
    return staged.select(*keep, "n_lines", "prose_lines", ratio.alias("ratio"))


def prose_flag(prose: Column, ratio: Column) -> Column:
    return F.when(prose == 0, "EMPTY").when(ratio < 0.5, "LOW_PROSE")


def declared_pieces(cahiers: DataFrame) -> DataFrame:
    """One row per declared piece with its position and the split-suspect flag."""
    second = F.get("pieces", F.lit(1))["title_fr"]
    return cahiers.select(
        F.col("slug").alias("cahier"),
        ((F.size("pieces") == 2) & F.coalesce(second, F.lit("")).rlike(P.ROMAN_PREFIX)).alias("split_suspect"),
        F.posexplode("pieces").alias("pos", "_piece"),
    ).select("cahier", "split_suspect", "pos", F.col("_piece.slug").alias("piece_slug"),
             F.col("_piece.title_fr").alias("title"), F.col("_piece.author").alias("listed_author"))


def audit_documents(
    cahiers: DataFrame, docs: DataFrame, upstream: DataFrame, surnames: DataFrame
) -> DataFrame:
    """One row per declared or found piece with its flags joined by ``|``.

    ``docs(cahier, piece_slug, lang, body)``; ``upstream(cahier, status)``: no
    row means missing, status ``placeholder`` means a placeholder;
    ``surnames(surname, slug, ord, subject_only)``.
    """
    return audit_declared(declared_pieces(cahiers), docs, upstream, surnames)


def audit_declared(
    declared: DataFrame, docs: DataFrame, upstream: DataFrame, surnames: DataFrame
) -> DataFrame:
    """``audit_documents`` over an exploded catalog (see ``declared_pieces``)."""
    stats = prose_stats(docs.select("cahier", "piece_slug", "lang", "body"))
    fr = F.col("lang") == "fr"
    # one file per piece and language; numeric maxima keep the aggregation hash-based
    files = stats.groupBy("cahier", "piece_slug").agg(*[
        F.max(F.when(cond, F.col(c))).alias(f"{side}_{c}")
        for side, cond in (("fr", fr), ("en", ~fr)) for c in ("prose_lines", "ratio")
    ])
    known = upstream.groupBy("cahier").agg(F.max(F.col("status") == "placeholder").alias("_placeholder"))
    listed = (
        declared.withColumn("_declared", F.lit(True))
        .withColumn("_key", F.concat_ws("--", "cahier", "piece_slug"))
        .join(known, "cahier", "left")
    )
    named = surnames.filter(~F.col("subject_only")).select("surname", "slug", "ord")
    listed = first_contained(listed, "title", named, "surname", "ord", name="_who")
    rows = listed.join(files, ["cahier", "piece_slug"], "full_outer")

    def lang_flag(side: str) -> Column:
        up = side.upper()
        prose, ratio = F.col(f"{side}_prose_lines"), F.col(f"{side}_ratio")
        return F.when(prose.isNull(), f"NO_{up}").otherwise(F.concat(prose_flag(prose, ratio), F.lit(f"_{up}")))

    expected, author = F.col("_who.slug"), F.coalesce("listed_author", F.lit(""))
    declared_flags = F.array(
        F.when(F.col("_placeholder").isNull(), "COM_MISSING").when(F.col("_placeholder"), "COM_PLACEHOLDER"),
        F.when(F.col("split_suspect"), "SPLIT_SUSPECT"),
        lang_flag("fr"),
        lang_flag("en"),
        F.when(
            expected.isNotNull() & (author != "") & (author != expected),
            F.concat(F.lit("AUTHOR_MISMATCH("), author, F.lit("→"), expected, F.lit(")")),
        ),
    )
    flags = F.when(
        F.col("_declared"), F.array_join(F.filter(declared_flags, lambda f: f.isNotNull()), "|")
    ).otherwise("ORPHAN_FILE")
    known_side = F.col("_declared").isNotNull()

    def shown(side: str) -> list[Column]:
        prose, ratio = F.col(f"{side}_prose_lines"), F.col(f"{side}_ratio")
        return [
            F.when(known_side, F.coalesce(prose, F.lit(0))).alias(f"{side}_prose"),
            F.when(known_side, F.bround(ratio, 2)).alias(f"{side}_ratio"),
        ]

    return rows.select(
        "cahier", "piece_slug", F.coalesce("title", F.lit("")).alias("title"), author.alias("listed_author"),
        *shown("fr"), *shown("en"), flags.alias("flags"),
    )


def flag_histogram(audit: DataFrame) -> DataFrame:
    """Rows per flag, most frequent first, without the detail in parentheses."""
    each = audit.select(F.explode(F.split("flags", r"\|")).alias("flag")).filter(F.col("flag") != "")
    return each.select(F.substring_index("flag", "(", 1).alias("flag")).groupBy("flag").agg(
        F.count(F.lit(1)).alias("n")
    ).orderBy(F.desc("n"), "flag")


def flag_report(audit: DataFrame, key: str = "doc", show: int = 50) -> DataFrame:
    """Per flag the first ``show`` rows and, if there are more, one "… and N more" row.

    Returns ``(section, pos, line)``; ``audit`` has the columns ``key``,
    ``flags`` and ``line``.
    """
    each = audit.select(
        key, "line",
        F.explode(F.array_distinct(F.transform(
            F.split("flags", r"\|"), lambda f: F.substring_index(f, "(", 1)
        ))).alias("section"),
    ).filter(F.col("section") != "")
    each = write_out(each, "report")
    shown = first_per_group(each, ["section"], F.col(key), show).select(
        "section", "pos", F.concat(F.lit("- "), "line").alias("line")
    )
    rest = each.groupBy("section").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > show).select(
        "section",
        F.lit(show + 1).alias("pos"),
        F.concat(F.lit("- ... and "), (F.col("n") - show).cast("string"), F.lit(" more")).alias("line"),
    )
    return shown.unionByName(rest)
