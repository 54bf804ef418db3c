"""Catalog loading: records and issue texts to issues, authors, pieces and works."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stemma.functions import text as T
from stemma.operators.lookup import resolve_names
from stemma.operators.ordered import number_within
from stemma.plans.segmentation import route_sections
from stemma.session import write_out

# --- fixed values ------------------------------------------------------------------
STUB_BIO_FR = "Notice biographique à venir."
STUB_BIO_EN = "Bio pending."
AUTHOR_MARK = r"\b([A-Z][A-ZÀ-Ü]{2,}(?:\s+(?:ET\s+)?[A-Z][A-ZÀ-Ü]{2,})*)\.\s+"
_CUT = "\u0001"  # a mark that no text holds


def _clean_title(c: Column) -> Column:
    return F.regexp_replace(T.strip_blank(c), r"\.+$", "")


def description_pieces(desc: Column) -> Column:
    """"AUTHOR. Title. Title. AUTHOR. Title." as array of struct(title, author).

    A leading parenthesis is dropped; text before the first author stands
    without one, and a description without any author mark is one title.
    """
    bare = F.regexp_replace(desc, r"^\([^)]+\)\s*", "")
    marked = F.regexp_replace(bare, "(?U)" + AUTHOR_MARK, f"{_CUT}$1{_CUT}{_CUT}")
    # each block is AUTHOR, two cuts, titles; the first has no author
    blocks = F.split(marked, f"{_CUT}(?!{_CUT})(?=[^{_CUT}]*{_CUT}{_CUT})")
    none = F.array().cast("array<struct<title:string,author:string>>")

    def titles(block: Column) -> Column:
        author = F.initcap(F.lower(T.strip_blank(F.substring_index(block, _CUT * 2, 1))))
        told = F.split(T.strip_blank(F.substring_index(block, _CUT * 2, -1)), r"(?U)\.\s+")
        kept = F.filter(F.transform(told, _clean_title), lambda t: t != "")
        return F.transform(kept, lambda t: F.struct(t.alias("title"), author.alias("author")))

    lead = _clean_title(blocks[0])
    first = F.when(lead != "", F.array(F.struct(lead.alias("title"), F.lit("").alias("author")))).otherwise(none)
    rest = F.flatten(F.transform(F.slice(blocks, 2, F.size(blocks)), titles))
    return F.concat(first, rest)


def unique_slugs(titles: Column) -> Column:
    """Slugs of an issue's titles in order; a slug taken already gets the next free number."""
    def add(acc: Column, title: Column) -> Column:
        base = T.slugify(title)
        tries = F.transform(F.sequence(F.lit(2), F.size(acc) + 2), lambda n: F.concat(base, F.lit("-"), n.cast("string")))
        free = F.get(F.filter(tries, lambda s: ~F.array_contains(acc, s)), F.lit(0))
        return F.array_append(acc, F.when(F.array_contains(acc, base), free).otherwise(base))

    return F.aggregate(titles, F.array().cast("array<string>"), add)


def number_slugs(rows: DataFrame, group: str, title: str, by: str) -> DataFrame:
    """``unique_slugs`` for titles in rows of their own: adds ``slug``.

    Rows are numbered per (group, slug) over all tasks. Only families where a
    title ends in a number itself (``x``, ``x 2``) need the sequential rule, and
    of these only the occurrences up to the largest such number; the later ones
    count on from there.
    """
    based = rows.withColumn("_base", T.slugify(F.col(title)))
    numbered = number_within(based, [group, "_base"], [by], "_n")
    own = r"^(.*)-([2-9]|[1-9]\d{1,8})$"
    numbered = numbered.withColumns({
        "_family": F.regexp_replace("_base", r"(-\d+)+$", ""),
        "_parent": F.when(F.col("_base").rlike(own), F.regexp_extract("_base", own, 1)),
        "_own": F.regexp_extract("_base", own, 2).try_cast("int"),
        "slug": F.when(F.col("_n") == 1, F.col("_base")).otherwise(F.concat_ws("-", "_base", F.col("_n").cast("string"))),
    })
    numbered = write_out(numbered, "slugs")
    keep = [*rows.columns, "slug"]
    clash = (
        numbered.groupBy(group, "slug", "_family").agg(F.count(F.lit(1)).alias("_c")).filter(F.col("_c") > 1)
        .select(group, "_family").distinct()
    )
    if clash.isEmpty():
        return numbered.select(*keep)
    calm = numbered.join(clash, [group, "_family"], "left_anti").select(*keep)
    top = numbered.filter(F.col("_parent").isNotNull()).groupBy(group, F.col("_parent").alias("_base")).agg(
        F.max("_own").alias("_top")
    )
    hot = write_out(
        numbered.join(clash, [group, "_family"], "left_semi").join(top, [group, "_base"], "left")
        .withColumn("_head", F.col("_n") <= F.coalesce("_top", F.lit(0)) + 1), "slugs",
    )
    head = hot.filter("_head").select(group, by, "_base", "_family", "_parent", "_n")

    def redo(pdf):
        taken, next_free, out = set(), {}, []
        pdf = pdf.sort_values(by)
        for base in pdf["_base"]:
            slug, n = base, next_free.get(base, 2)
            while slug in taken:
                slug, n = f"{base}-{n}", n + 1
            next_free[base] = n
            taken.add(slug)
            out.append(slug)
        return pdf.assign(slug=out)

    schema = head.withColumn("slug", F.lit("")).schema
    done = write_out(head.groupBy(group, "_family").applyInPandas(redo, schema), "slugs")
    first = done.filter("_n = 1")
    kept_own = F.col("slug") == F.col("_base")
    held = first.filter(kept_own & F.col("_parent").isNotNull()).groupBy(group, F.col("_parent").alias("_base")).agg(
        F.count(F.lit(1)).alias("_held")
    )
    moved = first.filter(~kept_own).select(group, "_base", F.lit(1).alias("_moved"))
    tail = hot.filter("NOT _head").join(held, [group, "_base"], "left").join(moved, [group, "_base"], "left")
    number = F.col("_n") + F.coalesce("_held", F.lit(0)) + F.coalesce("_moved", F.lit(0))
    tail = tail.withColumn("slug", F.concat_ws("-", "_base", number.cast("string"))).select(*keep)
    redone = hot.filter("_head").drop("slug").join(done.select(group, by, "slug"), [group, by]).select(*keep)
    return calm.unionByName(redone).unionByName(tail)


def find_piece(wanted: DataFrame, declared: DataFrame) -> DataFrame:
    """Piece of an issue whose accent-free title holds all keywords, else its first piece.

    ``wanted(id, cahier, keywords)``; returns ``id, cahier, piece_slug``.
    """
    def plain(c: Column) -> Column:
        return F.lower(T.strip_accents(c))

    asked = wanted.select("id", "cahier", F.transform("keywords", plain).alias("_keys"))
    # the same question is asked once, and a title that an issue has many times is looked at once
    titled = declared.groupBy("cahier", "title").agg(F.min("pos").alias("_pos"), F.min_by(F.struct("piece_slug"), "pos").alias("_piece"))
    titled = titled.select("cahier", "_pos", "_piece", plain(F.col("title")).alias("_title"))
    questions = asked.select("cahier", "_keys").distinct()
    # the test is part of the join, so only matches leave it
    hits = questions.join(titled, "cahier").filter(F.forall("_keys", lambda k: F.col("_title").contains(k)))
    answers = hits.groupBy("cahier", "_keys").agg(F.min("_pos").alias("_pos"), F.min_by("_piece", "_pos").alias("_piece"))
    best = asked.join(answers, ["cahier", "_keys"]).groupBy("id").agg(F.min_by("_piece.piece_slug", "_pos").alias("_best"))
    firsts = declared.groupBy("cahier").agg(F.min_by("piece_slug", "pos").alias("_first"))
    return asked.join(firsts, "cahier").join(best, "id", "left").select(
        "id", "cahier", F.coalesce("_best", "_first").alias("piece_slug")
    )


def author_rows(contributors: DataFrame, names: DataFrame, editor: str) -> DataFrame:
    """Author table: contributors plus a stub for every new name."""
    known = contributors.select("slug", "name", "dates", "bio_fr", "bio_en")
    stubs = names.filter(F.col("is_new")).groupBy("slug").agg(F.min("name").alias("name")).select(
        "slug", "name", F.lit("").alias("dates"), F.lit(STUB_BIO_FR).alias("bio_fr"), F.lit(STUB_BIO_EN).alias("bio_en")
    ).join(known.select("slug"), "slug", "left_anti")
    born, died = T.life_years(F.col("dates"))
    body = F.concat(F.lit("## En français\n\n"), F.col("bio_fr"), F.lit("\n\n## In English\n\n"), F.col("bio_en"))
    return known.unionByName(stubs).select(
        "slug", "name", T.sort_name(F.col("name")).alias("name_sort"), born.alias("born"), died.alias("died"),
        (F.col("slug") == editor).alias("is_editor"), body.alias("body"),
    )


def load_catalog(
    catalog: DataFrame, contributors: DataFrame, texts: DataFrame, aliases: DataFrame, editor: str,
    work_parts: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Full load: ``cahiers``, ``authors``, ``pieces`` and ``works`` parts.

    ``catalog(series, issue, label, url, description)``; ``contributors(name,
    slug, dates, bio_fr, bio_en)``; ``texts(cahier, lang, date, pieces, body)``
    with ``pieces`` an array of struct(title, author) or null; ``aliases(name,
    slug)``; ``work_parts(work, part, cahier, keywords, label)``.
    """
    key = T.issue_key(F.col("series"), F.col("issue"))
    listed = texts.filter(F.size("pieces") > 0)
    side = F.when(F.col("lang") == "fr", 0).otherwise(1)
    told = listed.groupBy("cahier").agg(F.min_by("pieces", side).alias("_told"))
    dated = texts.filter(F.col("date").isNotNull()).groupBy("cahier").agg(F.min_by("date", side).alias("date"))
    rows = catalog.withColumn("cahier", key).join(told, "cahier", "left").join(dated, "cahier", "left")
    found = F.transform(
        F.coalesce("_told", description_pieces(F.col("description"))),
        lambda p: F.struct(T.strip_blank(p["title"]).alias("title"), T.strip_blank(p["author"]).alias("author")),
    )
    found = F.filter(found, lambda p: p["title"] != "")
    stub = F.array(F.struct(
        F.coalesce(F.nullif(_clean_title(F.substring("description", 1, 80)), F.lit("")), F.lit("Contenu")).alias("title"),
        F.lit("").alias("author"),
    ))
    rows = rows.withColumn("_found", found).withColumn("_empty", F.size("_found") == 0)
    rows = rows.withColumn("_pieces", F.when(F.col("_empty"), stub).otherwise(F.col("_found")))
    slugs = F.when(F.col("_empty"), F.array(F.lit("contenu"))).otherwise(
        unique_slugs(F.transform("_pieces", lambda p: p["title"]))
    )
    rows = write_out(rows.withColumn("_slugs", slugs), "catalog")

    declared = rows.select(
        "cahier", "series", "issue", F.posexplode(F.arrays_zip(F.col("_pieces").alias("p"), F.col("_slugs").alias("slug"))).alias("pos", "_z")
    ).select(
        "cahier", "series", "issue", "pos", F.col("_z.slug").alias("piece_slug"), F.col("_z.p.title").alias("title"),
        F.col("_z.p.author").alias("author_name"),
    ).withColumn("is_notice", T.is_notice_title(F.col("title")))
    # arrival order of the names: catalog order, then position
    arrival = F.struct(*[F.col(c).cast("long").alias(c) for c in ("series", "issue", "pos")])
    # contributors in their order, if they have one, then the aliases
    place = F.col("ord").cast("long") if "ord" in contributors.columns else F.lit(0).cast("long")
    known = contributors.select("name", "slug", place.alias("ord")).unionByName(
        aliases.select("name", "slug", F.lit(2**62).cast("long").alias("ord"))
    )
    resolved = resolve_names(declared.select(F.col("author_name").alias("name"), arrival.alias("ord")), known)
    resolved = write_out(resolved, "authors")
    label = F.when(F.coalesce(F.trim("author_name"), F.lit("")) == "", "Anonymous").otherwise(F.col("author_name"))
    declared = write_out(
        declared.withColumn("_name", label).join(
            resolved.select(F.col("name").alias("_name"), F.col("slug").alias("author")), "_name"
        ).drop("_name", "author_name"),
        "pieces",
    )
    # pieces of one issue come from one record, so their number is bounded by it
    nested = declared.groupBy("cahier").agg(F.array_sort(F.collect_list(F.struct(
        "pos", F.col("piece_slug").alias("slug"), F.col("title").alias("title_fr"), "author", "is_notice"
    ))).alias("_p"))
    cahiers = rows.join(nested, "cahier").select(
        F.col("cahier").alias("slug"), "series", "issue", "label",
        T.issue_title(F.col("series"), F.col("issue")).alias("title_fr"), "date", F.col("url").alias("source_url"),
        F.transform("_p", lambda p: p.dropFields("pos")).alias("pieces"),
    )
    titles = nested.select("cahier", F.transform("_p", lambda p: F.struct(
        p["slug"].alias("slug"), p["title_fr"].alias("title"))).alias("pieces"))
    routed = None
    for lang in ("fr", "en"):
        part = route_sections(texts.filter(F.col("lang") == lang).select("cahier", "body"), titles, "one_to_one")
        part = part.withColumn("lang", F.lit(lang))
        routed = part if routed is None else routed.unionByName(part)
    pieces = routed.join(declared, ["cahier", "pos", "piece_slug"]).select(
        "cahier", "piece_slug", "lang", "title", "author", "is_notice",
        T.token_count(F.col("body")).alias("word_count"), "body",
    )
    out = {
        "cahiers": cahiers,
        "authors": author_rows(contributors, resolved, editor),
        "pieces": pieces,
    }
    if work_parts is not None:
        wanted = work_parts.select(F.struct("work", "part", "label").alias("id"), "cahier", "keywords")
        out["works"] = find_piece(wanted, declared).select("id.work", "id.part", "id.label", "cahier", "piece_slug")
    return out
