"""Segmentation jobs: anchor splits, chunks, anchor segments, section routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stemma.functions import patterns as P, text as T
from stemma.operators.assembly import assemble

# --- fixed values --------------------------------------------------------------
CHUNK_WORDS = 2500
ANCHOR_CHARS = 120
PROBE_CHARS = 40
PROBE_STEP = 20
MAX_BACK_OFF = 50
# --- end of fixed values -------------------------------------------------------
NEAR_CHARS = 4000


def split_at_anchor(docs: DataFrame, rules: DataFrame) -> DataFrame:
    """Cut documents in two at the first paragraph holding an anchor.

    ``docs(doc, body)``; ``rules(doc, anchor, side, part1, part2)``. With side
    ``before`` the anchor paragraph opens the second part, with ``after`` it
    ends the first. Returns ``doc, part, body, words``; a document whose anchor
    is not found keeps one row with a null part and body.
    """
    rows = docs.join(rules, "doc").withColumn("_paras", T.paragraphs_of(F.col("body")))
    anchor = T.straight_quotes(F.col("anchor"))
    hit = F.array_position(F.transform("_paras", lambda p: T.straight_quotes(p).contains(anchor)), True)
    rows = rows.withColumn("_cut", (hit - F.when(F.col("side") == "before", 1).otherwise(0)).cast("int"))
    found = hit > 0

    def part(name: str, start: Column, size: Column) -> Column:
        return F.struct(F.col(name).alias("part"), F.array_join(F.slice("_paras", start, size), "\n\n").alias("body"))

    none = F.struct(F.lit(None).cast("string").alias("part"), F.lit(None).cast("string").alias("body"))
    parts = F.when(found, F.array(
        part("part1", F.lit(1), F.col("_cut")),
        part("part2", F.col("_cut") + 1, F.greatest(F.size("_paras") - F.col("_cut"), F.lit(0))),
    )).otherwise(F.array(none))
    return rows.select("doc", F.explode(parts).alias("_p")).select(
        "doc", "_p.part", "_p.body", T.word_count(F.col("_p.body")).alias("words")
    )


# --- chunks --------------------------------------------------------------------

def chunk_starts(counts: Column, target: int) -> Column:
    """0-based index of each chunk's first paragraph, filled greedily to ``target`` words."""
    start = F.struct(F.array(F.lit(0)).alias("starts"), F.lit(0).alias("n"), F.lit(0).alias("i"))

    def add(acc: Column, words: Column) -> Column:
        full = (acc["i"] > 0) & (acc["n"] + words > target)
        return F.struct(
            F.when(full, F.array_append(acc["starts"], acc["i"])).otherwise(acc["starts"]).alias("starts"),
            F.when(full, words).otherwise(acc["n"] + words).alias("n"),
            (acc["i"] + 1).alias("i"),
        )

    return F.aggregate(counts, start, add, lambda acc: acc["starts"])


def chunk(docs: DataFrame, target: int = CHUNK_WORDS) -> DataFrame:
    """Paragraph chunks of about ``target`` words: ``doc, idx, total, words, text``."""
    rows = docs.select("doc", T.paragraphs_of(T.strip_blank(T.drop_header(F.col("body")))).alias("_paras"))
    rows = rows.withColumn("_starts", chunk_starts(F.transform("_paras", T.token_count), target))
    ends = F.concat(F.slice("_starts", 2, F.size("_starts")), F.array(F.size("_paras")))
    spans = F.arrays_zip(F.col("_starts").alias("a"), ends.alias("b"))
    # finished rows are built inside the document's row, so nothing else is copied to each
    text = F.transform(spans, lambda s: F.array_join(F.slice("_paras", s["a"] + 1, s["b"] - s["a"]), "\n\n"))
    out = F.transform(text, lambda t, i: F.struct(i.alias("idx"), T.token_count(t).alias("words"), t.alias("text")))
    rows = rows.select("doc", F.size("_starts").alias("total"), F.explode(out).alias("_c"))
    return rows.select("doc", "_c.idx", "total", "_c.words", "_c.text")


def reassemble(manifest: DataFrame, chunks: DataFrame) -> DataFrame:
    """Chunks back to documents: ``doc, segment, body, missing``.

    ``manifest(doc, idx)`` lists the chunks expected; ``chunks(doc, idx,
    text)`` holds those present. A missing or blank chunk leaves a marker.
    """
    text = F.when(T.strip_blank(F.col("text")) != "", T.strip_blank(F.col("text")))
    marker = F.concat(F.lit("[[MISSING CHUNK "), F.col("idx").cast("string"), F.lit("]]"))
    rows = manifest.select("doc", "idx").join(
        chunks.select("doc", "idx", text.alias("_t")), ["doc", "idx"], "left"
    ).select("doc", "idx", F.coalesce("_t", marker).alias("text"), F.col("_t").isNull().cast("int").alias("_gone"))
    return assemble(rows, "doc", "idx", "text", "\n\n", extra={"missing": F.sum("_gone").cast("int")})


# --- sections ------------------------------------------------------------------

def sections_of(body: Column, strict: bool = True) -> Column:
    """``## `` sections as array of struct(head, body); text before the first is left out.

    ``strict`` asks for exactly one blank after the marks and keeps ``## #`` out.
    """
    parts = F.split(body, r"(?dm)^## (?!#)" if strict else r"(?dmU)^##\s+")
    return F.transform(F.slice(parts, 2, F.size(parts)), lambda s: F.struct(
        T.strip_blank(F.substring_index(s, "\n", 1)).alias("head"),
        F.when(s.contains("\n"), F.substring(s, F.locate("\n", s) + 1, F.length(s))).otherwise("").alias("body"),
    ))


def _either_contains(a: Column, b: Column) -> Column:
    return a.contains(b) | b.contains(a)


def _section_text(s: Column) -> Column:
    return F.concat(F.lit("## "), s["head"], F.lit("\n\n"), T.strip_blank(s["body"]))


def route_sections(docs: DataFrame, catalog: DataFrame, policy: str = "contains") -> DataFrame:
    """Give each ``## `` section of an issue text to one of its pieces.

    ``docs(cahier, body)``; ``catalog(cahier, pieces)`` with ``pieces`` an
    ordered array of struct(slug, title). Returns ``cahier, pos, piece_slug,
    body, matched_by``. Policies:

    ``contains``: a section goes to the first piece whose slug contains the
    section's slug or is contained in it; the others go to the last piece.
    ``one_to_one``: slugs equal or one a prefix of the other, each piece taken
    once; the other sections fill the empty pieces in order, what is left goes
    to the last piece.
    """
    rows = docs.join(catalog, "cahier")
    if policy == "contains":
        return _route_by_containment(rows)
    if policy == "one_to_one":
        return _route_one_to_one(rows)
    raise ValueError(f"unknown policy {policy}")


def _route_by_containment(rows: DataFrame) -> DataFrame:
    rows = rows.withColumn("_secs", sections_of(F.col("body")))
    tagged = F.transform("_secs", lambda s: F.struct(
        _section_text(s).alias("text"), T.slugify_keep_accents(s["head"]).alias("slug")
    ))
    placed = F.transform(tagged, lambda s: F.struct(
        s["text"].alias("text"),
        F.array_position(F.transform("pieces", lambda p: _either_contains(p["slug"], s["slug"])), True).alias("at"),
    ))
    n = F.size("pieces")
    rows = rows.withColumn("_placed", placed)
    rows = rows.select("cahier", "body", "_placed", n.alias("_n"), F.posexplode("pieces").alias("pos", "_piece"))
    mine = F.filter("_placed", lambda s: s["at"] == F.col("pos") + 1)
    rest = F.when(F.col("pos") == F.col("_n") - 1, F.filter("_placed", lambda s: s["at"] == 0)).otherwise(F.array())
    text = F.array_join(F.transform(F.concat(mine, rest), lambda s: s["text"]), "\n\n")
    # an issue of one piece gets everything, its whole body when there is no heading
    alone = F.when(F.size("_placed") == 0, T.strip_blank(F.col("body"))).otherwise(
        F.array_join(F.transform("_placed", lambda s: s["text"]), "\n\n")
    )
    single = F.col("_n") == 1
    matched = (
        F.when(single, "single").when(F.size(mine) > 0, "slug").when(F.size(rest) > 0, "rest")
    )
    out = rows.select(
        "cahier", "pos", F.col("_piece.slug").alias("piece_slug"),
        F.when(single, alone).otherwise(text).alias("body"), matched.alias("matched_by"),
    )
    return out.filter(F.col("matched_by").isNotNull())


def _route_one_to_one(rows: DataFrame) -> DataFrame:
    rows = rows.withColumn("_secs", F.transform(sections_of(F.col("body"), strict=False), lambda s: F.struct(
        s["head"].alias("head"), s["body"].alias("body"), T.slugify(s["head"]).alias("slug")
    )))
    rows = rows.withColumn("_want", F.transform("pieces", lambda p: T.slugify(p["title"])))
    n = F.size("pieces")
    free = F.array_repeat(F.lit(-1), n)
    start = F.struct(free.alias("got"), F.array().cast("array<int>").alias("rest"), F.lit(0).alias("i"))

    def place(acc: Column, s: Column) -> Column:
        fits = F.zip_with("_want", acc["got"], lambda w, g: (g < 0) & (w.startswith(s["slug"]) | s["slug"].startswith(w)))
        at = F.array_position(fits, True)
        return F.struct(
            F.when(at > 0, F.transform(acc["got"], lambda g, j: F.when(j + 1 == at, acc["i"]).otherwise(g)))
            .otherwise(acc["got"]).alias("got"),
            F.when(at > 0, acc["rest"]).otherwise(F.array_append(acc["rest"], acc["i"])).alias("rest"),
            (acc["i"] + 1).alias("i"),
        )

    rows = rows.withColumn("_m", F.aggregate("_secs", start, place))
    rows = rows.withColumn("_open", F.filter(F.sequence(F.lit(0), n - 1), lambda j: F.get(F.col("_m.got"), j) < 0))
    rows = rows.select(
        "cahier", "body", "_secs", "_m", "_open", n.alias("_n"), F.posexplode("pieces").alias("pos", "_piece")
    )

    def marked(i: Column) -> Column:
        s = F.get("_secs", i)
        return F.concat(F.lit("## "), s["head"], F.lit("\n"), s["body"])

    got = F.get(F.col("_m.got"), F.col("pos"))
    turn = F.array_position("_open", F.col("pos")).cast("int")
    filler = F.when(turn > 0, F.get(F.col("_m.rest"), turn - 1))
    own = F.coalesce(
        F.when(got >= 0, T.strip_blank(F.get("_secs", got)["body"])), T.strip_blank(marked(filler)), F.lit("")
    )
    n_open = F.size("_open")
    left = F.when(
        (F.col("pos") == F.col("_n") - 1) & (F.size("_m.rest") > n_open),
        F.concat(F.lit("\n\n"), F.array_join(
            F.transform(F.slice(F.col("_m.rest"), n_open + 1, F.greatest(F.size("_secs"), F.lit(1))), marked), "\n\n"
        )),
    ).otherwise("")
    whole = T.strip_blank(F.col("body"))
    bare = F.size("_secs") == 0
    text = (
        F.when(F.col("_n") == 1, whole)
        .when(bare, F.when(F.col("pos") == 0, whole).otherwise(""))
        .otherwise(F.concat(own, left))
    )
    matched = (
        F.when(F.col("_n") == 1, "single").when(bare, "whole").when(got >= 0, "slug").when(filler.isNotNull(), "order")
    )
    return rows.select(
        "cahier", "pos", F.col("_piece.slug").alias("piece_slug"), text.alias("body"), matched.alias("matched_by")
    )


# --- anchors -------------------------------------------------------------------

def opening_anchors(docs: DataFrame, catalog: DataFrame) -> DataFrame:
    """Opening text of each piece in a headed issue text.

    The heading whose normalised form equals, contains or is contained in the
    piece title is used; else the first sharing half of the title's tokens.
    Returns ``cahier, pieces, anchors``; an anchor is null when there is no heading.
    """
    rows = docs.join(catalog, "cahier")
    heads = F.transform(sections_of(F.concat(F.lit("\n"), F.col("body")), strict=False), lambda s: F.struct(
        s["head"].alias("head"), s["body"].alias("body"), T.normalise(s["head"]).alias("norm")
    ))
    rows = rows.withColumn("_heads", heads).withColumn("_want", F.transform("pieces", lambda p: T.normalise(p["title"])))

    # the text from each heading on, so an opening may run past the next heading; a later
    # section gives its heading line at least, so a fixed number of them is enough
    reach = ANCHOR_CHARS // len("## \n") + 1

    def opening(i: Column) -> Column:
        later = F.transform(F.slice("_heads", i + 2, F.lit(reach)), lambda h: F.concat(
            F.lit("## "), h["head"], F.lit("\n"), F.substring(h["body"], 1, ANCHOR_CHARS)
        ))
        prose = F.regexp_replace(
            F.get("_heads", i)["body"], r"(?U)\A(?:[^\S\n]*(?:\*(?:[^\n]*\*)?[^\S\n]*)?(?:\n|\z))+", ""
        )
        return F.concat(F.substring(prose, 1, ANCHOR_CHARS), F.array_join(later, ""))

    def named(want: Column) -> Column:
        at = F.array_position(F.transform("_heads", lambda h: _either_contains(h["norm"], want)), True)
        return (F.nullif(at, F.lit(0)) - 1).cast("int")

    def near(toks: Column) -> Column:
        least = F.greatest(F.floor(F.size(toks) / 2), F.lit(1))
        at = F.array_position(F.transform("_toks", lambda h: T.overlap(toks, h) >= least), True)
        return (F.nullif(at, F.lit(0)) - 1).cast("int")

    rows = rows.withColumn("_named", F.transform("_want", named))
    # tokens are compared only where a title names no heading
    open_title = F.exists("_named", lambda i: i.isNull())
    rows = rows.withColumn("_toks", F.when(open_title, F.transform("_heads", lambda h: T.significant_tokens(h["head"]))))
    rows = rows.withColumn("_at", F.when(open_title, F.transform(
        F.arrays_zip(F.col("_named").alias("i"), F.col("pieces").alias("p")),
        lambda z: F.coalesce(z["i"], near(T.significant_tokens(z["p"]["title"]))),
    )).otherwise(F.col("_named")))
    rows = rows.withColumn("_open", F.transform("_at", lambda i: F.when(i.isNotNull(), opening(i))))
    anchors = F.transform("_open", lambda o: F.when(T.strip_blank(o) != "", F.substring(o, 1, ANCHOR_CHARS)))
    return rows.select("cahier", "pieces", anchors.alias("anchors"))


def probes_of(anchor: Column) -> Column:
    """Search windows of a normalised anchor: array of struct(at, text)."""
    short = F.array(F.struct(F.lit(0).alias("at"), anchor.alias("text")))
    last = F.greatest(F.length(anchor) - PROBE_CHARS, F.lit(0))
    windows = F.transform(F.sequence(F.lit(0), last, F.lit(PROBE_STEP)), lambda i: F.struct(
        i.alias("at"), F.substring(anchor, i + 1, F.lit(PROBE_CHARS)).alias("text")
    ))
    return F.when(F.length(anchor) < PROBE_CHARS, short).otherwise(windows)


# Letters that one character can stand for, longest first.
LIGATURES = [("ffi", "ﬃ"), ("ffl", "ﬄ"), ("ff", "ﬀ"), ("fi", "ﬁ"), ("fl", "ﬂ"), ("st", "ﬆ")]
MARKS = r"\p{M}*"


def probe_pattern(window: Column) -> Column:
    """A window of normalised text as a pattern for lower-case text in any form.

    Each letter may be followed by marks, pairs of letters may be one ligature, at
    the window's ends half of one, and a blank is any run of blanks.
    """
    s, whole = window, {}
    for k, (letters, _) in enumerate(LIGATURES):
        s = F.replace(s, F.lit(letters), F.lit(chr(0xE000 + k)))
        parts = [letters]
        for shorter, sign in LIGATURES:  # one ligature inside the letters, or one for all of them
            parts += [letters.replace(shorter, sign, 1)] if shorter in letters else []
        whole[chr(0xE000 + k)] = "(?:" + "|".join("".join(c + MARKS for c in part) for part in dict.fromkeys(parts)) + ")"
    s = F.regexp_replace(s, r"([\p{L}\p{N}_])", r"$1\\p{M}*")
    ends = {c: "".join(sign for letters, sign in LIGATURES if letters.endswith(c)) for c in "filt"}
    begins = {c: "".join(sign for letters, sign in LIGATURES if letters.startswith(c)) for c in "fs"}
    for letter, signs in ends.items():
        s = F.regexp_replace(s, f"^{letter}(?=.)", f"[{letter}{signs}]") if signs else s
    for letter, signs in begins.items():
        s = F.regexp_replace(s, rf"{letter}\\p\{{M\}}\*$", f"[{letter}{signs}]")
    for sign, pattern in whole.items():
        s = F.replace(s, F.lit(sign), F.lit(pattern))
    return F.regexp_replace(F.regexp_replace(s, "^ ", "(?<=[^ ]) "), " ", " +")


def segment_by_anchor(clean: DataFrame, anchors: DataFrame) -> DataFrame:
    """Slice clean issue texts at the opening anchors of their pieces.

    ``clean(cahier, text)``; ``anchors(cahier, pieces, anchors)`` as given by
    ``opening_anchors``. The first window of an anchor found in the normalised
    text fixes the start; offsets out of order drop the whole issue. Returns
    ``cahier, pos, piece_slug, start, end, body, warning`` with a 0-based start.
    """
    rows = clean.join(anchors, "cahier")
    # the text letter for letter, so a place in it is a place in the text; and the text as anchors are compared with it
    flat = F.regexp_replace(F.lower(T.fold_accents(F.col("text"))), r"[^\p{L}\p{N}\p{M}_ ]", " ")
    rows = rows.withColumn("_flat", flat).withColumn("_norm", T.normalise(F.col("text")))
    rows = rows.withColumn("_longer", F.col("_flat").rlike("[" + "".join(sign for _, sign in LIGATURES) + "]"))
    rows = rows.withColumn("_want", F.transform("anchors", T.normalise))
    rows = rows.withColumn("_probes", F.transform("_want", probes_of))
    hits = F.transform("_probes", lambda ps: F.get(
        F.filter(ps, lambda p: F.col("_norm").contains(p["text"]) & (F.regexp_instr(F.col("_flat"), probe_pattern(p["text"])) > 0)), F.lit(0)
    ))
    rows = rows.withColumn("_hits", hits)

    # a place in the text is never before its place in the normalised text, and seldom far
    # behind it: look in a short span first, then in the rest
    spotted = F.transform("_hits", lambda h: F.struct(
        h["at"].alias("at"),
        probe_pattern(h["text"]).alias("probe"),
        F.when(F.col("_longer"), 1).otherwise(F.greatest(F.position(h["text"], F.col("_norm")) - 1, F.lit(1))).alias("from"),
    ))
    rows = rows.withColumn("_spots", spotted)

    def offset(s: Column) -> Column:
        near = F.regexp_instr(F.substring("_flat", s["from"], F.lit(NEAR_CHARS)), s["probe"])
        far = F.regexp_instr(F.substring("_flat", s["from"], F.length("_flat")), s["probe"])
        at = s["from"] + F.coalesce(F.nullif(near, F.lit(0)), far) - 2
        return F.when(s["probe"].isNotNull(), F.greatest(at - F.least(s["at"], F.lit(MAX_BACK_OFF)), F.lit(0)))

    rows = rows.withColumn("_offs", F.transform("_spots", offset))
    present = F.filter("_offs", lambda o: o.isNotNull())
    rows = rows.withColumn("_sorted", F.array_sort(present) == present)
    rows = rows.select("cahier", "text", "anchors", "_offs", "_sorted", F.posexplode("pieces").alias("pos", "_piece"))
    start = F.get("_offs", F.col("pos"))
    later = F.filter(
        F.slice("_offs", F.col("pos") + 2, F.greatest(F.size("_offs"), F.lit(1))), lambda o: o.isNotNull()
    )
    rows = rows.withColumn("start", F.when(F.col("_sorted"), start)).withColumn(
        "end", F.when(F.col("start").isNotNull(), F.coalesce(F.get(later, F.lit(0)), F.length("text")))
    )
    body = F.substring("text", F.col("start") + 1, F.col("end") - F.col("start"))
    body = F.regexp_replace(body, r"(?dmU)^##\s+.+?\n+", "")
    warning = (
        F.when(~F.col("_sorted"), "offsets out of order")
        .when(F.get("anchors", F.col("pos")).isNull(), "anchor missing")
        .when(start.isNull(), "anchor not found")
    )
    return rows.select(
        "cahier", "pos", F.col("_piece.slug").alias("piece_slug"), "start", "end",
        F.when(F.col("start").isNotNull(), F.concat(T.strip_blank(body), F.lit("\n"))).alias("body"),
        warning.alias("warning"),
    )
