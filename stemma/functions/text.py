"""Text columns: accents, slugs, tokens, word counts, lines, names and dates."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, functions as F

from stemma.functions import patterns as P


def _base(ch: str) -> str:
    """Compatibility decomposition of one character without its marks."""
    return "".join(c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c))


# Letters with one base letter; letters that spell out as several characters.
_FOLD_FROM = "".join(
    chr(n) for n in range(0xA0, 0x3000) if len(_base(chr(n))) == 1 and _base(chr(n)) != chr(n)
)
_FOLD_TO = "".join(_base(c) for c in _FOLD_FROM)
_MARKS = "".join(chr(n) for n in range(0xA0, 0x3000) if _base(chr(n)) == "")
_SPELLED = {
    chr(n): _base(chr(n))
    for low, high in [(0xA0, 0x17F), (0x1C4, 0x1F3), (0x2000, 0x2189), (0xFB00, 0xFB06)]
    for n in range(low, high + 1)
    if len(_base(chr(n))) > 1
}

_NON_ASCII = r"[^\x00-\x7f]"


def fold_accents(c: Column) -> Column:
    """Replace each accented letter by its base letter; the length stays the same."""
    return F.when(c.rlike(_NON_ASCII), F.translate(c, _FOLD_FROM, _FOLD_TO)).otherwise(c)


def strip_accents(c: Column) -> Column:
    """Drop accents and marks, spelling out ligatures and fractions; œ stays."""
    folded = F.translate(c, _FOLD_FROM + _MARKS, _FOLD_TO)
    # two literal strings, cut once when the plan is optimised
    pairs = F.arrays_zip(
        F.split(F.lit("\t".join(_SPELLED)), "\t").alias("k"), F.split(F.lit("\t".join(_SPELLED.values())), "\t").alias("v")
    )
    spelled = F.aggregate(pairs, folded, lambda acc, p: F.replace(acc, p["k"], p["v"]))
    return (
        F.when(~c.rlike(_NON_ASCII), c)
        .when(c.rlike("[" + "".join(_SPELLED) + "]"), spelled)
        .otherwise(folded)
    )


def straight_quotes(c: Column) -> Column:
    """Curly apostrophe to straight."""
    return F.translate(c, "’", "'")


def slugify(c: Column) -> Column:
    """Accent-free slug; apostrophes separate words; never empty."""
    s = F.lower(strip_accents(F.coalesce(c, F.lit(""))))
    s = F.regexp_replace(F.regexp_replace(s, "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.when(s == "", F.lit("untitled")).otherwise(s)


def slugify_keep_accents(c: Column) -> Column:
    """Slug that keeps accents and hyphens and drops curly quotes."""
    s = F.translate(F.lower(c), "‘’“”", "")
    s = F.regexp_replace(s, rf"(?U)[^\p{{L}}\p{{N}}_\s-]", " ")
    s = F.regexp_replace(strip_blank(s), r"(?U)\s+", "-")
    return F.regexp_replace(s, "-+", "-")


def normalise(c: Column) -> Column:
    """Accent-free lower-case words separated by single blanks (any script)."""
    s = F.regexp_replace(F.lower(strip_accents(c)), rf"[^\p{{L}}\p{{N}}_]+", " ")
    return F.trim(s)


def normalise_ascii(c: Column) -> Column:
    """As ``normalise`` but only a-z and 0-9 survive; blanks still separate words."""
    s = F.regexp_replace(F.lower(strip_accents(c)), r"(?U)[^a-z0-9\s]", " ")
    return F.trim(F.regexp_replace(s, r"(?U)\s+", " "))


def significant_tokens(c: Column) -> Column:
    """Distinct tokens of three letters or more that are no stop words."""
    toks = F.split(normalise_ascii(c), " ")
    return F.array_distinct(F.filter(toks, lambda t: (F.length(t) >= 3) & ~t.isin(P.STOP_WORDS)))


def title_words(c: Column) -> Column:
    """Distinct lower-case words of four characters or more."""
    return F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit(rf"({P.PY_WORD}{{4,}})"), F.lit(1)))


def overlap(a: Column, b: Column) -> Column:
    """Number of tokens two token sets share."""
    return F.size(F.array_intersect(a, b))


def strip_blank(c: Column) -> Column:
    """Trim whitespace of any script at both ends."""
    return F.trim(c, F.lit(P.BLANK_CHARS))


def word_count(c: Column) -> Column:
    """Runs of word characters."""
    return F.regexp_count(c, F.lit(f"{P.PY_WORD}+"))


def token_count(c: Column) -> Column:
    """Whitespace-separated tokens."""
    return F.regexp_count(c, F.lit(f"(?:{P.NOT_BLANK})+"))


def lines_of(c: Column) -> Column:
    """Lines on newline only."""
    return F.split(c, "\n")


def any_lines_of(c: Column) -> Column:
    """Lines on every kind of line break; no empty line after a final break."""
    return F.split(F.regexp_replace(c, rf"(?:{P.ANY_LINE_BREAK})\z", ""), P.ANY_LINE_BREAK)


def non_blank(lines: Column) -> Column:
    return F.filter(lines, lambda l: l.rlike(P.NOT_BLANK))


def paragraphs_of(c: Column) -> Column:
    """Paragraphs separated by blank lines."""
    return F.split(c, r"(?U)\n\s*\n")


def drop_header(c: Column) -> Column:
    """Remove the leading ``---`` block, if any."""
    return F.regexp_replace(c, r"(?s)\A---.*?---", "")


def header_of(c: Column) -> Column:
    """The leading ``---`` block with its delimiters, or an empty string."""
    return F.regexp_extract(c, r"(?s)\A(---\n.*?\n---\n)", 1)


def body_of(c: Column) -> Column:
    """What follows the leading ``---`` block."""
    return F.substring(c, F.length(header_of(c)) + 1, F.length(c))


def issue_key(series: Column, issue: Column) -> Column:
    return F.format_string("s%02d-c%02d", series.cast("int"), issue.cast("int"))


def year_of(date: Column) -> Column:
    return F.substring(date, 1, 4)


def roman(n: Column) -> Column:
    """Series number as a roman numeral, else the number itself."""
    table = F.array(*[F.lit(r) for r in P.SERIES_ROMANS])
    return F.coalesce(F.get(table, n.cast("int") - 1), n.cast("string"))


def french_ordinal(n: Column) -> Column:
    table = F.array(*[F.lit(o) for o in P.FRENCH_ORDINALS])
    return F.coalesce(F.get(table, n.cast("int") - 1), n.cast("string"))


def issue_title(series: Column, issue: Column) -> Column:
    return F.concat(
        french_ordinal(issue), F.lit(" cahier de la "), F.lower(french_ordinal(series)), F.lit(" série")
    )


def life_years(dates: Column) -> tuple[Column, Column]:
    """Birth and death year from "1873–1914" or the first of "… / …"."""
    first = F.split(dates, "/")[0]
    parts = F.filter(F.transform(F.split(first, "[–—-]"), strip_blank), lambda p: p != "")

    def year(part: Column) -> Column:
        y = F.regexp_extract(part, r"^(\d{3,4})", 1)
        return F.when(y != "", y)

    return year(F.get(parts, F.lit(0))), year(F.get(parts, F.lit(1)))


def sort_name(name: Column) -> Column:
    """"Last, First", except for single names and joint names with "et"."""
    parts = F.filter(F.split(name, r"(?U)\s+"), lambda p: p != "")
    joint = F.exists(parts, lambda p: F.lower(p) == "et")
    return F.when(
        (F.size(parts) >= 2) & ~joint,
        F.concat(
            F.element_at(parts, -1), F.lit(", "), F.array_join(F.slice(parts, 1, F.size(parts) - 1), " ")
        ),
    ).otherwise(name)


def quote_value(c: Column) -> Column:
    """Header value, quoted when it holds special characters or outer blanks."""
    special = c.rlike("[:#'\"\n]") | (strip_blank(c) != c)
    inner = F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    inner = F.replace(F.replace(inner, F.lit("\n"), F.lit("\\n")), F.lit("\t"), F.lit("\\t"))
    return F.when(special, F.concat(F.lit('"'), inner, F.lit('"'))).otherwise(c)


def drop_provenance_lines(c: Column) -> Column:
    """Drop leading comment and blank lines and trailing blanks; end with a newline."""
    s = F.regexp_replace(c, r"(?U)\A(?:(?:#[^\n]*|[^\S\n]*)(?:\n|\z))+", "")
    return F.concat(F.regexp_replace(s, r"(?U)\s+\z", ""), F.lit("\n"))


def is_notice_title(title: Column) -> Column:
    return F.lower(title).rlike("^(avertissement|avis)")


def back_matter_slug(slug: Column, cues: list[str] | None = None) -> Column:
    """The slug holds one of the back-matter cues."""
    found = F.lit(False)
    for cue in cues or P.BACK_MATTER_SLUGS:
        found = found | slug.contains(cue)
    return found
