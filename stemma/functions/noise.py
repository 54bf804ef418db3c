"""Noise columns: garbled tokens, line flags, noise lines and line repairs."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from stemma.functions import patterns as P
from stemma.functions.text import strip_blank

_LOW = P.LOWER_FR
_LETTERS = P.LOWER_FR + P.UPPER_FR


# --- tokens ------------------------------------------------------------------

_TOKEN = P.letters("A-Za-zÀ-ÿ'’")
_CONSONANTS = "bcdfghjklmnpqrstvwxzçñBCDFGHJKLMNPQRSTVWXZÇÑ"


def _without(chars: str) -> str:
    return "".join(c for c in _TOKEN if c not in chars)


# One scan of the text finds the few tokens worth testing: those with a capital
# or an apostrophe after the first letter, a consonant run, or no vowel. The
# loops are possessive, so each token is passed over once per alternative.
_SUSPECT = (
    f"(?<![{_TOKEN}])("
    f"(?=[{_without(P.VOWELS + P.VOWELS.upper())}]{{4,}}+(?![{_TOKEN}])"
    f"|[{_TOKEN}][{_without(P.UPPER_WIDE + chr(39) + '’')}]*+[{P.UPPER_WIDE}'’]"
    f"|(?:[{_CONSONANTS}]{{0,4}}+[{_without(_CONSONANTS)}]++)*+[{_CONSONANTS}]{{5}})"
    f"[{_TOKEN}]++)"
)


def garble_tokens(c: Column) -> Column:
    """Runs of two or more Latin letters and apostrophes."""
    return F.regexp_extract_all(c, F.lit(f"([{_TOKEN}]{{2,}})"), F.lit(1))


def garble_token_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit(f"[{_TOKEN}]{{2,}}"))


def suspect_tokens(c: Column) -> Column:
    """Every token that ``is_garbled`` could accept, and some more."""
    return F.regexp_extract_all(c, F.lit(_SUSPECT), F.lit(1))


def is_garbled(tok: Column, mode: str = "reference") -> Column:
    """The token cannot be a French word.

    ``mode="fixed"`` also accepts ``qu'`` as an elision and a capital right
    after an apostrophe (``d'Arc``).
    """
    fixed = mode == "fixed"
    low = F.regexp_replace(F.lower(tok), "^['’]+|['’]+$", "")
    core = F.regexp_replace(low, r"[^\p{L}]", "")
    before = "[^'’]" if fixed else ""
    mid_capital = tok.rlike(f"^.+(?<={before or '.'})[{P.UPPER_WIDE}]") & tok.rlike("[a-zß-öø-ÿ]")
    glued = F.regexp_extract(low, "([a-zà-ÿ])['’][a-zà-ÿ]{4,}", 1)
    elisions = P.ELISION_LETTERS + ("u" if fixed else "")
    return (F.length(low) >= 4) & (
        mid_capital
        | (
            (F.length(core) >= 4)
            & (
                ~core.rlike(f"[{P.VOWELS}]")
                | core.rlike("[bcdfghjklmnpqrstvwxzçñ]{5,}")
                | ((glued != "") & ~glued.rlike(f"[{elisions}]"))
            )
        )
    )


# --- line flags --------------------------------------------------------------

def ledger_line_patterns(broad_marks: bool = False) -> dict[str, str]:
    """The six line flags of the ledger (or, with ``broad_marks``, the worklist)."""
    return {
        "LEAD-NUM": P.LEAD_NUM if broad_marks else P.LEAD_NUM_WIDE,
        "LEAD-MD": P.LEAD_MARK_BROAD if broad_marks else P.LEAD_MARK_NARROW,
        "CARET/BRKT": P.CARET_BRACKET,
        "MIX-AD": P.MIXED_TOKEN,
        "LONG-TOK": P.LONG_RUN,
        "BACK-MATTER": P.BACK_MATTER,
    }


def has_mixed_token(line: Column, pattern: str = P.MIXED_TOKEN) -> Column:
    """A token mixing letters and digits; only lines with a digit are searched."""
    return line.rlike(P.DIGIT) & line.rlike(pattern)


def count_lines_matching(lines: Column, pattern: str) -> Column:
    if pattern == P.MIXED_TOKEN:
        return F.size(F.filter(lines, lambda l: has_mixed_token(l)))
    return F.size(F.filter(lines, lambda l: l.rlike(pattern)))


def top_flags(names: list[str], counts: list[Column]) -> Column:
    """Nonzero counts as ``name:count`` joined by commas, largest first."""
    entries = F.array(*[
        F.struct((-n).alias("neg"), F.lit(i).alias("pos"), F.lit(name).alias("name"))
        for i, (name, n) in enumerate(zip(names, counts))
    ])
    kept = F.filter(F.array_sort(entries), lambda e: e["neg"] < 0)
    return F.array_join(
        F.transform(kept, lambda e: F.concat(e["name"], F.lit(":"), (-e["neg"]).cast("string"))), ","
    )


def suspect_shorts(line: Column) -> Column:
    """One- and two-letter tokens between blanks that are no French short word."""
    shorts = F.regexp_extract_all(line, F.lit(r"(?U)(?<=\s)([A-Za-zÀ-ÿ]{1,2})(?=\s)"), F.lit(1))
    return F.filter(
        shorts,
        lambda s: ~F.lower(s).isin(P.SHORT_WORDS_OK)
        & ~s.isin(P.ROMAN_NUMERALS)
        & ((F.length(s) == 1) | (s.rlike("[A-ZÀ-ÖØ-Þ]") & ~s.rlike("[a-zß-öø-ÿ]"))),
    )


def line_flags(line: Column) -> Column:
    """Array of the flags a line raises, in fixed order."""
    sus = suspect_shorts(line)
    rules = [
        ("LEAD-NUM", line.rlike(P.LEAD_NUM)),
        ("LEAD-MD", line.rlike(P.LEAD_MARK_BROAD)),
        ("CARET", line.rlike(P.CARET)),
        ("BRACKET", line.rlike(P.BRACKET) & ~line.contains("![") & ~line.contains("](")),
        ("MIX-AD", has_mixed_token(line, P.MIXED_TOKEN_CASED)),
        ("LONG-TOK", line.rlike(P.LONG_WORD)),
        ("BACK-MATTER", line.rlike(P.BACK_MATTER_CUES)),
    ]
    flags = [F.when(cond, F.lit(name)) for name, cond in rules]
    flags.append(
        F.when(F.size(sus) > 0, F.concat(F.lit("SHORTS("), F.array_join(F.slice(sus, 1, 6), ","), F.lit(")")))
    )
    return F.filter(F.array(*flags), lambda f: f.isNotNull())


# --- prose lines -------------------------------------------------------------

_REAL_WORD_2 = rf"(?<![A-Z{_LOW}])(?:[{P.UPPER_FR}]?[{_LOW}]{{2,}})(?![A-Z{_LOW}])"
_TWO_REAL_WORDS = rf"{_REAL_WORD_2}.*?{_REAL_WORD_2}"


def _any_word(words: list[str]) -> str:
    return rf"(?iu)(?<!{P.PY_WORD})(?:{'|'.join(words)})(?!{P.PY_WORD})"


_FR_WORD = _any_word(P.FUNCTION_WORDS_FR)
_EN_WORD = _any_word(P.FUNCTION_WORDS_EN)


def is_prose_line(line: Column, french: Column) -> Column:
    """Two real words or more and a function word of the document's language."""
    return line.rlike(_TWO_REAL_WORDS) & F.when(french, line.rlike(_FR_WORD)).otherwise(line.rlike(_EN_WORD))


# --- noise lines -------------------------------------------------------------

_MARKER = "^(?:" + "|".join(
    "".join("\\" + ch if not ch.isalnum() else ch for ch in m) for m in P.LEAF_MARKERS
) + ")"


def _line_facts(lines: Column) -> Column:
    """Token counts of each line, as structs read by ``_noise_verdict``.

    Built in stages, because a lambda evaluates each use of a sub-expression anew.
    """
    staged = F.transform(lines, lambda l: F.struct(l.alias("line"), strip_blank(l).alias("bare")))
    staged = F.transform(staged, lambda s: F.struct(
        s["line"].alias("line"),
        s["bare"].alias("bare"),
        F.when(s["bare"].startswith("|"), F.regexp_replace(s["bare"], r"(?U)^(?:\|\s*)+", ""))
        .otherwise(s["bare"]).alias("text"),
    ))
    staged = F.transform(staged, lambda s: F.struct(
        *[s[c].alias(c) for c in ("line", "bare", "text")],
        F.regexp_extract_all(s["text"], F.lit(f"([{_LETTERS}]+)"), F.lit(1)).alias("runs"),
    ))
    return F.transform(staged, lambda s: F.struct(
        *[s[c].alias(c) for c in ("line", "bare", "text")],
        F.filter(s["runs"], lambda r: r.rlike(f"^[{P.UPPER_FR}]?[{_LOW}]{{3,}}$")).alias("real"),
        F.exists(s["runs"], lambda r: r.isin(P.PROSE_WORDS_FR)).alias("hit"),
        F.aggregate(s["runs"], F.lit(0), lambda n, r: n + F.length(r)).alias("letters"),
        F.regexp_count(s["text"], F.lit(r"(?U)(?<!\S)[^\s\p{L}]*+\p{L}")).alias("tokens"),
    ))


def _noise_verdict(f: Column) -> Column:
    n = F.size(f["real"])
    size = F.length(f["text"])
    share = f["letters"] / size

    def has_word(k: int) -> Column:
        return F.exists(f["real"], lambda w: F.length(w) >= k)

    return (
        F.when((f["bare"] == "") | f["bare"].rlike("^(?:---|```)"), False)
        .when(size == 0, True)
        .when(f["text"].rlike(_MARKER), True)
        .when(f["text"].rlike(r"(?U)^\d{1,4}$"), True)
        .when(f["text"].rlike(r"(?U)^[\d\s.,\-–—]+$"), False)
        .when(f["letters"] == 0, True)
        .when((f["tokens"] >= 5) & (n / f["tokens"] < 0.4), True)
        .when((n >= 3) & (share >= 0.55) & (f["hit"] | has_word(5)), False)
        .when((n >= 2) & f["hit"] & (share >= 0.5), False)
        .when((n >= 1) & f["hit"] & (share >= 0.65) & (size <= 40) & has_word(4), False)
        .otherwise(True)
    )


def split_noise(lines: Column) -> Column:
    """Lines with their verdict: array of struct(line, noise)."""
    return F.transform(
        _line_facts(lines), lambda f: F.struct(f["line"].alias("line"), _noise_verdict(f).alias("noise"))
    )


# --- line repairs ------------------------------------------------------------

def strip_leading_number(line: Column) -> Column:
    """Page number in front of a capital."""
    return F.regexp_replace(line, rf"(?U)^\d{{1,3}}\s+(?=[{P.UPPER_FR}])", "")


def _only(words: list[str]) -> str:
    return "|".join(words)


_DIGIT = r"\p{Nd}²³¹⁰⁴-⁹₀-₉"
_JUNK_TOKEN = (
    r"(?U)(?<!\S)(?:"
    # a short mix of letters and digits
    rf"(?=\S{{1,5}}(?!\S))(?=\S*[{_DIGIT}])(?=\S*\p{{L}})\S+"
    # a quote mark glued to digits
    r"|['‘’`]\p{Nd}{1,4}[.,;:'‘’`]?"
    # one letter and one symbol
    r"|\p{L}[^\p{L}\p{N}\s.]|[^\p{L}\p{N}\s.]\p{L}"
    # symbols only, other than the punctuation of running text
    rf"|(?![,;:!?—–\-…«»()](?!\S))[^\p{{L}}{_DIGIT}\s.]+"
    # stray single letters and letter pairs
    rf"|(?!(?iu:{_only(P.INLINE_ONE_OK)})(?!\S))\p{{L}}"
    rf"|(?!(?iu:{_only(P.INLINE_TWO_OK)})(?!\S))\p{{L}}{{2}}"
    r")(?!\S)"
)


def strip_inline_junk(line: Column) -> Column:
    """Drop stray tokens and tidy the spacing they leave."""
    s = F.regexp_replace(line, r"(?U)^[#>]+\s*", "")
    s = F.regexp_replace(s, _JUNK_TOKEN, "")
    s = F.regexp_replace(s, " {2,}", " ")
    s = F.regexp_replace(s, r"(?U)\s+([.,;:!?])", "$1")
    return strip_blank(s)


_TAIL = (
    r"\s+[*\-–—|:;,.]?\s*"
    rf"(?:(?=[{_LETTERS}]{{0,2}}[0-9])[0-9{_LETTERS}]{{1,3}}|(?![àyÀYaA])[{_LETTERS}])"
    r"[.,;:!?]?"
)


def strip_trailing_marks(line: Column) -> Column:
    """Drop margin marks at the line end, at most four of them."""
    return F.regexp_replace(line, rf"(?U)(?:{_TAIL}){{0,4}}\s*$", "")


def repair_line(line: Column) -> Column:
    return strip_trailing_marks(strip_inline_junk(strip_leading_number(line)))


# --- healing across lines ----------------------------------------------------

_BREAK = r"[^\S\n]*\n(?:[^\S\n]*\n)*"
_HYPHEN_BREAK = rf"(?U)(?<=[{_LOW}]{{2}})-{_BREAK}(?=[{_LOW}]{{2}})"
# The two halves must hold four letters together. A half that was itself healed
# just before (\G) is long enough already.
_NUMBER_BREAK = (
    rf"(?U)(?:(?<=\n)\G([{_LOW}]{{1,2}})\p{{Nd}}{{1,4}}{_BREAK}(?=[{_LOW}])"
    rf"|(?<=[{_LOW}]{{3}})\p{{Nd}}{{1,4}}{_BREAK}(?=[{_LOW}])"
    rf"|(?<=[{_LOW}]{{2}})\p{{Nd}}{{1,4}}{_BREAK}(?=[{_LOW}]{{2}})"
    rf"|(?<=[{_LOW}])\p{{Nd}}{{1,4}}{_BREAK}(?=[{_LOW}]{{3}}))"
)


def heal_hyphens(body: Column) -> Column:
    """Join words hyphenated at a line end."""
    return F.regexp_replace(body, _HYPHEN_BREAK, "")


def heal_page_numbers(body: Column) -> Column:
    """Join words cut by a page number at a line end."""
    healed = F.regexp_replace(body, _NUMBER_BREAK, "$1")
    return F.when(body.rlike(r"(?U)\d\s*\n"), healed).otherwise(body)


def count_hyphen_breaks(body: Column) -> Column:
    return F.regexp_count(body, F.lit(_HYPHEN_BREAK))


def count_number_breaks(body: Column) -> Column:
    return F.regexp_count(body, F.lit(_NUMBER_BREAK))
