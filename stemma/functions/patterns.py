"""Patterns and word lists shared by the jobs.

Everything under a "fixed values" comment must stay as it is: results depend
on the exact members. Patterns are Java regular expressions; ``PY_WORD`` and
``BLANK`` name the character classes used for "word character" and
"whitespace" so that accented letters count as letters.
"""

def letters(spec: str) -> str:
    """Spell out the ranges of a character class.

    Java tests a class of single Latin characters with one table lookup, but a
    class of ranges with a chain of comparisons.
    """
    out, i = [], 0
    while i < len(spec):
        if i + 2 < len(spec) and spec[i + 1] == "-":
            out += [chr(n) for n in range(ord(spec[i]), ord(spec[i + 2]) + 1)]
            i += 3
        else:
            out.append(spec[i])
            i += 1
    return "".join(dict.fromkeys(out))


# A word character: any letter or number of any script, or underscore.
PY_WORD = r"[\p{L}\p{N}_]"
# Whitespace of any script, including the four ASCII separators.
BLANK = r"(?U)[\s\x1c-\x1f]"
NOT_BLANK = r"(?U)[^\s\x1c-\x1f]"
BLANK_CHARS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + letters("\u2000-\u200a")
# Every line separator a text may carry.
ANY_LINE_BREAK = "\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85  ]"

# --- fixed values: letters -------------------------------------------------
LOWER_FR = letters("a-zàâçéèêëîïôûùüÿñæœ")
UPPER_FR = letters("A-ZÀÂÇÉÈÊËÎÏÔÛÙÜŸÑÆŒ")
UPPER_WIDE = letters("A-ZÀÂÄÇÉÈÊËÎÏÔÖÛÙÜŸÑÆŒ")
VOWELS = "aeiouyàâäéèêëîïôöûùüÿœæ"
ELISION_LETTERS = "cdjlmnst"

# --- fixed values: function words ------------------------------------------
FUNCTION_WORDS_FR = (
    "le la les de et qui que un une dans pour avec était elle il sur ses au aux "
    "comme son sa nous vous ce cette mais plus tout tous"
).split()
FUNCTION_WORDS_EN = (
    "the and of to in that was with for on but as by at from this all or not are were"
).split()
STOP_WORDS = "le la les de du des un une et ou a au aux en dans sur par pour à".split()

# Words that mark a line as French prose (case matters).
PROSE_WORDS_FR = (
    "le la les l un une des du de "
    "et ou mais donc car ni que qui quoi "
    "dans sur sous avec sans pour par vers chez entre "
    "il elle ils elles on nous vous je tu moi toi lui leur "
    "son sa ses mon ma mes ton ta tes notre votre nos vos "
    "ce cette ces cet "
    "est était sont étaient fut furent sera seront "
    "avait avaient ont avez avons "
    "pas ne plus déjà encore toujours jamais "
    "comme quand où puis alors ainsi aussi même très bien tant tout tous toute toutes "
    "fait faire dit dire voir vu "
    "homme femme enfant jour nuit temps année vie monde pays "
    "père mère fils fille frère sœur "
    "christophe olivier antoinette rolland"
).split()

# --- fixed values: short tokens --------------------------------------------
SHORT_WORDS_OK = (
    "a à y ô an au ce ci de du en es et eu il je la le ma me mu ne ni nu on ou or pu sa se "
    "si su ta te tu un va vu ya ai as ah oh eh ça là où ès dû dé ré"
).split()
ROMAN_NUMERALS = (
    "I II III IV V VI VII VIII IX X XI XII XIII XIV XV XVI XVII XVIII XIX XX "
    "XL L LX XC C CM D M"
).split()
INLINE_TWO_OK = (
    "le la de du et ou ce se me te ne ni on en au si il je tu ma ta sa où "
    "oh ah eh ai as es an un à y"
).split()
INLINE_ONE_OK = "a à y o ô é è ê ï ù".split()

# --- fixed values: line patterns -------------------------------------------
LEAD_NUM_WIDE = rf"(?U)^\s{{0,3}}\d{{1,3}}\s+[{UPPER_WIDE}]"
LEAD_NUM = rf"(?U)^\s{{0,3}}\d{{1,3}}\s+[{UPPER_FR}]"
LEAD_MARK_NARROW = r"(?U)^\s*\||^\s*[#>][^\s#>]"
LEAD_MARK_BROAD = r"(?U)^\s*[#>|]"
CARET_BRACKET = r"[\^\\\[\]]"
CARET = r"[\^\\]"
BRACKET = r"[\[\]]"
LONG_RUN = r"(?U)\S{26,}"
LONG_WORD = rf"(?<!{PY_WORD})[A-Za-zÀ-ÿ]{{26,}}(?!{PY_WORD})"
BACK_MATTER = (
    r"(?iu)imprimerie|abonnement|souscription|rue de la sorbonne|paraissant|whatman|"
    r"le gérant|ouvriers syndiqués|cahier de la .{0,20}série"
)
BACK_MATTER_CUES = (
    rf"(?iuU)(?<!{PY_WORD})(?:Imprimerie|abonnement|souscription|exemplaires?|"
    r"cahier de la (?:première|deuxième|troisième|quatrième|cinquième|sixième|septième|"
    r"huitième|neuvième|dixième|onzième|douzième|treizième|quatorzième|quinzième) série|"
    r"frais d'envoi|le numéro\s*:|le cahier\s*:)"
)
BACK_MATTER_SLUGS = (
    "administration librairie petit-index inventaire annonces proces-verbaux "
    "nouvelles-communications almanach memoires-et-dossiers oeuvres-choisies"
).split()
LEAF_MARKERS = ["[leaf", "[COLOPHON", "[BACK-MATTER", "[GUIEYSSE", "[p."]
ROMAN_PREFIX = r"^(I{1,3}|IV|V|VI{1,3}|IX|X|XI{1,3}|XIV|XV)\.\s"
SOURCE_SKIP = (
    r"-(ocr|leaf-manifest|vision-repair|half\d|translation|manual|completion|"
    r"partial|extension|tail|bak|fill|summary|hathi|extra)"
)

# --- fixed values: labels --------------------------------------------------
NOISE_FLAGS = ["LEAD-NUM", "LEAD-MD", "CARET/BRKT", "MIX-AD", "LONG-TOK", "BACK-MATTER"]
FRENCH_ORDINALS = (
    "Premier Deuxième Troisième Quatrième Cinquième Sixième Septième Huitième Neuvième "
    "Dixième Onzième Douzième Treizième Quatorzième Quinzième Seizième Dix-septième "
    "Dix-huitième Dix-neuvième Vingtième Vingt-et-unième Vingt-deuxième Vingt-troisième"
).split()
SERIES_ROMANS = "I II III IV V VI VII VIII IX X XI XII XIII XIV XV".split()
SECTION_SEGMENTS = {"about": "a-propos", "authors": "auteurs", "works": "oeuvres", "cahiers": "cahiers"}

# A letter run mixed with digits, in either order; lines without a digit need
# not be searched. Every letter of these classes counts in both cases in the
# first pattern; in the second, accented capitals do not.
DIGIT = r"\p{Nd}"
MIXED_TOKEN = (
    rf"(?U)(?<!{PY_WORD})[{LOWER_FR}{LOWER_FR.upper()}]+\d"
    rf"|(?<!{PY_WORD})\d+[{LOWER_FR}{LOWER_FR.upper()}]{{2,}}"
)
MIXED_TOKEN_CASED = (
    rf"(?U)(?<!{PY_WORD})[{letters('A-Z')}{LOWER_FR}]+\d|(?<!{PY_WORD})\d+[{letters('A-Z')}{LOWER_FR}]{{2,}}"
)
