"""Column functions on hand-made values."""

import math
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from stemma.functions import html as H, noise as N, text as T, urls as U
from stemma.plans import leaves as L


def one(spark, value, fn, kind="string"):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    return df.select(fn(F.col("v")).alias("r")).collect()[0].r


@pytest.mark.parametrize("given, expected", [
    ("L'Été à l’école", "l-ete-a-l-ecole"), ("Œuvres choisies", "uvres-choisies"), ("…!", "untitled"),
    (None, "untitled"), ("  Déjà -- vu ", "deja-vu"), ("ﬁn de 1ʳᵉ", "fin-de-1re"),
])
def test_slugify(spark, given, expected):
    assert one(spark, given, T.slugify) == expected


def test_slugify_keeping_accents(spark):
    assert one(spark, "L’Été, “déjà” - vu!", T.slugify_keep_accents) == "lété-déjà-vu"


def test_strip_accents_drops_marks_and_spells_ligatures(spark):
    assert one(spark, "é ç Ÿ ﬀ ½ œ ß", T.strip_accents) == "e c Y ff 1⁄2 œ ß"


def test_word_counts(spark):
    assert one(spark, "été de l’œuvre", T.word_count) == 4
    assert one(spark, "  été de\tl’œuvre \n", T.token_count) == 3
    assert one(spark, "", T.word_count) == 0


def test_lines_follow_every_break(spark):
    assert one(spark, "a\r\nb c\x0bd\n", T.any_lines_of) == ["a", "b", "c", "d"]


def test_header_and_body(spark):
    doc = "---\ntitle: x\n---\nBody\n---\nmore\n"
    assert one(spark, doc, T.header_of) == "---\ntitle: x\n---\n"
    assert one(spark, doc, T.body_of) == "Body\n---\nmore\n"
    assert one(spark, "no header\n---\n", T.body_of) == "no header\n---\n"
    assert one(spark, doc, T.drop_header) == "\nBody\n---\nmore\n"


@pytest.mark.parametrize("dates, years", [
    ("1873–1914", ("1873", "1914")), ("1874–1953 / 1877–1952", ("1874", "1953")), ("1850—?", ("1850", None)), ("", (None, None)),
])
def test_life_years(spark, dates, years):
    born, died = T.life_years(F.col("v"))
    row = spark.createDataFrame([(dates,)], "v string").select(born, died).collect()[0]
    assert tuple(row) == years


@pytest.mark.parametrize("name, expected", [
    ("Marie Curie", "Curie, Marie"), ("Jean et Paul Dupont", "Jean et Paul Dupont"), ("Voltaire", "Voltaire"),
    ("Ana de la Cruz", "Cruz, Ana de la"),
])
def test_sort_name(spark, name, expected):
    assert one(spark, name, T.sort_name) == expected


def test_quote_value(spark):
    assert one(spark, "plain", T.quote_value) == "plain"
    assert one(spark, 'a: "b"', T.quote_value) == '"a: \\"b\\""'
    assert one(spark, " x", T.quote_value) == '" x"'


def test_provenance_lines(spark):
    assert one(spark, "# scan\n\n# page\n \nText # no\nend \n\n", T.drop_provenance_lines) == "Text # no\nend\n"


@pytest.mark.parametrize("token, reference, fixed", [
    ("supEi'be", True, True), ("xrtpq", True, True), ("bcdfgha", True, True), ("d'abord", False, False),
    ("qu'elle", True, False), ("d'Arc", True, False), ("PARIS", False, False), ("mot", False, False),
    ("Constantinople", False, False), ("rkvz", True, True), ("del'insulteur", False, False),
])
def test_garbled_tokens(spark, token, reference, fixed):
    assert one(spark, token, N.is_garbled) is reference
    assert one(spark, token, lambda c: N.is_garbled(c, "fixed")) is fixed


def test_suspects_include_every_garbled_token(spark):
    """The one-scan prefilter agrees with testing every token, over all texts."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(
        F.concat("text", F.lit(" supEi'be xrtpq d'Arc qu'elle 'bcdfgha' ÉTÉs rkvz aujourd’huixx"), F.upper("text"),
                 F.replace("text", F.lit("e"), F.lit("'"))).alias("t"))
    counts = docs.select(
        F.size(F.filter(N.garble_tokens(F.col("t")), lambda t: N.is_garbled(t))).alias("all"),
        F.size(F.filter(N.suspect_tokens(F.col("t")), lambda t: N.is_garbled(t))).alias("some"),
    )
    assert counts.filter("all <> some").count() == 0
    assert counts.agg(F.sum("all")).collect()[0][0] > 1000


def test_line_flags(spark):
    assert one(spark, "12 Le x RU fin", N.line_flags) == ["LEAD-NUM", "SHORTS(x,RU)"]
    assert one(spark, "> fé^Tier [a] ab3c", N.line_flags) == ["LEAD-MD", "CARET", "BRACKET", "MIX-AD"]
    assert one(spark, "voir [a](b) IV et il y a " + "a" * 26, N.line_flags) == ["LONG-TOK"]
    assert one(spark, "Le numéro : deux exemplaires", N.line_flags) == ["BACK-MATTER"]
    assert one(spark, "Une ligne propre.", N.line_flags) == []


@pytest.mark.parametrize("given, expected", [
    ("mysté-\nrieuse", "mystérieuse"), ("pré- \n \n\nJe tiens", "pré- \n \n\nJe tiens"), ("ab-\ncd-\nef", "abcdef"),
    ("grand-père", "grand-père"), ("a-\nbc", "a-\nbc"), ("déjà-\n\nvu", "déjàvu"),
])
def test_heal_hyphens(spark, given, expected):
    assert one(spark, given, N.heal_hyphens) == expected


@pytest.mark.parametrize("given, expected", [
    ("furieu76\n\nsement", "furieusement"), ("en 1900\nle", "en 1900\nle"), ("a3\nbc", "a3\nbc"), ("abc1\nd2\nef", "abcdef"),
    ("a1\nb2\ncde", "a1\nbcde"), ("abc12345\nde", "abc12345\nde"), ("abc1\nd2\ne3\nf", "abcdef"), ("x1\nyz2\nabc", "x1\nyzabc"),
])
def test_heal_page_numbers(spark, given, expected):
    assert one(spark, given, N.heal_page_numbers) == expected


@pytest.mark.parametrize("given, expected", [
    ("la fin 4", "la fin"), ("la fin k", "la fin"), ("la fin . 4", "la fin"), ("il va à", "il va à"), ("il y", "il y"),
    ("fin 1e", "fin"), ("mot ab", "mot ab"), ("un 1 2 3 4 5", "un 1"), ("fin", "fin"), ("", ""),
])
def test_trailing_marks(spark, given, expected):
    assert one(spark, given, N.strip_trailing_marks) == expected


@pytest.mark.parametrize("given, expected", [
    ("le 5e mot", "le mot"), ("le '42 mot", "le mot"), ("le x mot RU bis", "le mot bis"), ("52 pages", "52 pages"),
    ("10 mars 1903", "10 mars 1903"), ("M. Dupont", "M. Dupont"), ("le I] mot | % ,", "le mot,"), ("#> de la", "de la"),
    ("« oui » — non", "« oui » — non"), ("l'un\tou  l'autre", "l'un\tou l'autre"),
])
def test_inline_junk(spark, given, expected):
    assert one(spark, given, N.strip_inline_junk) == expected


@pytest.mark.parametrize("line, noise", [
    ("[leaf 12]", True), ("145", True), ("1903, 12.50", False), ("---", False), ("", False), ("~ ^ |", True), ("| ", True),
    ("et le lendemain.", False), ("Le lendemain.", True), ("Il était une fois dans le pays", False), ("on D RE FRE) NRC Ter SOA aus SR mnt", True),
    ("Tien-Tsin, vingt février", False), ("xx", True),
])
def test_noise_lines(spark, line, noise):
    assert one(spark, line, lambda c: N.split_noise(F.array(c)))[0].noise is noise


def test_clean_html(spark):
    page = (
        '<style>p{}</style><div class="a ws-noexport" id="b">x</div><h2>Un</h2><p>Le <b>mot</b><sup id="r" class="reference">1</sup>'
        '&amp; la<br>suite­</p><table><tr><td>n</td></tr></table><p>[voir](http://x) {.k}&#233;&#xE9;</p>'
    )
    assert one(spark, page, lambda c: H.html_to_text(H.drop_page_furniture(c))) == "## Un\n\nLe mot& la\nsuite\n\nvoir éé"


def test_nested_subtrees(spark):
    nested = lambda page: one(spark, page, lambda c: H.drop_blocked_subtrees(c))
    page = '<div class="noprint"><div>in <p>side</p></div></div><p class="q">out<script>x("<p>")</script></p><div>too &lt;</div>'
    assert nested(page) == '<p class="q">out</p>too &lt;'
    assert nested('<div class="noprint">a<br>b<img src="x"/>c</div>rest <b>bold</b>') == "rest <b>bold</b>"
    assert nested('<p>a</p><div class="x noprint"><p>never closed') == "<p>a</p>"
    assert nested('<hr class="noprint">a < b<!-- <p> --><p>c</p>') == "a &lt; b<p>c</p>"
    assert nested("") == "" and nested(None) is None
    text = "<p>si 5 &lt; 6 alors oui</p><p>suite > fin</p>"
    assert one(spark, text, lambda c: H.html_to_text(H.drop_blocked_subtrees(c))) == "si 5 < 6 alors oui\n\nsuite > fin"


def test_named_references(spark):
    text = "&eacute;t&eacute; &oelig;uvre &amp;eacute; &nope; &amp;amp; &#233;&copy;"
    assert one(spark, text, H.decode_entities) == "été œuvre &eacute; &nope; &amp; é©"


def test_drop_leading_lines(spark):
    text = "Accueil\nPaul Ollendorff, 1904 (Tome 1)\n\nL'Aube\nIl vint.\nfin"
    assert one(spark, text, H.drop_leading_lines) == "Il vint.\nfin"
    assert one(spark, "Titre court\n# Un\nx", H.drop_leading_lines) == "# Un\nx"
    assert one(spark, "court\nbref", H.drop_leading_lines) == ""


def test_urls(spark):
    assert one(spark, "/", U.to_fr) == "/fr/"
    assert one(spark, "/authors/x/", U.to_fr) == "/fr/auteurs/x"
    assert one(spark, "/fr/oeuvres/y", U.to_en) == "/works/y"
    assert one(spark, "/fr/", U.to_en) == "/"
    assert one(spark, "/fr/x", U.to_fr) == "/fr/x"
    assert one(spark, "/france", U.is_fr_path) is False
    assert one(spark, "https://w/wiki/L%E2%80%99Aube_(a+b)", U.page_title) == "L’Aube_(a+b)"
    assert one(spark, "https://w/x", U.page_title) is None


def test_leaf_ranges(spark):
    assert one(spark, "50-53", L.leaf_range) == [50, 51, 52, 53]
    assert one(spark, "54", L.leaf_range) == [54]
    assert one(spark, "9-7", L.leaf_range) == []
    assert one(spark, bytearray(b"\xff\xd8\xff"), L.is_jpeg, "binary") is True
    assert one(spark, bytearray(b"<html>"), L.is_jpeg, "binary") is False


def walked(page):
    """Pages by a stack of one number, token after token."""
    out, depth = [], 0
    for token in re.findall(H.TOKEN, page):
        name = re.match(r"</?([A-Za-z][A-Za-z0-9]*)", token)
        name = name[1].lower() if name else ""
        found = re.search(r"""(?i)\sclass\s*=\s*["']?([^"'>]*)""", token) if token.startswith("<") else None
        words = re.split(r"\s+", found[1]) if found else [""]
        level = name and name not in H.VOID_TAGS and name not in H.BLOCK_TAGS and not token.endswith("/>")
        closes = token.startswith("</")
        blocked = name and not closes and set(words) & set(H.BLOCK_CLASSES)
        if depth:
            depth += (-1 if closes else 1) if level else 0
            continue
        if blocked:
            depth = 1 if level else 0
        elif token == "<":
            out.append("&lt;")
        elif not token.startswith("<"):
            out.append(token)
        elif name in H.KEPT_TAGS:
            named = " ".join(words)
            out.append(("" if name in ("br", "hr") else f"</{name}>") if closes else f"<{name}" + (f' class="{named}"' if named else "") + ">")
    return "".join(out)


def test_nested_subtrees_against_a_walk(spark):
    rnd = random.Random(7)
    parts = ["<div>", "</div>", '<div class="noprint">', '<span class="x pagenum y">', "</span>", "<p>", "</p>", "<br>", '<hr class="noprint">', "text ", " < ", "<!-- <div> -->", "<script>a</b></script>", '<p class="q">', "<b/>", "</x>"]
    pages = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 60))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(pages)), "i int, page string")
    got = {r["i"]: r["out"] for r in df.select("i", H.drop_blocked_subtrees(F.col("page")).alias("out")).collect()}
    assert got == {i: walked(p) for i, p in enumerate(pages)}


def test_time_of_a_page_doubled_in_length_about_doubles(spark):
    part = '<div class="noprint">a<div>b</div></div><p class="q">kept <b>x</b></p><br>&eacute;&#233;'

    def seconds(times):
        df = spark.createDataFrame([(part * times,)] * 8, "page string").repartition(8).cache()
        df.count()
        best = math.inf
        for _ in range(3):
            start = time.perf_counter()
            df.select(F.length(H.html_to_text(H.drop_blocked_subtrees(F.col("page")))).alias("n")).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - start)
        return best

    seconds(50)
    small, large = seconds(1000), seconds(4000)
    assert large < 9 * small, (small, large)
