"""The jobs bound to the supplied tables: one callable per registered query."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stemma.functions import html as H, text as T, urls as U
from stemma.operators import upsert as X
from stemma.operators.lookup import resolve_names as resolve
from stemma.plans import audit as A, cleaning as C, leaves as L, migration as M, planning as G, reading as R
from stemma.plans import long_documents as LD, segmentation as S

QUERIES: dict = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def texts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents")


# --- rule tables used as the small side --------------------------------------

BACK_CUES = ["tion-the", "and-the", "eau"]


def rules(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def documents(spark: SparkSession, sf: str) -> DataFrame:
    """documents as pieces: doc, cahier (source), piece_slug (first words), lang, body."""
    return texts(spark, sf).select(
        F.col("doc_id").alias("doc"),
        F.col("source").alias("cahier"),
        T.slugify(first_words(F.col("text"), 4)).alias("piece_slug"),
        "lang",
        F.col("text").alias("body"),
    )


def first_words(text: Column, n: int) -> Column:
    return F.substring_index(F.split(text, "\n")[0], " ", n)


def actions(spark: SparkSession, sf: str) -> DataFrame:
    """labels as the action table."""
    lab = table(spark, sf, "labels")
    action = (
        F.when(F.col("toxic") == 1, "filter-blocked")
        .when(F.col("quality") == 1, "use-wikisource")
        .otherwise("skip")
    )
    return lab.select(F.col("doc_id").alias("doc"), action.alias("action"))


# --- audits --------------------------------------------------------------------

@query
def noise_ledger(spark, sf):
    docs = documents(spark, sf).select("doc", "cahier", "piece_slug", "body")
    scanned = table(spark, sf, "documents").filter("n_chars > 12000").select(
        F.col("source").alias("cahier")
    )
    ledger = A.noise_ledger(docs, actions(spark, sf), scanned, BACK_CUES)
    return ledger.select(
        F.col("rank").cast("bigint").alias("rank"), "score", "garble_pct", "line_pct", "status", "bucket",
        "doc", "cahier", "piece_slug", F.col("lines").cast("bigint").alias("lines"),
        F.col("words").cast("bigint").alias("words"), "top_flags",
    )


@query
def ledger_totals(spark, sf):
    docs = documents(spark, sf).select("doc", "cahier", "piece_slug", "body")
    scanned = table(spark, sf, "documents").filter("n_chars > 20000").select(F.col("source").alias("cahier"))
    return A.ledger_totals(A.noise_ledger(docs, actions(spark, sf), scanned, BACK_CUES, ranked=False))


@query
def worst_documents(spark, sf):
    docs = documents(spark, sf).select("doc", "cahier", "piece_slug", "body")
    scanned = table(spark, sf, "documents").filter("n_chars > 20000").select(F.col("source").alias("cahier"))
    ledger = A.noise_ledger(docs, actions(spark, sf), scanned, BACK_CUES, ranked=False)
    return A.worst_documents(ledger, 20).select("doc", "score", "garble_pct", "status", "top_flags")


@query
def review_worklist(spark, sf):
    lab = table(spark, sf, "labels").filter("quality = 0 OR toxic = 1")
    # a second listing per document that names no document: kept with score -1
    wanted = lab.select(F.col("doc_id").alias("doc"), "quality").unionByName(
        lab.filter("toxic = 1").select((-F.col("doc_id") - 1).alias("doc"), "quality")
    )
    docs = documents(spark, sf).select("doc", "body")
    return A.review_worklist(wanted, docs).select(
        F.col("rank").cast("bigint").alias("rank"), "score", "doc", "quality",
        F.col("lines").cast("bigint").alias("lines"), "flags",
    )


@query
def line_flags(spark, sf):
    return A.flag_lines(documents(spark, sf).select("doc", "body")).select(
        "doc", F.col("line_no").cast("bigint").alias("line_no"), "flags", "text"
    )


@query
def flagged_line_counts(spark, sf):
    return A.flagged_line_counts(documents(spark, sf).select("doc", "body")).select(
        "doc", F.col("n").cast("bigint").alias("n")
    )


@query
def prose_audit(spark, sf):
    stats = A.prose_stats(documents(spark, sf).select("doc", "lang", "body"))
    return stats.select(
        "doc", F.col("n_lines").cast("bigint").alias("n_lines"),
        F.col("prose_lines").cast("bigint").alias("prose_lines"),
        F.bround("ratio", 3).alias("ratio"),
        A.prose_flag(F.col("prose_lines"), F.col("ratio")).alias("flag"),
    )


@query
def word_counts(spark, sf):
    return texts(spark, sf).select(
        "doc_id",
        T.word_count(F.col("text")).cast("bigint").alias("words"),
        T.token_count(F.col("text")).cast("bigint").alias("tokens"),
    )


# --- document audit: pairs of documents stand for the two languages of a piece ---

def paired(spark, sf):
    d = texts(spark, sf)
    pair = F.floor(F.col("doc_id") / 2)
    return d.select(
        "doc_id", F.concat(F.lit("c"), (pair % 37).cast("string")).alias("cahier"),
        F.concat(F.lit("d"), pair.cast("string")).alias("piece_slug"),
        F.when(F.col("doc_id") % 2 == 0, "fr").otherwise("en").alias("lang"), "source", "n_chars",
        F.col("text").alias("body"),
    )


def declared_from_labels(spark, sf):
    docs = paired(spark, sf).select("doc_id", "cahier", "piece_slug", first_words(F.col("body"), 6).alias("title"))
    lab = table(spark, sf, "labels").select("doc_id", "quality")
    rows = docs.join(lab, "doc_id").groupBy("cahier", "piece_slug").agg(
        F.min_by("title", "doc_id").alias("title"),
        F.concat(F.lit("a"), F.min_by("quality", "doc_id").cast("string")).alias("listed_author"),
        F.min("doc_id").alias("pos"),
    )
    return rows.withColumn("split_suspect", F.col("title").rlike(r"^(La|The|Is) "))


SURNAMES = [
    ("Then", "a1", 1, False), ("ea ", "a0", 2, False), ("The", "a1", 3, True), ("eau", "a9", 4, False),
    ("tion", "a1", 5, False), ("ung", "a0", 6, False),
]


def document_audit_rows(spark, sf):
    docs = paired(spark, sf)
    lab = table(spark, sf, "labels").filter("toxic = 1").select("doc_id", F.lit(1).alias("bad"))
    upstream = docs.filter("n_chars > 6000").select("doc_id", "cahier").join(lab, "doc_id", "left").select(
        "cahier", F.when(F.col("bad") == 1, "placeholder").otherwise("full").alias("status")
    )
    surnames = rules(spark, SURNAMES, "surname string, slug string, ord int, subject_only boolean")
    return A.audit_declared(declared_from_labels(spark, sf), docs, upstream, surnames)


@query
def audit_documents(spark, sf):
    a = document_audit_rows(spark, sf)
    return a.select(
        "cahier", "piece_slug", "title", "listed_author", F.col("fr_prose").cast("bigint").alias("fr_prose"),
        F.bround("fr_ratio", 2).alias("fr_ratio"), F.col("en_prose").cast("bigint").alias("en_prose"),
        F.bround("en_ratio", 2).alias("en_ratio"), "flags",
    )


@query
def flag_histogram(spark, sf):
    return A.flag_histogram(document_audit_rows(spark, sf))


@query
def flag_report_top50(spark, sf):
    a = document_audit_rows(spark, sf).withColumn("doc", F.concat_ws("--", "cahier", "piece_slug"))
    a = a.withColumn("line", F.concat("doc", F.lit(": "), "title"))
    return A.flag_report(a).select("section", F.col("pos").cast("bigint").alias("pos"), "line")


@query
def declared_vs_files(spark, sf):
    """Labelled documents against long documents: both, only declared, only found."""
    lab = table(spark, sf, "labels").select("doc_id", F.lit(True).alias("declared"))
    files = table(spark, sf, "documents").filter("n_chars > 1500").select("doc_id", F.lit(True).alias("found"))
    rows = lab.join(files, "doc_id", "full_outer")
    state = F.when(F.col("declared").isNull(), "ORPHAN_FILE").when(F.col("found").isNull(), "NO_FILE").otherwise("OK")
    return rows.select("doc_id", state.alias("state"))


@query
def missing_references(spark, sf):
    """Orders whose customer and labels whose document do not resolve (keys shifted to make some fail)."""
    from stemma.sources.catalog import missing_references as missing

    orders = table(spark, sf, "orders").select(
        "o_orderkey", (F.col("o_custkey") * 2).alias("customer"), (F.col("o_custkey") % 150).alias("supplier")
    )
    return missing(orders, "o_orderkey", {
        "customer": (table(spark, sf, "customer"), "c_custkey"),
        "supplier": (table(spark, sf, "supplier"), "s_suppkey"),
    })


@query
def lang_pivot(spark, sf):
    docs = paired(spark, sf).withColumn("lang", F.when(F.col("n_chars") > 900, F.col("lang")).otherwise("xx"))
    p = R.language_pivot(docs.select("cahier", "piece_slug", "lang"))
    fr, en = F.col("fr"), F.col("en")
    return p.select(
        "cahier", "piece_slug", "fr", "en",
        R.primary_language(fr, en, "en").alias("primary_en"), R.other_language(fr, en, "en").alias("other_en"),
        R.primary_language(fr, en, "fr").alias("primary_fr"), R.other_language(fr, en, "fr").alias("other_fr"),
        (~fr & ~en).alias("is_pending"),
    )


# --- planning ------------------------------------------------------------------------

@query
def source_inventory(spark, sf):
    d = texts(spark, sf)
    noisy = F.replace(F.replace(F.replace(
        F.col("text"), F.lit("tion "), F.lit("tion-\n")), F.lit("er "), F.lit("er7\n")), F.lit(". "), F.lit(" [?] "))
    docs = d.select(F.col("source").alias("cahier"), F.lit("org-piece").alias("type"),
                    F.concat(F.lit("pieces/"), F.col("doc_id").cast("string"), F.lit(".md")).alias("path"), noisy.alias("text"))
    pages = table(spark, sf, "pages").select(
        F.concat(F.lit("src"), (F.col("page_id") % 20).cast("string")).alias("cahier"), F.lit("com-cahier").alias("type"),
        F.concat(F.lit("texts/"), F.col("page_id").cast("string"), F.lit(".md")).alias("path"), F.col("html").alias("text"))
    conv = table(spark, sf, "conversations").select(
        F.concat(F.lit("src"), (F.col("conv_id") % 20).cast("string")).alias("cahier"), F.lit("slug-fallback").alias("type"),
        F.concat(F.lit("raw/"), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string"), F.lit("-"),
                 F.col("role"), F.lit(".txt")).alias("path"), F.col("text"))
    out = G.source_inventory(docs, pages, conv, skip="-(system|extra)")
    ints = ["lines", "hyph_end", "pgnum_end", "weird", "qmark", "bytes"]
    return out.select("cahier", "type", *[F.col(c).cast("bigint").alias(c) for c in ints], "path")


TIERS = [("src0", "T1"), ("src1", "T1"), ("src2", "T2"), ("src3", "T2"), ("src4", "T2")]
URL_RULES = [
    ("src1", "and-the", "contains", "Page_A", "proofread", "use-wikisource", 1),
    ("src1", "tion", "contains", "Page_B", "validated", "use-wikisource", 2),
    ("src3", "the", "contains", "Page_C", "proofread", "use-wikisource", 3),
    ("src1", "c5", "issue", "Page_D", "validated", "use-wikisource-jc", 4),
    ("src2", "c1", "issue", "Page_E", "validated", "use-wikisource-jc", 5),
]
SKIP_TITLES = [("src0", "The", 1), ("src0", "er ", 2), ("src1", "Of", 3)]
DEFAULTS = [("src0", "verify-first"), ("src1", "verify-second")]


def source_plan_rows(spark, sf):
    d = table(spark, sf, "documents")
    docs = d.select(
        F.col("doc_id").alias("doc"), F.concat(F.lit("c"), (F.col("doc_id") % 7).cast("string")).alias("cahier"),
        T.slugify(first_words(F.col("text"), 4)).alias("piece_slug"), F.col("source").alias("author"),
        first_words(F.col("text"), 6).alias("title"),
    )
    schema = "author string, key string, match string, url string, status string, action string, ord int"
    exact = docs.join(
        table(spark, sf, "labels").filter("quality = 1 AND toxic = 1").select(F.col("doc_id").alias("doc")), "doc"
    ).select(
        "author", F.col("piece_slug").alias("key"), F.lit("exact").alias("match"),
        F.concat(F.lit("Doc_"), F.col("doc").cast("string")).alias("url"), F.lit("validated").alias("status"),
        F.lit("use-wikisource").alias("action"), F.col("doc").cast("int").alias("ord"),
    )
    return G.source_plan(
        docs, rules(spark, TIERS, "author string, tier string"),
        rules(spark, URL_RULES, schema).unionByName(exact),
        rules(spark, SKIP_TITLES, "author string, words string, ord int"),
        rules(spark, DEFAULTS, "author string, action string"), "https://example.org/wiki/",
    )


@query
def source_plan(spark, sf):
    return source_plan_rows(spark, sf)


@query
def plan_counts(spark, sf):
    return G.category_counts(source_plan_rows(spark, sf), "tier", "action", "status")


@query
def candidate_verdicts(spark, sf):
    """benchmark passages as wanted titles, documents sharing five words in a row as candidates."""
    def grams(rows, key):
        toks = F.filter(F.split(F.lower("text"), r"\s+"), lambda t: t != "")
        rows = rows.select(key, toks.alias("toks")).filter(F.size("toks") >= 5)
        runs = F.transform(F.sequence(F.lit(1), F.size("toks") - 4), lambda i: F.array_join(F.slice("toks", i, 5), " "))
        return rows.select(key, F.explode(runs).alias("g"))

    bench = table(spark, sf, "benchmark")
    wanted = bench.select(F.col("item_id").alias("wanted"), F.regexp_extract("text", r"^[^.\n]*", 0).alias("title"))
    want_grams = grams(bench, "item_id").distinct()
    doc_grams = grams(texts(spark, sf), "doc_id")
    pairs = doc_grams.join(want_grams, "g").select("item_id", "doc_id").distinct()
    quality = table(spark, sf, "labels").select("doc_id", F.when(
        F.col("quality") == 1, F.array(F.lit("Textes validés"))).otherwise(F.array(F.lit("Textes corrigés"))).alias("categories"))
    cands = pairs.join(table(spark, sf, "documents").select("doc_id", "text"), "doc_id").join(quality, "doc_id", "left")
    cands = cands.select(
        F.col("item_id").alias("wanted"), F.col("doc_id").alias("rank"), F.col("text").alias("title"),
        T.token_count(F.col("text")).alias("word_count"), "categories", "doc_id",
    )
    out = G.candidate_verdicts(wanted, cands.withColumn("categories", F.coalesce("categories", F.array().cast("array<string>"))))
    return out.select("wanted", "verdict", F.md5("best").alias("best_md5"), F.col("verdict_order").cast("bigint").alias("verdict_order"))


@query
def resolve_names(spark, sf):
    """customer names with near variants against supplier names as the register."""
    c = table(spark, sf, "customer")
    key = F.col("c_custkey").cast("bigint")
    plain = c.select(F.replace("c_name", F.lit("C"), F.lit("Ç")).alias("name"), (key * 4).alias("ord"))
    near = c.filter("c_nationkey > 12").select(
        F.concat(F.lower("c_name"), F.substring("c_mktsegment", 1, 2)).alias("name"), (key * 4 + 1).alias("ord"))
    far = c.filter("c_nationkey < 6").select(
        F.concat(F.replace(F.substring("c_name", 9, 12), F.lit("#"), F.lit("Supplier#")), F.lit("-")).alias("name"),
        (key * 4 + 2).alias("ord"))
    blank = c.filter("c_acctbal < 0").select(F.lit(" ").alias("name"), (key * 4 + 3).alias("ord"))
    s = table(spark, sf, "supplier").select(
        F.col("s_name").alias("name"), F.concat(F.lit("s-"), F.col("s_suppkey").cast("string")).alias("slug"),
        F.col("s_suppkey").alias("ord"))
    return resolve(plain.unionByName(near).unionByName(far).unionByName(blank), s)


@query
def slug_dedupe(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_brand", "p_name")
    return M.number_slugs(p, "p_brand", "p_name", "p_partkey").select("p_partkey", "p_brand", "slug")


@query
def url_views(spark, sf):
    p = table(spark, sf, "pages")
    path = F.regexp_extract("url", r"^https?://[^/]+([^?#]*)", 1)
    title = F.replace(F.regexp_extract("html", r"<title>([^<]*)</title>", 1), F.lit(" "), F.lit("_"))
    wiki = F.concat(F.lit("https://w.example.org/wiki/"), F.url_encode(title))
    section = F.element_at(F.array(F.lit("about"), F.lit("authors"), F.lit("works"), F.lit("cahiers"), F.lit("x")),
                           (F.col("page_id") % 5 + 1).cast("int"))
    inner = F.concat(F.lit("/"), section, F.lit("/"), F.col("page_id").cast("string"))
    fr = U.is_fr_path(path)
    key = F.col("page_id").cast("string")
    return p.select(
        "page_id", path.alias("path"), fr.alias("is_fr"), U.to_fr(path).alias("fr_path"), U.to_en(path).alias("en_path"),
        U.to_fr(inner).alias("fr_inner"), U.to_en(U.to_fr(inner)).alias("en_inner"), U.page_title(wiki).alias("title"),
        U.piece_url(F.lit("s01-c01"), key, F.lit("fr"), fr).alias("piece_url"), U.cahier_url(key, fr).alias("cahier_url"),
        U.author_url(key, fr).alias("author_url"), U.work_url(key, fr).alias("work_url"),
    )


# --- reading views: orders as issues, customers as authors -----------------------------

def order_issues(spark, sf, dated: bool = False):
    """orders as issues: the priority is the series; unfinished ones have no date."""
    date = F.date_format("o_orderdate", "yyyy-MM-dd")
    if not dated:
        date = F.when(F.col("o_orderstatus") != "P", date)
    return table(spark, sf, "orders").select(
        F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("slug"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("series"),
        F.col("o_orderkey").alias("issue"), F.col("o_orderpriority").alias("label"), date.alias("date"),
    )


@query
def river(spark, sf):
    return R.river(order_issues(spark, sf)).select(
        "river_no", "series", "slug", "issue", "date", "is_series_start", "series_roman", "series_year"
    )


@query
def river_dated(spark, sf):
    return R.river(order_issues(spark, sf, dated=True)).select("river_no", "series", "slug", "is_series_start")


@query
def issue_neighbours(spark, sf):
    return R.issue_neighbours(order_issues(spark, sf))


@query
def series_overview(spark, sf):
    return R.series_overview(order_issues(spark, sf))


def order_pieces(spark, sf):
    """orders as declared pieces of their customer's issue; some authors are unknown."""
    return table(spark, sf, "orders").select(
        F.concat(F.lit("k"), F.col("o_custkey").cast("string")).alias("cahier"), F.col("o_orderkey").alias("pos"),
        F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("piece_slug"), F.col("o_orderpriority").alias("title"),
        F.concat(F.lit("s"), (F.col("o_custkey") % 1200).cast("string")).alias("author"),
        (F.col("o_orderstatus") == "P").alias("is_notice"), "o_orderstatus",
    )


def order_texts(spark, sf):
    """Finished orders have a French text, open ones an English one, partial ones both; cheap ones none."""
    p = order_pieces(spark, sf).join(
        table(spark, sf, "orders").filter("o_totalprice > 60000").select(F.col("o_orderkey").alias("pos")), "pos")
    langs = F.when(F.col("o_orderstatus") == "P", F.array(F.lit("fr"), F.lit("en"))).when(
        F.col("o_orderstatus") == "F", F.array(F.lit("fr"))).otherwise(F.array(F.lit("en")))
    return p.withColumn("lang", F.explode(langs))


def customer_issues(spark, sf):
    return table(spark, sf, "customer").select(
        F.concat(F.lit("k"), F.col("c_custkey").cast("string")).alias("slug"), F.col("c_nationkey").alias("series"),
        F.col("c_custkey").alias("issue"), F.col("c_name").alias("label"),
    )


def supplier_authors(spark, sf):
    return table(spark, sf, "supplier").select(
        F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("slug"), F.col("s_name").alias("name"),
        (F.col("s_acctbal") > 5000).alias("is_editor"),
    )


@query
def cahier_view(spark, sf):
    return R.cahier_view(
        customer_issues(spark, sf), order_pieces(spark, sf).drop("o_orderstatus"), order_texts(spark, sf),
        supplier_authors(spark, sf))


@query
def piece_view(spark, sf):
    return R.piece_view(
        order_texts(spark, sf).select("cahier", "piece_slug", "lang", "author"), order_pieces(spark, sf),
        customer_issues(spark, sf), supplier_authors(spark, sf))


def contributions(spark, sf):
    return R.author_contributions(
        supplier_authors(spark, sf), customer_issues(spark, sf), order_pieces(spark, sf), order_texts(spark, sf))


@query
def author_contributions(spark, sf):
    return contributions(spark, sf)


@query
def contribution_counts(spark, sf):
    return R.contribution_counts(contributions(spark, sf))


@query
def author_index(spark, sf):
    c = table(spark, sf, "customer")
    authors = c.select(
        F.concat(F.lit("k"), F.col("c_custkey").cast("string")).alias("slug"), F.col("c_name").alias("name"),
        F.when(F.col("c_nationkey") > 3, T.sort_name(F.replace("c_name", F.lit("#"), F.lit(" ")))).otherwise("").alias("name_sort"),
        F.when(F.col("c_acctbal") > 0, (F.floor(F.col("c_acctbal") / 10) + 1000).cast("string")).alias("born"),
        F.when(F.col("c_nationkey") > 10, (F.col("c_nationkey") + 1900).cast("string")).alias("died"),
        (F.col("c_mktsegment") == "BUILDING").alias("is_editor"))
    return R.author_index(authors).select("slug", "name", "sort_key", "is_editor", "years")


@query
def notice_targets(spark, sf):
    texts_ = order_texts(spark, sf).withColumn(
        "introduces_piece", F.when(F.col("is_notice"), F.concat(F.lit("o"), (F.col("pos") + F.col("pos") % 7 - 3).cast("string"))))
    one_issue = F.concat(F.lit("g"), F.floor(F.col("pos") / 20).cast("string"))
    declared = order_pieces(spark, sf).withColumn("cahier", one_issue)
    return R.notice_targets(texts_.withColumn("cahier", one_issue), declared)


@query
def work_parts(spark, sf):
    conv = table(spark, sf, "conversations").withColumn("key", F.col("conv_id") * 10 + F.col("turn"))
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("key"), "o_custkey")
    parts = conv.join(orders, "key", "left").select(
        F.concat(F.lit("w"), F.col("conv_id").cast("string")).alias("work"), F.col("turn").alias("pos"),
        F.when(F.col("role") == "user", F.concat(F.lit("k"), F.col("o_custkey").cast("string"))).otherwise("k?").alias("cahier"),
        F.concat(F.lit("o"), F.col("key").cast("string")).alias("piece_slug"),
        F.when(F.col("role") == "system", F.lit("Prologue")).alias("label"),
    )
    return R.work_view(parts, customer_issues(spark, sf), order_pieces(spark, sf), order_texts(spark, sf))


@query
def works_of_issues(spark, sf):
    parts = table(spark, sf, "orders").select(
        F.concat(F.lit("k"), F.col("o_custkey").cast("string")).alias("cahier"),
        F.concat(F.lit("w"), F.col("o_orderkey").cast("string")).alias("work"))
    works = table(spark, sf, "conversations").filter("turn = 0").select(
        F.concat(F.lit("w"), F.col("conv_id").cast("string")).alias("slug"), first_words(F.col("text"), 3).alias("title"))
    return R.works_of_issues(parts, works)


# --- corrections and merges --------------------------------------------------------------

def document_pieces(spark, sf):
    d = table(spark, sf, "documents")
    return d.select(
        F.col("source").alias("cahier"), F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("piece_slug"),
        F.col("doc_id").alias("pos"), first_words(F.col("text"), 5).alias("title"), F.col("lang").alias("author"))


@query
def apply_corrections(spark, sf):
    return corrected(spark, sf)[0]


@query
def correction_log(spark, sf):
    return corrected(spark, sf)[1]


def corrected(spark, sf):
    pieces = document_pieces(spark, sf)
    lab = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "source"), "doc_id")
    slug = F.concat(F.lit("d"), F.col("doc_id").cast("string"))
    none = F.lit(None).cast("string")
    set_author = lab.filter("toxic = 1").select(
        F.col("source").alias("cahier"), slug.alias("piece_slug"), F.lit("author").alias("field"), none.alias("from"),
        F.lit("toxic").alias("to"), F.lit("set").alias("op"))
    swap = lab.filter("quality = 0").select(
        F.col("source").alias("cahier"), slug.alias("piece_slug"), F.lit("title").alias("field"), F.lit("e").alias("from"),
        F.lit("E").alias("to"), F.lit("replace").alias("op"))
    # a second rule for the same pieces, after the first, and rules for whole issues after both
    again = swap.withColumns({"from": F.lit("E"), "to": F.lit("3"), "ord": F.lit(2)})
    issue = rules(spark, [("src1", None, "title", "The", "A", "replace"), ("src2", None, "title", "tion", "-", "replace"), ("src3", None, "title", "3", "", "replace")],
                  "cahier string, piece_slug string, field string, from string, to string, op string").withColumn("ord", F.lit(3))
    adds = lab.filter("toxic = 1").select(
        F.col("source").alias("cahier"),
        F.explode(F.array(slug, F.concat(F.lit("new-"), slug))).alias("piece_slug"), F.lit("piece").alias("field"),
        F.lit("added").alias("from"), F.concat(F.lit("Added "), slug).alias("to"), F.lit("append").alias("op"))
    first = set_author.unionByName(swap).unionByName(adds).withColumn("ord", F.lit(1))
    return X.apply_corrections(pieces, first.unionByName(again).unionByName(issue))


def duplicate_rules(spark, sf):
    """Exact copies within a language: the first is kept."""
    d = texts(spark, sf).select("doc_id", "lang", F.md5("text").alias("h"))
    first = d.groupBy("lang", "h").agg(F.min("doc_id").alias("keep"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    copies = d.join(first, ["lang", "h"]).filter(F.col("doc_id") != F.col("keep"))
    return copies.select(
        F.col("lang").alias("cahier"), F.concat(F.lit("d"), F.col("keep").cast("string")).alias("keep_slug"),
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("drop_slug"),
        F.concat(F.lit("Kept of "), F.col("n").cast("string")).alias("new_title"))


@query
def merge_duplicates(spark, sf):
    pieces = document_pieces(spark, sf).withColumn("cahier", F.col("author")).drop("author")
    return X.merge_duplicates(pieces, duplicate_rules(spark, sf))


@query
def drop_documents(spark, sf):
    docs = document_pieces(spark, sf).select(F.col("author").alias("cahier"), "piece_slug")
    return X.drop_documents(docs, duplicate_rules(spark, sf))


# --- leaves ------------------------------------------------------------------------------

def part_ranges(spark, sf):
    first, last = F.col("p_size"), F.col("p_size") + F.col("p_partkey") % 60
    spec = F.when(F.col("p_partkey") % 60 == 0, first.cast("string")).otherwise(
        F.concat(first.cast("string"), F.lit("-"), last.cast("string")))
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), spec.alias("leaves"), first.cast("int").alias("first"), last.cast("int").alias("last"))


@query
def leaf_manifest(spark, sf):
    stored = table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("id"), F.col("l_quantity").cast("int").alias("leaf"))
    return L.leaf_manifest(part_ranges(spark, sf).select("id", "leaves"), stored)


@query
def batch_ranges(spark, sf):
    return L.batch_ranges(part_ranges(spark, sf).select("id", "first", "last"))


@query
def batch_status(spark, sf):
    results = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("id"), (F.col("l_orderkey") % 4 + 1).cast("int").alias("batches"),
        (F.col("l_returnflag") != "R").alias("ok"), (F.col("l_discount") > 0.08).alias("blocked"))
    return L.batch_status(results).select("id", "batches", "parts_saved", "status")


# --- cleaning ------------------------------------------------------------------------------

def noisy_documents(spark, sf):
    """documents with word breaks, page numbers, margin marks and noise lines put in."""
    body = F.col("text")
    for old, new in [("tion ", "tion-\n"), ("er ", "er12\n\n"), (". ", ". 4\n"), (", ", ", k 5e ")]:
        body = F.replace(body, F.lit(old), F.lit(new))
    body = F.concat(F.lit("[leaf 12]\n145\n\n\n"), body, F.lit("\n1903, 12.50\n"), F.substring("text", 1, 30),
                    F.lit(" RU I] '42 52 | M. x\n#> de la\n\n"))
    return texts(spark, sf).select(F.col("doc_id").alias("doc"), body.alias("body"))


@query
def denoise(spark, sf):
    return C.denoise(noisy_documents(spark, sf)).select(
        "doc", "body", F.col("kept").cast("bigint").alias("kept"), F.col("dropped").cast("bigint").alias("dropped"))


@query
def denoise_preview(spark, sf):
    return C.denoise_preview(noisy_documents(spark, sf)).select(
        "doc", *[F.col(c).cast("bigint").alias(c) for c in
                 ("lines_before", "words_before", "lines_after", "words_after", "dropped")])


@query
def heal_breaks(spark, sf):
    return C.heal_report(noisy_documents(spark, sf)).select("doc", "body")


AD_CLASSES = ["ad", "sidebar"]


def wrapped_pages(spark, sf):
    """pages with the furniture of a library page put in."""
    html = F.replace("html", F.lit("<p>"), F.lit('<span class="x pagenum y" id="p">12</span><p>'))
    html = F.replace(html, F.lit("</p>"), F.lit('<sup id="r" class="reference">3</sup>[see](http://x.y/z) {.cls}</p><table><tr><td>n</td></tr></table>'))
    return table(spark, sf, "pages").select("page_id", html.alias("html"))


@query
def clean_html(spark, sf):
    return C.page_texts(wrapped_pages(spark, sf), div_classes=AD_CLASSES).select(
        "page_id", "text", T.word_count(F.col("text")).cast("bigint").alias("words"))


@query
def clean_html_nested(spark, sf):
    """The subtree-aware variant, on pages with elements inside blocked ones, tags that hold nothing and references."""
    extra = '<div class="noprint"><div>in<br>side<p class="pagenum">x</p></div><img src="y"/> z</div><p>5 &lt; 6 a > b &eacute;t&eacute; &oelig;uvre</p>'
    pages = wrapped_pages(spark, sf).withColumn("html", F.replace("html", F.lit("</p>"), F.lit("</p>" + extra)))
    return C.page_texts(pages, nested=True).select(
        "page_id", "text", T.word_count(F.col("text")).cast("bigint").alias("words"))


@query
def drop_leading_lines(spark, sf):
    t = C.page_texts(wrapped_pages(spark, sf), div_classes=AD_CLASSES)
    return t.select("page_id", H.drop_leading_lines(F.col("text"), r"^- [A-Z]").alias("text"))


@query
def import_pages(spark, sf):
    pages = table(spark, sf, "pages").select(
        F.floor(F.col("page_id") / 3 * 2).cast("bigint").alias("doc"), (F.col("page_id") % 3 % 2).alias("pos"), "html")
    docs = table(spark, sf, "documents").filter("lang <> 'es'").select(
        F.col("doc_id").alias("doc"), F.col("n_chars").alias("word_count"))
    lab = table(spark, sf, "labels")
    plan = lab.select(
        F.col("doc_id").alias("doc"),
        F.when(F.col("doc_id") % 11 == 0, "").otherwise(F.concat(F.lit("https://x.org/wiki/P%C3%A9_"), F.col("doc_id").cast("string"))).alias("url"),
        F.lit("validated").alias("status"), F.when(F.col("quality") == 1, "use-wikisource").otherwise("skip").alias("action"))
    out = C.import_pages(docs, pages, plan, "2026-01-01", to_text=lambda p: C.page_texts(p, div_classes=AD_CLASSES))
    return out.select("doc", F.col("segment").cast("bigint").alias("segment"), "body",
                      F.col("word_count").cast("bigint").alias("word_count"), "status", "message", "provenance")


# --- segmentation ----------------------------------------------------------------------------

def spaced(spark, sf):
    """documents with each line as a paragraph."""
    return texts(spark, sf).select(F.col("doc_id").alias("doc"), F.replace("text", F.lit("\n"), F.lit("\n\n")).alias("body"))


@query
def split_at_anchor(spark, sf):
    lines = F.split("text", "\n")
    middle = F.get(lines, F.floor(F.size(lines) / 2).cast("int"))
    rule = texts(spark, sf).join(table(spark, sf, "labels"), "doc_id").select(
        F.col("doc_id").alias("doc"),
        F.when(F.col("toxic") == 1, "no such anchor").otherwise(F.substring_index(middle, " ", 3)).alias("anchor"),
        F.when(F.col("quality") == 1, "before").otherwise("after").alias("side"), F.lit("one").alias("part1"), F.lit("two").alias("part2"))
    return S.split_at_anchor(spaced(spark, sf), rule).select(
        "doc", "part", "body", F.col("words").cast("bigint").alias("words"))


@query
def chunk_words(spark, sf):
    return S.chunk(spaced(spark, sf), 60).select(
        "doc", *[F.col(c).cast("bigint").alias(c) for c in ("idx", "total", "words")], "text")


@query
def chunk_rows(spark, sf):
    """All texts of a language as one document of any length, its lines as paragraphs: chunks without a row per document."""
    lines = texts(spark, sf).select(F.coalesce("lang", F.lit("und")).alias("doc"), "doc_id", F.posexplode(T.lines_of(F.col("text"))).alias("line", "text"))
    return LD.chunk_rows(lines, by=("doc_id", "line")).select(
        "doc", *[F.col(c).cast("bigint").alias(c) for c in ("idx", "total", "words")], "text")


@query
def missing_chunks(spark, sf):
    c = table(spark, sf, "conversations").select(F.col("conv_id").alias("doc"), F.col("turn").alias("idx"), "role", "text")
    return LD.missing_chunks(c, c.filter("role <> 'system'")).select("doc", F.col("idx").cast("bigint").alias("idx"))


@query
def reassemble(spark, sf):
    c = table(spark, sf, "conversations").select(F.col("conv_id").alias("doc"), F.col("turn").alias("idx"), "role", "text")
    return S.reassemble(c, c.filter("role <> 'system'")).select(
        "doc", F.col("segment").cast("bigint").alias("segment"), "body", F.col("missing").cast("bigint").alias("missing"))


@query
def reassemble_long(spark, sf):
    """Order lines as the parts of a few very long documents: one row each, which grows with the table (see ``assemble``)."""
    li = table(spark, sf, "lineitem").select(
        F.concat("l_returnflag", F.lit("-"), "l_linestatus").alias("doc"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("idx"), "l_partkey")
    li = li.groupBy("doc", "idx").agg(F.max("l_partkey").cast("string").alias("text"))
    return S.reassemble(li, li).select(
        "doc", F.col("segment").cast("bigint").alias("segment"), F.md5("body").alias("body_md5"), F.length("body").cast("bigint").alias("body_chars"), F.col("missing").cast("bigint").alias("missing"))


@query
def first_contained(spark, sf):
    """The first of many rules, the openings of all documents of a language, that a document's first line holds."""
    from stemma.operators.lookup import first_contained as first

    d = texts(spark, sf).select("doc_id", "lang", F.substring_index("text", "\n", 1).alias("line"))
    named = d.groupBy("lang", F.substring_index("line", " ", 2).alias("opening")).agg(F.min(F.col("doc_id") % 1000).alias("ord"))
    named = named.withColumn("opening", F.when(F.col("ord") == 999, "").otherwise(F.col("opening")))
    return first(d, "line", named, "opening", "ord", ["lang"]).select("doc_id", F.col("hit.opening").alias("opening"), F.col("hit.ord").cast("bigint").alias("ord"))


@query
def opening_anywhere(spark, sf):
    """The first opening of any document of a language that a document's whole text holds; half of all texts share one."""
    from stemma.operators.lookup import first_contained as first

    said = F.when(F.col("doc_id") % 2 == 0, "Unless said otherwise. ").otherwise("")
    d = texts(spark, sf).select("doc_id", "lang", F.concat(said, "text").alias("body"))
    named = d.groupBy("lang", F.substring_index("body", " ", 3).alias("opening")).agg(F.min("doc_id").alias("ord"))
    named = named.withColumn("ord", F.when(F.col("opening") == "Unless said otherwise.", F.lit(1 << 40)).otherwise(F.col("ord")))
    hits = first(d, "body", named, "opening", "ord", ["lang"])
    return hits.select("doc_id", F.col("hit.opening").alias("opening"), F.col("hit.ord").cast("bigint").alias("ord"))


@query
def seam_join(spark, sf):
    """Turns of a conversation as transcription parts, cut at seams."""
    from stemma.operators.assembly import seam_join as seams

    parts = F.split(F.replace(F.replace("text", F.lit("tion "), F.lit("tion-|")), F.lit(", "), F.lit("| ")), r"\|")
    return table(spark, sf, "conversations").select("conv_id", "turn", seams(parts).alias("body"))


def headed(spark, sf, shift: bool = False):
    """Each line of a document as a section headed by its first words; every second one is a piece.

    With ``shift`` every third title is taken from the line's end, so that some sections match no piece.
    """
    lines = F.filter(F.split("text", "\n"), lambda l: l.rlike(r"\S"))
    d = texts(spark, sf).select(F.col("doc_id").alias("cahier"), lines.alias("ls")).filter("size(ls) > 0")
    body = F.array_join(F.transform("ls", lambda l: F.concat(
        F.lit("## "), F.substring_index(l, " ", 2), F.lit("\n"), l)), "\n")
    piece = F.transform(F.filter("ls", lambda l, i: i % 2 == 0), lambda l, i: F.struct(
        T.slugify_keep_accents(F.substring_index(l, " ", 2)).alias("slug"),
        F.when((i % 3 == 0) & F.lit(shift), F.substring_index(l, " ", -2)).otherwise(F.substring_index(l, " ", 2)).alias("title")))
    return d.select("cahier", body.alias("body")), d.select("cahier", piece.alias("pieces"))


@query
def route_sections(spark, sf):
    docs, catalog = headed(spark, sf)
    return S.route_sections(docs, catalog).select(
        "cahier", F.col("pos").cast("bigint").alias("pos"), "piece_slug", "body", "matched_by")


@query
def route_sections_one_to_one(spark, sf):
    docs, catalog = headed(spark, sf, True)
    return S.route_sections(docs, catalog, "one_to_one").select(
        "cahier", F.col("pos").cast("bigint").alias("pos"), "piece_slug", "body", "matched_by")


@query
def route_section_rows(spark, sf):
    """The sections and pieces of ``headed`` as rows, routed one-to-one: a row per section, whatever an issue holds."""
    from stemma.plans.routing import route_rows

    lines = F.filter(F.split("text", "\n"), lambda l: l.rlike(r"\S"))
    rows = texts(spark, sf).select(F.col("doc_id").alias("cahier"), F.posexplode(lines).alias("sec", "body"))
    rows = rows.withColumn("head", F.substring_index("body", " ", 2))
    pieces = rows.filter("sec % 2 = 0").withColumn("pos", F.floor(F.col("sec") / 2)).select(
        "cahier", "pos", T.slugify_keep_accents(F.col("head")).alias("piece_slug"),
        F.when(F.col("pos") % 3 == 0, F.substring_index("body", " ", -2)).otherwise(F.col("head")).alias("title"))
    return route_rows(rows, pieces).withColumn("sec", F.col("sec").cast("bigint"))


@query
def segment_by_anchor(spark, sf):
    """Every third line of a document opens a piece; the headed text differs in accents and punctuation."""
    d = texts(spark, sf).select(F.col("doc_id").alias("cahier"), "text", F.split("text", "\n").alias("ls"))
    opens = F.filter("ls", lambda l, i: i % 3 == 0)
    noisy = F.array_join(F.transform(opens, lambda l, i: F.concat(
        F.format_string("## Part %04d\n*by someone*\n\n", i), F.replace(F.replace(l, F.lit("é"), F.lit("e")), F.lit("."), F.lit(" ;"))
    )), "\n")
    pieces = F.transform(opens, lambda l, i: F.struct(
        F.concat(F.lit("p"), i.cast("string")).alias("slug"), F.format_string("Part %04d", i).alias("title")))
    anchors = S.opening_anchors(d.select("cahier", noisy.alias("body")), d.select("cahier", pieces.alias("pieces")))
    out = S.segment_by_anchor(d.select("cahier", "text"), anchors)
    return out.select("cahier", F.col("pos").cast("bigint").alias("pos"), "piece_slug",
                      F.col("start").cast("bigint").alias("start"), F.col("end").cast("bigint").alias("end"), "body", "warning")


# --- sources and sinks ---------------------------------------------------------------------------

@query
def file_keys(spark, sf):
    from stemma.sources.catalog import file_keys as keys

    d = table(spark, sf, "documents")
    name = F.format_string("s%02d-c%02d--%s.%s.md", (F.col("doc_id") % 15 + 1).cast("int"), (F.col("doc_id") % 120).cast("int"),
                           T.slugify(first_words(F.col("text"), 3)), F.col("lang"))
    keyed, rejected = keys(d.select("doc_id", name.alias("name")))
    return keyed.unionByName(rejected, allowMissingColumns=True)


def headers(spark, sf):
    """customers as documents with a header block: quotes, colons in values, a repeated key."""
    c = table(spark, sf, "customer")
    text = F.concat(
        F.lit("---\ncahier: k"), F.col("c_custkey").cast("string"), F.lit("\ntitle: first\npieceSlug:   '"), F.col("c_name"),
        F.lit("'\nauthor: \"n: "), F.col("c_nationkey").cast("string"), F.lit("\"\nword count: 3\nno value here\ntitle: \""),
        F.col("c_mktsegment"), F.lit("\"\nwordCount: "), F.when(F.col("c_acctbal") < 0, "many").otherwise(F.floor("c_acctbal").cast("string")),
        F.lit("\n---\n\nBody of "), F.col("c_name"), F.lit("\n---\nend\n"))
    return c.select("c_custkey", F.when(F.col("c_nationkey") == 0, F.substring(text, 2, F.length(text))).otherwise(text).alias("text"))


@query
def parse_headers(spark, sf):
    from stemma.sources import catalog as K

    rows = headers(spark, sf)
    for style in ("word", "colon", "raw"):
        fields = {f"{style}_{k}": v for k, v in {"slug": "pieceSlug", "title": "title", "author": "author", "count": "word count"}.items()}
        rows = K.with_header(rows, fields, style)
    out = K.with_header(rows, {"wc": "wordCount"}, "colon")
    return out.withColumn("wc", F.col("wc").try_cast("bigint")).drop("text")


@query
def validate_rows(spark, sf):
    from stemma.sources import catalog as K

    c = table(spark, sf, "customer")
    piece = F.struct(F.col("c_name").alias("slug"), F.lit("t").alias("title_fr"), F.lit(None).cast("string").alias("title_en"),
                     F.when(F.col("c_nationkey") != 7, F.col("c_mktsegment")).alias("author"),
                     F.lit(None).cast("string").alias("pages"), F.lit(False).alias("is_notice"))
    rows = c.select(
        "c_custkey", F.col("c_name").alias("slug"), F.col("c_nationkey").alias("series"),
        F.floor(F.col("c_acctbal") / 100).cast("int").alias("issue"), F.col("c_mktsegment").alias("label"),
        F.when(F.col("c_nationkey") != 3, F.lit("t")).alias("title_fr"),
        F.when(F.col("c_nationkey") == 4, "not a url").when(F.col("c_nationkey") != 5, "https://example.org/x").alias("source_url"),
        F.when(F.col("c_nationkey") != 6, F.array(piece)).alias("pieces"))
    checked = K.validate(rows, K.cahier_rules())
    return checked.select("c_custkey", F.array_join("violations", "|").alias("violations"))


@query
def render_documents(spark, sf):
    from stemma.sources.sinks import render_piece

    d = texts(spark, sf)
    return render_piece(d.select(
        F.col("source").alias("cahier"), F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("piece_slug"), "lang",
        F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit('a "b": '), F.col("source"))).otherwise(first_words(F.col("text"), 3)).alias("title"),
        F.col("source").alias("author"), (F.col("doc_id") % 2 == 0).alias("is_notice"), F.col("text").alias("body"),
        F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("d"), F.col("doc_id").cast("string"))).alias("introduces_piece"),
        F.when(F.col("doc_id") % 4 == 0, "scan").alias("ocr_source"), F.lit("2026-01-01").alias("translation_date"),
        F.when(F.col("doc_id") % 7 == 0, "see: notes").alias("translation_notes"), F.when(F.col("doc_id") % 2 == 1, "given").alias("source_provenance")))


@query
def catalog_records(spark, sf):
    """Issue records as literal text, five parts per blob, descriptions with escaped quotes."""
    from stemma.sources.catalog import catalog_records as records

    p = table(spark, sf, "part")
    rec = F.concat(
        F.lit("{ series: "), F.col("p_size").cast("string"), F.lit(", issue: "), F.col("p_partkey").cast("string"),
        F.lit(",\n  label: '"), F.col("p_brand"), F.lit("', url: 'https://e.org/"), F.col("p_partkey").cast("string"),
        F.lit("', description: 'L\\'"), F.col("p_name"), F.lit(" d\\'"), F.col("p_type"), F.lit(". (\\\\)' },\n"))
    blobs = p.withColumn("rec", rec).groupBy(F.floor(F.col("p_partkey") / 5).alias("b")).agg(
        F.concat(F.lit("const catalog = ["), F.array_join(F.array_sort(F.collect_list("rec")), ""), F.lit("];")).alias("text"))
    return records(blobs)


@query
def description_pieces(spark, sf):
    p = table(spark, sf, "part")
    upper = F.upper(F.replace("p_name", F.lit(" "), F.lit(" ET ")))
    desc = F.concat(
        F.when(F.col("p_size") > 25, "(Gallica) ").otherwise(""),
        F.when(F.col("p_size") % 3 == 0, F.concat(F.initcap(F.lower("p_type")), F.lit(" lead. "))).otherwise(""),
        F.when(F.col("p_size") % 4 > 0, F.concat(upper, F.lit(". First "), F.col("p_name"), F.lit(". Second. "))).otherwise("Plain "),
        F.when(F.col("p_size") % 5 > 0, F.concat(F.upper("p_type"), F.lit(". Third title."))).otherwise("end."))
    rows = p.select("p_partkey", F.posexplode(M.description_pieces(desc)).alias("pos", "z"))
    return rows.select("p_partkey", F.col("pos").cast("bigint").alias("pos"), "z.title", "z.author")


@query
def name_fields(spark, sf):
    """Sort names, life years, issue keys and titles."""
    c = table(spark, sf, "customer")
    name = F.concat(F.initcap(F.lower("c_mktsegment")), F.when(F.col("c_nationkey") % 3 == 0, " et Jean ").otherwise(" "),
                    F.replace("c_name", F.lit("#"), F.lit("-")))
    year = (F.col("c_custkey") % 900 + 1000).cast("string")
    dates = F.concat(year, F.when(F.col("c_nationkey") % 2 == 0, F.concat(F.lit("–"), F.col("c_nationkey").cast("string"), year)).otherwise("—?"),
                     F.lit(" / 1900–1901"))
    born, died = T.life_years(dates)
    series, issue = F.col("c_nationkey"), F.col("c_custkey") % 30
    return c.select("c_custkey", T.sort_name(name).alias("sort_name"), born.alias("born"), died.alias("died"),
                    T.issue_key(series, issue).alias("issue_key"), T.issue_title(series, issue).alias("issue_title"),
                    T.roman(series).alias("roman"), T.is_notice_title(F.col("c_mktsegment")).alias("is_notice"))


@query
def find_piece(spark, sf):
    """Keywords per brand against part names; the first part of the brand otherwise."""
    p = table(spark, sf, "part")
    declared = p.select(F.col("p_brand").alias("cahier"), F.col("p_partkey").alias("pos"),
                        F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("piece_slug"), F.replace("p_name", F.lit("e"), F.lit("É")).alias("title"))
    wanted = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"), F.concat(F.lit("Brand#"), (F.col("s_suppkey") % 25 + 1).cast("string")).alias("cahier"),
        F.when(F.col("s_nationkey") < 8, F.array(F.lit("Red"), F.lit("plaTe"))).when(F.col("s_nationkey") < 16, F.array(F.lit("gé")))
        .otherwise(F.array(F.lit("nothing"))).alias("keywords"))
    return M.find_piece(wanted, declared)


@query
def insert_absent(spark, sf):
    lab = table(spark, sf, "labels").select("doc_id", "quality")
    docs = table(spark, sf, "documents").select("doc_id", F.lit(-1).alias("quality"))
    return X.insert_absent(lab, docs, ["doc_id"])


@query
def good_leaves(spark, sf):
    """Stored blobs: pictures open with FF D8, error pages do not."""
    i = table(spark, sf, "lineitem")
    code = F.when(F.col("l_returnflag") == "R", "3C68").otherwise("FFD8FFE0")
    return L.good_leaves(i.select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("leaf"), F.unhex(code).alias("content")))


@query
def import_totals(spark, sf):
    return C.job_totals(import_pages(spark, sf))


@query
def load_catalog(spark, sf):
    """suppliers as contributors, parts as issue records, conversations as issue texts: the piece table."""
    p = table(spark, sf, "part")
    kind = F.initcap(F.lower("p_type"))
    catalog = p.select(
        F.floor(F.col("p_partkey") / 50 + 1).cast("int").alias("series"), (F.col("p_partkey") % 50).cast("int").alias("issue"),
        F.col("p_brand").alias("label"), F.lit("https://e.org").alias("url"),
        F.concat(F.upper(F.replace("p_name", F.lit(" "), F.lit(" ET "))), F.lit(". Title "), kind, F.lit(". Avis. Title "), kind, F.lit(".")).alias("description"))
    s = table(spark, sf, "supplier")
    contributors = s.select(F.col("s_name").alias("name"), F.concat(F.lit("s-"), F.col("s_suppkey").cast("string")).alias("slug"),
                            F.lit("1873–1914").alias("dates"), F.lit("fr").alias("bio_fr"), F.lit("en").alias("bio_en"))
    body = F.concat(F.lit("## Title "), F.col("role"), F.lit("\n"), F.col("text"), F.lit("\n## Avis\nShort.\n"))
    number = F.col("conv_id") * 10 + F.floor(F.col("turn") / 2)
    txt = table(spark, sf, "conversations").select(
        T.issue_key(F.floor(number / 50 + 1), number % 50).alias("cahier"),
        F.when(F.col("turn") % 2 == 0, "fr").otherwise("en").alias("lang"), F.lit(None).cast("string").alias("date"),
        F.lit(None).cast("array<struct<title:string,author:string>>").alias("pieces"), body.alias("body"))
    aliases = rules(spark, [("Red Et Plate", "s-1")], "name string, slug string")
    out = M.load_catalog(catalog, contributors, txt, aliases, "s-0")
    return out["pieces"].withColumn("word_count", F.col("word_count").cast("bigint"))
