"""Readers for documents with headers, nested catalogs, record blobs and rule tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as S

from stemma.functions import text as T

# --- fixed values: formats -----------------------------------------------------
FILE_NAME = r"^(s\d{2}-c\d{2})--(.+)\.(fr|en)\.md$"
CATALOG_RECORD = (
    r"\{\s*series:\s*(\d+),\s*issue:\s*(\d+),\s*label:\s*'([^']+)',\s*"
    r"url:\s*'([^']+)',\s*description:\s*'([^'\\]*+(?:\\.[^'\\]*+)*+)'\s*\}"
)
CONTRIBUTOR_RECORD = (
    r'(?s)\{\s*name:\s*"([^"\\]*+(?:\\.[^"\\]*+)*+)",\s*slug:\s*"([^"\\]*+(?:\\.[^"\\]*+)*+)",\s*'
    r'dates:\s*"([^"\\]*+(?:\\.[^"\\]*+)*+)",\s*'
    r"bioFr:\s*`([^`\\]*+(?:\\.[^`\\]*+)*+)`,\s*bioEn:\s*`([^`\\]*+(?:\\.[^`\\]*+)*+)`\s*\}"
)

PIECE = S.StructType([
    S.StructField("slug", S.StringType()), S.StructField("title_fr", S.StringType()),
    S.StructField("title_en", S.StringType()), S.StructField("author", S.StringType()),
    S.StructField("pages", S.StringType()), S.StructField("is_notice", S.BooleanType()),
])
CAHIERS = S.StructType([
    S.StructField("slug", S.StringType()), S.StructField("series", S.IntegerType()),
    S.StructField("issue", S.IntegerType()), S.StructField("label", S.StringType()),
    S.StructField("title_fr", S.StringType()), S.StructField("date", S.StringType()),
    S.StructField("page_count", S.IntegerType()), S.StructField("print_run", S.IntegerType()),
    S.StructField("whatman_count", S.IntegerType()), S.StructField("price", S.StringType()),
    S.StructField("printer", S.StringType()), S.StructField("source_url", S.StringType()),
    S.StructField("source_volume", S.StringType()), S.StructField("pieces", S.ArrayType(PIECE)),
    S.StructField("part_of_works", S.ArrayType(S.StringType())), S.StructField("notes", S.StringType()),
])
# Names of the nested fields in the stored JSON objects.
_JSON_PIECE = "slug STRING, titleFr STRING, titleEn STRING, author STRING, pages STRING, isAvertissement BOOLEAN"
_JSON_CAHIER = (
    "slug STRING, series INT, issue INT, label STRING, titleFr STRING, bonATirer STRING, pageCount INT, "
    "printRun INT, whatmanCount INT, price STRING, imprimeur STRING, sourceUrl STRING, sourceVolume STRING, "
    f"pieces ARRAY<STRUCT<{', '.join(f.replace(' ', ': ', 1) for f in _JSON_PIECE.split(', '))}>>, "
    "partOfWorks ARRAY<STRING>, notes STRING"
)


# --- documents -------------------------------------------------------------------

def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Text files under ``path``, one row each: ``path, name, text``."""
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.md").text(path, wholetext=True)
    return files.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("name"),
        F.col("value").alias("text"),
    )


def file_keys(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split rows by file name: keyed ``(cahier, piece_slug, lang)`` and rejected."""
    keyed = files.filter(F.col("name").rlike(FILE_NAME)).withColumns({
        "cahier": F.regexp_extract("name", FILE_NAME, 1),
        "piece_slug": F.regexp_extract("name", FILE_NAME, 2),
        "lang": F.regexp_extract("name", FILE_NAME, 3),
    })
    return keyed, files.filter(~F.col("name").rlike(FILE_NAME))


def _unquote(v: Column, quotes: bool) -> Column:
    v = T.strip_blank(v)
    return F.trim(F.trim(v, F.lit('"')), F.lit("'")) if quotes else v


def header_entries(text: Column, style: str = "word") -> Column:
    """Header lines as array of struct(key, value), in file order.

    Styles: ``word`` takes lines opening with a word and a colon and strips
    quotes; ``colon`` cuts any line at its first colon and strips quotes;
    ``raw`` does so and keeps quotes.
    """
    block = F.regexp_extract(text, r"(?s)\A---\n(.*?)\n---\n", 1)
    lines = F.split(block, "\n")
    if style == "word":
        pattern = r"(?U)^(\w+):\s*(.*)$"
        kept = F.filter(lines, lambda l: l.rlike(pattern))
        return F.transform(kept, lambda l: F.struct(
            F.regexp_extract(l, pattern, 1).alias("key"), _unquote(F.regexp_extract(l, pattern, 2), True).alias("value")
        ))
    kept = F.filter(lines, lambda l: l.contains(":"))
    return F.transform(kept, lambda l: F.struct(
        T.strip_blank(F.substring_index(l, ":", 1)).alias("key"),
        _unquote(F.substring(l, F.locate(":", l) + 1, F.length(l)), style == "colon").alias("value"),
    ))


def header_value(entries: Column, key: str) -> Column:
    """Last value of a key, null without one."""
    hits = F.filter(entries, lambda e: e["key"] == key)
    return F.when(F.size(hits) > 0, F.element_at(hits, -1)["value"])


def with_header(docs: DataFrame, fields: dict[str, str], style: str = "word", text: str = "text") -> DataFrame:
    """Add one column per header field (``{column: key}``) and the ``body``."""
    rows = docs.withColumn("_h", header_entries(F.col(text), style))
    rows = rows.withColumns({c: header_value(F.col("_h"), k) for c, k in fields.items()})
    return rows.withColumn("body", T.body_of(F.col(text))).drop("_h")


PIECE_FIELDS = {
    "cahier": "cahier", "piece_slug": "pieceSlug", "lang": "lang", "title": "title", "author": "author",
    "is_notice": "isAvertissement", "introduces_piece": "introducesPiece", "ocr_source": "ocrSource",
    "translation_date": "translationDate", "translation_notes": "translationNotes",
    "source_provenance": "sourceProvenance", "word_count": "wordCount",
}


def piece_documents(files: DataFrame) -> DataFrame:
    """Typed piece table from raw files."""
    rows = with_header(files, PIECE_FIELDS, "colon")
    return rows.withColumns({
        "is_notice": F.coalesce(F.col("is_notice") == "true", F.lit(False)),
        "word_count": F.col("word_count").try_cast("int"),
    })


# --- nested catalog ----------------------------------------------------------------

def read_cahiers(spark: SparkSession, path: str) -> DataFrame:
    """One JSON object per file, typed and with defaults filled in."""
    raw = spark.read.schema(_JSON_CAHIER).option("multiLine", True).json(path)
    pieces = F.transform("pieces", lambda p: F.struct(
        p["slug"].alias("slug"), p["titleFr"].alias("title_fr"), p["titleEn"].alias("title_en"),
        p["author"].alias("author"), p["pages"].alias("pages"),
        F.coalesce(p["isAvertissement"], F.lit(False)).alias("is_notice"),
    ))
    return raw.select(
        "slug", "series", "issue", "label", F.col("titleFr").alias("title_fr"), F.col("bonATirer").alias("date"),
        F.col("pageCount").alias("page_count"), F.col("printRun").alias("print_run"),
        F.col("whatmanCount").alias("whatman_count"), "price", F.col("imprimeur").alias("printer"),
        F.col("sourceUrl").alias("source_url"), F.col("sourceVolume").alias("source_volume"),
        pieces.alias("pieces"),
        F.coalesce("partOfWorks", F.array().cast("array<string>")).alias("part_of_works"), "notes",
    )


def catalog_records(blobs: DataFrame) -> DataFrame:
    """Issue records in literal text: ``series, issue, label, url, description``."""
    rec = F.explode(F.regexp_extract_all("text", F.lit(f"({CATALOG_RECORD})"), F.lit(1))).alias("_r")
    rows = blobs.select(rec)

    def part(i: int) -> Column:
        return F.regexp_extract("_r", CATALOG_RECORD, i)

    told = part(5)
    for old, new in (("\\'", "'"), ('\\"', '"'), ("\\\\", "\\")):
        told = F.replace(told, F.lit(old), F.lit(new))
    return rows.select(
        part(1).cast("int").alias("series"), part(2).cast("int").alias("issue"), part(3).alias("label"),
        part(4).alias("url"), told.alias("description"),
    )


def contributor_records(blobs: DataFrame) -> DataFrame:
    """Contributor records in literal text: ``name, slug, dates, bio_fr, bio_en``."""
    names = ["name", "slug", "dates", "bio_fr", "bio_en"]
    whole = CONTRIBUTOR_RECORD.replace("(?s)", "(?s)(", 1) + ")"
    rows = blobs.select(F.explode(F.regexp_extract_all("text", F.lit(whole), F.lit(1))).alias("_r"))
    cols = [F.regexp_extract("_r", CONTRIBUTOR_RECORD, i + 1) for i in range(5)]
    return rows.select(*[(T.strip_blank(c) if n.startswith("bio") else c).alias(n) for n, c in zip(names, cols)])


def read_rules(spark: SparkSession, path: str, schema: str, sep: str = ",") -> DataFrame:
    """CSV with a header; text may hold line breaks."""
    return spark.read.schema(schema).option("header", True).option("multiLine", True).option("sep", sep).csv(path)


# --- checks ------------------------------------------------------------------------

URL = r"^[A-Za-z][A-Za-z0-9+.-]*:[^\s]+$"


def cahier_rules() -> dict[str, Column]:
    """Conditions a catalog row must meet."""
    return {
        "slug": F.col("slug").isNotNull(),
        "series": F.col("series").between(1, 15),
        "issue": F.col("issue") >= 1,
        "label": F.col("label").isNotNull(),
        "title_fr": F.col("title_fr").isNotNull(),
        "source_url": F.col("source_url").isNull() | F.col("source_url").rlike(URL),
        "pieces": F.col("pieces").isNotNull() & F.forall(
            F.coalesce("pieces", F.array().cast(S.ArrayType(PIECE))),
            lambda p: p["slug"].isNotNull() & p["title_fr"].isNotNull() & p["author"].isNotNull(),
        ),
    }


def piece_rules() -> dict[str, Column]:
    return {
        "cahier": F.col("cahier").isNotNull(),
        "piece_slug": F.col("piece_slug").isNotNull(),
        "lang": F.col("lang").isin("fr", "en"),
        "title": F.col("title").isNotNull(),
        "author": F.col("author").isNotNull(),
    }


def validate(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Add ``violations``: the names of the rules a row breaks."""
    broken = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]
    return rows.withColumn("violations", F.filter(F.array(*broken), lambda v: v.isNotNull()))


def split_valid(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    good = F.size("violations") == 0
    return checked.filter(good).drop("violations"), checked.filter(~good)


def missing_references(rows: DataFrame, key: str, refs: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """References that do not resolve: ``key, field, ref``.

    ``refs`` maps a column to the table and column it points to. Nulls pass.
    """
    out = None
    for column, (target, target_key) in refs.items():
        lost = rows.filter(F.col(column).isNotNull()).select(
            F.col(key), F.lit(column).alias("field"), F.col(column).alias("ref")
        ).join(target.select(F.col(target_key).alias("ref")), "ref", "left_anti").select(key, "field", "ref")
        out = lost if out is None else out.unionByName(lost)
    return out
