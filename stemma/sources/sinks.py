"""Writers: tables, reports, rendered documents and versioned overwrites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stemma.functions import text as T

# --- fixed values: key order of a rendered header ------------------------------
HEADER_ORDER = "cahier pieceSlug lang title author isAvertissement wordCount sourceProvenance ocrSource".split()
OPTIONAL_KEYS = [
    ("introduces_piece", "introducesPiece"), ("source_provenance", "sourceProvenance"), ("ocr_source", "ocrSource"),
    ("translation_date", "translationDate"), ("translation_notes", "translationNotes"),
]


def write_csv(rows: DataFrame, path: str, columns: list[str], sep: str = ",") -> None:
    """Delimited text with a header and a fixed column order."""
    rows.select(*columns).write.mode("overwrite").option("header", True).option("sep", sep).csv(path)


def write_ranked(rows: DataFrame, path: str, columns: list[str], rank: str = "rank") -> None:
    """Tab-separated list in rank order across the part files."""
    rows.orderBy(rank).select(*columns).write.mode("overwrite").option("header", True).option("sep", "\t").csv(path)


def write_report(report: DataFrame, path: str) -> None:
    """``(section, pos, line)`` rows as text in order."""
    report.orderBy("section", "pos").select(F.col("line").alias("value")).write.mode("overwrite").text(path)


def render_header(entries: Column) -> Column:
    """Header block: known keys in fixed order, the others after them as they came.

    ``entries`` is an array of struct(key, value); later values win, null
    values are left out.
    """
    held = F.filter(entries, lambda e: e["value"].isNotNull())
    unique = F.filter(held, lambda e, i: ~F.exists(
        F.slice(held, i + 2, F.greatest(F.size(held), F.lit(1))), lambda o: o["key"] == e["key"]
    ))
    order = F.array(*[F.lit(k) for k in HEADER_ORDER])
    ranked = F.transform(unique, lambda e, i: F.struct(
        F.when(F.array_contains(order, e["key"]), F.array_position(order, e["key"])).otherwise(F.lit(1000)).alias("o"),
        i.alias("i"), F.concat(e["key"], F.lit(": "), e["value"]).alias("line"),
    ))
    lines = F.transform(F.array_sort(ranked), lambda r: r["line"])
    return F.concat(F.lit("---\n"), F.array_join(F.concat(lines, F.array(F.lit("---"))), "\n"), F.lit("\n"))


def set_entry(entries: Column, key: str, value: Column) -> Column:
    """Replace a header value or add it at the end."""
    fresh = F.struct(F.lit(key).alias("key"), value.alias("value"))
    known = F.exists(entries, lambda e: e["key"] == key)
    swapped = F.transform(entries, lambda e: F.when(e["key"] == key, fresh).otherwise(e))
    return F.when(known, swapped).otherwise(F.concat(entries, F.array(fresh)))


def render_piece(rows: DataFrame) -> DataFrame:
    """Piece rows as documents: ``cahier, piece_slug, lang, text``.

    Optional header values are written where the rows have their columns; nulls
    are left out.
    """
    rows = rows.withColumn("_words", T.word_count(F.col("body")).cast("string"))
    pairs = [
        ("cahier", F.col("cahier")), ("pieceSlug", F.col("piece_slug")), ("lang", F.col("lang")),
        ("title", T.quote_value(F.col("title"))), ("author", F.col("author")),
        ("isAvertissement", F.col("is_notice").cast("string")),
        ("wordCount", F.col("_words")),
        *((key, T.quote_value(F.col(c).cast("string"))) for c, key in OPTIONAL_KEYS if c in rows.columns),
    ]
    entries = F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in pairs])
    body = F.regexp_replace("body", r"(?U)\s+\z", "")
    return rows.select(
        "cahier", "piece_slug", "lang", F.concat(render_header(entries), F.lit("\n"), body, F.lit("\n")).alias("text")
    )


def write_documents(rendered: DataFrame, path: str) -> None:
    """Rendered documents, partitioned by language."""
    rendered.write.mode("overwrite").partitionBy("lang").parquet(path)


def overwrite_with_backup(fresh: DataFrame, path: str, backup_path: str, version: str, by: list[str]) -> None:
    """Keep the partitions about to be replaced, then replace only those.

    ``fresh`` must not read from ``path``: write it out first if it does.
    """
    spark = fresh.sparkSession
    touched = fresh.select(*by).distinct()
    old = spark.read.parquet(path)
    kept = old.join(touched, by, "left_semi").withColumn("version", F.lit(version))
    kept.write.mode("append").partitionBy("version").parquet(backup_path)
    fresh.select(*old.columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
