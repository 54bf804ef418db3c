"""Readers and writers on files."""

import json

from pyspark.sql import functions as F

from stemma.plans import audit as A, cleaning as C, leaves as L
from stemma.sources import catalog as K, sinks as W


def test_documents_round_trip(spark, tmp_path):
    folder = tmp_path / "docs" / "deep"
    folder.mkdir(parents=True)
    (folder / "s01-c02--un-mot.fr.md").write_text(
        '---\ncahier: s01-c02\npieceSlug: un-mot\nlang: fr\ntitle: "Un: mot"\nauthor: x\nisAvertissement: true\nwordCount: n/a\nwordCount: 3\n---\n\nUn mot dit.\n',
        encoding="utf-8")
    (folder / "s01-c02--un-mot.de.md").write_text("x", encoding="utf-8")
    (folder / "note.txt").write_text("x", encoding="utf-8")
    keyed, rejected = K.file_keys(K.read_documents(spark, str(tmp_path / "docs")))
    assert [r.name for r in rejected.collect()] == ["s01-c02--un-mot.de.md"]
    row = K.piece_documents(keyed).collect()[0]
    assert (row.cahier, row.piece_slug, row.lang, row.title, row.is_notice, row.word_count) == ("s01-c02", "un-mot", "fr", "Un: mot", True, 3)
    text = W.render_piece(K.piece_documents(keyed).withColumn("body", F.trim("body"))).collect()[0].text
    assert text.startswith('---\ncahier: s01-c02\npieceSlug: un-mot\nlang: fr\ntitle: "Un: mot"\nauthor: x\nisAvertissement: true\nwordCount: 3\n---\n')


def test_header_order_and_set(spark):
    df = spark.createDataFrame([([("z", "1"), ("title", "T"), ("cahier", "c"), ("z", "2"), ("none", None)],)], "e array<struct<key:string,value:string>>")
    entries = W.set_entry(W.set_entry(F.col("e"), "wordCount", F.lit("9")), "title", F.lit("N"))
    assert df.select(W.render_header(entries)).collect()[0][0] == "---\ncahier: c\ntitle: N\nwordCount: 9\nz: 2\n---\n"


def test_nested_catalog_and_checks(spark, tmp_path):
    good = {"slug": "s01-c01", "series": 1, "issue": 1, "label": "I-1", "titleFr": "T", "sourceUrl": "https://e.org/x",
            "pieces": [{"slug": "a", "titleFr": "A", "author": "x"}], "partOfWorks": ["w"]}
    bad = {"slug": "s16-c00", "series": 16, "issue": 0, "label": "L", "sourceUrl": "nope", "pieces": [{"slug": "b", "titleFr": "B"}]}
    for record in (good, bad):
        (tmp_path / f"{record['slug']}.json").write_text(json.dumps(record, indent=2), encoding="utf-8")
    cahiers = K.read_cahiers(spark, str(tmp_path))
    ok, broken = K.split_valid(K.validate(cahiers, K.cahier_rules()))
    assert [r.slug for r in ok.collect()] == ["s01-c01"]
    row = broken.collect()[0]
    assert row.violations == ["series", "issue", "title_fr", "source_url", "pieces"] and row.part_of_works == []
    authors = spark.createDataFrame([("y",)], "slug string")
    lost = K.missing_references(A.declared_pieces(ok), "piece_slug", {"listed_author": (authors, "slug")})
    assert [tuple(r) for r in lost.collect()] == [("a", "listed_author", "x")]


def test_contributor_records(spark):
    blob = 'export const c = [\n  { name: "A \\"B\\"", slug: "a", dates: "1873–1914", bioFr: ` Né\n à `, bioEn: `x` },\n  { name: "C", slug: "c", dates: "", bioFr: ``, bioEn: `y` }];'
    got = [tuple(r) for r in K.contributor_records(spark.createDataFrame([(blob,)], "text string")).collect()]
    assert got == [('A \\"B\\"', "a", "1873–1914", "Né\n à", "x"), ("C", "c", "", "", "y")]


def test_tables_and_reports(spark, tmp_path):
    df = spark.createDataFrame([(2, "b,c", "x\ny"), (1, "a", "z")], "rank int, name string, note string")
    W.write_csv(df, str(tmp_path / "csv"), ["name", "note", "rank"])
    back = K.read_rules(spark, str(tmp_path / "csv"), "name string, note string, rank int")
    assert sorted(map(tuple, back.collect())) == [("a", "z", 1), ("b,c", "x\ny", 2)]
    W.write_ranked(df.drop("note"), str(tmp_path / "tsv"), ["rank", "name"])
    lines = [line for p in sorted((tmp_path / "tsv").glob("part-*")) for line in p.read_text().splitlines() if line != "rank\tname"]
    assert lines == ["1\ta", "2\tb,c"]
    report = spark.createDataFrame([("B", 1, "- b1"), ("A", 2, "- a2"), ("A", 1, "- a1")], "section string, pos int, line string")
    W.write_report(report, str(tmp_path / "txt"))
    text = [line for p in sorted((tmp_path / "txt").glob("part-*")) for line in p.read_text().splitlines()]
    assert text == ["- a1", "- a2", "- b1"]


def test_overwrite_keeps_the_old_partition(spark, tmp_path):
    path, backup = str(tmp_path / "t"), str(tmp_path / "b")
    spark.createDataFrame([(1, "fr", "old"), (2, "en", "old")], "id int, lang string, body string").write.partitionBy("lang").parquet(path)
    W.overwrite_with_backup(spark.createDataFrame([(1, "fr", "new")], "id int, lang string, body string"), path, backup, "v1", ["lang"])
    assert sorted(map(tuple, spark.read.parquet(path).select("id", "body").collect())) == [(1, "new"), (2, "old")]
    assert [tuple(r) for r in spark.read.parquet(backup).select("id", "body", "version").collect()] == [(1, "old", "v1")]


def test_stored_leaves(spark, tmp_path):
    for name, blob in {"book_0003.jpg": b"\xff\xd8\xff", "book_0004.jpg": b"<html>", "cover.jpg": b"\xff\xd8"}.items():
        (tmp_path / name).write_bytes(blob)
    assert [tuple(r) for r in L.good_leaves(L.read_leaves(spark, str(tmp_path))).collect()] == [("book", 3)]
