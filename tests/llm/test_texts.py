"""Classifiers by held-out accuracy, fingerprints by true similarity, licences by SQL, and the pipeline."""

import hashlib
import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from stemma.llm import grams, language, licenses, minhash, quality, queries_classifiers, queries_fingerprints, queries_licenses, shingles
from stemma.llm.common import held_out
from tests.llm.test_duplicates import brute_bytes, brute_jaccard, shingle_set

LARGER = "/root/testdata/sf0.01"


def labelled(spark, docs):
    ids = [r.doc_id for r in docs.select("doc_id").collect()]
    return spark.createDataFrame([(i, k % 2, 0) for k, i in enumerate(ids)] + [(None, 1, 0), (1, None, 0), (2, 0, 1)], "doc_id long, quality int, toxic int")


def test_quality_on_held_out_rows(spark):
    found = queries_classifiers.op7_quality(spark, LARGER)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = found.join(spark.read.parquet(f"{LARGER}/labels.parquet"), "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) >= 0.95
    assert all(r.predicted for r in rows if r.quality) and found.count() == 1000


def test_quality_of_odd_documents(spark, odd_docs, no_docs):
    labels = labelled(spark, odd_docs)
    model = quality.fit(odd_docs, labels)
    scores = quality.mark(odd_docs, model).collect()
    assert len(scores) == odd_docs.count() and all(0 <= r.score <= 1 for r in scores)
    assert len({r.score for r in scores if not r.text}) == 1  # null and empty texts are alike
    assert quality.mark(no_docs, quality.fit(no_docs, labels.limit(0))).collect() == []
    assert {r.score for r in quality.score(odd_docs, quality.fit(odd_docs, labels.limit(0))).collect()} == {0.5}
    kept = quality.keep(odd_docs, labels)
    assert kept.columns == odd_docs.columns


def test_quality_reads_only_learning_rows_and_texts(spark):
    docs, labels = (spark.read.parquet(f"{LARGER}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.selectExpr("doc_id", "case when crc32(cast(cast(doc_id as string) as binary)) % 5 = 0 then 1 - quality else quality end as quality")
    assert quality.fit(docs, labels) == quality.fit(docs.withColumn("lang", held_out()), flipped)


def test_descent_separates():
    rows, good = [np.array([0, 2]), np.array([0, 3]), np.array([1, 2]), np.array([1, 3])], np.array([True, True, False, False])
    weights = quality.descend(rows, good, np.ones(4))
    assert weights[0] > 0 > weights[1] and abs(weights[2]) < 0.1


def test_language_on_held_out_rows(spark):
    found = queries_classifiers.op8_language(spark, LARGER)
    assert found.columns == ["doc_id", "held_out", "lang_pred", "score"]
    rows = found.join(spark.read.parquet(f"{LARGER}/documents.parquet"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang_pred == r.lang for r in rows]) >= 0.97 and found.count() == 1000


def test_language_of_odd_documents(odd_docs, no_docs):
    rows = language.mark(odd_docs, language.fit(odd_docs)).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert (r.lang_pred == "und") == (not any(map(str.isalpha, r.text or ""))) and 0 <= r.score <= 1
    assert {r.lang_pred for r in language.identify(odd_docs, language.fit(no_docs)).collect()} == {"und"}
    assert language.identify(no_docs, language.fit(no_docs)).collect() == []
    assert language.keep(odd_docs).columns == odd_docs.columns


def test_texts_of_no_learned_language_are_rejected(spark):
    docs, rnd = spark.read.parquet(f"{LARGER}/documents.parquet").select("doc_id", "text", "lang"), random.Random(3)
    noise = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz     ") for _ in range(500)) for _ in range(20)]
    other = ["Съешь же ещё этих мягких французских булок да выпей чаю.", "Pchnąć w tę łódź jeża lub ośm skrzyń fig i zażółcić gęślą jaźń.", "これは日本語の文章です。", "Köszönöm szépen, de ma már nem kérek többet belőle."]
    planted = spark.createDataFrame([(-1 - i, x, None) for i, x in enumerate(noise + other)], docs.schema)
    for missing in ("", "de", "es"):  # a language that is not learned
        told = docs.withColumn("lang", F.when(F.col("lang") != missing, F.col("lang")))
        kept = language.keep(told.unionByName(planted)).groupBy(F.col("doc_id") < 0, F.col("lang").isNull()).count().collect()
        counts = {(r[0], r[1]): r[2] for r in kept}
        assert counts.get((True, True), 0) == 0
        assert counts[False, False] >= 0.998 * told.where("lang is not null").count()
        assert counts.get((False, True), 0) <= 0.1 * told.where("lang is null").count()
    one = language.keep(docs.withColumn("lang", F.when(F.col("lang") == "en", "en")).unionByName(planted))
    assert one.where("doc_id < 0").count() == 0 and one.where("lang = 'en'").count() >= 0.998 * docs.where("lang = 'en'").count()


def test_a_language_of_one_hot_text_is_learned(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet").select("doc_id", "text", "lang")
    hot = spark.range(400_000).selectExpr("id + 1000000 as doc_id", "'der die das' as text", "'de' as lang")
    found = language.identify(docs.where("lang = 'de'"), language.fit(docs.unionByName(hot)))
    assert found.where("lang_pred = 'de'").count() >= 0.98 * found.count()


def test_landmark_regression_equals_the_kernel_form():
    marks, texts = grams.Marks(language.BITS), ["the cat sat", "a cat and a hat", "der hund und die katze", "ein hund im haus"]
    rows = [language.features(t, marks) for t in texts]
    y = np.array([[1.0, -1], [1, -1], [-1, 1], [-1, 1]])
    weights = language.regress(rows, y, np.arange(4))
    x = language.presence(rows).astype(float)
    kernel = x @ x.T
    centre = np.eye(4) - 1 / 4
    dual = np.linalg.solve(centre @ kernel @ centre + language.RIDGE * np.eye(4), centre @ y)
    assert np.allclose(x @ weights[:-1] + weights[-1], kernel @ (centre @ dual) + (y - kernel @ (centre @ dual)).mean(axis=0), atol=1e-5)


def test_landmarks_of_all_languages_are_bounded(spark, monkeypatch):
    seen = "".join(chr(97 + i) for i in range(20))
    docs = spark.createDataFrame([(k * 30 + i, f"{c * 3} {c}{i} {c * 2}", c) for k, c in enumerate(seen) for i in range(30)], "doc_id long, text string, lang string")
    free = language.fit(docs)
    monkeypatch.setattr(language, "ALL_LANDMARKS", 40)
    names, raw = language.fit(docs)
    assert names == list(seen) and raw != free[1]  # two of each language now
    assert language.identify(docs, (names, raw)).join(docs, "doc_id").where("lang = lang_pred").count() == 600


def test_six_hundred_small_languages_with_odd_names(spark):
    names = [f"l{i}\nx" for i in range(600)]
    letters = [chr(0x4E00 + i) for i in range(600)]
    rows = [(k * 6 + i, f"{c * 2} {c}{i} {c * (i + 1)}", n) for k, (c, n) in enumerate(zip(letters, names, strict=True)) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    model = language.fit(docs)
    assert set(model[0]) == set(names)
    found = language.identify(docs, model).join(docs, "doc_id").selectExpr("count_if(lang = lang_pred) as right", "count(*) as n").first()
    assert found.right >= 0.99 * found.n


def test_noise_is_rejected_though_languages_are_small(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet").select("doc_id", "text", "lang").where("lang is not null and length(text) > 200")
    few = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(25)) == 0)
    rnd = np.random.default_rng(5)
    noise = ["".join(rnd.choice(list("qxzjkwvyqhß"), 9)) for _ in range(40)]
    planted = spark.createDataFrame([(-1 - i, " ".join(rnd.choice(noise, 60)), None) for i in range(10)], "doc_id long, text string, lang string")
    kept = {r["gone"]: r["n"] for r in language.keep(few.unionByName(planted)).groupBy((F.col("doc_id") < 0).alias("gone")).agg(F.count(F.lit(1)).alias("n")).collect()}
    assert kept.get(True, 0) == 0
    assert kept[False] >= 0.97 * few.count()


def test_language_kernel_against_strings():
    """Values of whole strings' n-gram sets, without hashing, give the same languages and nearly the same values."""
    rnd = np.random.default_rng(3)
    vocab = {"a": ["the", "cat", "sat", "hat", "and"], "b": ["der", "hund", "und", "katze", "haus"], "c": ["le", "chat", "et", "chien", "maison"]}
    texts, langs = [], []
    for lang, words in vocab.items():
        for _ in range(12):
            texts.append(" ".join(rnd.choice(words, 8)))
            langs.append(lang)
    marks = grams.Marks(language.BITS)
    rows = [language.features(t, marks) for t in texts]
    targets = np.array([[1 if x == n else -1 for n in vocab] for x in langs], float)
    at = np.arange(0, len(texts), 3)
    weights = language.regress(rows, targets, at)
    values = language.presence(rows).astype(float) @ weights[:-1] + weights[-1]
    sets = [{t.encode()[i : i + n] for n in range(1, language.LONGEST + 1) for i in range(len(t.encode()) - n + 1)} for t in texts]
    kernel = np.array([[len(a & b) / np.sqrt(len(a) * len(b)) for b in sets] for a in sets])
    low, vectors = np.linalg.eigh(kernel[np.ix_(at, at)])
    good = low > 1e-6 * low[-1]
    mapped = kernel[:, at] @ (vectors[:, good] / np.sqrt(low[good]))
    mean, middle = targets.mean(axis=0), mapped.mean(axis=0)
    solved = np.linalg.solve((mapped - middle).T @ (mapped - middle) + language.RIDGE * np.eye(len(middle)), (mapped - middle).T @ (targets - mean))
    direct = (mapped - middle) @ solved + mean
    assert np.abs(values - direct).max() < 0.05
    assert (values.argmax(axis=1) == direct.argmax(axis=1)).all()


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=50))
def test_marks_are_emptied(text):
    marks = grams.Marks(12)
    first = quality.features(text, marks).tolist()
    assert not marks.on.any() and quality.features(text, marks).tolist() == first


def test_fingerprints_of_odd_documents(spark, odd_docs, no_docs):
    assert minhash.compare_with_next(no_docs).collect() == []
    rows = minhash.compare_with_next(odd_docs).collect()
    texts = Counter((r.doc_id, len(r.text or "")) for r in odd_docs.collect())
    assert Counter((r.doc_id, r.n_chars) for r in rows) == texts
    alone = minhash.compare_with_next(odd_docs.where("doc_id = 1")).collect()
    assert len(alone) == 1 and alone[0].near_next == 1.0
    prints = {}
    for r, p in zip(sorted(odd_docs.where("doc_id > 3").collect()), sorted(minhash.fingerprints(odd_docs.where("doc_id > 3")).collect()), strict=True):
        assert prints.setdefault(r.text or "", p.fingerprint) == p.fingerprint


def test_op9_query_against_true_similarity(spark):
    docs = sorted(spark.read.parquet(f"{LARGER}/documents.parquet").select("doc_id", "text").collect())
    rows = sorted(queries_fingerprints.op9_fingerprints(spark, LARGER).collect())
    errors = []
    for i, (d, r) in enumerate(zip(docs, rows, strict=True)):
        text, following = d.text or "", docs[(i + 1) % len(docs)].text or ""
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        assert (r.doc_id, r.n_chars, r.edited_sha256) == (d.doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest())
        a, b, c = map(shingle_set, (text, changed, following))
        errors += [r.near_edited - len(a & b) / max(1, len(a | b)), r.near_next - len(a & c) / max(1, len(a | c))]
    assert abs(np.mean(errors)) < 0.01 and np.sqrt(np.mean(np.square(errors))) < 0.04


@pytest.mark.parametrize("shared", [0, 100, 300, 400])
def test_likeness_is_unbiased(shared):
    rnd, found = np.random.default_rng(shared), []
    for _ in range(40):
        x = rnd.integers(0, 1 << 62, 800 - shared, dtype=np.uint64)
        found.append(minhash.likeness(minhash.fingerprint(x[:400]), minhash.fingerprint(x[400 - shared :])))
    assert abs(np.mean(found) - shared / (800 - shared)) < 0.03
    one = [minhash.likeness(minhash.fingerprint(shingles.mixed(np.array([i], np.uint64))), minhash.fingerprint(shingles.mixed(np.array([i + 1], np.uint64)))) for i in range(40)]
    assert np.mean(one) < 0.05


def test_licenses_inherit_from_the_nearest_directory(spark):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    files = [(1, "/a/LICENSE", mit), (2, "/a/x.txt", "words " * 50), (3, "/a/b/y.txt", None), (4, "/a/b/c/COPYING.txt", gpl + "\n" + "filler " * 90), (5, "/a/b/c/d/z.txt", ""),
             (6, "/q/z.txt", "words\n" + gpl + "\n" + "words " * 50), (7, "/q/n.txt", "no word"), (8, None, mit), (9, None, None), (2, "/a/x.txt", "words " * 50), (10, "/a/b/own.txt", "Licensed under CC BY-NC 4.0.\n" + "w " * 99)]
    rows = licenses.scan(spark.createDataFrame([(*f, "x", 1.0) for f in files], "file_id long, path string, text string, license string, score double")).collect()
    found = Counter((r.file_id, r.license, r.found, r.directory) for r in rows)
    assert found == Counter([(1, "MIT", "own", None), (2, "MIT", "inherited", "/a"), (2, "MIT", "inherited", "/a"), (3, "MIT", "inherited", "/a"), (4, "GPL-3.0", "own", None), (5, "GPL-3.0", "inherited", "/a/b/c"),
                             (6, "GPL-3.0", "own", None), (7, None, "none", None), (8, "MIT", "own", None), (9, None, "none", None), (10, "CC-BY-NC-4.0", "own", None)])
    assert licenses.scan(spark.createDataFrame([], "file_id long, path string, text string")).collect() == []


def test_licenses_of_common_notices_and_whole_texts(spark):
    gpl = "# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General Public License as published by\n# the Free Software Foundation, either version 3 of the License, or\n# (at your option) any later version.\n"
    code = "x = 1\n" * 300
    said = [("MIT", "// SPDX-License-Identifier: MIT"), ("Apache-2.0", "# SPDX-License-Identifier: Apache-2.0"), ("GPL-3.0", "/* SPDX-License-Identifier: GPL-3.0-or-later */"), ("LGPL-2.1", "// SPDX-License-Identifier: LGPL-2.1-only"), ("GPL-3.0", gpl), ("GPL-2.0", gpl.replace("version 3", "version 2")),
            ("MPL-2.0", "Mozilla Public License Version 2.0"), ("MIT", "Copyright (c) 2020 Jane Doe and others. This file is part of a tool and is licensed under the MIT License; see the file beside it."), (None, "# SPDX-License-Identifier: Zlib"), (None, "You need a license to drive and permission to fish."), (None, "This is licensed under the terms of its own.")]
    files = [(i, f"/s/{i}.py", line + "\n" + code, 0.0) for i, (_, line) in enumerate(said)] + [(50 + i, "/h/m.py", "// SPDX-License-Identifier: MIT\n" + "y = 2\n" * i, 0.0) for i in range(50)]
    whole = licenses.whole_texts()
    files += [(100 + i, f"/w{i}/terms.txt", "Copyright (c) 2021 Jane Doe\n\n" + text, 0.0) for i, (_, text) in enumerate(whole)] + [(200 + i, f"/w{i}/src/a.c", "int x;", 0.0) for i in range(len(whole))]
    rows = {r.file_id: r for r in licenses.scan(spark.createDataFrame(files, "file_id long, path string, text string, score double")).collect()}
    assert len(rows) == len(files)
    assert [rows[i].license for i in range(len(said))] == [name for name, _ in said]
    assert {(rows[i].license, rows[i].found) for i in range(50, 100)} == {("MIT", "own")}
    assert [(rows[100 + i].license, rows[100 + i].found) for i in range(len(whole))] == [(name, "own") for name, _ in whole]
    assert [(rows[200 + i].license, rows[200 + i].found) for i in range(len(whole))] == [(name, "inherited") for name, _ in whole]


def test_op6_query_against_sql_and_without_python(spark, sf):
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{sf}/documents.parquet'")
    found = queries_licenses.op6_license_scan(spark, sf)
    assert not any(w in found._jdf.queryExecution().executedPlan().toString() for w in ("Python", "Arrow", "Pandas", "Cartesian"))
    want = con.sql(f"select {', '.join(found.columns)} from ({queries_licenses.OP6_SQL})").fetchall()
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(want, key=repr)


def test_pipeline_stages_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    stages, columns = dict(corpus_pipeline.STAGES), docs.columns
    rows = {r.doc_id: r for r in docs.collect()}
    good = stages["quality"](spark, docs, sf)
    bad = {r.doc_id for r in queries_classifiers.op7_quality(spark, sf).where("predicted = 0").collect()}
    assert good.columns == columns and {r.doc_id for r in good.collect()} == rows.keys() - bad
    clean = stages["language"](spark, good, sf)
    assert clean.columns == columns and clean.count() == good.count()
    one = stages["near_duplicates"](spark, clean, sf)
    own = [(r.doc_id, r.text) for r in clean.collect()]
    kept = {d for d, _, c in brute_jaccard(own) if d == c}
    assert one.columns == columns and Counter(r.doc_id for r in one.collect()) == Counter(kept)
    short = stages["repeated_bytes"](spark, one, sf)
    left = sorted(kept)
    want = {d: x[3].decode("utf-8", "ignore") for d, x in zip(left, brute_bytes([rows[d].text for d in left]), strict=True)}
    assert short.columns == columns and {r.doc_id: r.text for r in short.collect()} == want
    assert all(r.n_chars == len(r.text) for r in short.collect())
    packed = stages["packing"](spark, short, sf)
    assert {r.doc_id for r in packed.collect()} == set(left)
    assert corpus_pipeline.run(spark, sf).count() == packed.count()


def test_stages_take_empty_tables_and_nulls(spark, odd_docs, no_docs, tmp_path):
    labelled(spark, odd_docs).coalesce(1).write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (odd_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, docs, str(tmp_path)).count()
