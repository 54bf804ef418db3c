"""Licences of files: TF-IDF cosine of header lines to templates, then the nearest licensed directory above.

Everything here is DataFrame expressions. A header line is a line with one of the
words in ``SIGNAL``; equal lines count together before anything is joined. A file's
own licence is that of its header line most like a template. Besides, spans of
terms around a licence word, across lines, are compared with the notices in
``NOTICES``, and whole files with the whole licences in ``license_texts``; their
inverse document frequencies are those of these fixed texts. A file is a licence
file of its directory if it is like a whole licence, if its name says so, or if
lines like a template have at least half of its words; files without a licence
take that of the nearest directory above, their own first, that has a licence file.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import cache
from importlib.resources import files as shipped

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A line of cosine at least this to a template has its licence.
LIKE = 0.6
#: Words that make a line a header line.
SIGNAL = r"(?i)\b(licen[cs]e[ds]?|licen[cs]ing|copyright|spdx|public domain|redistribution|permission)\b"
#: Names of licence files.
FILE_NAME = r"(?i)^(licen[cs]e|copying|unlicense)([.-].*)?$"
#: Licences and what notices of them say. A licence may have several lines.
TEMPLATES = [
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("MIT", "Released under the MIT License"),
    ("MPL-2.0", "This work is subject to the terms of the Mozilla Public License, version 2.0"),
]

#: A span of cosine at least this to a notice has its licence; a file of cosine at least this to a whole licence is one.
LIKE_NOTICE, LIKE_WHOLE = 0.8, 0.8
_NAMED = ["AGPL-3.0", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "CC0-1.0", "GPL-2.0", "GPL-3.0", "ISC", "LGPL-2.1", "LGPL-3.0", "MIT", "MPL-2.0", "Unlicense"]
_GNU = "This {0} is free software; you can redistribute it and/or modify it under the terms of the GNU {1} as published by the Free Software Foundation; either version {2} of the License, or (at your option) any later version"
_GNU_NAMES = [("GPL-2.0", "General Public License", "2"), ("GPL-3.0", "General Public License", "3"), ("LGPL-2.1", "Lesser General Public License", "2.1"), ("LGPL-3.0", "Lesser General Public License", "3"), ("AGPL-3.0", "Affero General Public License", "3")]
#: What notices say that stand inside a line or span several.
NOTICES = (
    [(name, f"SPDX-License-Identifier: {name}{end}") for name in _NAMED for end in (["", "-only", "-or-later"] if "GPL" in name else [""])]
    + [(name, _GNU.format(kind, gnu, version)) for name, gnu, version in _GNU_NAMES for kind in ("program", "library")]
    + [(name, f"licensed under the GNU {gnu} {word}{version}") for name, gnu, version in _GNU_NAMES for word in ("version ", "v")]
    + [
        ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
        ("Apache-2.0", "Apache License Version 2.0"),
        ("BSD-2-Clause", "licensed under the BSD 2-Clause License"),
        ("BSD-3-Clause", "licensed under the BSD 3-Clause License"),
        ("ISC", "licensed under the ISC License"),
        ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
        ("MIT", "licensed under the MIT License"),
        ("MIT", "licensed under the terms of the MIT License"),
        ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
        ("MPL-2.0", "Mozilla Public License Version 2.0"),
        ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
        ("Unlicense", "This is free and unencumbered software released into the public domain"),
    ]
)
#: Terms by which a notice is laid on a text.
_HOLDS = ("license", "licence", "licensed", "licenced", "spdx", "permission", "domain")


def _terms(text: str) -> list[str]:
    return [w for w in re.split("[^a-z0-9]+", text.lower()) if w]


def _vectors(texts: list[list[str]]) -> tuple[list[dict[str, float]], dict[str, float], float]:
    """TF-IDF rows of length one, the inverse document frequencies, and that of a term in none of the texts."""
    found = Counter(w for t in texts for w in set(t))
    idf = {w: math.log((1 + len(texts)) / (1 + n)) + 1 for w, n in found.items()}
    rows = []
    for t in texts:
        raw = {w: n * idf[w] for w, n in Counter(t).items()}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        rows.append({w: x / norm for w, x in raw.items()})
    return rows, idf, math.log(1 + len(texts)) + 1


@cache
def whole_texts() -> list[tuple[str, str]]:
    """Name and text of the whole licences that come with this package."""
    return sorted((x.name.removesuffix(".txt"), x.read_text()) for x in (shipped("stemma.llm") / "license_texts").iterdir() if x.name.endswith(".txt"))


def terms(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")


def template_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, name, text) for i, (name, text) in enumerate(TEMPLATES)], "template int, license string, line string")


def _weighted(lines: DataFrame, key: str, idf: DataFrame) -> DataFrame:
    """``key, term, weight`` of rows of length one; ``lines`` has the key and its line."""
    counts = lines.select(key, F.explode(terms(F.col("line"))).alias("term")).groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))
    raw = counts.join(idf, "term").select(key, "term", (F.col("tf") * F.col("idf")).alias("raw"))
    norms = raw.groupBy(key).agg(F.sqrt(F.sum(F.col("raw") * F.col("raw"))).alias("norm"))
    return raw.join(norms, key).select(key, "term", (F.col("raw") / F.col("norm")).alias("weight"))


def line_licenses(headers: DataFrame, templates: DataFrame) -> DataFrame:
    """``line, license, score`` of each distinct line of ``headers(line, rows)`` that is like a template.

    Inverse document frequencies count every header line as often as it occurs,
    and each template once. ``templates(template, license, line)`` is small and
    given by the caller; it is the only side that is broadcast.
    """
    both = headers.select("line", "rows").unionByName(templates.select("line", F.lit(1).cast("long").alias("rows")))
    total = both.agg(F.sum("rows")).first()[0] or 0
    found = both.select(F.explode(F.array_distinct(terms(F.col("line")))).alias("term"), "rows").groupBy("term").agg(F.sum("rows").alias("df"))
    idf = found.select("term", (F.log((1 + F.lit(total)) / (1 + F.col("df"))) + 1).alias("idf"))
    own = _weighted(headers, "line", idf)
    given = _weighted(templates.select("template", "line"), "template", idf).join(F.broadcast(templates.select("template", "license")), "template")
    scores = own.join(F.broadcast(given.withColumnRenamed("weight", "given")), "term").groupBy("line", "template", "license").agg(F.sum(F.col("weight") * F.col("given")).alias("score"))
    best = scores.groupBy("line").agg(F.min(F.struct((-F.round("score", 6)).alias("below"), "license")).alias("best"))
    return best.select("line", F.col("best.license").alias("license"), (-F.col("best.below")).alias("score")).where(F.col("score") >= LIKE)


def notice_licenses(marked: DataFrame) -> DataFrame:
    """``file_id, path, license, score`` of the spans of ``marked(file_id, path, text)`` that are like a notice.

    A notice is laid on every place of a text that has its first term of
    ``_HOLDS``; the span has as many terms as the notice. Equal spans count once.
    """
    spark, said = marked.sparkSession, [_terms(x) for _, x in NOTICES]
    rows, idf, other = _vectors(said)
    at = [next(i for i, w in enumerate(t) if w in _HOLDS) for t in said]
    laid = F.array(*(F.struct(F.lit(k).alias("notice"), F.lit(t[i]).alias("hold"), F.lit(i).alias("at"), F.lit(len(t)).alias("size")) for k, (t, i) in enumerate(zip(said, at, strict=True))))
    table = F.broadcast(spark.createDataFrame([(k, name, row, idf) for k, ((name, _), row) in enumerate(zip(NOTICES, rows, strict=True))], "notice int, license string, weights map<string,double>, idf map<string,double>"))
    places = lambda ts: F.filter(F.transform(ts, lambda w, i: F.when(w.isin(*_HOLDS), i)), lambda i: i.isNotNull())
    on = lambda ts, x, i: F.struct(x["notice"].alias("notice"), F.array_join(F.slice(ts, F.greatest(i - x["at"], F.lit(0)) + 1, x["size"]), " ").alias("span"))
    spans = lambda ts: F.flatten(F.transform(places(ts), lambda i: F.transform(F.filter(laid, lambda x: x["hold"] == F.get(ts, i)), lambda x: on(ts, x, i))))
    found = marked.select("file_id", "path", F.explode(F.array_distinct(F.flatten(F.transform(F.array(terms(F.col("text"))), spans)))).alias("s")).select("file_id", "path", "s.notice", "s.span")
    words = F.split("span", " ")
    value = lambda w: F.size(F.filter(words, lambda x: x == w)) * F.coalesce(F.try_element_at("idf", w), F.lit(other))
    values = F.transform(F.array_distinct(words), lambda w: F.struct(value(w).alias("own"), F.coalesce(F.try_element_at("weights", w), F.lit(0.0)).alias("given")))
    total = lambda f: F.aggregate("values", F.lit(0.0), lambda a, x: a + f(x))
    scored = found.select("notice", "span").distinct().join(table, "notice").select("notice", "span", "license", values.alias("values"))
    scored = scored.select("notice", "span", "license", F.round(total(lambda x: x["own"] * x["given"]) / F.sqrt(total(lambda x: x["own"] * x["own"])), 6).alias("score"))
    return found.join(scored.where(F.col("score") >= LIKE_NOTICE), ["notice", "span"]).select("file_id", "path", "license", "score")


def whole_licenses(marked: DataFrame) -> DataFrame:
    """``key, whole, whole_score``: the whole licence that a text is most like, if it is like one; ``key`` is the text's MD5.

    Copies of a text add up to a multiple of its vector, which has the same cosines.
    """
    spark, names = marked.sparkSession, [name for name, _ in whole_texts()]
    rows, idf, other = _vectors([_terms(x) for _, x in whole_texts()])
    given = spark.createDataFrame([(name, w, x) for name, row in zip(names, rows, strict=True) for w, x in row.items()], "license string, term string, given double")
    keyed = marked.select(F.md5("text").alias("key"), terms(F.col("text")).alias("own"))  # once a text, not once a term
    counts = keyed.select("key", F.explode("own").alias("term")).groupBy("key", "term").agg(F.count(F.lit(1)).alias("tf"))
    known = spark.createDataFrame(list(idf.items()), "term string, idf double")
    own = counts.join(F.broadcast(known), "term", "left").select("key", "term", (F.col("tf") * F.coalesce("idf", F.lit(other))).alias("own"))
    norms = own.groupBy("key").agg(F.sqrt(F.sum(F.col("own") * F.col("own"))).alias("norm"))
    dots = own.join(F.broadcast(given), "term").groupBy("key", "license").agg(F.sum(F.col("own") * F.col("given")).alias("dot"))
    scored = dots.join(norms, "key").select("key", "license", F.round(F.col("dot") / F.col("norm"), 6).alias("score")).where(F.col("score") >= LIKE_WHOLE)
    best = scored.groupBy("key").agg(F.min(F.struct((-F.col("score")).alias("below"), "license")).alias("best"))
    return best.select("key", F.col("best.license").alias("whole"), (-F.col("best.below")).alias("whole_score"))


def scan(files: DataFrame, templates: DataFrame | None = None) -> DataFrame:
    """``file_id, path, license, found, score, directory`` for every row of ``files(file_id, path, text)``.

    ``found`` is ``own``, ``inherited`` or ``none``. Of equal scores the first
    licence by name counts. Null texts have no licence of their own, null paths
    inherit none; repeated rows stay rows; other columns are left out.
    """
    templates = template_table(files.sparkSession) if templates is None else templates
    rows = files.select("file_id", "path", "text")
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(SIGNAL))
    marked = rows.where(F.col("text").rlike(SIGNAL))
    headed = marked.select("file_id", "path", F.size(terms(F.col("text"))).alias("words"), F.explode(lines).alias("line"))
    headers = headed.groupBy("line").agg(F.count(F.lit(1)).alias("rows"))
    licensed = headed.join(line_licenses(headers, templates), "line").select("file_id", "path", "license", "score", F.size(terms(F.col("line"))).alias("line_words"), "words")
    # a whole licence comes before what single lines of it say
    whole = marked.select("file_id", "path", F.md5("text").alias("key")).join(whole_licenses(marked), "key").select("file_id", "path", F.col("whole").alias("license"), F.col("whole_score").alias("score"), F.lit(True).alias("whole"))
    every = licensed.unionByName(notice_licenses(marked), allowMissingColumns=True).withColumn("whole", F.lit(False)).unionByName(whole, allowMissingColumns=True)
    own = every.groupBy("file_id", "path").agg(
        F.min(F.struct((~F.col("whole")).alias("part"), (-F.col("score")).alias("below"), "license")).alias("best"), F.sum("line_words").alias("licensed_words"), F.sum("words").alias("all_words"), F.count("words").alias("n")
    )
    directory, name = F.regexp_extract("path", r"^(.*)/[^/]*$", 1), F.regexp_extract("path", r"([^/]*)$", 1)
    own = own.select("file_id", "path", F.col("best.license").alias("license"), (-F.col("best.below")).alias("score"), (~F.col("best.part") | F.coalesce(name.rlike(FILE_NAME), F.lit(False)) | F.coalesce(2 * F.col("licensed_words") * F.col("n") >= F.col("all_words"), F.lit(False))).alias("is_file"), directory.alias("directory"))
    held = own.where(F.col("is_file") & F.col("path").isNotNull()).groupBy("directory").agg(F.min(F.struct((-F.col("score")).alias("below"), "license")).alias("best"))
    held = held.select(F.col("directory").alias("above"), F.col("best.license").alias("above_license"), (-F.col("best.below")).alias("above_score"))
    # directories, not files, look for what is above them
    homes = rows.where("path is not null").select(directory.alias("directory")).distinct()
    parts = F.split("directory", "/")
    climbed = homes.select("directory", F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), "/"))).alias("above"))
    nearest = climbed.join(held, "above").groupBy("directory").agg(F.max(F.struct(F.length("above").alias("depth"), "above", "above_license", "above_score")).alias("near"))
    joined = rows.select("file_id", "path", directory.alias("directory")).join(own.select(F.col("file_id").alias("own_id"), F.col("path").alias("own_path"), "license", "score"), F.col("file_id").eqNullSafe(F.col("own_id")) & F.col("path").eqNullSafe(F.col("own_path")), "left")
    joined = joined.join(nearest.withColumnRenamed("directory", "home"), F.col("directory") == F.col("home"), "left")
    return joined.select(
        "file_id", "path", F.coalesce("license", "near.above_license").alias("license"),
        F.when(F.col("license").isNotNull(), "own").when(F.col("near").isNotNull(), "inherited").otherwise("none").alias("found"),
        F.coalesce("score", "near.above_score").alias("score"),
        F.when(F.col("license").isNull(), F.col("near.above")).alias("directory"),
    )
