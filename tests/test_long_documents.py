"""Documents of many rows against plain folds over them."""

import random

import pytest
from pyspark.sql import functions as F

from stemma.operators.ordered import place, running_sum
from stemma.plans import long_documents as LD, segmentation as S


def fold(paras, target):
    chunks, cur, n = [], [], 0
    for p in paras:
        if cur and n + len(p.split()) > target:
            chunks.append((n, "\n\n".join(cur)))
            cur, n = [], 0
        cur.append(p)
        n += len(p.split())
    return chunks + ([(n, "\n\n".join(cur))] if cur else [])


def test_running_sum(spark):
    df = spark.createDataFrame([(i, i % 7) for i in range(500)], "k int, v int")
    got = {r.k: r.total for r in running_sum(place(df, ["k"]), "v", "total").collect()}
    assert got == {i: sum(j % 7 for j in range(i + 1)) for i in range(500)}


@pytest.mark.parametrize("block", [1, 3, 16, LD.BLOCK])
def test_chunks_of_rows_are_those_of_the_fold(spark, block):
    rng = random.Random(block)
    docs = {d: [f"w{d} " + " ".join(["x"] * rng.choice([0, 1, 5, 30, 70])) for _ in range(n)]
            for d, n in (("a", 1), ("hot", 700), ("m", 40), (None, 9), ("z", 2))}
    data = [(d, i, p.strip()) for d, paras in docs.items() for i, p in enumerate(paras)]
    data += [("hot", 5_000, None), ("m", 3_000, " \n"), ("blank", 0, ""), ("none", 1, None)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "doc string, pos int, text string").withColumn("words", F.lit("clash"))
    got = {}
    for r in LD.chunk_rows(df, 50, block=block).orderBy("doc", "idx").collect():
        assert r.idx == len(got.setdefault(r.doc, []))
        got[r.doc].append((r.total, r.words, r.text))
    want = {d: fold([p.strip() for p in paras], 50) for d, paras in docs.items()}
    assert got == {d: [(len(c), n, t) for n, t in c] for d, c in want.items()}


def test_chunks_of_rows_are_those_of_whole_documents(spark):
    rng = random.Random(3)
    data = [(d, "\n\n".join("t " * rng.randint(1, 40) + "." for _ in range(rng.randint(1, 80)))) for d in range(15)]
    docs = spark.createDataFrame(data, "doc int, body string")
    rows = docs.select("doc", F.posexplode(F.split("body", "\n\n")).alias("pos", "text"))
    key = lambda df: sorted(tuple(r) for r in df.select("doc", "idx", "total", "words", "text").collect())
    assert key(LD.chunk_rows(rows, 60, block=8)) == key(S.chunk(docs, 60))


def test_repeated_positions_and_empty_tables(spark):
    df = spark.createDataFrame([("d", 1, "b c"), ("d", 1, "a"), ("d", 1, "b c"), ("d", 0, "z")], "doc string, pos int, text string")
    got = [(r.idx, r.text) for r in LD.chunk_rows(df, 3, block=2).orderBy("idx").collect()]
    assert got == [(0, "z\n\na"), (1, "b c"), (2, "b c")]
    assert LD.chunk_rows(df.limit(0), 3).collect() == []


def test_missing_chunks_are_listed(spark):
    manifest = spark.createDataFrame([("d", 0), ("d", 1), ("d", 2), ("e", 0), ("e", 0)], "doc string, idx int")
    chunks = spark.createDataFrame([("d", 0, "a"), ("d", 2, " \n"), ("x", 0, "y")], "doc string, idx int, text string")
    assert sorted(tuple(r) for r in LD.missing_chunks(manifest, chunks).collect()) == [("d", 1), ("d", 2), ("e", 0)]
