"""Near-duplicates, repeated bytes and vectors against brute force."""

import hashlib
import random
import re
from collections import Counter

import duckdb
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from stemma.llm import common, deep_sort, jaccard_join, queries_duplicates, repeated_bytes, shingles, vector_links


def shingle_set(text):
    w = [x for x in re.split("[\x20\x09-\x0d]+", (text or "").translate({k: k + 32 for k in range(65, 91)})) if x]
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def component_ids(rows, linked):
    """Smallest id reachable, by union of all linked pairs."""
    forest = common.Forest()
    for x in range(len(rows)):
        for y in range(x):
            if linked(x, y):
                forest.join(x, y)
    out = []
    for x in range(len(rows)):
        own = [rows[y] for y in range(len(rows)) if forest.root(y) == forest.root(x) and rows[y] is not None]
        out.append(min(own) if own else None)
    return out


def brute_jaccard(rows):
    sets = [shingle_set(t) for _, t in rows]
    same = component_ids([d for d, _ in rows], lambda x, y: sets[x] and sets[y] and 100 * len(sets[x] & sets[y]) >= 75 * len(sets[x] | sets[y]))
    return Counter((d, len(s), c) for (d, _), s, c in zip(rows, sets, same, strict=True))


def test_jaccard_of_odd_documents(odd_docs, no_docs):
    assert jaccard_join.near_duplicates(no_docs).collect() == []
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert Counter(map(tuple, jaccard_join.near_duplicates(odd_docs).collect())) == brute_jaccard(rows)


def test_jaccard_with_blocks_cut_into_groups(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 150)
    rnd = random.Random(2)
    words, rows = [f"w{i}" for i in range(60)], []
    for g in range(6):
        base = [rnd.choice(words) for _ in range(40)]
        for _ in range(12):
            own = list(base)
            for _ in range(rnd.randint(0, 2)):
                own[rnd.randrange(40)] = rnd.choice(words)
            rows.append((len(rows), " ".join(own[rnd.randint(0, 6) :])))
    found = jaccard_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert Counter(map(tuple, found.collect())) == brute_jaccard(rows)


def test_one_of_each_group_stays(odd_docs, no_docs):
    assert jaccard_join.keep_one(no_docs).collect() == []
    kept = jaccard_join.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    named = {(r.doc_id, r.component_id) for r in jaccard_join.near_duplicates(odd_docs).collect()}
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {d for d, c in named if d == c}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sets(st.integers(0, 12), min_size=1, max_size=9), min_size=1, max_size=14))
def test_trie_connects_what_links(sets):
    own = [np.array(sorted(s), np.uint64) for s in sets]
    forest, want = common.Forest(), common.Forest()
    for x, y in jaccard_join.Trie(own).links(75):
        assert 100 * len(sets[x] & sets[y]) >= 75 * len(sets[x] | sets[y])
        forest.join(x, y)
    for x in range(len(sets)):
        for y in range(x):
            if 100 * len(sets[x] & sets[y]) >= 75 * len(sets[x] | sets[y]):
                want.join(x, y)
    assert [forest.root(x) for x in range(len(sets))] == [want.root(x) for x in range(len(sets))]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="aB \t\né", max_size=60), max_size=5))
def test_shingle_counts(texts):
    assert [len(x) for x in shingles.sets(texts)] == [len(shingle_set(t)) for t in texts]


def test_long_texts_are_hashed_alike_in_slices(monkeypatch):
    text = " ".join(str(i * i) for i in range(4000))
    whole = shingles.sets([text])[0]
    monkeypatch.setattr(shingles, "SLICE", 1000)
    assert np.array_equal(shingles.sets([text])[0], whole)


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (None, 3)]
    random.Random(1).shuffle(links)
    found = common.components(spark.createDataFrame(links, "a long, b long").repartition(6), "t").collect()
    assert {r.node: r.root for r in found} == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 140)}}
    assert common.components(spark.createDataFrame([], "a long, b long"), "t").collect() == []


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.text(alphabet="ab\0", max_size=40)), min_size=1, max_size=30))
def test_deep_shallow_order(rows):
    strings, groups = [s.encode() for _, s in rows], np.array([g for g, _ in rows])
    order, shared = deep_sort.sort(strings, groups, 40)
    key = lambda i: (groups[i], strings[i].ljust(40, b"\0"), len(strings[i]))
    assert [key(i) for i in order] == sorted(map(key, range(len(rows))))
    for k in range(1, len(rows)):
        a, b = strings[order[k - 1]], strings[order[k]]
        n = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        assert shared[k] == (n if groups[order[k]] == groups[order[k - 1]] else -1)


def brute_bytes(texts):
    texts, times, out = [(t or "").encode() for t in texts], Counter(), []
    for t in texts:
        times.update(t[p : p + 200] for p in range(len(t) - 199))
    for t in texts:
        gone = np.zeros(len(t), bool)
        for p in range(len(t) - 199):
            if times[t[p : p + 200]] > 1:
                gone[p : p + 200] = True
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        out.append((len(t), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), kept))
    return out


def removed(docs):
    return Counter((r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in repeated_bytes.remove(docs).collect())


def test_repeated_bytes_of_odd_documents(odd_docs, no_docs):
    short = odd_docs.where("text is null or length(text) < 10000")
    assert removed(short) == Counter(brute_bytes([r.text for r in short.collect()]))
    assert repeated_bytes.remove(no_docs).collect() == []


def test_repeated_bytes_with_hot_anchors_and_small_slices(spark, monkeypatch):
    monkeypatch.setattr(repeated_bytes, "HOT", 3)
    monkeypatch.setattr(repeated_bytes, "CHUNK", 20)
    monkeypatch.setattr(repeated_bytes, "SLICE", 300)
    monkeypatch.setattr(repeated_bytes, "TOGETHER", 5)
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abcé") for _ in range(5))
    passage = " ".join(word() for _ in range(50))
    texts = [" ".join([word() for _ in range(rnd.randint(0, 30))] + [passage[rnd.randint(0, 60) :]] + [word() for _ in range(rnd.randint(0, 30))]) for _ in range(25)]
    texts += ["a" * 700, "xy" * 300, passage, passage, None, ""]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    assert removed(docs) == Counter(brute_bytes(texts))


def test_repeated_bytes_at_every_place_around_a_slice_boundary(spark, monkeypatch):
    monkeypatch.setattr(repeated_bytes, "SLICE", 1000)
    rnd = random.Random(6)
    prose = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    texts = []
    for at in range(760, 1010, 2):
        passage = prose(rnd.randint(200, 230))
        texts += [prose(at) + passage + prose(300), prose(rnd.randint(0, 400)) + passage + prose(rnd.randint(0, 300))]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    assert removed(docs) == Counter(brute_bytes(texts))


def test_shortened_documents_keep_their_columns(odd_docs):
    out = repeated_bytes.shorten(odd_docs)
    assert out.columns == odd_docs.columns and out.count() == odd_docs.count()
    assert {r.doc_id for r in out.where("text is null").collect()} == {r.doc_id for r in odd_docs.where("text is null").collect()}
    assert out.where("length(text) <> n_chars").count() == 0


def test_op2_query_against_brute_force(spark, sf):
    docs = sorted(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    want = [(d.doc_id, n, gone, runs, hashlib.sha256(kept).hexdigest()) for d, (n, gone, runs, kept) in zip(docs, brute_bytes([d.text for d in docs]), strict=True)]
    assert sorted(map(tuple, queries_duplicates.op2_repeated_bytes(spark, sf).collect())) == want


def test_queries_against_their_sql(spark, sf):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.sql(f"create view {table} as select * from '{sf}/{table}.parquet'")
    for name, sql in queries_duplicates.ORACLES.items():
        found = queries_duplicates.QUERIES[name](spark, sf)
        want = con.sql(f"select {', '.join(found.columns)} from ({sql})").fetchall()
        assert sorted(map(tuple, found.collect())) == sorted(want), name


def test_vectors_of_every_kind(spark, monkeypatch):
    monkeypatch.setattr(vector_links, "GROUP", 4)
    rnd = np.random.default_rng(3)
    base, rows = rnd.standard_normal((5, 16)), []
    for i in range(80):
        x = (base[i % 5] + 0.12 * rnd.standard_normal(16)) * rnd.uniform(0.1, 1e6)
        rows.append((x.tolist(), int(i % 2)))
    rows += [rows[0], rows[0], ([0.0] * 16, 0), ([float("nan")] + [1.0] * 15, 0), ([float("inf")] + [1.0] * 15, 0), ([None] + [1.0] * 15, 0), (None, 0), ([], 0), (rows[1][0], None), (base[0].tolist()[:8], 0), ([-0.0, 1.0], 1), ([0.0, 1.0], 1), ([1e200, 0.0], 1), ([1e-200, 0.0], 1)]
    ids = [*range(len(rows) - 2), 5, None]
    frame = spark.createDataFrame([(i, x, label, 1, "k") for i, (x, label) in zip(ids, rows, strict=True)], "vec_id long, embedding array<double>, label int, copies int, key string").repartition(3)

    def usable(x, label):
        return label is not None and x and all(v is not None and np.isfinite(v) for v in x) and any(x)

    def linked(a, b):
        (x, p), (y, q) = rows[a], rows[b]
        if a == b or not usable(x, p) or not usable(y, q) or p != q or len(x) != len(y):
            return False
        x, y = np.array(x) / np.abs(x).max(), np.array(y) / np.abs(y).max()
        return x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.93

    counts = [sum(linked(a, b) for b in range(len(rows))) for a in range(len(rows))]
    same = component_ids(ids, linked)
    assert Counter(map(tuple, vector_links.links(frame).collect())) == Counter((i, n, c, i == c) for i, n, c in zip(ids, counts, same, strict=True))
    assert vector_links.links(frame.limit(0)).collect() == []


def test_vector_recall(spark):
    rnd = np.random.default_rng(5)
    base = rnd.standard_normal((300, 64))
    near = base + rnd.standard_normal(base.shape) * np.sqrt(1 / 0.935**2 - 1)  # just above the least cosine, most of them
    x = np.concatenate([base, near])
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = int((unit @ unit.T >= 0.93).sum()) - len(x)
    frame = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    found = vector_links.links(frame).agg({"n_links": "sum"}).first()[0]
    assert 0.98 * want <= found <= want


def test_one_stays_where_an_id_repeats_with_other_texts(spark):
    words = " ".join(f"w{i}" for i in range(60))
    rows = [(3, words, "a"), (5, "other " + words.upper() + " b", "b"), (5, words + " more", "c"), (None, words + " x", "d"), (7, None, "e"), (7, "", "f"), (8, "alone here", "g")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, name string")
    assert sorted(r.name for r in jaccard_join.keep_one(docs).collect()) == ["a", "e", "f", "g"]
    assert sorted(r.name for r in jaccard_join.keep_one(docs.where("name = 'd'")).collect()) == ["d"]
