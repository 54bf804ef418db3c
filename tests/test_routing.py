"""Routing over rows against the sequential rule."""

import random

import pytest
from pyspark.sql import functions as F

from stemma.operators import greedy
from stemma.operators.greedy import prefix_matches
from stemma.plans import routing, segmentation as S


@pytest.fixture(scope="module", autouse=True)
def few_partitions(spark):
    """Rounds are many small jobs."""
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def fits(a, b):
    return a.startswith(b) or b.startswith(a)


def by_rule(takers, offers):
    free, out = sorted(offers), []
    for row, grp, key in sorted(takers):
        for o in free:
            if o[1] == grp and fits(o[2], key):
                free.remove(o)
                out.append((row, o[0]))
                break
    return sorted(out)


def matches(spark, takers, offers, small=50_000):
    schema = "row long, grp string, key string"
    return sorted(tuple(r) for r in prefix_matches(spark.createDataFrame(takers, schema), spark.createDataFrame(offers, schema), small).collect())


KEYS = ["", "a", "ab", "abc", "abd", "b", "ba", "c"]


@pytest.mark.parametrize("small", [0, 50_000])
def test_matches_are_those_of_the_rule(spark, small):
    rng = random.Random(small)
    takers, offers = [], []
    for g in range(40):
        some = rng.sample(KEYS, rng.randint(1, 6))
        for side in (takers, offers):
            side += [(0, f"g{g}", rng.choice(some)) for _ in range(rng.randint(0, 7))]
    for side in (takers, offers):
        rng.shuffle(side)
        side[:] = [(i, g, k) for i, (_, g, k) in enumerate(side)]
    assert matches(spark, takers, offers, small) == by_rule(takers, offers)


def test_many_rows_of_one_group(spark):
    rng = random.Random(5)
    takers = [(i, "hot", rng.choice(["intro"] * 30 + ["part", "part-one", "note", "note-2", "other"])) for i in range(300)]
    offers = [(i, "hot", rng.choice(["intro", "intro-b", "part", "part-one-b", "note", "else"])) for i in range(200)]
    for small in (100,):
        assert matches(spark, takers, offers, small) == by_rule(takers, offers)


def test_groups_of_few_rows_need_no_classes(spark, monkeypatch):
    monkeypatch.setattr(greedy, "_fitting", None)
    rng = random.Random(3)
    takers, offers = ([(i, f"g{rng.randrange(30)}", rng.choice(KEYS)) for i in range(n)] for n in (200, 150))
    assert matches(spark, takers, offers) == by_rule(takers, offers)


def test_groups_of_few_and_of_many_rows_together(spark):
    rng = random.Random(4)
    takers, offers = ([(i, rng.choice(["hot", "hot", f"g{rng.randrange(9)}"]), rng.choice(KEYS)) for i in range(n)] for n in (90, 70))
    assert matches(spark, takers, offers, 40) == by_rule(takers, offers)


def test_rule_over_one_group_of_any_keys():
    rng = random.Random(6)
    for _ in range(500):
        keys = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 4))) for _ in range(rng.randint(1, 9))]
        takers, offers = ([(i, "g", rng.choice(keys)) for i in range(rng.randint(0, 12))] for _ in range(2))
        rows = [(0, k, i) for i, _, k in offers] + [(1, k, i) for i, _, k in takers]
        assert sorted(greedy._rule(rows)) == by_rule(takers, offers)


def test_null_and_empty(spark):
    assert matches(spark, [], []) == []
    assert matches(spark, [(0, None, "a"), (1, "g", None), (2, "g", "")], [(0, "g", "x"), (1, None, "a")]) == [(2, 0)]


def joined(rows):
    """Piece texts as the job over whole issues gives them."""
    out = {}
    for r in sorted(rows, key=lambda r: (r.cahier, r.pos, r.seq or 0)):
        old = out.get((r.cahier, r.pos))
        text = "" if r.sec is None else f"## {r.head}\n{r.body}"
        if r.matched_by == "slug":
            text = r.body.strip()
        elif r.matched_by == "order":
            text = text.strip()
        elif r.matched_by == "rest":
            text = (old[1] if old else "") + "\n\n" + text
        out[r.cahier, r.pos] = (old[0] if old else None if r.matched_by == "rest" else r.matched_by, text)
    return out


def test_pieces_are_those_of_whole_issues(spark):
    rng = random.Random(11)
    words = ["Un", "Deux", "Un deux", "Un deux trois", "Fin", "Avis", "Notes"]
    issues = {f"c{i}": ([rng.choice(words) for _ in range(rng.randint(1, 9))], [rng.choice(words) for _ in range(rng.randint(2, 7))]) for i in range(25)}
    docs = spark.createDataFrame([(c, "".join(f"## {h}\nt{i}\n" for i, h in enumerate(heads))) for c, (heads, _) in issues.items()], "cahier string, body string")
    catalog = spark.createDataFrame([(c, [(f"p{j}", t) for j, t in enumerate(ps)]) for c, (_, ps) in issues.items()],
                                    "cahier string, pieces array<struct<slug:string,title:string>>")
    whole = {(r.cahier, r.pos): (r.matched_by, r.body.strip()) for r in S.route_sections(docs, catalog, "one_to_one").collect()}
    sections = spark.createDataFrame([(c, i, h, f"t{i}\n") for c, (heads, _) in issues.items() for i, h in enumerate(heads)],
                                     "cahier string, sec int, head string, body string").withColumn("n", F.lit("clash"))
    pieces = catalog.select("cahier", F.posexplode("pieces").alias("pos", "p")).select("cahier", "pos", F.col("p.slug").alias("piece_slug"), F.col("p.title").alias("title"))
    got = joined(routing.route_rows(sections, pieces).collect())
    assert {k: (m, b.strip()) for k, (m, b) in got.items()} == whole


def test_single_whole_repeated_and_unlisted(spark):
    sections = [("one", 0, None, "pre"), ("one", 1, "A", "a"), ("bare", 0, None, "text"), ("two", 0, None, "pre"), ("two", 1, "X", "b"),
                ("two", 1, "X", "b"), ("two", 1, "X", None), (None, 0, "A", "a"), ("gone", 0, "A", "a")]
    pieces = [("one", 0, "p", "Z"), ("bare", 0, "p", "A"), ("bare", 1, "q", "B"), ("two", 0, "p", "N"), ("two", 1, "q", None), ("alone", 0, "p", "A"), (None, 0, "p", "A")]
    out = routing.route_rows(spark.createDataFrame(sections, "cahier string, sec int, head string, body string"),
                             spark.createDataFrame(pieces, "cahier string, pos int, piece_slug string, title string"))
    got = sorted((r.cahier, r.pos, r.seq, r.head, r.matched_by) for r in out.filter("seq is not null").collect())
    assert got[:3] == [("bare", 0, 0, None, "whole"), ("one", 0, 0, None, "single"), ("one", 0, 1, "A", "single")]
    assert [g[1:3] + g[4:] for g in got[3:]] == [(0, 0, "order"), (1, 0, "order"), (1, 1, "rest")]  # a null title is "untitled"
    assert sorted((r.cahier, r.pos) for r in out.filter("seq is null").collect()) == [("alone", 0), ("bare", 1)]
    assert routing.route_rows(out.limit(0).select("cahier", "sec", "head", "body"), spark.createDataFrame([], "cahier string, pos int, piece_slug string, title string")).count() == 0
