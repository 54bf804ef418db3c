import random
import re
from collections import Counter

import numpy as np
import pytest

from stemma.llm import collocations
from stemma.llm.collocations import Chunk, Grams


def pieces(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    return [[w for w in re.split("[ \t]+", p) if w] for p in re.split("[.,;:!?\n\x0b\x0c\r]", low)]


def counts(rows, longest=4):
    """Occurrences by (lang, words), and words by lang."""
    found, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        total[lang] += 0
        for w in pieces(text or ""):
            total[lang] += len(w)
            for n in range(1, longest + 1):
                found.update((lang, tuple(w[i : i + n])) for i in range(len(w) - n + 1))
    return found, total


def expected(rows, least, top, share=80):
    found, total = counts(rows)
    wanted = {k: a for k, a in found.items() if len(k[1]) > 1 and a >= least}
    above = Counter()
    for (lang, w), a in wanted.items():
        for n in range(2, len(w)):
            for i in range(len(w) - n + 1):
                above[lang, w[i : i + n]] = max(above[lang, w[i : i + n]], a)
    out = {}
    for (lang, w), a in wanted.items():
        if 100 * above[lang, w] >= share * a:
            continue
        score, _, left, right = min((2000000 * a // (found[lang, w[:k]] + found[lang, w[k:]]), k, found[lang, w[:k]], found[lang, w[k:]]) for k in range(1, len(w)))
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), left, right))
    return sorted((lang, i, p.decode(), -a, x, y, total[lang], -s) for lang, own in out.items() for i, (s, a, p, x, y) in enumerate(sorted(own)[:top], 1))


def got(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize(("least", "top", "bits"), [(2, 10_000, 26), (3, 5, 20), (2, 40, 6)])
def test_odd_texts(spark, odd_docs, least, top, bits):
    rows = [(r["lang"], r["text"]) for r in odd_docs.collect()]
    found = got(collocations.collocations(odd_docs, least=least, top=top, bits=bits))
    assert found == expected(rows, least, top)
    assert found


def test_a_text_longer_than_a_slice(spark):
    rnd = random.Random(2)
    words = ["".join(rnd.choice("abcÄé") for _ in range(rnd.randint(1, 8))) for _ in range(40)]
    text = "".join(rnd.choice(words) + rnd.choice([" ", " ", "  ", "\t", ", ", " . ", "\n"]) for _ in range(500_000))
    rows = [("en", text), ("en", "x" * (3 << 20)), (None, text[:1000]), ("en", "")]
    df = spark.createDataFrame(rows, "lang string, text string")
    assert len(text.encode()) > 2 << 20
    assert got(collocations.collocations(df, least=30)) == expected(rows, 30, 2000)


def test_no_documents(spark, no_docs):
    assert collocations.collocations(no_docs).count() == 0


@pytest.mark.parametrize("size", [1, 7, 30, 200])
def test_chunks_hold_every_phrase_once(size):
    rnd = random.Random(size)
    for _ in range(40):
        text = "".join(rnd.choice(["a", "B", "cé", "dd", " ", " ", ".", "\t", "long" * 5, ", "]) for _ in range(rnd.randint(0, 120)))
        found, total = Counter(), Counter()
        for group in ([c] for c in collocations.chunks("en", text.encode(), 4, size)):
            grams = Grams(group)
            total["en"] += int(grams.fresh.sum())
            for n in range(1, 5):
                for at in np.flatnonzero(grams.phrases(n)).tolist():
                    found["en", tuple(grams.text[grams.start[at] : grams.end[at + n - 1]].tobytes().decode().split(" "))] += 1
        want, words = counts([("en", text)])
        assert (found, total["en"]) == (want, words["en"])


def test_colliding_fingerprints_are_told_apart(monkeypatch):
    rnd = random.Random(4)
    rows = [(rnd.choice(["en", "de"]), " ".join(rnd.choice(["a", "bb", "cccccccc", "ddddddddd", "ddddddddde"]) for _ in range(60))) for _ in range(8)]
    group = [Chunk(lang, text.encode(), 0) for lang, text in rows]
    true = Grams.fingerprints
    monkeypatch.setattr(Grams, "fingerprints", lambda self, n: true(self, n) % np.uint64(3) << np.uint64(60))
    table, bits = collocations.Table(), np.full(1 << 10, 255, np.uint8)
    for part in (group[:3], group[3:4], group[4:]):
        grams = Grams(part)
        for n in range(1, 5):
            for at, times in collocations.verified(grams, n, bits):
                table.add(grams.block(n, at, times))
    assert table.others
    names = {collocations.salt(x): x for x in ("en", "de")}
    merged = collocations.Table()
    for _ in range(2):  # handed on in blocks and added up twice
        for batch in table.blocks(names, 7):
            for row in batch.to_pylist():
                merged.add(collocations._block(*list(row.values())[2:]))
    found = Counter()
    for batch in merged.rows(names, 4):
        for row in batch.to_pylist():
            assert row["words"] == len(row["phrase"].split(" "))
            found[row["lang"], tuple(row["phrase"].split(" "))] += row["n"]
    assert found == Counter({k: 2 * n for k, n in counts(rows)[0].items() if n >= 2})


def test_equal_fingerprints_for_equal_phrases():
    grams = Grams([Chunk("en", b"One  two\tthree. one two", 0), Chunk("en", b"ONE TWO", 0), Chunk("de", b"one two", 0)])
    prints = grams.fingerprints(2)
    at = [i for i in np.flatnonzero(grams.phrases(2)).tolist() if grams.text[grams.start[i] : grams.end[i + 1]].tobytes() == b"one two"]
    assert len(at) == 4
    assert len({int(prints[i]) for i in at[:3]}) == 1
    assert int(prints[at[3]]) != int(prints[at[0]])


def test_scores_beyond_64_bits(spark):
    """2000000 a passes 2**63 in exact arithmetic."""
    a = 9 * 10**12
    found = spark.sql(f"select cast(cast({a}L as decimal(20,0)) * cast(2000000 as decimal(7,0)) div (cast({a}L as decimal(20,0)) + cast({a + 7}L as decimal(20,0))) as long)").first()[0]
    assert found == 2000000 * a // (2 * a + 7)
