import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, score string, start int, name string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Rows with nulls, empty and very long texts, ties, repeats and columns whose names the operators use inside."""
    rnd = random.Random(5)
    words = ["".join(rnd.choice("abcdeéñß") for _ in range(rnd.randint(1, 9))) for _ in range(300)]
    prose = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    shared, base = prose(60), prose(150)
    texts = [prose(rnd.randint(0, 90)) for _ in range(30)]
    texts += [None, "", " ", "\n\t\r", "a", "A b c", "x" * 3000, "The the THE the", "\x1c\x1f \x00 ok", "🙂 日本語 'll don't 12 345", "<|endoftext|> a"]
    texts += [base, base, base.upper(), base + " end", "first " + base, shared + " " + prose(40), prose(40) + " " + shared, shared, shared]
    texts += [prose(40_000), "ab" * 400, "ab" * 400 + "c"]
    rows = [(i, t, rnd.choice(["en", "de", None]), "s", None, None, "k", 1, None) for i, t in enumerate(texts)]
    rows += [rows[3], (3, "another text under the same id", None, None, 1, None, None, None, None), (None, base, None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
