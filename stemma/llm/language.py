"""Language of texts by string kernels: n-gram presence, Nyström landmarks, ridge regression.

The kernel of two texts is the number of byte n-grams, of one to ``LONGEST``
bytes, that both have, over the geometric mean of how many each has. Texts are
compared with landmarks; a one-versus-rest kernel ridge regression on the
landmarks' span gives a value for each language.

Those values say which language is best, not whether any fits: they sum to
2 - n over n languages, so the best is never low. Whether a text is of a learned
language at all is told by its familiarity: the mean logarithm of the share of
the language's learning texts that have its n-grams, over a floor that the
learning texts set, each measured against the others. N-grams are hashed to
``2**BITS`` columns, so the kernel counts those as one that share a column.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stemma.llm import grams
from stemma.llm.common import annotate, batch_of, held_out, rows_of
from stemma.session import write_out

#: Texts learned from and landmarks, of each language at most.
SAMPLE, LANDMARKS = 600, 60
#: Texts learned from and landmarks, of all languages together; every language has its even share, one text at least.
ALL_SAMPLE, ALL_LANDMARKS = 60_000, 3000
BITS, LONGEST, RIDGE = 16, 4, 0.1
#: Texts scored by one matrix product.
TOGETHER = 32
UNKNOWN = "und"
#: A language's floor is the figure that this share of its learning texts is under, times ``SLACK``.
LOW, SLACK = 0.01, 1.25
#: Languages with fewer learning texts than tell such a share have a floor from the figures of all such languages.
MEASURED = 20
_MODEL = "languages array<string>, weights binary"
_MODEL_ARROW = pa.schema([("languages", pa.list_(pa.string())), ("weights", pa.binary())])
_OWN = ("_language", "_language_score", "_language_known")


def features(text: str, marks: grams.Marks) -> np.ndarray:
    marks.add(grams.as_bytes(text.lower()), range(1, LONGEST + 1), 4)
    return marks.take()


def packed(row: np.ndarray) -> bytes:
    """A text's columns as numbers or, where that is shorter, as bits; never more than the bits take."""
    if 2 * len(row) < 1 << BITS - 3:
        return row.astype("<u2").tobytes()
    on = np.zeros(1 << BITS, bool)
    on[row] = True
    return np.packbits(on).tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    if len(raw) < 1 << BITS - 3:
        return np.frombuffer(raw, "<u2").astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(raw, np.uint8)))


class Rows:
    """Columns of many texts, packed."""

    def __init__(self, rows: list[bytes]) -> None:
        self.rows = rows

    def __len__(self) -> int:
        return len(self.rows)

    def __getitem__(self, at):
        return [unpacked(x) for x in self.rows[at]] if isinstance(at, slice) else unpacked(self.rows[at])


def presence(rows: list[np.ndarray]) -> np.ndarray:
    """Rows of length one, a column for each n-gram."""
    out = np.zeros((len(rows), 1 << BITS), np.float32)
    for x, own in zip(out, rows, strict=True):
        x[own] = 1 / np.sqrt(max(1, len(own)))
    return out


def regress(rows: Rows | list[np.ndarray], targets: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    """Ridge regression on the landmarks' span, as weights of n-grams: a column for each target and a row more for the mean.

    The kernel with all landmarks is a matrix product, and so is the value from it;
    the two matrices are multiplied once, here.
    """
    marks = presence([rows[i] for i in landmarks.tolist()])
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    kept = values > 1e-6 * values[-1]
    half = vectors[:, kept] / np.sqrt(values[kept])
    mean = targets.mean(axis=0)
    total, inner, cross = 0, 0, 0  # the kernel of all rows is never held, only its sums
    for i in range(0, len(rows), 256):
        mapped = (presence(rows[i : i + 256]) @ marks.T).astype(np.float64) @ half
        total, inner, cross = total + mapped.sum(axis=0), inner + mapped.T @ mapped, cross + mapped.T @ (targets[i : i + 256] - mean)
    middle = total / len(rows)
    solved = np.linalg.solve(inner - len(rows) * np.outer(middle, middle) + RIDGE * np.eye(len(middle)), cross)
    onto = half @ solved
    weights = np.concatenate([marks[:, i : i + 4096].T.astype(np.float64) @ onto for i in range(0, marks.shape[1], 4096)])
    return np.concatenate([weights, (mean - middle @ solved)[None]])


def familiarity(rows: Iterable[np.ndarray]) -> tuple[np.ndarray, list[float]]:
    """Of texts of one language: for each n-gram the log share of the texts that have it, and each text's figure as the others see it."""
    rows = list(rows)
    n, counts = len(rows), np.zeros(1 << BITS)
    for own in rows:
        counts[own] += 1
    rest = np.log(np.maximum(counts - 0.5, 0.5) / n)
    return np.log((counts + 0.5) / (n + 1)), [float(rest[x].mean()) for x in rows if len(x)]


def floors(figures: list[list[float]], sizes: list[int]) -> np.ndarray:
    """The least figure of a text that is taken for one of each language.

    Where a language has ``MEASURED`` texts, their low quantile says so. The figures of smaller
    ones are put together, as shares of the figure of a text with nothing known (which depends on
    their number), and the quantile of these gives each its floor; where there is none, of all languages.
    """
    out = np.full(len(figures), -np.inf)
    small = [k for k, own in enumerate(figures) if len(own) < MEASURED]
    worst = [np.log(0.5 / (n + 1)) for n in sizes]
    shares = [x / np.log(0.5 / sizes[k]) for k in small if sizes[k] > 1 for x in figures[k]]
    shares = shares or [x / np.log(0.5 / n) for own, n in zip(figures, sizes, strict=True) if n > 1 for x in own]
    for k, own in enumerate(figures):
        if len(own) >= MEASURED:
            out[k] = SLACK * np.quantile(own, LOW)
        elif shares:
            out[k] = worst[k] * min(1.0, SLACK * np.quantile(shares, 1 - LOW))
    return out


def fit(docs: DataFrame, sample: int = SAMPLE) -> tuple[list[str], bytes]:
    """Languages and their n-gram weights, then familiarities, from text and non-null ``lang`` of at most ``sample`` distinct texts of each.

    Every language is learned, whatever its name and however many there are; all together have
    ``ALL_SAMPLE`` texts. Held-out documents are not read. Texts are chosen by hash: those under a bound
    that lets about twice as many distinct ones of a language through, however often
    each occurs, then the lowest. Without labelled texts nothing is learned.
    """
    known = docs.where("lang is not null and text is not null").where(~held_out())
    hashed = known.select("text", "lang", F.xxhash64("text").alias("hash"))
    # copies of a text share a hash, so the bound goes by distinct hashes
    counts = hashed.groupBy("lang").agg(F.approx_count_distinct("hash").alias("all_texts"))
    counts = write_out(counts, "languages")  # a row for each language, as the model has a column
    sample = max(1, min(sample, ALL_SAMPLE // max(1, counts.count())))
    hashed = hashed.join(F.broadcast(counts), "lang")
    low = hashed.where(F.pmod("hash", F.lit(1 << 30)) * F.col("all_texts") <= 2 * sample * (1 << 30)).groupBy("lang", "hash").agg(F.min("text").alias("text"))
    ranked = low.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod("hash", F.lit(1 << 30)), "hash"))).where(F.col("rank") <= sample)

    def train(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, found = grams.Marks(BITS), []
        for bodies, langs, ranks in rows_of(batches, "text", "lang", "rank"):
            found += [(lang, rank, packed(features(x, marks))) for x, lang, rank in zip(bodies, langs, ranks, strict=True)]
        if not found:
            return
        found.sort(key=lambda x: x[:2])
        names = sorted({x[0] for x in found})
        number = {name: k for k, name in enumerate(names)}
        place = np.array([number[lang] for lang, _, _ in found])
        targets = np.full((len(found), len(names)), -1, np.int8)
        targets[np.arange(len(found)), place] = 1
        share = max(1, min(LANDMARKS, ALL_LANDMARKS // len(names)))
        landmarks = np.array([i for i, (_, rank, _) in enumerate(found) if rank <= share][:ALL_LANDMARKS])
        rows = Rows([x[2] for x in found])
        weights = np.empty(((1 << BITS) + 1, 2 * len(names)), np.float32)
        weights[:, : len(names)] = regress(rows, targets, landmarks)
        figures, bounds = [], np.searchsorted(place, np.arange(len(names) + 1))
        for k in range(len(names)):
            shares, own = familiarity(rows[bounds[k] : bounds[k + 1]])
            weights[:-1, len(names) + k] = shares
            figures.append(own)
        weights[-1, len(names) :] = floors(figures, np.diff(bounds).tolist())
        yield batch_of(_MODEL_ARROW, [names], [weights.tobytes()])

    model = ranked.select("text", "lang", "rank").repartition(1).mapInArrow(train, _MODEL).collect()
    return (list(model[0][0]), bytes(model[0][1])) if model else ([], b"")


def mark(docs: DataFrame, model: tuple[list[str], bytes], column: str = "lang_pred", score: str = "score", known: str = "known") -> DataFrame:
    """Every row of ``docs`` with its language, its score and whether it is of a learned language; only the text counts.

    A text that is null or has no letter is ``und`` with score 0, as is every text
    when nothing was learned. The score is the best language's value, from -1 to 1,
    moved to 0 to 1; of languages with equal values the first by name counts. A text is known if it is over the floor of any language.
    Columns of the same names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        names, raw = shared.value
        weights = np.frombuffer(raw, np.float32).reshape(-1, max(1, 2 * len(names)))
        least = weights[-1, len(names) :] if names else None
        marks = grams.Marks(BITS)

        def find(bodies: list) -> list:
            langs, scores, sure = [UNKNOWN] * len(bodies), np.zeros(len(bodies)), [False] * len(bodies)
            worded = [i for i, x in enumerate(bodies) if any(map(str.isalpha, x or ""))] if names else []
            for at in range(0, len(worded), TOGETHER):
                own = worded[at : at + TOGETHER]
                rows = [features(bodies[i], marks) for i in own]
                both = presence(rows) @ weights[:-1]
                values = both[:, : len(names)] + weights[-1, : len(names)]
                sizes = np.sqrt([[max(1, len(x))] for x in rows])
                over = (both[:, len(names) :] / sizes >= least).any(axis=1)
                for i, best, value, fits in zip(own, values.argmax(axis=1), values.max(axis=1), over, strict=True):
                    langs[i], scores[i] = names[best], min(1.0, max(0.0, (float(value) + 1) / 2))
                    sure[i] = bool(fits)
            return [langs, scores, sure]

        return find

    return annotate(docs, make, f"{column} string, {score} double, {known} boolean")


def identify(docs: DataFrame, model: tuple[list[str], bytes]) -> DataFrame:
    """``doc_id, lang_pred, score`` of every row."""
    return mark(docs.select("doc_id", "text"), model).select("doc_id", "lang_pred", "score")


def keep(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose language is learned, with their columns."""
    found = mark(docs, fit(docs), *_OWN)
    return found.where(_OWN[2]).select(docs.columns)
