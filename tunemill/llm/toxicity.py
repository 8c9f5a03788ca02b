"""Toxicity: a logistic classifier on words whose score does not move when identity terms are swapped.

Fitting minimises the log loss of labelled texts, a quadratic weight penalty,
and ``fairness`` times the mean squared change of the logit between each text
with identity terms and its counterfactual, in which every such term is
replaced by another of its group.  A weight that a group's name picks up from
the company it keeps is thereby pressed to that of its peers, so neutral
mentions stay neutral.

Features are the distinct words of the whole text (letters only, lower case)
and the beginnings of longer words: those whose share differs between the
labels by ``min_z`` standard errors, and all identity terms.  The fit looks at some ``max_rows`` labelled texts, chosen
by a hash of their ids; everything else covers all rows.

A NULL or empty text gets the score of no words.  Without labels of both kinds
the score is the smoothed share of label 1 for every text.  Labels of unknown
documents, NULL labels and NULL ids teach nothing; of several labels of one
document the highest counts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunemill.llm.common import small_batches, stored, text_or_empty

GROUPS = (
    ("women", "men"),
    ("woman", "man"),
    ("girls", "boys"),
    ("female", "male"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("gay", "lesbian", "bisexual", "straight", "transgender"),
    ("black", "white", "asian", "latino", "arab"),
    ("africans", "europeans", "asians", "americans", "arabs"),
    ("immigrants", "refugees", "natives"),
    ("deaf", "blind", "disabled"),
    ("femmes", "hommes"),
    ("frauen", "männer"),
    ("mujeres", "hombres"),
    ("musulmans", "chrétiens", "juifs"),
    ("muslime", "christen", "juden"),
    ("musulmanes", "cristianos", "judíos"),
)
MAX_ROWS = 20_000
MAX_FEATURES = 4_096
AT_ONCE = 128
"""Texts whose words a task of the fit holds as Python sets."""
MIN_Z = 4.0
PREFIXES = (5, 7)
FAIRNESS = 4.0
RIDGE = 1e-4
THRESHOLD = 0.3

WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> set[str]:
    return set(WORD.findall(text.lower())) if text else set()


def features_of(words: set[str]) -> set[str]:
    """The words, and their beginnings of ``PREFIXES`` letters, marked by a hyphen."""
    return words.union(*[{w[:n] + "-" for w in words if len(w) > n} for n in PREFIXES])


def swapped(words: set[str], groups=GROUPS) -> set[str] | None:
    """The words with each identity term replaced by the next of its group; None without such a term."""
    peers = {term: group[(i + 1) % len(group)] for group in groups for i, term in enumerate(group)}
    found = words & peers.keys()  # beginnings are made from the swapped words
    return (words - found) | {peers[w] for w in found} if found else None


@dataclass(frozen=True)
class Model:
    bias: float
    weights: dict[str, float]

    def score(self, text: str | None) -> float:
        known = features_of(words_of(text)) & self.weights.keys()
        logit = self.bias + sum(self.weights[w] for w in sorted(known))
        return float(1 / (1 + np.exp(-np.clip(logit, -40, 40))))


def in_parts(batches: Iterator[pa.RecordBatch], rows: int = AT_ONCE) -> Iterator[pa.RecordBatch]:
    """The batches in slices of so many rows at most."""
    for batch in batches:
        yield from (batch.slice(at, rows) for at in range(0, batch.num_rows, rows))


def _word_sets(rows: DataFrame) -> DataFrame:
    """``label``, the distinct words of each text and its features, made in one pass over the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            words = [words_of(batch.column(1)[i].as_py()) for i in range(batch.num_rows)]
            kind = pa.list_(pa.string())
            made = [pa.array([sorted(f(w)) for w in words], kind) for f in (set, features_of)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], names=["label", "words", "features"])

    return rows.select("label", "text").mapInArrow(run, "label int, words array<string>, features array<string>")


def select_features(rows: DataFrame, min_z: float = MIN_Z, limit: int = MAX_FEATURES) -> list[str]:
    """The words whose share differs most between the labels, over all given rows."""
    totals = rows.groupBy("label").count().collect()  # two rows
    n = {r["label"]: r["count"] for r in totals}
    if not (n.get(0) and n.get(1)):
        return []
    counts = rows.select("label", F.explode("features").alias("word")).groupBy("word").agg(
        F.sum("label").alias("ones"), F.count("*").alias("all")
    )
    share = F.col("all") / (n[0] + n[1])
    error = F.sqrt(share * (1 - share) * (1 / n[0] + 1 / n[1]))
    z = F.abs(F.col("ones") / n[1] - (F.col("all") - F.col("ones")) / n[0]) / error
    kept = counts.where((F.col("all") > 2) & (share < 1)).withColumn("z", z).where(F.col("z") >= min_z)
    return [r["word"] for r in kept.orderBy(F.desc("z"), "word").limit(limit).collect()]


def fit(
    labelled: DataFrame,
    min_z: float = MIN_Z,
    fairness: float = FAIRNESS,
    ridge: float = RIDGE,
    groups=GROUPS,
) -> Model:
    """``labelled`` has ``text`` and ``label`` (0 or 1) and is the bounded sample.

    Only the numbers of the features in each text come to the driver, which
    solves the small convex problem.
    """
    rows = stored(_word_sets(labelled))
    features = select_features(rows, min_z)
    terms = sorted({t for g in groups for t in g} - set(features))
    vocabulary = {w: i for i, w in enumerate([*features, *terms])}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = lambda words: sorted(vocabulary[w] for w in words & vocabulary.keys())
        for batch in in_parts(batches):
            sets = [set(words) for words in batch.column(1).to_pylist()]
            own = [number(features_of(words)) for words in sets]
            other = [number(features_of(s)) if (s := swapped(words, groups)) else None for words in sets]
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(own, kind), pa.array(other, kind)], names=["label", "own", "other"]
            )

    numbers = rows.select("label", "words").mapInArrow(run, "label int, own array<int>, other array<int>")
    with small_batches(rows.sparkSession):
        table = numbers.toArrow()
    labels = np.array(table.column("label").to_pylist(), float)
    ones, n = labels.sum(), len(labels)
    prior = (ones + 0.5) / (n + 1)
    if not 0 < ones < n:
        return Model(float(np.log(prior / (1 - prior))), {})
    own, other = table.column("own").to_pylist(), table.column("other").to_pylist()
    weights, bias = _solve(own, other, labels, len(vocabulary), fairness, ridge)
    names = list(vocabulary)
    return Model(bias, {names[i]: float(w) for i, w in enumerate(weights) if w})


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(x) for x in lists], np.int64)
    return np.repeat(np.arange(len(lists)), sizes), np.array([i for x in lists for i in x], np.int64)


def _solve(own, other, labels, width, fairness, ridge, steps=400) -> tuple[np.ndarray, float]:
    """Accelerated gradient steps, each as long as the curvature allows."""
    row, column = _flat(own)
    pairs = [(a, b) for a, b in zip(own, other) if b is not None]
    pair_row, pair_column = _flat([a + b for a, b in pairs])
    sign = np.concatenate([np.r_[np.ones(len(a)), -np.ones(len(b))] for a, b in pairs]) if pairs else np.zeros(0)
    n, m = len(labels), max(1, len(pairs))

    def gradient(w, bias):
        logit = bias + np.bincount(row, w[column], n)
        residual = (1 / (1 + np.exp(-np.clip(logit, -40, 40))) - labels) / n
        g = np.bincount(column, residual[row], width) + ridge * w
        if pairs:
            change = np.bincount(pair_row, sign * w[pair_column], m)
            g += fairness * np.bincount(pair_column, 2 / m * change[pair_row] * sign, width)
        return g, residual.sum()

    def curvature():
        """The largest eigenvalue of a bound on the Hessian, by power iteration."""
        v, value = np.full(width + 1, 1 / np.sqrt(width + 1)), 1.0
        for _ in range(30):
            z = v[-1] + np.bincount(row, v[:-1][column], n)
            new = np.r_[np.bincount(column, z[row], width) / (4 * n), z.sum() / (4 * n)]
            if pairs:
                change = np.bincount(pair_row, sign * v[:-1][pair_column], m)
                new[:-1] += fairness * 2 / m * np.bincount(pair_column, change[pair_row] * sign, width)
            value = np.linalg.norm(new)
            v = new / value
        return 1.05 * value + ridge

    step = 1 / curvature()
    w, bias = np.zeros(width), float(np.log(labels.mean() / (1 - labels.mean())))
    ahead, ahead_bias = w, bias
    for k in range(steps):
        g, g_bias = gradient(ahead, ahead_bias)
        new, new_bias = ahead - step * g, ahead_bias - step * g_bias
        pull = k / (k + 3)
        ahead, ahead_bias = new + pull * (new - w), new_bias + pull * (new_bias - bias)
        w, bias = new, new_bias
    return w, float(bias)


def teaches(key: str = "doc_id") -> Column:
    """Whether a document's label may be learned from; the rest is held out."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 4 != 2


def sample_labels(labels: DataFrame, max_rows: int = MAX_ROWS, key: str = "doc_id", label: str = "toxic") -> DataFrame:
    """``key`` and ``label`` of some ``max_rows`` documents that may teach, chosen by a hash of the key."""
    known = (
        labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull())
        .where(teaches(key))
        .groupBy(key)
        .agg(F.max(label).cast("int").alias("label"))
    )
    n = known.count()
    parts = 1 << 20
    share = parts if n <= max_rows else parts * max_rows // n
    return known.where(F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(parts)) < share)


def fit_documents(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, **settings) -> Model:
    """A model from ``docs`` and the ``toxic`` column of ``labels``.

    The sample's ids and labels, some ``max_rows`` pairs of numbers, go to every
    executor; the texts stay where they are.
    """
    chosen = stored(sample_labels(labels, max_rows))
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return fit(rows.select("label", "text"), **settings)


def score(model: Model, text: str = "text") -> Column:
    """The score of each text: it alone is read, whole, row by row."""

    @F.pandas_udf("double")
    def scored(texts):
        return texts.map(model.score)

    return scored(text_or_empty(text))
