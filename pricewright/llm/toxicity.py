"""Toxicity by a classifier chain of linear models.

The categories are label columns, predicted one after the other.  The model of each category sees which words
the text holds and the probabilities of the categories before it.  What later models are trained on are
out-of-fold predictions: each labelled row gets its earlier probabilities from models that have not seen it.
Scoring uses the models fitted on all labelled rows.

The models are logistic regressions over words and word beginnings, each weighed by the logarithm of how much
more often it occurs in rows of one label than of the other, so that few telling words outweigh many others.  They
are fitted on about `MAX_LABELLED` labelled rows at most, drawn by a hash
of the id; their word lists, one short array of numbers a row, are all that reaches the driver.  Every row of the
documents is scored, whole, where it lies.

Defined results: a NULL text has no words; an id labelled several times counts as positive in a category if any
row says so; labels that are NULL are left out; a category without labels has a NULL probability and is
passed over, one whose labels are all equal has the probability 0 or 1; repeated rows each get their row;
empty tables give none.  Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import map_texts, shared_value, stored

MAX_LABELLED = 8_000
LEAST_ROWS = 3  # labelled rows that a word must occur in
SMOOTHING = 1.0  # added to a word's rows of either label
FOLDS = 3
ITERATIONS = 60
PENALTY = 1.0  # of half the squared weights, against the sum of the rows' losses
THRESHOLD = 0.5
WORDS = re.compile(r"[^\W_]+")


PREFIXES = (5, 6, 7)  # beginnings of words are features too, for words that come in many forms


def features_of(text: str | None) -> set[str]:
    """The distinct words of a text, and their beginnings, marked with a star."""
    words = set(WORDS.findall(text.lower())) if text else set()
    return words.union(*[[w[:n] + "*" for w in words if len(w) > n] for n in PREFIXES])


class Rows(NamedTuple):
    """Words of n rows as two parallel arrays: row, word number."""

    n: int
    row: np.ndarray
    word: np.ndarray

    def take(self, chosen: np.ndarray) -> Rows:
        place = np.cumsum(chosen, dtype=np.int32) - 1
        mine = chosen[self.row]
        return Rows(int(chosen.sum()), place[self.row[mine]], self.word[mine])


class Linear(NamedTuple):
    """Logistic regression over words and earlier probabilities; the last weight is the constant."""

    weights: np.ndarray
    extra: np.ndarray

    def probability(self, rows: Rows, earlier: np.ndarray) -> np.ndarray:
        margin = np.bincount(rows.row, self.weights[rows.word], rows.n) + earlier @ self.extra[:-1] + self.extra[-1]
        return 1.0 / (1.0 + np.exp(-np.clip(margin, -500, 500)))


def fit_linear(rows: Rows, earlier: np.ndarray, truth: np.ndarray, vocabulary: int, penalty: float = PENALTY) -> Linear:
    """Limited-memory quasi-Newton steps with a halving line search."""
    k = earlier.shape[1]
    share = [np.bincount(rows.word, t[rows.row], vocabulary) + SMOOTHING for t in (truth, 1 - truth)]
    ratio = np.abs(np.log(share[0] / (truth.sum() + 2 * SMOOTHING)) - np.log(share[1] / ((1 - truth).sum() + 2 * SMOOTHING)))
    full = np.hstack([earlier, np.ones((rows.n, 1))])
    scale = np.r_[np.full(vocabulary + k, penalty), 0.0]

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        margin = np.bincount(rows.row, (x[:vocabulary] * ratio)[rows.word], rows.n) + full @ x[vocabulary:]
        p = 1.0 / (1.0 + np.exp(-np.clip(margin, -500, 500)))
        value = np.logaddexp(0, margin).sum() - (truth * margin).sum() + 0.5 * (scale * x * x).sum()
        off = p - truth
        return value, np.r_[np.bincount(rows.word, off[rows.row], vocabulary) * ratio, full.T @ off] + scale * x

    x = np.zeros(vocabulary + k + 1)
    value, gradient = loss(x)
    steps: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(ITERATIONS):
        direction, saved = -gradient, []
        for s, y, r in reversed(steps):
            a = r * (s @ direction)
            saved.append(a)
            direction -= a * y
        if steps:
            s, y, r = steps[-1]
            direction *= 1.0 / (r * (y @ y))
        else:
            direction /= max(1.0, np.abs(gradient).max())
        for (s, y, r), a in zip(steps, reversed(saved)):
            direction += s * (a - r * (y @ direction))
        slope = gradient @ direction
        if slope > -1e-9 * max(1.0, abs(value)):
            break
        size = 1.0
        while True:
            moved, after = loss(x + size * direction)
            if moved <= value + 1e-4 * size * slope or size < 1e-8:
                break
            size /= 2
        s, y = size * direction, after - gradient
        if s @ y > 1e-12:
            steps = [*steps[-7:], (s, y, 1.0 / (s @ y))]
        x, gained, value, gradient = x + s, value - moved, moved, after
        if gained < 1e-7 * max(1.0, abs(value)):
            break
    return Linear(x[:vocabulary] * ratio, x[vocabulary:])


class Chain(NamedTuple):
    """The vocabulary, and for each category its model or the one probability that its labels allow."""

    vocabulary: dict[str, int]
    categories: list[str]
    models: list[Linear | float | None]

    def probabilities(self, rows: Rows) -> list[np.ndarray | None]:
        found, earlier = [], np.zeros((rows.n, 0))
        for model in self.models:
            if isinstance(model, Linear):
                found.append(model.probability(rows, earlier))
                earlier = np.column_stack([earlier, found[-1]])
            else:
                found.append(None if model is None else np.full(rows.n, model))
        return found


def labelled_rows(docs: DataFrame, labels: DataFrame, categories: list[str], most: int = MAX_LABELLED) -> DataFrame:
    """(doc_id, text, categories) of about `most` labelled rows at most, each id and text once.

    Ids are drawn first, then rows of them: an id that stands on many rows of different text takes part with a share
    of these, by a hash of id and text.
    """
    marks = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(*[F.max(c).cast("double").alias(c) for c in categories])
    total = marks.count()
    if total > most:
        marks = marks.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * most / total))
    known = docs.filter(F.col("doc_id").isNotNull()).select("doc_id", "text")
    rows = known.join(F.broadcast(marks), "doc_id")  # bounded by `most`
    found = rows.count()
    if found > most:
        draw = F.pmod(F.xxhash64(F.lit("row"), "doc_id", F.coalesce("text", F.lit(""))), F.lit(1_000_000))
        rows = rows.filter(draw < int(1_000_000 * most / found))
    return rows.dropDuplicates(["doc_id", "text"])


def _numbered(texts: list[str | None], vocabulary: dict[str, int]) -> Rows:
    found = [[vocabulary[w] for w in vocabulary.keys() & features_of(t)] for t in texts]
    sizes = list(map(len, found))
    return Rows(len(texts), np.repeat(np.arange(len(texts), dtype=np.int32), sizes), np.array([i for f in found for i in f], np.int32))


def fit_chain(docs: DataFrame, labels: DataFrame, categories: list[str], folds: int = FOLDS, most: int = MAX_LABELLED) -> Chain:
    spark = docs.sparkSession
    sample = stored(labelled_rows(docs, labels, categories, most))

    def spread(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_pydict({"words": pa.array([sorted(features_of(t)) for t in batch.column("text").to_pylist()], pa.list_(pa.string()))})

    counts = map_texts(sample.select("text"), spread, "words array<string>").select(F.explode("words").alias("word")).groupBy("word").count()
    known = counts.filter(F.col("count") >= LEAST_ROWS).select("word").toArrow().column("word").to_pylist()
    vocabulary = {w: i for i, w in enumerate(sorted(known))}
    shared = shared_value(spark, vocabulary)  # words of the bounded sample

    def number(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = _numbered(batch.column("text").to_pylist(), shared.value)
        ends = np.r_[0, np.cumsum(np.bincount(rows.row, minlength=rows.n))]
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(rows.word, pa.int32()))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), lists, *batch.columns[2:]], ["fold", "words", *categories]
        )

    fold = F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(folds)).cast("int").alias("fold")
    schema = "fold int, words array<int>, " + ", ".join(f"`{c}` double" for c in categories)
    ordered = sample.orderBy("doc_id", "text").select(fold, "text", *categories)
    got = map_texts(ordered, number, schema).toArrow()
    lists = got.column("words").combine_chunks()
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64) if len(lists) else np.zeros(0, np.int64)
    rows = Rows(len(sizes), np.repeat(np.arange(len(sizes), dtype=np.int32), sizes), lists.flatten().to_numpy())
    part = got.column("fold").to_numpy()

    models: list[Linear | float | None] = []
    earlier = np.zeros((rows.n, 0))
    for category in categories:
        truth = got.column(category).to_numpy().astype(float)  # NULL is NaN
        has = ~np.isnan(truth)
        values = set(truth[has])
        if len(values) < 2:
            models.append(values.pop() if values else None)
            continue

        def fitted(chosen: np.ndarray) -> Linear:
            return fit_linear(rows.take(chosen), earlier[chosen], truth[chosen], len(vocabulary))

        models.append(fitted(has))
        if category != categories[-1]:
            unseen = np.empty(rows.n)  # out-of-fold probabilities
            for k in range(folds):
                held, rest = part == k, has & (part != k)
                if len(set(truth[rest])) < 2:
                    unseen[held] = truth[rest][0] if rest.any() else 0.5
                else:
                    unseen[held] = fitted(rest).probability(rows.take(held), earlier[held])
            earlier = np.column_stack([earlier, unseen])
    return Chain(vocabulary, categories, models)


def score_chain(docs: DataFrame, chain: Chain, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of `docs`: doc_id, and for every category its probability p_<category> and whether it reaches the threshold."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = shared_value(docs.sparkSession, chain)
    names = [f"p_{c}" for c in chain.categories]

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = shared.value.probabilities(_numbered(batch.column("text").to_pylist(), shared.value.vocabulary))
        columns = [pa.nulls(batch.num_rows, pa.float64()) if p is None else pa.array(p) for p in found]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", *names])

    scored = map_texts(docs.select("doc_id", "text"), work, f"doc_id {kind}, " + ", ".join(f"`{n}` double" for n in names))
    return scored.withColumns({c: F.coalesce(F.col(f"p_{c}") >= threshold, F.lit(False)) for c in chain.categories})


def toxicity(docs: DataFrame, labels: DataFrame, categories: tuple[str, ...] = ("quality", "toxic")) -> DataFrame:
    return score_chain(docs, fit_chain(docs, labels, list(categories)))
