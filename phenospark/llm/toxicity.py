"""Toxicity by a classifier chain.

Categories are predicted in order.  Each linear model sees the words of a text and the
probabilities of the categories before it; it is trained with out-of-fold probabilities of
those, so it learns from what it will get.  The threshold of each category comes from the
same out-of-fold predictions.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from .common import stored, texts
from .textmodel import (
    FEATURES,
    FOLDS,
    SAMPLE_ROWS,
    Features,
    Rows,
    fit_softmax,
    labelled_sample,
    numbered,
    on_sample,
    softmax,
    telling_words,
)

CATEGORIES = ("low_quality", "toxic")


@dataclass
class Chain:
    categories: tuple[str, ...]
    words: list[str]
    weights: list[np.ndarray]  # per category: constant and words, then earlier probabilities
    thresholds: list[float]

    def probabilities(self, numbers: list[int]) -> list[float]:
        found: list[float] = []
        for w in self.weights:
            z = w[numbers].sum(axis=0) + np.array(found) @ w[len(self.words) + 1:]
            found.append(1 / (1 + float(np.exp(np.clip(z[0] - z[1], -500, 500)))))
        return found


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The probability from which on F1 is best; above 1 without a positive row."""
    if not y.any():
        return 1.01
    order = np.argsort(-p, kind="stable")
    hits, taken = np.cumsum(y[order]), np.arange(1, len(y) + 1)
    last = np.append(p[order][1:] != p[order][:-1], True)  # equal probabilities go together
    f1 = np.where(last, 2 * hits / (taken + y.sum()), 0)
    k = int(f1.argmax())
    below = p[order][k + 1] if k + 1 < len(p) else 0.0
    return float((p[order][k] + below) / 2)


def fit_columns(columns: dict, words: Sequence[str], categories: Sequence[str], folds: int = FOLDS) -> np.ndarray:
    """Weights and threshold of each category, flattened, from the columns of the sample."""
    numbers = columns["numbers"]
    fold = np.array(columns["fold"]) % folds
    width, out = len(words) + 1, []
    earlier = np.zeros((len(numbers), 0))
    for name in categories:
        y = np.array(columns[name], float)
        target = np.stack([1 - y, y], axis=1)

        def part(mask, earlier=earlier):
            return Rows([numbers[i] for i in np.flatnonzero(mask)], width, earlier[mask])

        unseen = np.full(len(y), y.mean())
        for f in range(folds):
            held = fold == f
            if held.any() and not held.all():
                w = fit_softmax(part(~held), target[~held])
                unseen[held] = softmax(part(held).times(w))[:, 1]
        final = fit_softmax(part(np.ones(len(y), bool)), target)
        out += [final.ravel(), [best_threshold(unseen, y)]]
        earlier = np.hstack([earlier, unseen[:, None]])
    return np.concatenate(out)


def fit_chain(
    docs: DataFrame, labels: DataFrame, categories: Sequence[str] = CATEGORIES,
    rows: int = SAMPLE_ROWS, features: int = FEATURES,
) -> Chain:
    """Fit on at most ``rows`` labelled documents, in one task.  ``labels`` has doc_id and a
    0/1 column per category.  Without labelled rows all probabilities are one half and nothing is
    rejected."""
    categories = tuple(categories)
    sample = stored(labelled_sample(docs, labels, categories, rows), "labelled")
    words = sorted({w for c in categories for w in telling_words(sample, c, (0, 1), features)})
    flat = on_sample(numbered(sample, words), lambda columns: fit_columns(columns, words, categories))
    chain = Chain(categories, words, [], [])
    for k in range(len(categories)):
        size = 2 * (len(words) + 1 + k)
        if len(flat):
            chain.weights.append(flat[:size].reshape(-1, 2))
            chain.thresholds.append(float(flat[size]))
            flat = flat[size + 1:]
        else:
            chain.weights.append(np.zeros((size // 2, 2)))
            chain.thresholds.append(1.01)
    # words have to speak for a category: a text without any is never in one
    silent = chain.probabilities([0])
    chain.thresholds = [max(t, float(np.nextafter(p, 2))) for t, p in zip(chain.thresholds, silent, strict=True)]
    return chain


def quality_labels(labels: DataFrame) -> DataFrame:
    """The labels table as categories of the chain."""
    return labels.select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")


def probabilities(text: Column, chain: Chain) -> Column:
    """An array of the probabilities of the chain's categories.  Only texts leave the JVM."""
    shared = SparkSession.active().sparkContext.broadcast(chain)  # bounded by the features

    @F.arrow_udf(ArrayType(DoubleType()))
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = shared.value
        look = Features(known.words)
        for column in batches:
            found = [known.probabilities(look(t.as_py())) for t in column]
            yield pa.array(found, pa.list_(pa.float64()))

    # else the optimiser copies the function to each place that reads its result
    return score.asNondeterministic()(F.coalesce(text.cast("string"), F.lit("")))


def score_documents(
    df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    categories: Sequence[str] = CATEGORIES, rejects: str = "toxic", **options,
) -> DataFrame:
    """One row per row of ``df``: doc_id, p_<category> for each, and ``toxic``, whether the
    category ``rejects`` reaches its threshold.

    Whole texts are scored; a null or empty text has no words, gets the models' constant and
    is not rejected.  Null and repeated ids stay as they are.
    """
    docs = texts(df, id_col, text_col)
    chain = fit_chain(docs, labels, categories, **options)
    limit = chain.thresholds[chain.categories.index(rejects)]
    scored = docs.select("doc_id", probabilities(F.col("text"), chain).alias("p"))
    return scored.select(
        "doc_id", *[F.col("p")[k].alias(f"p_{c}") for k, c in enumerate(chain.categories)]
    ).withColumn("toxic", F.col(f"p_{rejects}") >= limit)


def drop_toxic(
    df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    categories: Sequence[str] = CATEGORIES, rejects: str = "toxic", **options,
) -> DataFrame:
    """The rows of ``df``, with their columns as they are, that are not rejected."""
    chain = fit_chain(texts(df, id_col, text_col), labels, categories, **options)
    place = chain.categories.index(rejects)
    row = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))
    scored = row.withColumn("p", probabilities(F.col(f"row.`{text_col}`"), chain))
    return scored.where(F.col("p")[place] < chain.thresholds[place]).select(
        *[F.col(f"row.`{c}`").alias(c) for c in df.columns]
    )
