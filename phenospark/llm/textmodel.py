"""Linear models over the words of whole texts, fitted on a bounded sample of labelled rows."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from .common import stored

SAMPLE_ROWS = 8_000
FEATURES = 1024
LEAST_ROWS = 5
PENALTY = 1e-3
FOLDS = 3
_WORD = re.compile(r"[^\W_]+")


def word_features(word: str) -> tuple[str, ...]:
    """A word, and its first four and five letters."""
    return word, f"4^{word[:4]}", f"5^{word[:5]}"


class Features:
    """Which of the known features the distinct words of a text have, by number from 1 on.

    Number 0 is in every text.  What a word gives is remembered for up to ``remember`` words of at
    most 32 characters, some 20 MB.
    """

    def __init__(self, names: Sequence[str], remember: int = 80_000) -> None:
        self.numbers = {n: k for k, n in enumerate(names, 1)}
        self.known: dict[str, tuple[int, ...]] = {}
        self.remember = remember

    def __call__(self, text: str) -> list[int]:
        if len(self.known) > self.remember:
            self.known = {}
        found, known = {0}, self.known
        for word in set(_WORD.findall(text.lower())):
            numbers = known.get(word)
            if numbers is None:
                numbers = tuple(self.numbers[f] for f in word_features(word) if f in self.numbers)
                if len(word) <= 32:
                    known[word] = numbers
            if numbers:
                found.update(numbers)
        return sorted(found)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, columns: Sequence[str], rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """doc_id, text, the label columns and a fold number that exact copies share, for at most
    ``rows`` labelled documents, by hash of the id.

    Label rows with a null in the id or in ``columns`` are left out; of several for one id
    the smallest counts, and of several texts under one id the least.  The sample of ids and labels is bounded, so it is broadcast.
    """
    known = labels.dropna(subset=["doc_id", *columns]).groupBy(
        F.col("doc_id").cast("long").alias("labelled_id")
    ).agg(F.min(F.struct(*columns)).alias("label"))
    chosen = known.orderBy(F.xxhash64("labelled_id"), "labelled_id").limit(rows)
    found = docs.join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled_id"))
    one = found.groupBy("doc_id").agg(F.min("text").alias("text"), F.min("label").alias("label"))
    return one.select(
        "doc_id", "text", *[F.col(f"label.{c}").alias(c) for c in columns],
        F.pmod(F.xxhash64("text"), F.lit(FOLDS)).cast("int").alias("fold"),
    )


def telling_words(sample: DataFrame, label: str, classes: Sequence, features: int = FEATURES) -> list[str]:
    """Up to ``features`` features per class, by the chi-square of feature and class; each in
    at least ``LEAST_ROWS`` rows.  Counts are reduced in the tasks before they meet."""
    k, places = len(classes), {c: i for i, c in enumerate(classes)}

    def count(batches):
        seen: list[Counter] = [Counter() for _ in range(k)]
        for batch in batches:
            for text, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = set(_WORD.findall(text.lower()))
                seen[places[value]].update({f for w in words for f in word_features(w)})
        names = list({f for c in seen for f in c})
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), *[pa.array([c[f] for f in names], pa.int64()) for c in seen]],
            names=["feature", *[f"n{i}" for i in range(k)]],
        )

    schema = "feature string, " + ", ".join(f"n{i} long" for i in range(k))
    rows = sample.groupBy(label).count().collect()  # a row per class
    size = {r[label]: r["count"] for r in rows}
    total = sum(size.values())
    counts = sample.select("text", label).mapInArrow(count, schema).groupBy("feature").agg(
        *[F.sum(f"n{i}").alias(f"n{i}") for i in range(k)]
    )
    n = sum((F.col(f"n{i}") for i in range(k)), F.lit(0))
    counts = stored(counts.withColumn("n", n).where(F.col("n") >= LEAST_ROWS), "features")
    found: set[str] = set()
    for i, value in enumerate(classes):
        share = size.get(value, 0) / max(1, total)
        gap = F.col(f"n{i}") - F.col("n") * share
        chi = F.try_divide(gap * gap, F.col("n") * (share * (1 - share)) * (1 - F.col("n") / max(1, total)))
        top = counts.orderBy(F.desc_nulls_last(chi), "feature").limit(features)
        found.update(r["feature"] for r in top.select("feature").collect())
    return sorted(found)


class Rows:
    """Sparse 0/1 rows, some dense columns after them, and what a softmax regression needs of both."""

    def __init__(self, numbers: list[list[int]], width: int, dense: np.ndarray) -> None:
        sizes = np.array([len(r) for r in numbers], "i8")
        self.index = np.concatenate([np.array(r, "i8") for r in numbers])
        self.sizes, self.starts = sizes, np.cumsum(sizes) - sizes
        self.width, self.dense = width, dense

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.add.reduceat(w[self.index], self.starts) + self.dense @ w[self.width:]

    def turned(self, r: np.ndarray) -> np.ndarray:
        sparse = [np.bincount(self.index, np.repeat(c, self.sizes), self.width) for c in r.T]
        return np.vstack([np.stack(sparse, axis=1), self.dense.T @ r])

    def spread(self) -> np.ndarray:
        """Variance of each column: rare features are penalised less."""
        share = np.bincount(self.index, minlength=self.width) / len(self.sizes)
        return np.concatenate([share * (1 - share), self.dense.var(axis=0)])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit_softmax(rows: Rows, target: np.ndarray, penalty: float = PENALTY, steps: int = 40) -> np.ndarray:
    """Weights (columns x classes) of an L2-penalised regression, by limited-memory BFGS."""
    n = len(target)
    weight = penalty * rows.spread()[:, None]  # the constant column has no variance

    def value(w):
        p = softmax(rows.times(w))
        loss = -np.log(np.maximum((p * target).sum(axis=1), 1e-12)).mean()
        return loss + 0.5 * (weight * w * w).sum(), rows.turned((p - target) / n) + weight * w

    w = np.zeros((rows.width + rows.dense.shape[1], target.shape[1]))
    loss, grad = value(w)
    past: list[tuple] = []
    for _ in range(steps):
        q, saved = grad.copy(), []
        for s, y, rho in reversed(past):
            a = rho * (s * q).sum()
            q -= a * y
            saved.append(a)
        if past:
            s, y, _ = past[-1]
            q *= (s * y).sum() / (y * y).sum()
        for (s, y, rho), a in zip(past, reversed(saved), strict=True):
            q += (a - rho * (y * q).sum()) * s
        slope, size = (q * grad).sum(), 1.0
        for _ in range(20):
            new = w - size * q
            new_loss, new_grad = value(new)
            if new_loss <= loss - 1e-4 * size * slope:
                break
            size /= 2
        else:
            break
        s, y = new - w, new_grad - grad
        if (s * y).sum() > 1e-12:
            past = [*past[-9:], (s, y, 1 / (s * y).sum())]
        done = loss - new_loss < 1e-4 * max(loss, 1e-3)
        w, loss, grad = new, new_loss, new_grad
        if done:
            break
    return w


def numbered(sample: DataFrame, names: Sequence[str]) -> DataFrame:
    """``sample`` with the numbers of its features instead of the text: at most one a known feature."""
    others = [c for c in sample.columns if c != "text"]

    def run(batches):
        look = Features(names)
        for batch in batches:
            found = [look(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in others], pa.array(found, pa.list_(pa.int32()))], names=[*others, "numbers"]
            )

    schema = sample.select(*others).schema.add("numbers", ArrayType(IntegerType()))
    return sample.mapInArrow(run, schema)


def on_sample(sample: DataFrame, work: Callable[[dict], np.ndarray]) -> np.ndarray:
    """Run ``work`` on the columns of the bounded sample in one task; the numbers it returns."""

    def run(table: pa.Table) -> pa.Table:
        result = np.asarray(work(table.to_pydict()), float).ravel()
        return pa.table({"values": pa.array([result], pa.list_(pa.float64()))})

    found = sample.groupBy(F.lit(0).alias("all")).applyInArrow(run, "values array<double>").collect()
    return np.array(found[0]["values"]) if found else np.zeros(0)
