"""Mixing to target weights with soft membership.

A classifier fitted on the labelled table gives every document a posterior over domains.
Document rates, not negative, are fitted by projected steps so that the expected tokens of each
domain (rate x tokens x posterior, summed) meet the targets, in least squares where nothing meets
them.  A step needs one sum per domain and pair of domains over the documents; a document's rate
follows from its own posterior and one multiplier per domain, so nothing but those sums leaves the executors.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from .common import stored, texts
from .textmodel import (
    FEATURES,
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

TOLERANCE = 1e-6
STEPS = 60
NEAR = 1e-9  # weight of the distance between multipliers, which keeps the Newton steps finite


def label_domains(labels: DataFrame) -> DataFrame:
    """doc_id and domain: toxic, fine (of good quality) or poor."""
    return labels.select(
        "doc_id", F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "fine")
        .when(F.col("quality") == 0, "poor").alias("domain"),
    )


def posteriors(
    docs: DataFrame, domains: DataFrame, names: list[str], rows: int = SAMPLE_ROWS, features: int = FEATURES,
) -> DataFrame:
    """docs with ``tokens`` (words of the whole text) and ``p``, the posterior over ``names``.

    Fitted on at most ``rows`` labelled documents of these domains; without any, all
    domains are equally likely.
    """
    wanted = domains.where(F.col("domain").isin(names))
    sample = stored(labelled_sample(docs.select("doc_id", "text"), wanted, ["domain"], rows), "labelled")
    words = telling_words(sample, "domain", names, features)

    def fit(columns):
        target = np.array([[d == n for n in names] for d in columns["domain"]], float)
        rows_ = columns["numbers"]
        return fit_softmax(Rows(rows_, len(words) + 1, np.zeros((len(rows_), 0))), target)

    flat = on_sample(numbered(sample, words), fit)
    weights = flat.reshape(-1, len(names)) if len(flat) else np.zeros((len(words) + 1, len(names)))
    model = docs.sparkSession.sparkContext.broadcast((words, weights))  # bounded by the features
    others = [c for c in docs.columns if c != "text"]

    def score(batches):
        known, w = model.value
        look = Features(known)
        for batch in batches:
            found, sizes = [], []
            for text in (t.as_py() for t in batch.column("text")):  # one at a time
                found.append(softmax(w[look(text)].sum(axis=0)[None])[0])
                sizes.append(len(text.split()))
            yield pa.RecordBatch.from_arrays([
                *[batch.column(c) for c in others], pa.array(sizes, pa.int64()),
                pa.array(found, pa.list_(pa.float64())),
            ], names=[*others, "tokens", "p"])

    schema = docs.select(*others).schema.add("tokens", "long").add("p", ArrayType(DoubleType()))
    return docs.mapInArrow(score, schema)


def rate_at(step: np.ndarray, lowest: float) -> Column:
    """A document's rate: from 1 along its posterior, held at ``lowest``."""
    start = F.lit(max(1.0, lowest))
    return F.greatest(F.lit(float(lowest)), start - sum((F.col("p")[k] * float(x) for k, x in enumerate(step)), F.lit(0.0)))


def fit_rates(
    rows: DataFrame, weights: np.ndarray, lowest: float = 0.0, grow: bool = False,
    tolerance: float = TOLERANCE, most_steps: int = STEPS,
) -> tuple[Column, np.ndarray, np.ndarray]:
    """(rate column, expected tokens per domain, targets) for rows with ``tokens`` and ``p``.

    Of all rates that meet the targets these are nearest to 1 (least squares over tokens).  Targets share
    out the corpus' tokens; with ``grow`` the shares are met and the total is free.  A rate is 1 less the
    posterior times one multiplier a domain, held at the lowest rate.  The multipliers are found by Newton
    steps with a line search; a step's Gram matrix leaves out the documents held.  Where nothing meets the
    targets, the least-squares optimum comes back, to be told by ``reached``; raises if neither
    is found in ``most_steps`` passes.
    """
    k, start = len(weights), max(1.0, lowest)
    p, n = F.col("p"), F.col("tokens")
    upper = np.triu_indices(k)

    def look(step):
        """Tokens, expected tokens per domain, Gram matrix of the free documents, dual value: one pass."""
        rate, free = rate_at(step, lowest), start - sum((p[i] * float(step[i]) for i in range(k)), F.lit(0.0))
        row = rows.agg(
            F.sum(n), F.sum(n * ((rate - lowest) * (rate - lowest) / 2 + lowest * free)), *[F.sum(n * rate * p[i]) for i in range(k)],
            *[F.sum(F.when(free >= lowest, n * p[i] * p[j]).otherwise(0.0)) for i, j in zip(*upper, strict=True)],
        ).first()
        if not row[0]:
            return 0.0, 0.0, np.zeros(k), np.zeros((k, k))
        found, curve = np.array(row[1:], float) / row[0], np.zeros((k, k))
        curve[upper] = found[k + 1:]
        return float(row[0]), found[0], found[1:k + 1], curve + np.triu(curve, 1).T

    total, value, reached, curve = look(np.zeros(k))
    if not total:
        return rate_at(np.zeros(k), lowest), np.zeros(k), np.zeros(k)
    # with a free total the sums of (posterior - weight) have to vanish
    turn = np.eye(k) - np.outer(weights, np.ones(k)) if grow else np.eye(k)
    target = np.zeros(k) if grow else weights
    sizes, axes = np.linalg.eigh(turn @ curve @ turn.T)
    used = sizes > 1e-9 * np.trace(curve)
    base = turn.T @ (axes[:, used] / np.sqrt(sizes[used]))  # there the first Gram matrix is 1
    aim = (axes[:, used] / np.sqrt(sizes[used])).T @ target
    at = middle = np.zeros(used.sum())
    last, passes = np.inf, 1
    while True:
        gap = np.abs(turn @ reached - target).max() / (reached.sum() if grow else 1.0)
        if gap < tolerance:
            break
        slope = aim - base.T @ reached + NEAR * (at - middle)
        move = -np.linalg.solve(base.T @ curve @ base + NEAR * np.eye(len(at)), slope)
        whole = value + aim @ at + NEAR / 2 * ((at - middle) ** 2).sum()
        fall = -slope @ move
        if fall <= 1e-13 * (1 + abs(whole)):
            if gap > last / 2:
                break  # as near as rates from the lowest on come
            last, middle = gap, at
            continue
        size = 1.0
        while True:
            if passes >= most_steps:
                raise RuntimeError(f"rates not found in {most_steps} passes: {reached / reached.sum()}, not {weights}")
            new = at + size * move
            _, value, reached, curve = look(base @ new)
            passes += 1
            if value + aim @ new + NEAR / 2 * ((new - middle) ** 2).sum() <= whole - 1e-4 * size * fall + 1e-14 * abs(whole):
                break
            size /= 4
        at = new
    return rate_at(base @ at, lowest), reached * total, weights * total * (reached.sum() if grow else 1.0)


def mix(
    df: DataFrame, domains: DataFrame, weights: Mapping[str, float], id_col: str = "doc_id",
    text_col: str = "text", lowest: float = 0.0, grow: bool = False, **options,
) -> DataFrame:
    """One row per row of ``df``: doc_id, tokens, p_<domain> for each, rate, copies.

    ``copies`` rounds the rate up or down by a hash of the id, so that it has the rate as its mean.  A
    null or empty text has no tokens and no say; it gets the rate of its posterior.  Null
    and repeated ids stay as they are.
    """
    rows, rate, names = _fitted(texts(df, id_col, text_col), domains, weights, lowest, grow, options)
    return rows.select(
        "doc_id", "tokens", *[F.col("p")[k].alias(f"p_{n}") for k, n in enumerate(names)],
        rate.alias("rate"), copies(rate, F.col("doc_id")).alias("copies"),
    )


def _fitted(docs, domains, weights, lowest, grow, options):
    names = sorted(weights)
    share = np.array([weights[n] for n in names], float)
    rows = stored(posteriors(docs, domains, names, **options), "posteriors")
    rate, reached, target = fit_rates(rows, share / share.sum(), lowest, grow)
    if np.abs(reached - target).max() > TOLERANCE * max(1.0, target.sum()):
        shares = ", ".join(f"{n} {x:.6f}" for n, x in zip(names, reached / target.sum(), strict=True))
        warnings.warn(f"no rates from {lowest} on meet the targets; nearest shares of them: {shares}", stacklevel=3)
    return rows, rate, names


def copies(rate: Column, key: Column) -> Column:
    chance = F.pmod(F.xxhash64(key, F.lit("mixing")), F.lit(1 << 32)) / float(1 << 32)
    return F.floor(rate + chance).cast("long")


def repeat_documents(
    df: DataFrame, domains: DataFrame, weights: Mapping[str, float], id_col: str = "doc_id",
    text_col: str = "text", lowest: float = 1.0, grow: bool = True, **options,
) -> DataFrame:
    """The rows of ``df``, each as often as its copies, with their columns as they are.

    By default no row goes: rates are 1 or more and the corpus grows to meet the targets.
    """
    rows, rate, _ = _fitted(texts(df, id_col, text_col).withColumn(
        "text_key", F.xxhash64("text")
    ), domains, weights, lowest, grow, options)
    times = copies(rate, F.col("doc_id")).alias("times")
    counts = stored(rows.select("doc_id", "text_key", times).where("times <> 1").distinct(), "copies")
    body = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")).select(
        "row", F.col(f"row.`{id_col}`").cast("long").alias("id"),
        F.xxhash64(F.coalesce(F.col(f"row.`{text_col}`").cast("string"), F.lit(""))).alias("key"),
    )
    same = F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("key") == F.col("text_key"))
    found = body.join(counts, same, "left").withColumn("times", F.coalesce("times", F.lit(1).cast("long")))
    again = found.where("times > 0").select("row", F.explode(F.sequence(F.lit(1).cast("long"), "times")))
    return again.select(*[F.col(f"row.`{c}`").alias(c) for c in df.columns])
