"""Grid search over tree ensembles from nested fits.

The first trees of a forest are a forest, the first rounds of boosting are a shorter boosting, and a
tree cut at a depth is the tree that would have been grown to it.  So one forest of the most trees
and the greatest depth per remaining setting and fold answers for all numbers of trees and depths, and
one boosting of the most rounds for all numbers of rounds.  The fitted model names the leaf of
each held-out row in each tree; a table of the leaves' values at each depth does the rest.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import shared_folder, stored
from .statistics import exact_medians, long_values

SEARCH_ROWS = 2_000


def settings_of(model_type: str, grid: dict[str, list]) -> tuple[list[dict], list[dict]]:
    """(what is fitted, what each fit answers for)."""
    nested = ("numTrees", "maxDepth") if model_type == "randomforest" else ("maxIter",)
    nested = [n for n in nested if n in grid]
    rest = [n for n in grid if n not in nested]
    fits = [dict(zip(rest, v, strict=True)) for v in product(*(grid[n] for n in rest))]
    inner = [dict(zip(nested, v, strict=True)) for v in product(*(grid[n] for n in nested))]
    return fits, inner


def leaf_values(spark: SparkSession, model, classification: bool, depths: Sequence[int]) -> list[np.ndarray]:
    """Per tree an array (leaf, depth): what the tree says of the leaf's rows when cut at each depth.

    Read from the nodes that the model writes, parents before children; leaves are numbered from left to
    right, as the model numbers them.  The nodes are bounded by the rows it was fitted on.
    """
    path = shared_folder(spark, "trees")
    model.write().save(path)
    value = F.col("nodeData.impurityStats")[1] / F.aggregate(
        "nodeData.impurityStats", F.lit(0.0), lambda s, x: s + x
    ) if classification else F.col("nodeData.prediction")
    nodes = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), "nodeData.id", "nodeData.leftChild", "nodeData.rightChild", value.alias("value")
    ).toPandas().sort_values(["tree", "id"])
    out = []
    for _, one in nodes.groupby("tree", sort=True):
        left, right, own = (one[c].to_numpy() for c in ("leftChild", "rightChild", "value"))
        said, here, level = np.zeros((len(own), len(depths))), np.zeros(1, int), 0
        said[0] = own[0]
        while len(here := here[left[here] >= 0]):
            level += 1
            deep = np.array(depths) >= level
            for child in (left[here], right[here]):
                said[child] = np.where(deep, own[child][:, None], said[here])
            here = np.concatenate([left[here], right[here]])
        out.append(said[left < 0])
    return out


def held_out_scores(held: DataFrame, model, tables: list[np.ndarray], weights, counts, depth_count: int) -> DataFrame:
    """label and ``scores``: for each number of trees, and in it each depth, the score of a row."""
    model = model.copy().setLeafCol("leaf")
    shared = held.sparkSession.sparkContext.broadcast((tables, list(weights)))  # bounded by the fitted rows
    leaves = model.transform(held).select("label", vector_to_array("leaf").alias("leaf"))
    width = len(counts) * depth_count

    def run(batches):
        tables, weights = shared.value
        for batch in batches:
            n = batch.num_rows
            leaf = batch.column("leaf").flatten().to_numpy().reshape(n, len(tables)).astype(int)
            sums, scores = np.zeros((n, depth_count)), np.zeros((n, len(counts), depth_count))
            for k, (table, weight) in enumerate(zip(tables, weights, strict=True), 1):
                sums += weight * table[leaf[:, k - 1]]
                for c in (c for c, count in enumerate(counts) if count == k):
                    scores[:, c] = sums / k
            flat = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()), pa.array(scores.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("label"), flat], names=["label", "scores"])

    return leaves.mapInArrow(run, "label double, scores array<double>")


def ranking_area(y: np.ndarray, score: np.ndarray) -> float | None:
    """Area under the ROC curve; None without both classes.  Equal scores count half."""
    good = int(y.sum())
    if not 0 < good < len(y):
        return None
    _, place, times = np.unique(score, return_inverse=True, return_counts=True)
    rank = (np.cumsum(times) - (times - 1) / 2)[place]
    return float((rank[y == 1].sum() - good * (good + 1) / 2) / (good * (len(y) - good)))


def nested_search(
    table: DataFrame, features: Sequence[str], model_type: str, classification: bool, grid: dict[str, list],
    folds: int, estimator, rows: int = SEARCH_ROWS, parallelism: int = 4,
) -> DataFrame:
    """One row per setting of ``grid``: its parameters, score (mean over folds) and folds.

    ``table`` has label, fold and the features; at most ``rows`` of its rows are used, by hash.  A missing
    value takes the exact median of the fold's training rows; all medians come from one selection.
    Scaling changes no tree, so there is none.  The score is the ROC area, or for regression the mean
    absolute error.  ``estimator`` makes an ensemble from parameters.  Cutting a deeper tree differs from
    growing a shorter one only where Spark merges sibling leaves of one class.
    """
    spark = table.sparkSession
    chosen = stored(
        table.select("label", "fold", *features).orderBy(F.xxhash64("label", *features)).limit(rows), "search"
    )
    medians = exact_medians(long_values(chosen, features, "fold"), range(folds))
    fits, inner = settings_of(model_type, grid)
    count_name = "numTrees" if model_type == "randomforest" else "maxIter"
    counts = sorted({i[count_name] for i in inner}) if count_name in grid else [None]
    depths = sorted({i["maxDepth"] for i in inner}) if inner and "maxDepth" in inner[0] else [30]
    assembler = VectorAssembler(inputCols=list(features), outputCol="scaled", handleInvalid="keep")

    def run(job):
        number, fold = job
        params = dict(fits[number])
        if counts[-1] is not None:
            params[count_name] = counts[-1]
        if "maxDepth" in grid and "maxDepth" not in params:
            params["maxDepth"] = depths[-1]
        filled = assembler.transform(chosen.fillna({f: medians.get((f, fold), 0.0) for f in features}))
        model = estimator(**params).fit(filled.where(F.col("fold") != fold))
        forest = model_type == "randomforest"
        tables = leaf_values(spark, model, classification and forest, depths)
        weights = [1.0] * len(tables) if forest else list(model.treeWeights)
        done = [len(tables) if c is None else c for c in counts]
        scored = held_out_scores(filled.where(F.col("fold") == fold), model, tables, weights, done, len(depths))
        if not forest:  # boosting adds up
            scored = scored.withColumn("scores", F.transform("scores", lambda x, i: x * F.element_at(
                F.array(*[F.lit(float(c)) for c in done for _ in depths]), i + 1)))
        return stored(scored.withColumn("fit", F.lit(number)).withColumn("fold", F.lit(fold)), "held-out")

    jobs = [(n, f) for n in range(len(fits)) for f in range(folds)]
    with ThreadPoolExecutor(parallelism) as pool:
        parts = list(pool.map(lambda job: inheritable_thread_target(spark)(run)(job), jobs))
    held = parts[0]
    for part in parts[1:]:
        held = held.unionByName(part)

    def judge(found: pa.Table) -> pa.Table:
        y = found.column("label").to_numpy()
        scores = np.array(found.column("scores").to_pylist(), float).reshape(len(y), -1)
        one = [ranking_area(y, c) if classification else float(np.abs(c - y).mean()) for c in scores.T]
        n = len(one)
        return pa.table({
            "fit": pa.array([found.column("fit")[0].as_py()] * n, pa.int32()), "place": pa.array(range(n), pa.int32()),
            "score": pa.array(one, pa.float64()),
        })

    judged = held.groupBy("fit", "fold").applyInArrow(judge, "fit int, place int, score double")
    mean = {(r["fit"], r["place"]): (r["score"], r["folds"]) for r in judged.groupBy("fit", "place").agg(
        F.avg("score").alias("score"), F.count("score").alias("folds")).collect()}
    out = []
    for n, params in enumerate(fits):
        for c, count in enumerate(counts):
            for d, depth in enumerate(depths):
                own = {**params, count_name: count, "maxDepth": params.get("maxDepth", depth)}
                out.append((*[float(own[g]) for g in grid], *mean.get((n, c * len(depths) + d), (None, 0))))
    schema = ", ".join(f"{g} double" for g in grid) + ", score double, folds long"
    return spark.createDataFrame(out, schema)
