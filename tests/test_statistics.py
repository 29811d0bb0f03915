"""Exact medians and per-fold moments against plain loops; the nested search against its parts."""

import math
import random
import statistics as plain

import numpy as np
import pytest

from phenospark.operators import search, statistics, train


@pytest.fixture(scope="module")
def table(spark):
    rnd = random.Random(3)
    rows = []
    for k in range(400):
        rows.append((
            k % 4, rnd.gauss(0, 1) if k % 7 else None, rnd.choice([1.0, 1.0, 2.0]), rnd.choice([-1e300, 1e300, 5e-324, 0.0]),
            float(k) if k % 4 == 2 else None, math.nan if k % 3 else rnd.random() * 1e-9 + 1.0, None,
        ))
    return rows, spark.createDataFrame(rows, "part int, a double, b double, c double, d double, e double, f double")


@pytest.mark.parametrize("bins", [2, 256])
def test_statistics_equal_loops(table, bins):
    rows, df = table
    long = statistics.long_values(df, list("abcdef"), "part")
    medians = statistics.exact_medians(long, range(4), bins)
    got = {(r["feature"], r["without"]): r for r in statistics.fold_moments(long).collect()}
    want = 0
    for j, name in enumerate("abcdef", 1):
        for without in (None, 0, 1, 2, 3):
            some = [r[j] for r in rows if r[0] != without and r[j] is not None and not math.isnan(r[j])]
            if not some:
                assert (name, without) not in medians and (name, without) not in got
                continue
            want += 1
            ordered = sorted(some)
            middle = ordered[(len(some) - 1) // 2], ordered[len(some) // 2]
            assert medians[name, without] == (middle[0] + middle[1]) / 2
            if name != "c":
                r = got[name, without]
                assert r["n"] == len(some) and r["mean"] == pytest.approx(plain.fmean(some), rel=1e-9)
                assert r["deviation"] == pytest.approx(plain.stdev(some), rel=1e-6, abs=1e-9)
    assert len(medians) == want == len(got)


def test_a_value_is_stored_and_counted_once(spark):
    rows = [(k % 3 if k % 10 else None, float(k % 17)) for k in range(120)]
    df = spark.createDataFrame([(p, v, v) for p, v in rows], "part int, a double, b double")
    long = statistics.long_values(df, ["a", "b"], "part")
    assert long.count() == 120  # however many columns
    counts = statistics._counts(long, [("a", 0.0, 16.0)], 256).collect()
    assert sum(r["n"] for r in counts) == 120  # not once for every fold left out
    assert {r["fold"] for r in counts} == {None, 0, 1, 2}
    got = {r["without"]: (r["n"], r["median"]) for r in statistics.column_statistics(df, ["a"], "part").collect()}
    for without in (None, 0, 1, 2):
        some = [v for p, v in rows if without is None or p != without]
        assert got[without] == (len(some), plain.median(some))


def test_area_equals_counting_pairs():
    rng = np.random.default_rng(1)
    y, s = rng.integers(0, 2, 60), rng.integers(0, 9, 60) / 9
    pairs = [(a > b) + (a == b) / 2 for a in s[y == 1] for b in s[y == 0]]
    assert search.ranking_area(y, s) == pytest.approx(np.mean(pairs))
    assert search.ranking_area(np.ones(3), s[:3]) is None


def made_up(spark, n=240):
    rnd = random.Random(5)
    rows = []
    for k in range(n):
        x = [rnd.random() for _ in range(3)]
        rows.append((k % 3, float(x[0] + 0.3 * x[1] > 0.6), x[0], x[1] if k % 5 else None, x[2]))
    return spark.createDataFrame(rows, "fold int, label double, x double, y double, z double")


@pytest.mark.parametrize("kind, task", [("randomforest", "classification"), ("randomforest", "regression"), ("xgboost", "classification")])
def test_shorter_ensembles_come_from_the_longest(spark, kind, task):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    count = "numTrees" if kind == "randomforest" else "maxIter"
    ready = VectorAssembler(inputCols=["x", "z"], outputCol="scaled").transform(made_up(spark))
    model = train._ESTIMATORS[kind, task](featuresCol="scaled", labelCol="label", seed=1, maxDepth=4, **{count: 6}).fit(ready)
    classes = task == "classification" and kind == "randomforest"
    tables = search.leaf_values(spark, model, classes, [0, 2, 4])
    weights = [1.0] * 6 if kind == "randomforest" else list(model.treeWeights)
    got = search.held_out_scores(ready, model, tables, weights, [3, 6], 3).collect()
    assert len(got[0]["scores"]) == 6 and len({r["scores"][0] for r in got}) == 1  # depth 0: the same for all
    scored = model.transform(ready)
    if classes:
        want = [r[0] for r in scored.select(vector_to_array("probability")[1]).collect()]
        assert np.allclose([r["scores"][5] for r in got], want)
    elif kind == "randomforest":
        assert np.allclose([r["scores"][5] for r in got], [r[0] for r in scored.select("prediction").collect()])
    else:
        want = [r[0] for r in scored.select(vector_to_array("rawPrediction")[1]).collect()]
        assert np.allclose([6 * r["scores"][5] for r in got], want)  # scores are means until the rounds are summed


def test_search_reports_every_setting(spark):
    grid = {"numTrees": [2, 5], "maxDepth": [1, 3], "minInstancesPerNode": [1, 20]}
    found = search.nested_search(
        made_up(spark), ["x", "y", "z"], "randomforest", True, grid, 3,
        lambda **p: train._ESTIMATORS["randomforest", "classification"](featuresCol="scaled", labelCol="label", seed=1, **p),
    ).collect()
    assert len(found) == 8 == len({tuple(r)[:3] for r in found})
    assert all(r["folds"] == 3 and 0.5 < r["score"] <= 1 for r in found)
    best = max(found, key=lambda r: r["score"])
    assert best["maxDepth"] == 3
