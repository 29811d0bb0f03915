"""Exact statistics of many columns at once, of all rows and of all rows but a fold."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import stored

BINS = 256
NO_FOLD = -(2 ** 40)  # stands for a null fold, outside the range of an int


def long_values(df: DataFrame, columns: Sequence[str], fold: str | None = None) -> DataFrame:
    """One stored row per row: fold, and a double per column; NaN counts as missing too."""
    where = F.col(fold) if fold else F.lit(None)
    cells = [F.col(c).cast("double").alias(f"v_{c}") for c in columns]
    return stored(df.select(where.cast("int").alias("fold"), *cells), "values")


def _folds_and_values(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]:
    """The folds of a batch, each row's place among them, and the values, a missing one as NaN."""
    fold = batch.column("fold").cast(pa.int64()).fill_null(NO_FOLD).to_numpy()
    names = [n for n in batch.schema.names if n != "fold"]
    return *np.unique(fold, return_inverse=True), {
        n.removeprefix("v_"): batch.column(n).to_numpy(zero_copy_only=False) for n in names
    }


def value_parts(long: DataFrame) -> DataFrame:
    """feature, fold, n, mean, squares (from the mean), low, high: a stored row per feature and fold.

    One pass; a task gives a row per feature and fold.
    """

    def run(batches):
        held: dict[tuple[str, int], tuple] = {}
        for batch in batches:
            folds, code, columns = _folds_and_values(batch)
            for name, v in columns.items():
                ok = ~np.isnan(v)
                at, v, k = code[ok], v[ok], len(folds)
                with np.errstate(all="ignore"):
                    n = np.bincount(at, minlength=k)
                    mean = np.bincount(at, v, k) / n
                    squares = np.bincount(at, (v - mean[at]) ** 2, k)
                    low, high = np.full(k, np.inf), np.full(k, -np.inf)
                    np.minimum.at(low, at, v)
                    np.maximum.at(high, at, v)
                    for j in np.flatnonzero(n):
                        key, new = (name, int(folds[j])), (int(n[j]), mean[j], squares[j], low[j], high[j])
                        if key in held:
                            m, old, s, lo, hi = held[key]
                            both, gap = m + new[0], new[1] - old
                            new = (both, old + gap * new[0] / both, s + new[2] + gap * gap * m * new[0] / both,
                                   min(lo, new[3]), max(hi, new[4]))
                        held[key] = new
        rows = [(f, None if w == NO_FOLD else w, n, *map(float, rest)) for (f, w), (n, *rest) in held.items()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 7, kinds, strict=True)], names=names)

    names = ["feature", "fold", "n", "mean", "squares", "low", "high"]
    kinds = [pa.string(), pa.int32(), pa.int64(), *[pa.float64()] * 4]
    found = long.mapInArrow(run, "feature string, fold int, n long, mean double, squares double, low double, high double")
    whole = found.groupBy("feature", "fold").agg(
        F.sum("n").alias("n"), (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("mean"),
        F.collect_list(F.struct("n", "mean", "squares")).alias("tasks"), F.min("low").alias("low"), F.max("high").alias("high"),
    )
    squares = F.aggregate("tasks", F.lit(0.0), lambda s, x: s + x["squares"] + x["n"] * (
        x["mean"] - F.col("mean")) * (x["mean"] - F.col("mean")))
    return stored(whole.select("feature", "fold", "n", "mean", squares.alias("squares"), "low", "high"), "moments")


def fold_moments(long: DataFrame, parts: DataFrame | None = None) -> DataFrame:
    """feature, without, n, mean, deviation: of all rows (``without`` null) and of the rows outside
    each fold.  One pass reduces per fold; a training set is the total less its fold."""
    part = (value_parts(long) if parts is None else parts).withColumn("spread", F.col("squares") / F.col("n"))
    total = part.groupBy("feature").agg(
        F.sum("n").alias("all_n"), (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("all_mean"),
        F.collect_list(F.struct("n", "mean", "spread")).alias("parts"),  # one a fold
    ).select("feature", "all_n", "all_mean", F.aggregate("parts", F.lit(0.0), lambda s, x: s + x["n"] * (
        x["spread"] + (x["mean"] - F.col("all_mean")) * (x["mean"] - F.col("all_mean"))
    )).alias("all_squares"))
    whole = total.select(
        "feature", F.lit(None).cast("int").alias("without"), F.col("all_n").alias("n"),
        F.col("all_mean").alias("mean"), F.col("all_squares").alias("squares"),
    )
    folds = part.where(F.col("fold").isNotNull()).select("fold").distinct()
    own = part.select(
        "feature", "fold", F.col("n").alias("own_n"), F.col("mean").alias("own_mean"), (F.col("n") * F.col("spread")).alias("own_squares")
    )
    # a row a fold and feature; a fold in which a feature has no value takes nothing away
    rest = total.join(F.broadcast(folds), F.lit(True)).join(own, ["feature", "fold"], "left").fillna(
        0, ["own_n", "own_squares"]
    ).withColumn("n", F.col("all_n") - F.col("own_n")).where("n > 0").withColumn(
        "mean", (F.col("all_n") * F.col("all_mean") - F.coalesce(F.col("own_n") * F.col("own_mean"), F.lit(0.0))) / F.col("n")
    )
    gap = F.coalesce(F.col("own_mean") - F.col("mean"), F.lit(0.0))
    rest = rest.select(
        "feature", F.col("fold").alias("without"), "n", "mean",
        (F.col("all_squares") - F.col("own_squares") - gap * gap * F.col("own_n") * F.col("n") / F.col("all_n")).alias("squares"),
    )
    deviation = F.sqrt(F.greatest(F.lit(0.0), F.col("squares")) / (F.col("n") - 1))
    return whole.unionByName(rest).select(
        "feature", "without", "n", "mean", F.when(F.col("n") > 1, deviation).alias("deviation")
    )


def _counts(long: DataFrame, ranges: Sequence[tuple[str, float, float]], bins: int) -> DataFrame:
    """range, fold, bin, n, least, most: the values of each (feature, low, high), both ends included, in
    ``bins`` equal ranges.  Both ends fall into ranges of their own.  Counted in the tasks before they meet."""

    def run(batches):
        held: dict[tuple[int, int], list] = {}
        for batch in batches:
            folds, code, columns = _folds_and_values(batch)
            for number, (name, low, high) in enumerate(ranges):
                v = columns[name]
                inside = (v >= low) & (v <= high)
                at, v, size = code[inside], v[inside], len(folds) * bins
                with np.errstate(all="ignore"):  # halves do not overflow
                    share = np.nan_to_num((v / 2 - low / 2) / (high / 2 - low / 2), nan=0.0)
                place = np.minimum(bins - 1, np.floor(np.clip(share, 0, 1) * bins)).astype("i8")
                cell = at * bins + np.where(v >= high, bins - 1, np.where(v <= low, 0, place))
                n, least, most = np.bincount(cell, minlength=size), np.full(size, np.inf), np.full(size, -np.inf)
                np.minimum.at(least, cell, v)
                np.maximum.at(most, cell, v)
                for j, fold in enumerate(folds.tolist()):
                    new = [x[j * bins:(j + 1) * bins] for x in (n, least, most)]
                    old = held.get((number, fold))
                    held[number, fold] = new if old is None else [
                        old[0] + new[0], np.minimum(old[1], new[1]), np.maximum(old[2], new[2])]
        if not held:
            return
        used = [np.flatnonzero(n) for n, _, _ in held.values()]
        sizes = [len(u) for u in used]
        fold = np.repeat([f for _, f in held], sizes)
        n, least, most = (np.concatenate([c[k][u] for c, u in zip(held.values(), used, strict=True)]) for k in range(3))
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat([k for k, _ in held], sizes).astype("i4")),
            pa.array(fold, pa.int64(), mask=fold == NO_FOLD).cast(pa.int32()),
            pa.array(np.concatenate(used).astype("i4")), pa.array(n), pa.array(least), pa.array(most),
        ], names=["range", "fold", "bin", "n", "least", "most"])

    found = long.mapInArrow(run, "range int, fold int, bin int, n long, least double, most double")
    return found.groupBy("range", "fold", "bin").agg(
        F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"))


def exact_medians(
    long: DataFrame, folds: Sequence[int] = (), bins: int = BINS, parts: DataFrame | None = None
) -> dict[tuple[str, int | None], float]:
    """The median of every feature over all rows, and over the rows outside each fold.

    Selection by counting: each pass counts the values of all features in equal ranges between the bounds
    known so far and keeps the range that holds the middle rank, until that range holds one
    value.  A value is counted once for its fold, whatever the number of folds: the rows outside a fold
    are the others.  Targets with the same bounds share the counts; the driver sees at most ``bins`` rows
    a fold and bounds in a pass.
    """
    ends: dict[str, list] = {}
    for r in (value_parts(long) if parts is None else parts).collect():
        ends.setdefault(r["feature"], []).append(r)
    found: dict[tuple[str, int | None], list[float]] = {}
    # per target and wanted rank: the rank inside the bounds, and the bounds
    open_: dict[tuple[str, int | None, int], tuple[int, float, float]] = {}
    for name, rows in ends.items():
        low, high = min(r["low"] for r in rows), max(r["high"] for r in rows)
        for without in (None, *folds):
            n = sum(r["n"] for r in rows if without is None or r["fold"] != without)
            for side, rank in enumerate(((n - 1) // 2, n // 2) if n else ()):
                open_[name, without, side] = rank, low, high
    while open_:
        for key in [k for k, (_, low, high) in open_.items() if low == high]:
            found.setdefault(key[:2], []).append(open_.pop(key)[1])
        if not open_:
            break
        ranges = sorted({(f, low, high) for (f, _, _), (_, low, high) in open_.items()})
        counted: dict[tuple, list] = {r: [] for r in ranges}
        for r in _counts(long, ranges, bins).collect():
            counted[ranges[r["range"]]].append((r["bin"], r["fold"], r["n"], r["least"], r["most"]))
        for rows in counted.values():
            rows.sort(key=lambda r: r[0])
        for (name, without, side), (rank, low, high) in list(open_.items()):
            for _, some in groupby(counted[name, low, high], key=lambda r: r[0]):
                some = list(some)
                n = sum(r[2] for r in some if without is None or r[1] != without)
                if rank < n:
                    open_[name, without, side] = rank, min(r[3] for r in some), max(r[4] for r in some)
                    break
                rank -= n
    return {key: (a + b) / 2 for key, (a, b) in found.items()}


def column_statistics(df: DataFrame, columns: Sequence[str], fold: str | None = None) -> DataFrame:
    """feature, without, n, mean, deviation, median; see ``fold_moments`` and ``exact_medians``.

    ``fold`` names an integer column with few values.  A feature without a value has no row.
    """
    long = long_values(df, columns, fold)
    parts = value_parts(long)
    folds = [r[0] for r in parts.select("fold").where("fold is not null").distinct().collect()]
    medians = [(f, w, m) for (f, w), m in exact_medians(long, folds, parts=parts).items()]
    table = df.sparkSession.createDataFrame(medians, "feature string, without int, median double")
    moments = fold_moments(long, parts).alias("m")
    same = (F.col("m.feature") == table["feature"]) & F.col("m.without").eqNullSafe(table["without"])
    return moments.join(F.broadcast(table), same).select("m.*", table["median"])
