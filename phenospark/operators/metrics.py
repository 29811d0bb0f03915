"""Model quality as grouped aggregates over a scored table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import stored

ROWS_PER_RANGE = 1_000_000


def _count(test: Column, weight: str | None = None) -> Column:
    rows = test.cast("long") if weight is None else F.when(test, F.col(weight))
    return F.coalesce(F.sum(rows), F.lit(0).cast("long"))


def _counts(label: str, prediction: str, weight: str | None = None) -> list[Column]:
    y, p = F.col(label), F.col(prediction)
    return [
        _count((y == 1) & (p == 1), weight).alias("tp"),
        _count((y == 0) & (p == 1), weight).alias("fp"),
        _count((y == 1) & (p == 0), weight).alias("fn"),
        _count((y == 0) & (p == 0), weight).alias("tn"),
    ]


def outcome_counts(
    df: DataFrame, label: str = "label", prediction: str = "prediction", score: str = "score"
) -> DataFrame:
    """How many ``rows`` share a label, a prediction and a score, stored.

    One read of the scored rows, reduced map-side; every table of a class report follows
    from it with ``weight="rows"``.
    """
    return stored(
        df.groupBy(label, prediction, score).agg(F.count(F.lit(1)).alias("rows")), "outcomes"
    )


def _ratio(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top.cast("double"), bottom), F.lit(0.0))


def _f1(tp: Column, fp: Column, fn: Column) -> Column:
    return _ratio(2 * tp, 2 * tp + fp + fn)


def classification_metrics(
    df: DataFrame, label: str = "label", prediction: str = "prediction", weight: str | None = None
) -> DataFrame:
    """Accuracy, precision, recall and F1 of class 1; 0 where undefined."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return df.agg(*_counts(label, prediction, weight)).select(
        _ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _f1(tp, fp, fn).alias("f1"),
    )


def class_report(
    df: DataFrame, label: str = "label", prediction: str = "prediction", weight: str | None = None
) -> DataFrame:
    """Precision, recall, F1 and support per class, and their macro and weighted means.

    Classes that neither occur nor are predicted are left out.  ``weight`` names a column
    that says how many rows a row stands for.
    """
    one = df.agg(*_counts(label, prediction, weight))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))

    def row(name: str, hit: Column, wrong: Column, missed: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"),
            _ratio(hit, hit + wrong).alias("precision"),
            _ratio(hit, hit + missed).alias("recall"),
            _f1(hit, wrong, missed).alias("f1"),
            (hit + missed).alias("support"),
            (hit + wrong + missed > 0).alias("present"),
        )

    rows = one.select(F.filter(
        F.array(row("0", tn, fn, fp), row("1", tp, fp, fn)), lambda r: r["present"]
    ).alias("classes"), (tp + tn).alias("right"))
    classes = F.col("classes")
    total = F.aggregate(classes, F.lit(0).cast("long"), lambda a, r: a + r["support"])

    def mean(field: str, weight) -> Column:
        weights = F.aggregate(classes, F.lit(0.0), lambda a, r: a + weight(r))
        summed = F.aggregate(classes, F.lit(0.0), lambda a, r: a + weight(r) * r[field])
        return _ratio(summed, weights)

    def summary(name: str, weight) -> Column:
        return F.struct(
            F.lit(name).alias("class"),
            *[mean(f, weight).alias(f) for f in ("precision", "recall", "f1")],
            total.alias("support"),
            F.lit(True).alias("present"),
        )

    accuracy = F.struct(
        F.lit("accuracy").alias("class"),
        *[_ratio(F.col("right"), total).alias(f) for f in ("precision", "recall", "f1")],
        total.alias("support"),
        F.lit(True).alias("present"),
    )
    extra = F.array(
        accuracy,
        summary("macro avg", lambda r: F.lit(1.0)),
        summary("weighted avg", lambda r: r["support"].cast("double")),
    )
    return rows.select(F.explode(F.concat(classes, extra)).alias("r")).select(
        "r.class", "r.precision", "r.recall", "r.f1", "r.support"
    )


def confusion_table(
    df: DataFrame, label: str = "label", prediction: str = "prediction", weight: str | None = None
) -> DataFrame:
    """Row count for each of the four (label, prediction) pairs."""
    cells = [("tn", 0, 0), ("fp", 0, 1), ("fn", 1, 0), ("tp", 1, 1)]
    return df.agg(*_counts(label, prediction, weight)).select(F.explode(F.array(*[
        F.struct(
            F.lit(y).alias("label"), F.lit(p).alias("prediction"), F.col(c).alias("rows")
        )
        for c, y, p in cells
    ])).alias("c")).select("c.*")


@dataclass(frozen=True)
class ScoreSteps:
    """Running counts per distinct score, highest first, and the totals."""

    rows: DataFrame
    positives: int
    negatives: int


def score_steps(
    df: DataFrame, label: str = "label", score: str = "score",
    rows_per_range: int = ROWS_PER_RANGE, weight: str | None = None,
) -> ScoreSteps:
    """Per distinct score, its positives and negatives and those at or above it.

    A NaN score counts as missing, as a null does.  The counts per score are stored, since
    range sums and running sums each read them.  Spark's range partitioning cuts the scores
    into ranges of about ``rows_per_range`` distinct ones, stored as well, so that the cuts
    stay what they are; the running sums are windows over a range plus the sums of the ranges
    above, and only those range sums meet in one task.
    """
    y = F.col(label)
    steps = stored(
        df.where(F.col(score).isNotNull() & ~F.isnan(score)).groupBy(F.col(score).alias("threshold")).agg(
            _count(y == 1, weight).alias("pos"), _count(y == 0, weight).alias("neg")
        ),
        "score-steps",
    )
    scores, pos, neg = steps.agg(
        F.count(F.lit(1)), F.coalesce(F.sum("pos"), F.lit(0)), F.coalesce(F.sum("neg"), F.lit(0))
    ).first()
    ranges = -(-scores // rows_per_range)
    if ranges > 1:
        ranged = stored(
            steps.repartitionByRange(ranges, "threshold").withColumn("_range", F.spark_partition_id()), "score-ranges"
        )
    else:
        ranged = steps.withColumn("_range", F.lit(0))
    above = Window.orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("_range").agg(
        F.sum("pos").alias("_pos"), F.sum("neg").alias("_neg")
    ).select(
        "_range",
        F.coalesce(F.sum("_pos").over(above), F.lit(0)).alias("_pos_above"),
        F.coalesce(F.sum("_neg").over(above), F.lit(0)).alias("_neg_above"),
    )
    inside = Window.partitionBy("_range").orderBy(F.desc("threshold")).rowsBetween(
        Window.unboundedPreceding, 0
    )
    rows = ranged.join(F.broadcast(offsets), "_range").select(
        "threshold", "pos", "neg",
        (F.sum("pos").over(inside) + F.col("_pos_above")).alias("tp"),
        (F.sum("neg").over(inside) + F.col("_neg_above")).alias("fp"),
    )
    return ScoreSteps(rows, pos, neg)


def _share(count: Column, total: int) -> Column:
    return count / F.lit(float(total)) if total else F.lit(None).cast("double")


def roc_points(
    df: DataFrame, label: str = "label", score: str = "score", steps: ScoreSteps | None = None
) -> DataFrame:
    """Every threshold's false and true positive rate; the (0, 0) start has no threshold."""
    steps = steps or score_steps(df, label, score)
    rated = steps.rows.select(
        "threshold",
        _share(F.col("fp"), steps.negatives).alias("fpr"),
        _share(F.col("tp"), steps.positives).alias("tpr"),
    )
    start = df.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"),
        F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"),
    )
    return start.unionByName(rated)


def pr_points(
    df: DataFrame, label: str = "label", score: str = "score", steps: ScoreSteps | None = None
) -> DataFrame:
    """Every threshold's precision and recall, closed by the point (1, 0)."""
    steps = steps or score_steps(df, label, score)
    rated = steps.rows.select(
        "threshold",
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        _share(F.col("tp"), steps.positives).alias("recall"),
    )
    end = df.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"),
        F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"),
    )
    return end.unionByName(rated)


def curve_areas(
    df: DataFrame, label: str = "label", score: str = "score", steps: ScoreSteps | None = None
) -> DataFrame:
    """Areas under both curves by the trapezoid rule; NULL when a class is missing.

    The ROC area equals the rank statistic with ties counted half; the precision-recall
    area runs along increasing recall, so it is positive.
    """
    steps = steps or score_steps(df, label, score)
    tp, fp, pos, neg = (F.col(c).cast("double") for c in ("tp", "fp", "pos", "neg"))
    earlier = tp + fp - pos - neg
    before = F.when(earlier > 0, F.try_divide(tp - pos, earlier)).otherwise(1.0)
    roc = F.sum(neg * (tp - pos / 2))
    pr = F.sum(pos * (before + tp / (tp + fp)) / 2)
    return steps.rows.agg(
        _share(roc, steps.positives * steps.negatives).alias("roc_auc"),
        _share(pr, steps.positives if steps.negatives else 0).alias("pr_auc"),
    )


def regression_metrics(
    df: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """MAE, MSE, RMSE, R2 and MAPE (in percent) in one pass."""
    y = F.col(label).cast("double")
    error = y - F.col(prediction)
    return df.agg(
        F.avg(F.abs(error)).alias("mae"),
        F.avg(error * error).alias("mse"),
        F.var_pop(y).alias("_var"),
        (F.avg(F.abs(F.try_divide(error, y))) * 100).alias("mape"),
    ).select(
        "mae", "mse", F.sqrt("mse").alias("rmse"),
        (1 - F.try_divide(F.col("mse"), F.col("_var"))).alias("r2"), "mape",
    )


def with_residuals(
    df: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    return df.withColumn("residual", F.col(label) - F.col(prediction))


def residual_histogram(
    df: DataFrame, residual: str = "residual", bins: int = 30, store: bool = True
) -> DataFrame:
    """Equal-width bins from lowest to highest residual, empty ones included.

    The highest residual falls in the last bin; when all are equal the range is one wide
    around them.  The residuals are read for their ends and for their bins: ``store=False``
    says they are a stored table already.
    """
    if store:
        df = stored(df.select(residual), "residuals")
    low, high = df.agg(F.min(residual), F.max(residual)).first()
    if low is not None and low == high:
        low, high = low - 0.5, high + 0.5
    low, high = F.lit(low).cast("double"), F.lit(high).cast("double")
    width = (high - low) / bins
    value = F.col(residual)
    guess = F.least(
        F.floor((value - low) / (high - low) * bins), F.lit(bins - 1).cast("long")
    )
    # the printed edges decide, where the division rounds across one
    placed = df.where(value.isNotNull()).withColumn("bin", guess).select(
        F.when(value < low + F.col("bin") * width, F.col("bin") - 1)
        .when(
            (F.col("bin") < bins - 1) & (value >= low + (F.col("bin") + 1) * width),
            F.col("bin") + 1,
        )
        .otherwise(F.col("bin")).alias("bin")
    )
    counts = placed.groupBy("bin").agg(F.count(F.lit(1)).alias("rows"))
    every = df.sparkSession.range(bins).select(F.col("id").alias("bin"))
    return every.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        (low + F.col("bin") * width).alias("bin_low"),
        (low + (F.col("bin") + 1) * width).alias("bin_high"),
        F.coalesce("rows", F.lit(0).cast("long")).alias("rows"),
    )
