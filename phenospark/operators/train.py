"""Tree models on feature tables with Spark ML."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from ..schema import DATE, LOCATION
from ..sources.shared import stored
from . import metrics
from .dataset import feature_columns
from .search import SEARCH_ROWS, nested_search

SEED = 42
MODEL_TYPES = ("randomforest", "xgboost")
TASKS = ("classification", "regression")
TARGETS = {"classification": "bloom_label", "regression": "onset_doy"}

# The search grids.  An unlimited depth is Spark's highest, 30; the
# minimum rows to split a node have no counterpart in Spark.
GRIDS = {
    "randomforest": {
        "numTrees": [50, 100, 200], "maxDepth": [5, 10, 15, 30], "minInstancesPerNode": [1, 2, 4],
    },
    "xgboost": {
        "maxIter": [50, 100, 200], "maxDepth": [3, 6, 9], "stepSize": [0.01, 0.1, 0.2],
        "subsamplingRate": [0.8, 0.9, 1.0],
    },
}

_ESTIMATORS = {
    ("randomforest", "classification"): RandomForestClassifier,
    ("randomforest", "regression"): RandomForestRegressor,
    ("xgboost", "classification"): GBTClassifier,
    ("xgboost", "regression"): GBTRegressor,
}


@dataclass
class BloomModel:
    """A fitted pipeline with what is needed to score with it."""

    pipeline: PipelineModel
    features: list[str]
    task: str
    model_type: str
    metrics: dict[str, float] = field(default_factory=dict)
    best_params: dict[str, float] = field(default_factory=dict)


def usable_features(df: DataFrame, names: Sequence[str] | None = None) -> list[str]:
    """Feature columns with at least one value: one pass, one row to the driver."""
    names = list(names or feature_columns(df.columns))
    row = df.agg(*[F.count(c).alias(c) for c in names]).first()
    return [c for c in names if row[c]]


def model_pipeline(
    model_type: str, task: str, features: Sequence[str], **params
) -> Pipeline:
    """Median imputation, standard scaling and a tree ensemble."""
    if (model_type, task) not in _ESTIMATORS:
        raise ValueError(f"unknown model or task: {model_type}, {task}")
    filled = [f"{c}__filled" for c in features]
    model = _ESTIMATORS[model_type, task](
        featuresCol="scaled", labelCol="label", seed=SEED, **params
    )
    return Pipeline(stages=[
        Imputer(strategy="median", inputCols=list(features), outputCols=filled, relativeError=1e-4),
        VectorAssembler(inputCols=filled, outputCol="assembled", handleInvalid="keep"),
        StandardScaler(inputCol="assembled", outputCol="scaled", withMean=True, withStd=True),
        model,
    ])


def fit_prepared(pipeline: Pipeline, table: DataFrame) -> PipelineModel:
    """``pipeline.fit(table)`` with the rows prepared once: an ensemble reads them several times
    before it has bins of its own."""
    *steps, model = pipeline.getStages()
    ready = Pipeline(stages=steps).fit(table)
    rows = ready.transform(table).select("label", "scaled").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return PipelineModel(stages=[*ready.stages, model.fit(rows)])
    finally:
        rows.unpersist()


def param_grid(model, grid: dict[str, list]) -> list:
    builder = ParamGridBuilder()
    for name, options in grid.items():
        builder = builder.addGrid(model.getParam(name), options)
    return builder.build()


def model_input(
    df: DataFrame, features: Sequence[str], target: str | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Doubles for the model; features the table lacks are 0."""
    columns = {
        c: F.col(c).cast("double") if c in df.columns else F.lit(0.0) for c in features
    }
    return df.select(
        *[c for c in keep if c not in columns],
        *([F.col(target).cast("double").alias("label")] if target else []),
        *[e.alias(c) for c, e in columns.items()],
    )


def with_folds(table: DataFrame, fold_by: Sequence[str], folds: int) -> DataFrame:
    """``table`` with ``fold``, from a hash of ``fold_by``.

    Where that leaves a fold empty there are few groups; they are dealt in order of their hash.
    """
    key = F.xxhash64(*fold_by)
    out = table.withColumn("fold", F.pmod(key, F.lit(folds)).cast("int"))
    if out.select("fold").distinct().count() == folds:
        return out
    number = F.row_number().over(Window.orderBy("fold_key"))
    dealt = table.select(key.alias("fold_key")).distinct().withColumn("fold", F.pmod(number, F.lit(folds)).cast("int"))
    return table.withColumn("fold_key", key).join(dealt, "fold_key").drop("fold_key")


def search_settings(
    table: DataFrame, features: Sequence[str], model_type: str, task: str, grid: dict[str, list], folds: int = 5,
    fold_by: Sequence[str] = (LOCATION, DATE), parallelism: int = 8, rows: int = SEARCH_ROWS, **params,
) -> DataFrame:
    """A row per setting of the grid with its held-out score; see ``search.nested_search``."""

    def ensemble(**chosen):
        return _ESTIMATORS[model_type, task](featuresCol="scaled", labelCol="label", seed=SEED, **{**params, **chosen})

    return nested_search(
        with_folds(table, fold_by, folds), features, model_type, task == "classification", grid, folds, ensemble,
        rows, parallelism,
    )


def train_model(
    dataset: DataFrame,
    model_type: str = "randomforest",
    task: str = "classification",
    folds: int = 5,
    grid: dict[str, list] | None = None,
    fold_by: Sequence[str] = (LOCATION, DATE),
    parallelism: int = 8,
    store: bool = True,
    search_rows: int = SEARCH_ROWS,
    settings_only: bool = False,
    **params,
) -> BloomModel | DataFrame:
    """Fit, with a cross-validated search when a ``grid`` is given (see ``GRIDS``).

    Folds come from a hash of ``fold_by``, so a recomputed partition lands in the same
    fold; ``fold_by=("location_id",)`` keeps a location's rows together.  The metrics
    are in-sample; the search's score is held out, and it looks at ``search_rows`` rows at most, while
    the best setting is fitted on all.  Training reads its table many times:
    ``store=False`` says the dataset is a stored table already.  ``settings_only`` gives the
    search's rows, one per setting of the grid, in place of the model.
    """
    target, names = TARGETS[task], feature_columns(dataset.columns)
    table = model_input(dataset, names, target, keep=fold_by)
    if store:
        table = stored(table, "training")
    features = usable_features(table, names)
    if settings_only:
        return search_settings(
            table, features, model_type, task, grid, folds, fold_by, parallelism, search_rows, **params
        )
    pipeline = model_pipeline(model_type, task, features, **params)
    best_params: dict[str, float] = {}
    cv_score = None
    if grid is None:
        fitted = fit_prepared(pipeline, table)
    else:
        found = search_settings(
            table, features, model_type, task, grid, folds, fold_by, parallelism, search_rows, **params
        ).collect()
        order = -1 if task == "classification" else 1
        best = min((r for r in found if r["score"] is not None), key=lambda r: order * r["score"])
        cv_score = best["score"]
        best_params = {n: type(grid[n][0])(best[n]) for n in grid}
        fitted = fit_prepared(model_pipeline(model_type, task, features, **{**params, **best_params}), table)
    # a copy leaves the training summary behind, which would tie the model to the session
    fitted = fitted.copy()
    out = BloomModel(fitted, features, task, model_type, best_params=best_params)
    out.metrics = in_sample_metrics(out, table)
    if cv_score is not None:
        out.metrics["cv_score"] = cv_score
    return out


def predict(model: BloomModel, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` columns, ``label`` if there is a target, ``prediction`` and ``score``."""
    target = TARGETS[model.task]
    if "label" in df.columns:
        target = "label"
    has_target = target in df.columns
    # kept columns that are features too travel under another name
    kept = [F.col(c).alias(f"_keep_{c}") for c in keep if c in df.columns]
    table = df.select("*", *kept)
    ready = model_input(
        table, model.features, target if has_target else None,
        keep=[f"_keep_{c}" for c in keep if c in df.columns],
    )
    scored = model.pipeline.transform(ready)
    if model.task == "classification":
        score = vector_to_array("probability")[1]
    else:
        score = F.col("prediction")
    return scored.select(
        *[F.col(f"_keep_{c}").alias(c) for c in keep if c in df.columns],
        *(["label"] if has_target else []),
        "prediction", score.alias("score"),
    )


def in_sample_metrics(model: BloomModel, dataset: DataFrame) -> dict[str, float]:
    scored = stored(predict(model, dataset), "scored")
    if model.task == "regression":
        return metrics.regression_metrics(scored).first().asDict()
    plain = metrics.classification_metrics(scored).first().asDict()
    return {**plain, **metrics.curve_areas(scored).first().asDict()}


def feature_importances(model: BloomModel, df: DataFrame, top_n: int = 20) -> DataFrame:
    """The ``top_n`` most important features (one small row per feature)."""
    weights = model.pipeline.stages[-1].featureImportances.toArray()
    rows = [(n, float(w)) for n, w in zip(model.features, weights)]
    table = df.sparkSession.createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature").limit(top_n)
