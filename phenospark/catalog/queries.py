"""One entry per registered query: (spark, folder of test tables) to a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import calendar, values
from ..operators import clean, dataset, features, grid, labels, metrics, nearby, outliers, score, statistics, train
from ..operators.consistency import consistency_filter
from ..operators.gapfill import interpolate
from ..operators.resample import resample
from ..operators.smooth import apply_smoothing, smooth
from ..plans import evaluation, scoring
from ..plans.evaluation import evaluation_metrics, timeseries_report
from ..plans.preprocess import preprocess
from ..plans.scoring import prediction_export, score_requests
from ..schema import PHENOLOGY_BANDS, RAW
from ..sources.ingest import ingest
from ..sources.publish import publish
from ..sources.readers import union_extracts
from ..sources.shared import shared_folder, stored
from ..sources.summaries import publish_summary, read_summary
from ..sources.writers import summarise, summarise_labels
from ..streaming import jobs, updates
from ..streaming import models as stream_models
from . import tables as t

Query = Callable[[SparkSession, str], DataFrame]
KEYS = ("location_id", "date")
DIGITS = 6


def tidy(df: DataFrame) -> DataFrame:
    """Doubles to six digits and without negative zero, so sums of any order agree."""
    return df.select(*[
        (F.round(F.col(f.name), DIGITS) + 0.0).alias(f.name)
        if f.dataType.simpleString() == "double" else F.col(f.name)
        for f in df.schema.fields
    ])


def _new(df: DataFrame, base: DataFrame) -> DataFrame:
    """Key columns and the columns an operator added."""
    return df.select(*KEYS, *[c for c in df.columns if c not in base.columns])


# --- cleaning -------------------------------------------------------------------------

def clean_scale_clip(spark, d):
    return clean.clean(t.unclean_observations(spark, d))


def clean_compact_key(spark, d):
    raw = t.raw_observations(t.read(spark, d, "lineitem")).withColumns({
        "latitude": F.col("latitude") * 0.9 + F.col("l_partkey") * 0.000125,
    })
    return clean.clean(raw, scale="never", key_style="compact").groupBy("location_id").agg(
        F.count(F.lit(1)).alias("rows"), F.avg("ndvi_raw").alias("mean")
    )


def lenient_dates(spark, d):
    text = F.when(F.col("event_id") % 5 == 0, "no date").otherwise(
        F.date_format("ts", "yyyy-MM-dd")
    )
    rows = t.read(spark, d, "events").select("event_id", text.alias("date"), "value")
    return clean.parse_dates(rows, "lenient")


def coordinate_check(spark, d):
    ok, rejected = clean.split_by_coordinates(t.requests(spark, d))
    return ok.withColumn("accepted", F.lit(True)).unionByName(
        rejected.withColumn("accepted", F.lit(False))
    )


def cloud_mask(spark, d):
    obs = t.event_observations(t.read(spark, d, "events"))
    return clean.mask_clouds(obs, "quality").select("event_id", *KEYS, "ndvi_raw")


def cloud_flag(spark, d):
    obs = t.event_observations(t.read(spark, d, "events"))
    return clean.flag_clouds(obs, "quality").select("event_id", *KEYS, "is_cloud")


def outlier_global(spark, d):
    flagged = outliers.flag_global_outliers(t.observations(spark, d), threshold=1.8)
    return flagged.select(*KEYS, *t.TIES, "ndvi_raw", "is_outlier")


def outlier_seasonal(spark, d):
    flagged = outliers.flag_seasonal_outliers(t.observations(spark, d))
    return flagged.select(*KEYS, *t.TIES, "ndvi_raw", "is_seasonal_outlier")


def consistency(spark, d):
    kept = consistency_filter(t.observations(spark, d), tie_break=t.TIES)
    return kept.select(*KEYS, *t.TIES, "ndvi_raw")


# --- series ---------------------------------------------------------------------------

def resample_month(spark, d):
    return t.monthly(spark, d)


def resample_quarter(spark, d):
    return resample(t.observations(spark, d), "quarter")


def resample_week(spark, d):
    return resample(t.event_observations(t.read(spark, d, "events")), "week")


def resample_day(spark, d):
    return resample(t.event_observations(t.read(spark, d, "events")), "day")


def interpolate_linear(spark, d):
    return interpolate(t.gappy(spark, d), "linear")


def interpolate_time(spark, d):
    return interpolate(t.gappy(spark, d), "linear", axis="time")


def interpolate_nearest(spark, d):
    return interpolate(t.gappy(spark, d), "nearest")


def interpolate_cubic(spark, d):
    return interpolate(t.gappy(spark, d), "cubic")


def savgol_5_2(spark, d):
    return smooth(t.gappy(spark, d), window=5, polyorder=2)


def savgol_7_3(spark, d):
    return smooth(t.gappy(spark, d), window=7, polyorder=3)


def preprocess_series(spark, d):
    return t.processed(spark, d)


def preprocess_filled(spark, d):
    raw = t.raw_observations(t.read(spark, d, "lineitem"))
    return preprocess(
        raw, scale="never", quality_filter=False, fill_after_resample=True
    )


# --- features -------------------------------------------------------------------------

def calendar_features(spark, d):
    base = t.monthly(spark, d)
    return _new(features.add_calendar(base), base)


def climate_features(spark, d):
    base = t.monthly(spark, d)
    return _new(features.add_climate(base), base)


def interaction_features(spark, d):
    base = t.unsmoothed(spark, d)
    full = features.add_interactions(features.add_rolling(
        features.add_calendar(base), windows=(3,), stats=("mean", "slope")))
    return full.select(
        *KEYS, "ndvi_month_interaction", "ndvi_lat_interaction", "mean_slope_interaction"
    )


def rolling_stats(spark, d):
    base = t.gappy(spark, d)
    return _new(features.add_rolling(base, "ndvi_raw", stats=("mean", "std", "min", "max")), base)


def rolling_slope(spark, d):
    base = t.gappy(spark, d)
    return _new(features.add_rolling(base, "ndvi_raw", stats=("slope",)), base)


def lags_diffs(spark, d):
    base = t.gappy(spark, d)
    return _new(features.add_differences(features.add_lags(base, "ndvi_raw"), "ndvi_raw"), base)


def peak_features(spark, d):
    base = t.gappy(spark, d)
    return _new(features.add_peaks(base, "ndvi_raw"), base)


def all_features(spark, d):
    return features.all_features(t.processed(spark, d))


def request_model_inputs(spark, d):
    """What a model is given to score each request: a row per step of the request, with the
    features of its steps alone."""
    rows = scoring.requested_rows(t.requests(spark, d), t.unsmoothed(spark, d), trails=True)
    ready = scoring.request_features(rows)
    return ready.select("request_id", *[c for c in ready.columns if c not in ("request_id", "start_date", "end_date")])


def scoring_features(spark, d):
    return features.scoring_features(t.unsmoothed(spark, d))


def raw_features(spark, d):
    return features.raw_features(t.monthly(spark, d))


def profile_nulls(spark, d):
    return features.non_null_profile(features.all_features(t.unsmoothed(spark, d)))


# --- labels and training sets ---------------------------------------------------------

def label_phenology(spark, d):
    return labels.phenology_labels(t.phenology_pixels(spark, d))


def label_phenology_epoch(spark, d):
    days = F.unix_date(F.col("date")).cast("double")
    pixels = t.phenology_pixels(spark, d)
    dated = pixels.withColumns({b: F.col(b) + days for b in PHENOLOGY_BANDS})
    return labels.phenology_labels(dated, epoch_days=True)


def label_spring_jump(spark, d):
    return labels.spring_jump_labels(t.monthly(spark, d))


def label_changepoint(spark, d):
    return labels.change_point_labels(t.stepped(spark, d))


def label_changepoint_binseg(spark, d):
    return labels.change_point_labels(t.stepped(spark, d), method="binseg")


def label_changepoint_window(spark, d):
    return labels.change_point_labels(t.stepped(spark, d), method="window", penalty=0.5)


def label_changepoint_yearly(spark, d):
    return labels.change_point_labels(t.seasonal(spark, d), penalty=1.0, per_year=True)


def _every_fifth(spark, d):
    arrays = labels.series_arrays(t.gappy(spark, d), "ndvi_raw")
    return arrays.withColumn("candidates", F.sequence(F.lit(0), F.size("series") - 1, F.lit(5)))


def onset_from_candidates(spark, d):
    return labels.onsets_from_candidates(_every_fifth(spark, d), min_increase=0.03)


def onset_per_year(spark, d):
    return labels.onsets_from_candidates(
        _every_fifth(spark, d), min_increase=0.03, per_year=True
    )


def label_summary(spark, d):
    return summarise_labels(label_spring_jump(spark, d))


def _small_features(spark, d):
    return features.scoring_features(t.unsmoothed(spark, d))


def train_set_cls(spark, d):
    return dataset.classification_set(
        _small_features(spark, d), label_spring_jump(spark, d)
    ).select(*KEYS, "year", "ndvi_mean_3", "label_quality_score", "bloom_label")


def train_set_reg(spark, d):
    return dataset.regression_set(
        _small_features(spark, d), label_spring_jump(spark, d)
    ).select(*KEYS, "year", "ndvi_mean_3", "label_quality_score", "onset_date", "onset_doy")


def class_balance(spark, d):
    return dataset.class_balance(train_set_cls(spark, d))


def target_range(spark, d):
    return dataset.target_range(train_set_reg(spark, d))


# --- scoring --------------------------------------------------------------------------

def _scored(spark, d):
    return score.rule_scores(t.unsmoothed(spark, d))


def score_rule(spark, d):
    return _scored(spark, d).select(
        *KEYS, "bloom_probability", "bloom_predicted", "ndvi"
    )


def onset_first(spark, d):
    return score.onset_by_probability(_scored(spark, d))


def onset_first_flag(spark, d):
    return score.onset_by_flag(_scored(spark, d))


def onset_nearest_doy(spark, d):
    guess = t.unsmoothed(spark, d).withColumn(
        "predicted_onset_doy", F.round(F.col("ndvi_raw") * 120, 3) + 60.0
    )
    return score.onset_by_day(guess)


def confidence(spark, d):
    return score.confidence(_scored(spark, d))


def bloom_events(spark, d):
    return score.bloom_events(t.unsmoothed(spark, d))


def location_peak(spark, d):
    return score.location_peak(t.gappy(spark, d), "ndvi_raw")


def request_answers(spark, d):
    """The answers with the nested predictions as count, sum and last date."""
    answers = score_requests(t.requests(spark, d), t.unsmoothed(spark, d))
    p = F.col("predictions")
    return answers.select(
        "request_id", "location_id", "latitude", "longitude",
        F.size(p).alias("n_predictions"),
        F.aggregate(p, F.lit(0.0), lambda a, x: a + x["ndvi"]).alias("ndvi_sum"),
        F.array_max(F.transform(p, lambda x: x["date"])).alias("last_date"),
        "predicted_onset_date", "confidence",
    )


def prediction_rows(spark, d):
    return prediction_export(score_requests(t.requests(spark, d), t.unsmoothed(spark, d)))


def timeseries_overlay(spark, d):
    few = score.overlay_onsets(score_rule(spark, d), label_spring_jump(spark, d), 5)
    return few.select(
        *KEYS, "ndvi", "bloom_probability",
        F.coalesce(F.size("actual_onsets"), F.lit(0)).alias("n_onsets"),
        F.array_min("actual_onsets").alias("first_onset"),
    )


# --- evaluation -----------------------------------------------------------------------

def _judged(spark, d):
    """Rule scores (to four digits, so ties occur) against the spring-jump labels."""
    scored = score.rule_scores(t.unsmoothed(spark, d)).withColumn("year", F.year("date"))
    return dataset.classification_set(scored, label_spring_jump(spark, d)).where(
        F.col("ndvi").isNotNull()
    ).select(
        F.col("bloom_label").alias("label"),
        F.col("bloom_predicted").cast("int").alias("prediction"),
        F.round("bloom_probability", 4).alias("score"),
    )


def metrics_cls(spark, d):
    return metrics.classification_metrics(_judged(spark, d))


def class_report(spark, d):
    return metrics.class_report(_judged(spark, d))


def curve_areas(spark, d):
    return metrics.curve_areas(_judged(spark, d))


def confusion(spark, d):
    return metrics.confusion_table(_judged(spark, d))


def roc_points(spark, d):
    return metrics.roc_points(_judged(spark, d))


def pr_points(spark, d):
    return metrics.pr_points(_judged(spark, d))


def evaluation_cls(spark, d):
    return evaluation_metrics(stored(_judged(spark, d), "judged"), "classification")


def evaluation_tables(spark, d):
    """The whole class report as one long table."""
    return evaluation.report_rows(evaluation.evaluation_tables(_judged(spark, d), "classification"))


def _guessed(spark, d):
    rows = dataset.regression_set(
        t.unsmoothed(spark, d).withColumn("year", F.year("date")), label_spring_jump(spark, d)
    ).where(F.col("ndvi_raw").isNotNull())
    return rows.select(
        *KEYS, F.col("onset_doy").alias("label"),
        (F.round(F.col("ndvi_raw") * 120, 3) + 60.0).alias("prediction"),
    )


def metrics_reg(spark, d):
    return metrics.regression_metrics(_guessed(spark, d))


def residual_hist(spark, d):
    return metrics.residual_histogram(metrics.with_residuals(_guessed(spark, d)))


def residual_rows(spark, d):
    return metrics.with_residuals(_guessed(spark, d))


def evaluation_reg(spark, d):
    """The whole regression report, but for its residual rows, as one long table."""
    return evaluation.report_rows(evaluation.evaluation_tables(_guessed(spark, d), "regression"))


# --- models ---------------------------------------------------------------------------

SIZE = 100  # trees or rounds where nothing is searched: the middle of ``train.GRIDS``


def _training(spark, d, kind):
    build = dataset.classification_set if kind == "classification" else dataset.regression_set
    return build(
        features.all_features(t.processed(spark, d)), label_spring_jump(spark, d)
    )


def _fitted(spark, d, model_type, task, **params):
    data = stored(_training(spark, d, task), "dataset")
    return train.train_model(data, model_type, task, store=False, **params), data


def model_rf_cls(spark, d):
    model, data = _fitted(spark, d, "randomforest", "classification", numTrees=SIZE)
    return train.predict(model, data, KEYS)


def model_rf_reg(spark, d):
    model, data = _fitted(spark, d, "randomforest", "regression", numTrees=SIZE)
    return train.predict(model, data, KEYS)


def model_gbt_cls(spark, d):
    model, data = _fitted(spark, d, "xgboost", "classification", maxIter=SIZE)
    return train.predict(model, data, KEYS)


def model_gbt_reg(spark, d):
    model, data = _fitted(spark, d, "xgboost", "regression", maxIter=SIZE)
    return train.predict(model, data, KEYS)


def importance_topk(spark, d):
    model, data = _fitted(spark, d, "randomforest", "classification", numTrees=SIZE)
    return train.feature_importances(model, data)


def model_search(spark, d):
    """The whole grid: a row per setting with its held-out score over five folds."""
    return train.train_model(
        _training(spark, d, "classification"), "randomforest", "classification", folds=5,
        grid=train.GRIDS["randomforest"], fold_by=("location_id",), settings_only=True,
    )


def _inputs(spark, d):
    """The model inputs, cut to five digits, so that a mean of two of them has six; and their names."""
    data = tidy(all_features(spark, d))
    names = dataset.feature_columns(data.columns)
    cut = [(F.floor(F.col(c).cast("double") * 100000.0) / 100000.0).alias(c) for c in names]
    return stored(data.select((F.year("date") % 5).alias("fold"), *cut), "inputs"), names


def model_medians(spark, d):
    """The exact median of every model input."""
    return statistics.column_statistics(*_inputs(spark, d)).select("feature", "n", "median")


def fold_statistics(spark, d):
    """What preparation needs of every training set: all rows but those of a fold of years."""
    return statistics.column_statistics(*_inputs(spark, d), "fold").where("without is not null")


def model_overlay(spark, d):
    model, data = _fitted(spark, d, "randomforest", "classification", numTrees=SIZE)
    return timeseries_report(model, data, label_spring_jump(spark, d))


# --- pixels and extracts --------------------------------------------------------------

def bbox_date_filter(spark, d):
    area = grid.area_bounds("-120,-45.5,60,45.5")
    obs = grid.within_bounds(t.observations(spark, d), area)
    return grid.within_dates(obs, "1996-01-01", "1999-07-01").select(
        *KEYS, "latitude", "longitude", "ndvi_raw", *t.TIES
    )


def band_select(spark, d):
    return grid.select_band(t.pixels(spark, d), "MOD13A2")


def grid_points(spark, d):
    return grid.grid_points(spark, grid.table_bounds(t.pixels(spark, d)))


def sample_nearest(spark, d):
    pixels = t.pixels(spark, d)
    return grid.sample_nearest(
        grid.select_band(pixels, "MOD13A2"), grid.table_bounds(pixels), scale=3000.0
    )


def sample_phenology(spark, d):
    pixels = t.phenology_pixels(spark, d)
    return grid.sample_phenology(pixels, grid.table_bounds(pixels), scale=4000.0)


POLAR = grid.Bounds(172.0, 76.5, -171.0, 89.5)


def sample_distance(spark, d):
    """The nearest pixel within 3 km of every point of an area across the date line."""
    return nearby.sample_within(t.polar_pixels(spark, d), POLAR, reach=3000.0)


def sample_phenology_distance(spark, d):
    pixels = t.phenology_pixels(spark, d)
    return nearby.sample_phenology_within(pixels, grid.table_bounds(pixels), reach=4000.0)


def union_normalise(spark, d):
    first = t.read(spark, d, "lineitem").select(
        F.col("l_suppkey").cast("double").alias("Latitude"),
        F.col("l_partkey").cast("double").alias("Longitude"),
        F.col("l_shipdate").cast("date").alias("Date"),
        (F.col("l_discount") * 100000).alias("NDVI"),
    )
    second = t.read(spark, d, "orders").select(
        F.col("o_custkey").cast("double").alias("latitude"),
        F.col("o_orderkey").cast("double").alias("longitude"),
        F.col("o_orderdate").cast("date").alias("date"),
        (F.col("o_totalprice") / 53).alias("ndvi_raw"),
        F.col("o_orderstatus").alias("quality"),
    )
    return union_extracts([first, second])


def _extracts(spark, d):
    """The observations written as extract files of two layouts and taken in again."""
    home = shared_folder(spark, "extracts")
    for layout, texts in t.extract_texts(spark, d).items():
        texts.write.option("header", True).csv(f"{home}/files/{layout}")
    known = T.StructType([
        *RAW.fields, T.StructField("quality", T.IntegerType()),
        *[T.StructField(c, T.LongType()) for c in t.TIES],
    ])
    return ingest(spark, f"{home}/files", f"{home}/table", known)


def extract_roundtrip(spark, d):
    """Every line of the files, with the reason where it was rejected."""
    return _extracts(spark, d).rows.select(
        F.regexp_extract("source_file", "/files/([^/]+)/", 1).alias("layout"), *t.TIES,
        "rejected_for", *[F.when(F.col("accepted"), F.col(c)).alias(c) for c in (*RAW.names, "quality")],
    )


def extract_counts(spark, d):
    """Accepted and rejected lines, summed over a layout's files."""
    layout = F.regexp_extract("source_file", "/files/([^/]+)/", 1).alias("layout")
    return _extracts(spark, d).counts().groupBy(layout).agg(
        F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected"))


def clean_counts(spark, d):
    return clean.count_incomplete(t.unclean_observations(spark, d))


def labels_roundtrip(spark, d):
    """Labels published with the later ones in wrong years, then a re-run that answers for those."""
    home = shared_folder(spark, "labels")
    found = stored(label_phenology_epoch(spark, d), "found-labels")
    late = F.col("year") >= 1995
    publish(found.withColumn("year", F.when(late, F.col("year") + 4).otherwise(F.col("year"))), home)
    return publish(found.where(late), home, covers=(1995, 2010))


def features_roundtrip(spark, d):
    """Features published with one year short of rows, and then that year's again."""
    home = shared_folder(spark, "features")
    found = stored(all_features(spark, d), "found-features")
    publish(found.where("year <> 1996 OR month < 6"), home)
    return publish(found.where("year = 1996"), home)


def series_roundtrip(spark, d):
    """The processed series published twice on one folder; its year comes from the date."""
    home = shared_folder(spark, "series")
    found = stored(t.processed(spark, d), "found-series")
    publish(found, home)
    return publish(found, home)


def summary(spark, d):
    return summarise(apply_smoothing(t.monthly(spark, d)))


def summary_years(spark, d):
    """The summary kept per year: early years, then a run over the later ones that holds the
    last early year again."""
    path = shared_folder(spark, "summary")
    series = stored(apply_smoothing(t.monthly(spark, d)), "smoothed")
    publish_summary(series.where("year(date) <= 1997"), path)
    publish_summary(series.where("year(date) >= 1997"), path)
    return read_summary(spark, path).withColumn(
        "estimate_holds", F.abs("estimate_error") < 0.02
    ).drop("locations_estimate", "estimate_error")


def doy_dates(spark, d):
    date = F.col("o_orderdate").cast("date")
    return t.read(spark, d, "orders").select(
        "o_orderkey",
        calendar.date_of_day(F.year(date), F.dayofyear(date)).alias("round_trip"),
        calendar.date_of_day(
            F.year(date), (F.col("o_custkey") % 366 + 1).cast("int")
        ).alias("some_day"),
    )


def demo_bloom(spark, d):
    return t.monthly(spark, d).select(
        *KEYS, values.demo_bloom_flag(F.col("ndvi_raw"), F.month("date")).alias("is_bloom")
    )


# --- streams --------------------------------------------------------------------------

def _stream(spark, d, name):
    schema = t.read(spark, d, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(d)


def _run(query):
    query.awaitTermination()


def stream_score(spark, d):
    home = shared_folder(spark, "stream-score")
    scored = jobs.score_stream(t.event_observations(_stream(spark, d, "events")).drop(
        "location_id"))
    _run(jobs.write_stream(scored, f"{home}/table", f"{home}/state"))
    return spark.read.schema(scored.schema).parquet(f"{home}/table").select(
        "event_id", *KEYS, "bloom_probability", "bloom_predicted", "ndvi"
    )


def stream_month(spark, d):
    home = shared_folder(spark, "stream-month")
    obs = t.keyed(t.raw_observations(_stream(spark, d, "lineitem")))
    _run(jobs.write_updates(jobs.monthly_stream(obs), f"{home}/table", f"{home}/state"))
    latest = jobs.latest_updates(spark.read.parquet(f"{home}/table"), ("location_id", "month"))
    return latest.select(
        "location_id", F.col("month").cast("date").alias("month"), "month_mean", "month_rows"
    )


def stream_features(spark, d):
    """Months that the watermark has closed, each given once."""
    home = shared_folder(spark, "stream-features")
    obs = t.keyed(t.raw_observations(_stream(spark, d, "lineitem")))
    months = jobs.monthly_stream(obs)
    _run(jobs.write_stream(months, f"{home}/months", f"{home}/months-state"))
    closed = spark.readStream.schema(jobs.MONTHS).parquet(f"{home}/months")
    _run(jobs.write_stream(jobs.trailing_stream(closed), f"{home}/table", f"{home}/state"))
    return spark.read.schema(jobs.TRAILING).parquet(f"{home}/table")


def stream_features_latest(spark, d):
    """All months, the open ones as they stand."""
    home = shared_folder(spark, "stream-features-latest")
    obs = t.keyed(t.raw_observations(_stream(spark, d, "lineitem")))
    _run(jobs.write_updates(jobs.monthly_stream(obs), f"{home}/months", f"{home}/months-state"))
    months = spark.readStream.schema(jobs.MONTH_UPDATES).parquet(f"{home}/months")
    _run(jobs.write_updates(jobs.trailing_stream(months, "update"), f"{home}/table", f"{home}/state"))
    return jobs.latest_updates(spark.read.parquet(f"{home}/table"), KEYS).select(jobs.TRAILING.names)


def stream_compacted(spark, d):
    """Monthly means that twelve batches change, read from one snapshot and the log after it."""
    home = shared_folder(spark, "stream-compacted")
    obs = t.keyed(t.raw_observations(t.read(spark, d, "lineitem")))
    obs.repartition(12, *t.TIES).write.option("compression", "zstd").parquet(f"{home}/arrivals")
    arriving = spark.readStream.schema(obs.schema).option("maxFilesPerTrigger", 1).parquet(
        f"{home}/arrivals")
    months = jobs.monthly_stream(arriving, lateness=None)
    key = ("location_id", "month")
    _run(updates.write_compacted(months, f"{home}/table", f"{home}/state", key, every=5))
    return updates.read_latest(spark, f"{home}/table", months.schema, key).withColumn(
        "month", F.col("month").cast("date"))


def stream_model_scores(spark, d):
    """Feature rows as they arrive, scored by the model that was newest then: those before 1997
    by the first of two models, the others by the second, the first fitted on the early rows
    and the second on all."""
    home = shared_folder(spark, "stream-models")
    data = stored(_training(spark, d, "classification"), "dataset")
    for size, rows in ((50, "year(date) < 1997"), (SIZE, "year(date) >= 1997")):
        fresh = data.where(rows)
        model = train.train_model(
            data if size == SIZE else fresh, "randomforest", "classification", store=False, numTrees=size)
        stream_models.publish_model(spark, model, f"{home}/registry")
        fresh.write.mode("append").parquet(f"{home}/arrivals")
        arriving = spark.readStream.schema(data.schema).parquet(f"{home}/arrivals")
        _run(stream_models.write_model_scores(
            arriving, f"{home}/registry", f"{home}/table", f"{home}/state"))
    return spark.read.parquet(f"{home}/table").select(
        *KEYS, F.col("label").cast("int").alias("label"), stream_models.VERSION,
        F.col("score").between(0, 1).alias("scored"),
    )


_ALL = (
    clean_scale_clip, clean_compact_key, lenient_dates, coordinate_check, cloud_mask,
    cloud_flag, outlier_global, outlier_seasonal, consistency,
    resample_month, resample_quarter, resample_week, resample_day, interpolate_linear,
    interpolate_time, interpolate_nearest, interpolate_cubic, savgol_5_2, savgol_7_3,
    preprocess_series, preprocess_filled,
    calendar_features, climate_features, interaction_features, rolling_stats, rolling_slope,
    lags_diffs, peak_features, all_features, scoring_features, raw_features, profile_nulls,
    label_phenology, label_phenology_epoch, label_spring_jump, label_changepoint,
    label_changepoint_binseg, label_changepoint_window, label_changepoint_yearly,
    onset_from_candidates, onset_per_year, label_summary,
    train_set_cls, train_set_reg, class_balance, target_range,
    score_rule, onset_first, onset_first_flag, onset_nearest_doy, confidence, bloom_events, request_model_inputs,
    location_peak, request_answers, prediction_rows, timeseries_overlay,
    metrics_cls, class_report, curve_areas, confusion, roc_points, pr_points, evaluation_cls,
    evaluation_tables, metrics_reg, residual_hist, residual_rows, evaluation_reg,
    model_rf_cls, model_rf_reg, model_gbt_cls, model_gbt_reg, importance_topk, model_search,
    model_overlay, model_medians, fold_statistics,
    bbox_date_filter, band_select, grid_points, sample_nearest, sample_phenology,
    sample_distance, sample_phenology_distance,
    union_normalise, extract_roundtrip, extract_counts, clean_counts, labels_roundtrip,
    features_roundtrip, series_roundtrip, summary, summary_years, doy_dates, demo_bloom,
    stream_score, stream_month, stream_features, stream_features_latest, stream_compacted,
    stream_model_scores,
)
# Names that read better than the function's, which would hide an imported one.
_NAMES = {"consistency": "consistency_filter", "request_answers": "score_requests"}


def _registered(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return tidy(build(spark, sf_dir))

    return run


def queries() -> dict[str, Query]:
    return {_NAMES.get(q.__name__, q.__name__): _registered(q) for q in _ALL}
