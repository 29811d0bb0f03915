"""Batch scoring of a table of location and date-range requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import values
from ..operators import score
from ..operators.clean import coordinate_ok
from ..operators.features import add_trails, scoring_features, trail_features
from ..operators.joins import salted_join
from ..operators.train import BloomModel, predict
from ..schema import DATE, LOCATION, PREDICTIONS, RAW_VALUE, SMOOTH_VALUE
from ..sources.shared import stored

REQUEST = "request_id"
ANSWER_KEY = (REQUEST, LOCATION, "latitude", "longitude")


def _keyed(requests: DataFrame) -> DataFrame:
    return requests.where(coordinate_ok()).withColumn(
        LOCATION, values.location_key(F.col("latitude"), F.col("longitude"))
    )


ALONE = "trail_alone"


def requested_rows(requests: DataFrame, series: DataFrame, trails: bool = False) -> DataFrame:
    """Series rows of each valid request, both ends of its date range included.

    A request without rows keeps one row without a date.  ``series`` holds one row per
    location and date, so the rows of a request are bounded by its dates; a location
    that most requests ask for is cut into parts by request.

    With ``trails`` the rows also carry what ``request_features`` then works from: trailing
    statistics are the place's, made once however many requests share them, and the rows of
    a request need not meet again.  ``series`` needs smoothed values for that.  Requests that
    repeat an id are one series to ``request_features``, and are marked.
    """
    columns = [c for c in (DATE, RAW_VALUE, SMOOTH_VALUE) if c in series.columns]
    asked = _keyed(requests)
    if trails:
        series = add_trails(series.select(LOCATION, *columns))
        columns = series.columns[1:]
        asked = _mark_alone(asked)
    within = F.col(f"r.{DATE}").between(F.col("l.start_date"), F.col("l.end_date"))
    return salted_join(asked, series.select(LOCATION, *columns), LOCATION, [REQUEST], within, "left")


def _mark_alone(requests: DataFrame) -> DataFrame:
    """Add whether no other request has the id."""
    counts = requests.groupBy(REQUEST).agg(F.count(F.lit(1)).alias("n"))
    repeated = stored(counts.where("n > 1").select(F.col(REQUEST).alias("_repeated"), F.lit(False).alias(ALONE)), "repeated")
    if repeated.isEmpty():
        return requests.withColumn(ALONE, F.lit(True))
    same = F.col(REQUEST).eqNullSafe(F.col("_repeated"))
    return requests.join(repeated, same, "left").drop("_repeated").withColumn(ALONE, F.coalesce(ALONE, F.lit(True)))


def requested_series(requests: DataFrame, series: DataFrame) -> DataFrame:
    """Each valid request with ``steps``, the (date, ndvi) of its range in date order.

    One row per location meets the requests, holding its steps by year, so no request is
    ever spread over rows and each looks only at the years it asks for.  The calendar
    bounds both the years and the steps of a year.
    """
    step = F.struct(DATE, score.greenness(series).alias("ndvi"))
    yearly = series.groupBy(LOCATION, F.year(DATE).alias("year")).agg(
        F.sort_array(F.collect_list(step)).alias("steps")
    )
    by_year = yearly.groupBy(LOCATION).agg(
        F.map_from_entries(F.collect_list(F.struct("year", "steps"))).alias("by_year")
    )
    joined = salted_join(_keyed(requests), by_year, LOCATION, [REQUEST], how="left")
    asked = F.sequence(F.year("start_date"), F.year("end_date"), F.lit(1))
    found = F.filter(
        F.transform(asked, lambda y: F.try_element_at("by_year", y)), lambda s: s.isNotNull()
    )
    within = F.filter(
        F.flatten(found),
        lambda s: s[DATE].between(F.col("start_date"), F.col("end_date")),
    )
    forward = F.col("start_date") <= F.col("end_date")
    return joined.withColumn(
        "steps", F.coalesce(F.when(forward, within), F.array())
    ).drop("by_year")


def request_features(rows: DataFrame) -> DataFrame:
    """Scoring features over the rows of each request alone."""
    if ALONE in rows.columns:
        shared = trail_features(rows.where(ALONE).drop(ALONE), "start_date")
        plain = rows.where(~F.col(ALONE)).drop(*[c for c in rows.columns if c.startswith("trail")])
        return shared.unionByName(request_features(plain))
    one_series = rows.withColumn("_place", F.col(LOCATION)).withColumn(
        LOCATION, F.col(REQUEST)
    )
    return scoring_features(one_series).withColumn(LOCATION, F.col("_place")).drop("_place")


def _rule_answers(asked: DataFrame) -> DataFrame:
    def predicted(step: Column) -> Column:
        probability = values.rule_probability(step["ndvi"], F.month(step[DATE]))
        return F.struct(
            step[DATE].alias(DATE),
            probability.alias("bloom_probability"),
            values.rule_flag(probability).alias("bloom_predicted"),
            step["ndvi"].alias("ndvi"),
        )

    answers = asked.withColumn(
        "predictions", F.transform("steps", predicted).cast(PREDICTIONS)
    )
    p = F.col("predictions")
    likely = F.filter(p, lambda x: x["bloom_probability"] > score.ONSET_LEVEL)
    total = F.aggregate(p, F.lit(0.0), lambda a, x: a + x["bloom_probability"])
    return answers.select(
        *ANSWER_KEY, "predictions",
        F.array_min(F.transform(likely, lambda x: x[DATE])).alias("predicted_onset_date"),
        F.try_divide(total, F.size(p)).alias("confidence"),
    )


def _answers(rows: DataFrame) -> DataFrame:
    has_row = F.col(DATE).isNotNull()
    step = F.struct(DATE, "bloom_probability", "bloom_predicted", "ndvi")
    return rows.groupBy(*ANSWER_KEY).agg(
        F.sort_array(F.collect_list(F.when(has_row, step))).cast(PREDICTIONS)
        .alias("predictions"),
        score.probable_onset().alias("predicted_onset_date"),
        F.avg(F.when(has_row, F.col("bloom_probability"))).alias("confidence"),
    )


def score_requests(
    requests: DataFrame, series: DataFrame, model: BloomModel | None = None
) -> DataFrame:
    """One answer per valid request: predictions by date, onset date, confidence.

    Without a model the rule scores.  A regression model answers with the date whose day
    of the year is nearest to its first prediction and a fixed confidence.
    """
    if model is None:
        return _rule_answers(requested_series(requests, series))
    rows = requested_rows(requests, series)
    if SMOOTH_VALUE not in rows.columns:
        rows = rows.withColumn(SMOOTH_VALUE, F.col(RAW_VALUE))
    keep = [*ANSWER_KEY, DATE, SMOOTH_VALUE]
    scored = predict(model, request_features(rows), keep).withColumnRenamed(
        SMOOTH_VALUE, "ndvi"
    )
    if model.task == "classification":
        return _answers(scored.withColumns({
            "bloom_probability": F.col("score"),
            "bloom_predicted": F.col("prediction") == 1,
        }))
    return _regression_answers(scored)


def _regression_answers(scored: DataFrame) -> DataFrame:
    has_row = F.col(DATE).isNotNull()
    step = F.struct(DATE, F.col("score").alias("predicted_onset_doy"), "ndvi")
    packed = scored.groupBy(*ANSWER_KEY).agg(
        F.sort_array(F.collect_list(F.when(has_row, step))).alias("predictions")
    )
    # a request's rows are bounded by its dates, so the answer comes from the array
    target = F.get("predictions", F.lit(0))["predicted_onset_doy"]
    ranked = F.transform("predictions", lambda p: F.struct(
        F.abs(F.dayofyear(p[DATE]) - target).alias("away"), p[DATE].alias(DATE)
    ))
    return packed.withColumns({
        "predicted_onset_date": F.array_min(ranked)[DATE],
        "confidence": F.when(F.size("predictions") > 0, F.lit(score.REGRESSION_CONFIDENCE)),
    })


def prediction_export(answers: DataFrame) -> DataFrame:
    """One flat row per request and date; fields a model does not give are 0 or false."""
    flat = answers.select(
        REQUEST, "latitude", "longitude", F.explode("predictions").alias("p")
    )
    present = answers.schema["predictions"].dataType.elementType.names
    defaults = {
        "ndvi": F.lit(0.0), "bloom_probability": F.lit(0.0),
        "bloom_predicted": F.lit(False), "predicted_onset_doy": F.lit(0.0),
    }
    return flat.select(
        REQUEST, F.col(f"p.{DATE}").alias(DATE), "latitude", "longitude",
        *[
            (F.coalesce(F.col(f"p.{c}"), d) if c in present else d).alias(c)
            for c, d in defaults.items()
        ],
    )
