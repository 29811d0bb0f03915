"""The registered queries stated in SQL, built up from named common tables."""

from __future__ import annotations

from collections.abc import Sequence

from ..schema import PHENOLOGY_BANDS
from ..operators.dataset import NOT_FEATURES

PI = "3.141592653589793"
TIES = "l_orderkey, l_linenumber, l_partkey"
WINDOWS = (3, 6, 12)
PERIODS = (1, 2, 3, 6, 12)

# Least-squares weights for five rows and a parabola, over 35, by place.
SAVGOL_5_2 = (
    (31, 9, -3, -5, 3),
    (9, 13, 12, 6, -5),
    (-3, 12, 17, 12, -3),
    (-5, 6, 12, 13, 9),
    (3, -5, -3, 9, 31),
)
# 42 times the least-squares weights of a cubic over seven points.
SAVGOL_7_3 = (
    (39, 8, -4, -4, 1, 4, -2),
    (8, 19, 16, 6, -4, -7, 4),
    (-4, 16, 19, 12, 2, -4, 1),
    (-4, 6, 12, 14, 12, 6, -4),
    (1, -4, 2, 12, 19, 16, -4),
    (4, -7, -4, 6, 16, 19, 8),
    (-2, 4, 1, -4, -4, 8, 39),
)

LAT = "CAST({k} * 37 % 181 - 90 AS DOUBLE)"
LON = "CAST({k} * 73 % 361 - 180 AS DOUBLE)"
KEY = "printf('%.4f_%.4f', latitude, longitude)"

RAW = f"""raw AS (
  SELECT {LAT.format(k='l_suppkey')} AS latitude, {LON.format(k='l_suppkey')} AS longitude,
         CAST(l_shipdate AS DATE) AS date,
         l_discount * 5 + l_extendedprice / 249971 AS ndvi_raw,
         l_linenumber % 4 AS quality, {TIES}
  FROM lineitem)"""
OBS = f"{RAW}, obs AS (SELECT *, {KEY} AS location_id FROM raw)"
EVENTS = f"""ev0 AS (
  SELECT {LAT.format(k='user_id')} AS latitude, {LON.format(k='user_id')} AS longitude,
         CAST(ts AS DATE) AS date, value / 499 AS ndvi_raw, event_id % 4 AS quality, event_id
  FROM events), ev AS (SELECT *, {KEY} AS location_id FROM ev0)"""


def resampled(source: str, name: str, unit: str = "month", step: str = "1 MONTH") -> str:
    return f"""{name}_cells AS (
  SELECT location_id, CAST(date_trunc('{unit}', date) AS DATE) AS period,
         avg(ndvi_raw) AS mean, count(*) AS n,
         min(latitude) AS lat, min(longitude) AS lon
  FROM {source} GROUP BY 1, 2),
{name}_span AS (
  SELECT location_id, CAST(min(period) AS TIMESTAMP) AS lo, CAST(max(period) AS TIMESTAMP) AS hi,
         arg_min(lat, period) AS latitude, arg_min(lon, period) AS longitude
  FROM {name}_cells GROUP BY 1 HAVING sum(n) >= 2),
{name}_grid AS (
  SELECT location_id, latitude, longitude,
         CAST(unnest(generate_series(lo, hi, INTERVAL {step})) AS DATE) AS date
  FROM {name}_span),
{name} AS (
  SELECT g.location_id, g.latitude, g.longitude, g.date, c.mean AS ndvi_raw
  FROM {name}_grid g LEFT JOIN {name}_cells c
    ON c.location_id = g.location_id AND c.period = g.date)"""


MONTHLY = f"{OBS}, {resampled('obs', 'monthly')}"
UNSMOOTHED = f"{MONTHLY}, series AS (SELECT *, ndvi_raw AS ndvi_smoothed FROM monthly)"
GAPPY = f"""{MONTHLY}, gappy AS (
  SELECT location_id, latitude, longitude, date,
         CASE WHEN ndvi_raw < 0.4 THEN NULL ELSE ndvi_raw END AS ndvi_raw
  FROM monthly)"""


def filtered(source: str, name: str) -> str:
    return f"""{name}_near AS (
  SELECT *, lag(ndvi_raw) OVER o AS before, lead(ndvi_raw) OVER o AS after,
         count(*) OVER (PARTITION BY location_id) AS n
  FROM {source} WINDOW o AS (PARTITION BY location_id ORDER BY date, {TIES}, ndvi_raw)),
{name} AS (
  SELECT * FROM {name}_near
  WHERE NOT (n >= 3 AND before IS NOT NULL AND abs(ndvi_raw - before) > 0.3 AND abs(
    ndvi_raw - (before + ndvi_raw + coalesce(after, 0)) /
      CAST(2 + CASE WHEN after IS NULL THEN 0 ELSE 1 END AS DOUBLE)) > 0.3))"""


def smoothed(source: str, name: str, weights: Sequence[Sequence[float]], over: float = 1) -> str:
    """Places in a list of the valid values; ``name`` has ``ndvi_smoothed``, NULL for gaps."""
    span = len(weights)
    half = span // 2
    places = " ".join(
        f"WHEN {p} THEN (" + " + ".join(
            f"({w!r}) * vals[base + {j + 1}]" for j, w in enumerate(row)
        ) + f") / CAST({over} AS DOUBLE)"
        for p, row in enumerate(weights)
    )
    return f"""{name}_list AS (
  SELECT location_id, list(ndvi_raw ORDER BY date) AS vals, count(*) AS n
  FROM {source} WHERE ndvi_raw IS NOT NULL GROUP BY 1),
{name}_at AS (
  SELECT s.*, l.vals, l.n,
         count(ndvi_raw) OVER (PARTITION BY s.location_id ORDER BY date) - 1 AS i
  FROM {source} s LEFT JOIN {name}_list l ON l.location_id = s.location_id),
{name}_base AS (
  SELECT *, greatest(0, least(i - {half}, n - {span})) AS base FROM {name}_at),
{name} AS (
  SELECT location_id, latitude, longitude, date, ndvi_raw,
         CASE WHEN ndvi_raw IS NULL OR n < {span} THEN ndvi_raw
              ELSE CASE i - base {places} END END AS ndvi_smoothed
  FROM {name}_base)"""


PROCESSED = f"""{OBS}, {filtered('obs', 'kept')}, {resampled('kept', 'grid')},
{smoothed('grid', 'processed', SAVGOL_5_2, 35)}"""

CALENDAR = f"""CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
  CAST(dayofyear(date) AS INTEGER) AS day_of_year, CAST(weekofyear(date) AS INTEGER) AS week_of_year,
  sin(2 * {PI} * month(date) / 12) AS month_sin, cos(2 * {PI} * month(date) / 12) AS month_cos,
  sin(2 * {PI} * dayofyear(date) / 365.25) AS doy_sin,
  cos(2 * {PI} * dayofyear(date) / 365.25) AS doy_cos,
  CAST(month(date) IN (3, 4, 5) AS INTEGER) AS is_spring,
  CAST(month(date) IN (6, 7, 8) AS INTEGER) AS is_summer,
  CAST(month(date) IN (9, 10, 11) AS INTEGER) AS is_autumn,
  CAST(month(date) IN (12, 1, 2) AS INTEGER) AS is_winter"""
CALENDAR_DOUBLES = ("month_sin", "month_cos", "doy_sin", "doy_cos")
CALENDAR_INTS = (
    "year", "month", "day_of_year", "week_of_year",
    "is_spring", "is_summer", "is_autumn", "is_winter",
)
CLIMATE = """abs(latitude) AS latitude_abs,
  CAST(abs(latitude) < 23.5 AS INTEGER) AS is_tropical,
  CAST(abs(latitude) >= 23.5 AND abs(latitude) < 66.5 AS INTEGER) AS is_temperate,
  CAST(abs(latitude) >= 66.5 AS INTEGER) AS is_polar, 0 AS elevation"""
CLIMATE_INTS = ("is_tropical", "is_temperate", "is_polar", "elevation")


def rolling(v: str, windows=WINDOWS, stats=("mean", "std", "min", "max", "slope")) -> str:
    calls = {
        "mean": "avg({v}) {w}", "std": "stddev_samp({v}) {w}",
        "min": "min({v}) {w}", "max": "max({v}) {w}",
        "slope": "CASE WHEN count({v}) {w} >= 2 THEN regr_slope({v}, pos) {w} END",
    }
    frame = ("OVER (PARTITION BY location_id ORDER BY date "
             "ROWS BETWEEN {n} PRECEDING AND CURRENT ROW)")
    return ", ".join(
        calls[s].format(v=v, w=frame.format(n=n - 1)) + f" AS ndvi_{s}_{n}"
        for n in windows for s in stats
    )


def rolling_names(windows=WINDOWS, stats=("mean", "std", "min", "max", "slope")) -> list[str]:
    return [f"ndvi_{s}_{n}" for n in windows for s in stats]


def lags(v: str, periods=PERIODS) -> str:
    return ", ".join(
        f"lag({v}, {k}) OVER (PARTITION BY location_id ORDER BY date) AS ndvi_lag_{k}, "
        f"{v} - lag({v}, {k}) OVER (PARTITION BY location_id ORDER BY date) AS ndvi_diff_{k}"
        for k in periods
    )


def lag_names(periods=PERIODS) -> list[str]:
    return [f"ndvi_{s}_{k}" for s in ("lag", "diff") for k in periods]


def peaks(source: str, name: str, v: str) -> str:
    """``name`` adds is_peak and days_since_peak; every window is searched by a self-join."""
    return f"""{name}_pos AS (
  SELECT *, row_number() OVER (PARTITION BY location_id ORDER BY date) AS place FROM {source}),
{name}_tops AS (
  SELECT a.location_id, a.place
  FROM {name}_pos a JOIN {name}_pos b
    ON b.location_id = a.location_id AND b.place BETWEEN a.place - 2 AND a.place + 2
  GROUP BY a.location_id, a.place, a.{v}
  HAVING count(*) = 5 AND a.{v} = max(b.{v}) AND a.{v} > 0.5),
{name}_valid AS (
  SELECT location_id, place,
         count({v}) OVER (PARTITION BY location_id ORDER BY date
                          ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS v5,
         count({v}) OVER (PARTITION BY location_id ORDER BY date
                          ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS v12
  FROM {name}_pos),
{name}_last AS (
  SELECT p.location_id, p.place, max(t.place) AS top
  FROM {name}_pos p JOIN {name}_tops t
    ON t.location_id = p.location_id AND t.place BETWEEN p.place - 9 AND p.place - 2
  GROUP BY 1, 2),
{name} AS (
  SELECT p.* EXCLUDE (place),
         CASE WHEN w.v5 >= 3 THEN CASE WHEN t.place IS NULL THEN 0 ELSE 1 END END AS is_peak,
         CASE WHEN w.v12 >= 6 THEN CAST(p.place - l.top AS INTEGER) END AS days_since_peak
  FROM {name}_pos p
  JOIN {name}_valid w ON w.location_id = p.location_id AND w.place = p.place
  LEFT JOIN {name}_tops t ON t.location_id = p.location_id AND t.place = p.place - 2
  LEFT JOIN {name}_last l ON l.location_id = p.location_id AND l.place = p.place)"""


def full_features(source: str, name: str) -> str:
    """``name`` holds the base columns, the 47 features and the count of missing ones."""
    feature_list = [
        *CALENDAR_INTS, *CALENDAR_DOUBLES, *rolling_names(), *lag_names(), "is_peak",
        "days_since_peak", "latitude_abs", *CLIMATE_INTS, *INTERACTIONS,
    ]
    missing = " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in feature_list)
    return f"""{peaks(source, name + '_peaks', 'ndvi_smoothed')},
{name}_rows AS (
  SELECT *, row_number() OVER (PARTITION BY location_id ORDER BY date) AS pos
  FROM {name}_peaks),
{name}_wide AS (
  SELECT *, {CALENDAR}, {CLIMATE}, {rolling('ndvi_smoothed')}, {lags('ndvi_smoothed')}
  FROM {name}_rows),
{name}_all AS (
  SELECT *, ndvi_smoothed * month AS ndvi_month_interaction,
         ndvi_smoothed * latitude AS ndvi_lat_interaction,
         ndvi_mean_3 * ndvi_slope_3 AS mean_slope_interaction
  FROM {name}_wide),
{name} AS (SELECT *, {missing} AS missing FROM {name}_all)"""


INTERACTIONS = ("ndvi_month_interaction", "ndvi_lat_interaction", "mean_slope_interaction")
BASE = ("location_id", "date")


def out(ctes: str, source: str, plain: Sequence[str] = BASE, doubles: Sequence[str] = (),
        where: str = "") -> str:
    """Final projection: doubles to six digits, without negative zero."""
    columns = [*plain, *[f"round({c}, 6) + 0.0 AS {c}" for c in doubles]]
    tail = f" WHERE {where}" if where else ""
    return f"WITH {ctes}\nSELECT {', '.join(columns)} FROM {source}{tail}"


JUMPS = """jump_years AS (
  SELECT *, CAST(year(date) AS INTEGER) AS year,
         count(*) OVER (PARTITION BY location_id, year(date)) AS rows_in_year
  FROM monthly),
jump_spring AS (
  SELECT location_id, year, date, ndvi_raw,
         ndvi_raw - lag(ndvi_raw) OVER o AS jump, row_number() OVER o - 1 AS place,
         count(*) OVER (PARTITION BY location_id, year)
           = count(ndvi_raw) OVER (PARTITION BY location_id, year) AS whole
  FROM jump_years WHERE rows_in_year >= 6 AND month(date) IN (3, 4, 5, 6)
  WINDOW o AS (PARTITION BY location_id, year ORDER BY date)),
jump_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY location_id, year ORDER BY jump DESC, date) AS rank
  FROM jump_spring WHERE whole AND jump IS NOT NULL),
jump_place AS (
  SELECT location_id, arg_min(latitude, date) AS latitude, arg_min(longitude, date) AS longitude
  FROM monthly GROUP BY 1),
jumps AS (
  SELECT r.location_id, r.year, r.date AS onset_date, CAST(r.place AS INTEGER) AS onset_index,
         least(1.0, r.jump / 0.3) AS label_quality_score, p.latitude, p.longitude
  FROM jump_ranked r JOIN jump_place p ON p.location_id = r.location_id
  WHERE r.rank = 1 AND r.jump > 0.1)"""
LABELLED = f"{UNSMOOTHED}, {JUMPS}"
TRAIN = f"""{LABELLED}, small AS (
  SELECT *, CAST(year(date) AS INTEGER) AS year,
         {rolling('ndvi_smoothed', (3,), ('mean',))} FROM series)"""
TRAIN_CLS = f"""{TRAIN}, cls AS (
  SELECT s.location_id, s.date, s.year, s.ndvi_mean_3, j.label_quality_score,
         CAST(j.label_quality_score IS NOT NULL AS INTEGER) AS bloom_label
  FROM small s LEFT JOIN jumps j ON j.location_id = s.location_id AND j.year = s.year)"""
TRAIN_REG = f"""{TRAIN}, reg AS (
  SELECT s.location_id, s.date, s.year, s.ndvi_mean_3, j.label_quality_score, j.onset_date,
         CAST(dayofyear(j.onset_date) AS INTEGER) AS onset_doy, s.ndvi_raw
  FROM small s JOIN jumps j ON j.location_id = s.location_id AND j.year = s.year)"""


def rule(v: str, date: str = "date") -> str:
    bonus = f"CASE WHEN month({date}) IN (3, 4, 5, 6) THEN 0.2 ELSE 0.0 END"
    score = f"least(CAST(0.9 AS DOUBLE), greatest(CAST(0.1 AS DOUBLE), {v} * 0.8 + {bonus}))"
    return f"CASE WHEN {v} IS NULL THEN CAST(0.1 AS DOUBLE) ELSE {score} END"


SCORED = f"""{UNSMOOTHED}, scored AS (
  SELECT location_id, date, ndvi_smoothed AS ndvi,
         {rule('ndvi_smoothed')} AS bloom_probability,
         {rule('ndvi_smoothed')} > 0.6 AS bloom_predicted
  FROM series)"""
JUDGED = f"""{LABELLED}, judged AS (
  SELECT CAST(j.year IS NOT NULL AS INTEGER) AS label,
         CAST({rule('s.ndvi_smoothed', 's.date')} > 0.6 AS INTEGER) AS prediction,
         round({rule('s.ndvi_smoothed', 's.date')}, 4) AS score
  FROM series s LEFT JOIN jumps j ON j.location_id = s.location_id AND j.year = year(s.date)
  WHERE s.ndvi_smoothed IS NOT NULL)"""
COUNTS = f"""{JUDGED}, c AS (
  SELECT CAST(count(*) FILTER (label = 1 AND prediction = 1) AS DOUBLE) AS tp,
         CAST(count(*) FILTER (label = 0 AND prediction = 1) AS DOUBLE) AS fp,
         CAST(count(*) FILTER (label = 1 AND prediction = 0) AS DOUBLE) AS fn,
         CAST(count(*) FILTER (label = 0 AND prediction = 0) AS DOUBLE) AS tn
  FROM judged)"""
CLS_METRICS = f"""{COUNTS}, m AS (
  SELECT (tp + tn) / (tp + fp + fn + tn) AS accuracy,
         coalesce(tp / nullif(tp + fp, 0), 0) AS "precision",
         coalesce(tp / nullif(tp + fn, 0), 0) AS recall,
         coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1 FROM c)"""
STEPS = f"""{JUDGED}, steps AS (
  SELECT score AS threshold, CAST(sum(label) AS DOUBLE) AS pos,
         CAST(sum(1 - label) AS DOUBLE) AS neg
  FROM judged GROUP BY 1),
running AS (
  SELECT *, sum(pos) OVER (ORDER BY threshold DESC) AS tp,
         sum(neg) OVER (ORDER BY threshold DESC) AS fp,
         sum(pos) OVER () AS all_pos, sum(neg) OVER () AS all_neg
  FROM steps),
points AS (
  SELECT threshold, fp / all_neg AS fpr, tp / all_pos AS tpr, tp / (tp + fp) AS "precision",
         tp / all_pos AS recall FROM running)"""
AREAS = f"""{STEPS},
roc AS (
  SELECT fpr, tpr, lag(fpr, 1, 0.0) OVER o AS fpr0, lag(tpr, 1, 0.0) OVER o AS tpr0,
         recall, "precision", lag(recall, 1, 0.0) OVER o AS recall0,
         lag("precision", 1, 1.0) OVER o AS precision0
  FROM points WINDOW o AS (ORDER BY threshold DESC)),
areas AS (
  SELECT sum((fpr - fpr0) * (tpr + tpr0) / 2) AS roc_auc,
         sum((recall - recall0) * ("precision" + precision0) / 2) AS pr_auc FROM roc)"""
GUESSED = f"""{TRAIN_REG}, guessed AS (
  SELECT location_id, date, onset_doy AS label, round(ndvi_raw * 120, 3) + 60 AS prediction,
         onset_doy - (round(ndvi_raw * 120, 3) + 60) AS residual
  FROM reg WHERE ndvi_raw IS NOT NULL)"""
REG_METRICS = f"""{GUESSED}, m AS (
  SELECT avg(abs(residual)) AS mae, avg(residual * residual) AS mse,
         sqrt(avg(residual * residual)) AS rmse,
         1 - avg(residual * residual) / var_pop(label) AS r2,
         avg(abs(residual / label)) * 100 AS mape FROM guessed)"""

PIXELS = """pixels AS (
  SELECT CASE WHEN l_linenumber % 2 = 1 THEN 'MOD13A2' ELSE 'VNP13A1' END AS product,
         l_partkey % 1000 * CAST(0.013 AS DOUBLE) - 60 AS latitude,
         l_suppkey % 1000 * CAST(0.017 AS DOUBLE) + 100 AS longitude,
         CAST(date_trunc('quarter', CAST(l_shipdate AS DATE)) AS DATE) AS date,
         l_discount * 50000 + l_extendedprice * 0.04 AS NDVI
  FROM lineitem)"""


def phenology_band(i: int) -> str:
    cycle = i % 4 + 1
    days = f"(o_orderkey * {i // 4 + 3} + o_custkey * {cycle * 17}) % 480"
    return f"CASE WHEN (o_orderkey + {cycle}) % 5 <> 0 THEN CAST({days} AS DOUBLE) END"


PHENOLOGY = f"""phen AS (
  SELECT o_custkey % 500 * CAST(0.011 AS DOUBLE) + 10 AS latitude,
         o_orderkey % 700 * CAST(0.013 AS DOUBLE) + 20 AS longitude,
         CAST(date_trunc('year', CAST(o_orderdate AS DATE)) AS DATE) AS date,
         {', '.join(f'{phenology_band(i)} AS {b}' for i, b in enumerate(PHENOLOGY_BANDS))}
  FROM orders)"""


def grid(source: str, name: str) -> str:
    return f"""{name}_box AS (
  SELECT min(longitude) AS west, min(latitude) AS south,
         CAST(floor((max(longitude) - min(longitude)) / CAST(0.1 AS DOUBLE) + 1e-9) AS BIGINT) AS nx,
         CAST(floor((max(latitude) - min(latitude)) / CAST(0.1 AS DOUBLE) + 1e-9) AS BIGINT) AS ny
  FROM {source}),
{name} AS (
  SELECT x AS grid_x, y AS grid_y, y * CAST(0.1 AS DOUBLE) + south AS latitude,
         x * CAST(0.1 AS DOUBLE) + west AS longitude
  FROM {name}_box, range(0, nx + 1) rx(x), range(0, ny + 1) ry(y))"""


def nearest(pixels: str, grid_name: str, reach_m: float, values: Sequence[str]) -> str:
    """Every pixel within reach of a point, ranked by distance."""
    reach = f"CAST({reach_m} AS DOUBLE) / 111320.0"
    return f"""offers AS (
  SELECT g.latitude, g.longitude, p.date, {', '.join('p.' + v for v in values)},
         row_number() OVER (
           PARTITION BY g.grid_x, g.grid_y, p.date
           ORDER BY (p.latitude - g.latitude) * (p.latitude - g.latitude)
             + (p.longitude - g.longitude) * cos(radians(g.latitude))
             * ((p.longitude - g.longitude) * cos(radians(g.latitude))),
             p.latitude, p.longitude, {', '.join(f'p.{v} NULLS FIRST' for v in values)}) AS rank
  FROM {grid_name} g JOIN {pixels} p
    ON p.latitude BETWEEN g.latitude - {reach} AND g.latitude + {reach}
   AND p.longitude BETWEEN g.longitude - {reach} AND g.longitude + {reach})"""


POLAR = """polar AS (
  SELECT latitude, CASE WHEN east > 180 THEN east - 360 ELSE east END AS longitude, date, ndvi_raw
  FROM (SELECT l_partkey * 7 % 1000 * CAST(0.013 AS DOUBLE) + CAST(76.5 AS DOUBLE) AS latitude,
               l_suppkey * 37 % 1000 * CAST(0.017 AS DOUBLE) + 172 AS east,
               CAST(date_trunc('quarter', CAST(l_shipdate AS DATE)) AS DATE) AS date,
               l_discount * 5 + l_extendedprice * CAST(0.000004 AS DOUBLE) AS ndvi_raw
        FROM lineitem WHERE l_linenumber % 2 = 1)),
points AS (
  SELECT x AS grid_x, y AS grid_y, y * CAST(0.1 AS DOUBLE) + CAST(76.5 AS DOUBLE) AS latitude,
         x * CAST(0.1 AS DOUBLE) + 172 AS longitude FROM range(0, 171) rx(x), range(0, 131) ry(y))"""


def within(pixels: str, points: str, reach_m: float, values: Sequence[str]) -> str:
    """Every pixel within reach of a point by haversine distance, ranked; points of a row near
    the pixel's latitude are all tried."""
    return f"""tried AS (
  SELECT g.grid_x, g.grid_y, g.latitude, g.longitude, p.date, p.latitude AS lat, p.longitude AS lon,
         {', '.join('p.' + v for v in values)},
         round(2 * CAST(6371008.8 AS DOUBLE) * asin(sqrt(least(1.0,
           pow(sin(radians(p.latitude - g.latitude) / 2), 2) + cos(radians(p.latitude))
           * cos(radians(g.latitude)) * pow(sin(radians(p.longitude - g.longitude) / 2), 2)))), 3) AS metres
  FROM {points} g JOIN {pixels} p
    ON g.latitude BETWEEN p.latitude - {reach_m / 111_000} AND p.latitude + {reach_m / 111_000}),
served AS (
  SELECT latitude, CASE WHEN longitude > 180 THEN longitude - 360 ELSE longitude END AS longitude,
         date, metres, {', '.join(values)},
         row_number() OVER (PARTITION BY grid_x, grid_y, date ORDER BY metres, lat, lon,
           {', '.join(f'{v} NULLS FIRST' for v in values)}) AS rank
  FROM tried WHERE metres <= {reach_m})"""


REQUESTS = f"""req AS (
  SELECT o_orderkey AS request_id,
         CASE WHEN o_custkey % 97 = 0 THEN 95.0 ELSE {LAT.format(k='k')} END AS latitude,
         {LON.format(k='k')} AS longitude, CAST(o_orderdate AS DATE) AS start_date,
         CAST(o_orderdate AS DATE) + 180 AS end_date
  FROM (SELECT *, o_orderkey % (SELECT max(s_suppkey) + 1 FROM supplier) AS k FROM orders))"""
REQUESTED = f"""{UNSMOOTHED}, {REQUESTS}, asked AS (
  SELECT request_id, {KEY} AS location_id, latitude, longitude, start_date, end_date
  FROM req WHERE latitude BETWEEN -90 AND 90),
answered AS (
  SELECT a.request_id, a.location_id, a.latitude, a.longitude, s.date, s.ndvi_smoothed AS ndvi,
         {rule('s.ndvi_smoothed', 's.date')} AS bloom_probability
  FROM asked a LEFT JOIN series s
    ON s.location_id = a.location_id AND s.date BETWEEN a.start_date AND a.end_date)"""


def interpolated(axis: str, value: str) -> str:
    place = {
        "position": "row_number() OVER (PARTITION BY location_id ORDER BY date)",
        "time": "date - DATE '1970-01-01'",
    }[axis]
    return f"""placed AS (
  SELECT *, {place} AS x, count(ndvi_raw) OVER (PARTITION BY location_id) AS n,
         count(ndvi_raw) OVER (PARTITION BY location_id ORDER BY date) AS seen
  FROM gappy),
valid AS (SELECT location_id, x, ndvi_raw AS v, seen AS k FROM placed WHERE ndvi_raw IS NOT NULL),
segments AS (
  SELECT p.*, a.x AS ax, a.v AS av, b.x AS bx, b.v AS bv
  FROM placed p
  LEFT JOIN valid a ON a.location_id = p.location_id AND a.k = greatest(1, least(p.seen, p.n - 1))
  LEFT JOIN valid b ON b.location_id = p.location_id AND b.k = a.k + 1),
filled AS (
  SELECT location_id, latitude, longitude, date,
         CASE WHEN ndvi_raw IS NOT NULL OR n < 2 THEN ndvi_raw ELSE {value} END AS ndvi_raw
  FROM segments)"""


LINE = "av + (bv - av) / (bx - ax) * (x - ax)"
NEAREST = "CASE WHEN abs(x - ax) <= abs(bx - x) THEN av ELSE bv END"
PLACES = ("latitude", "longitude")


def candidates(per_year: bool) -> str:
    """Every fifth place as a candidate, judged by windows over the places."""
    group = "location_id, year(date)" if per_year else "location_id"
    return f"""placed AS (
  SELECT *, row_number() OVER o - 1 AS place, count(*) OVER (PARTITION BY location_id) AS n,
         avg(ndvi_raw) OVER (o ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS pre2,
         avg(ndvi_raw) OVER (o ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS post2,
         avg(ndvi_raw) OVER (o ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS pre_onset_ndvi,
         avg(ndvi_raw) OVER (o ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING) AS post_onset_ndvi,
         max(ndvi_raw) OVER (PARTITION BY location_id) AS peak_ndvi
  FROM gappy WINDOW o AS (PARTITION BY location_id ORDER BY date)),
peaked AS (
  SELECT location_id, min(place) AS peak_index FROM placed WHERE ndvi_raw = peak_ndvi GROUP BY 1),
cands AS (SELECT *, month(date) IN (3, 4, 5, 6) AS spring FROM placed WHERE place % 5 = 0),
pool AS (
  SELECT *, bool_or(spring) OVER (PARTITION BY {group}) AS any_spring,
         min(place) OVER (PARTITION BY {group}) AS first_place FROM cands),
ranked AS (
  SELECT *, least(1.0, (post2 - pre2) / 0.3) AS label_quality_score,
         row_number() OVER (
           PARTITION BY {group} ORDER BY least(1.0, (post2 - pre2) / 0.3) DESC, place) AS rank
  FROM pool
  WHERE (spring OR (NOT any_spring AND place = first_place)) AND n >= 6 AND place < n - 1
    AND post2 - pre2 >= 0.03),
onsets AS (
  SELECT r.location_id, CAST(year(r.date) AS INTEGER) AS year, r.date AS onset_date,
         CAST(r.place AS INTEGER) AS onset_index, r.label_quality_score, r.latitude, r.longitude,
         r.pre_onset_ndvi, r.post_onset_ndvi, r.post_onset_ndvi - r.pre_onset_ndvi AS ndvi_increase,
         r.peak_ndvi, CAST(p.peak_index AS INTEGER) AS peak_index, r.ndvi_raw AS onset_ndvi
  FROM ranked r LEFT JOIN peaked p ON p.location_id = r.location_id WHERE r.rank = 1)"""


ONSET_PLAIN = ("location_id", "year", "onset_date", "onset_index", "peak_index")
ONSET_DOUBLES = (
    "label_quality_score", "latitude", "longitude", "pre_onset_ndvi", "post_onset_ndvi",
    "ndvi_increase", "peak_ndvi", "onset_ndvi",
)


def phenology_labels(epoch: bool) -> str:
    shift = "(date - DATE '1970-01-01')" if epoch else "0"
    high = 32766 if epoch else 366

    def days(phase: str) -> str:
        listed = ", ".join(f"CAST(trunc({phase}_{c}) AS INTEGER) + {shift}" for c in (1, 2, 3, 4))
        return f"list_filter([{listed}], lambda d: d BETWEEN 1 AND {high})"

    dated = "DATE '1970-01-01' + {0}" if epoch else "DATE '2020-01-01' + ({0} - 1)"
    onset = f"({dated.format('CAST(list_min(g) AS INTEGER)')})"
    peak = (f"dayofyear({dated.format('CAST(list_min(p) AS INTEGER)')})" if epoch
            else "list_min(p)")
    year = f"year({onset})" if epoch else "2020"
    return f"""{PHENOLOGY}, days AS (
  SELECT latitude, longitude, {days('Greenup')} AS g, {days('Peak')} AS p FROM phen),
labels_ AS (
  SELECT {KEY} AS location_id, CAST({year} AS INTEGER) AS year, {onset} AS onset_date,
         CAST(dayofyear({onset}) AS INTEGER) AS onset_doy, CAST({peak} AS INTEGER) AS peak_doy,
         len(g) / 4 AS label_quality_score, latitude, longitude, 'MCD12Q2' AS data_source
  FROM days WHERE len(g) > 0)"""


def counted_features() -> str:
    names = [
        "year", "month", "day_of_year", "week_of_year", *CALENDAR_DOUBLES,
        "is_spring", "is_summer", "is_autumn", "is_winter", *rolling_names(), *lag_names(),
        "is_peak", "days_since_peak", "latitude_abs", *CLIMATE_INTS, *INTERACTIONS,
    ]
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, count({c}) AS non_null, count(*) AS total_rows "
        "FROM feats WHERE missing < 23.5" for c in names
    )


def _report() -> str:
    per_class = """SELECT '0' AS class, tn AS hit, fn AS wrong, fp AS missed FROM c
  UNION ALL SELECT '1', tp, fp, fn FROM c"""
    return f"""WITH {COUNTS}, classes AS (
  SELECT class, coalesce(hit / nullif(hit + wrong, 0), 0) AS "precision",
         coalesce(hit / nullif(hit + missed, 0), 0) AS recall,
         coalesce(2 * hit / nullif(2 * hit + wrong + missed, 0), 0) AS f1,
         hit + missed AS support
  FROM ({per_class}) WHERE hit + wrong + missed > 0),
rows_ AS (
  SELECT * FROM classes
  UNION ALL SELECT 'accuracy', accuracy, accuracy, accuracy, support FROM (
    SELECT (tp + tn) / (tp + tn + fp + fn) AS accuracy, tp + tn + fp + fn AS support FROM c)
  UNION ALL SELECT 'macro avg', avg("precision"), avg(recall), avg(f1), sum(support) FROM classes
  UNION ALL SELECT 'weighted avg', sum("precision" * support) / sum(support),
    sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support)
  FROM classes)
SELECT class, CAST(support AS BIGINT) AS support, round("precision", 6) + 0.0 AS "precision",
       round(recall, 6) + 0.0 AS recall, round(f1, 6) + 0.0 AS f1 FROM rows_"""


def _histogram() -> str:
    return f"""WITH {GUESSED}, ends AS (
  SELECT min(residual) AS lo, max(residual) AS hi FROM guessed),
placed AS (
  SELECT least(floor((residual - lo) / (hi - lo) * 30), 29) AS bin, count(*) AS rows_
  FROM guessed, ends GROUP BY 1)
SELECT b.i AS bin, round(lo + b.i * ((hi - lo) / 30), 6) + 0.0 AS bin_low,
       round(lo + (b.i + 1) * ((hi - lo) / 30), 6) + 0.0 AS bin_high,
       coalesce(rows_, 0) AS rows
FROM range(0, 30) b(i) CROSS JOIN ends LEFT JOIN placed p ON p.bin = b.i"""


def _curve(columns: Sequence[str], extra: Sequence[str]) -> str:
    picked = ", ".join(f'round("{c}", 6) + 0.0 AS "{c}"' for c in columns)
    added = ", ".join(f'{v} AS "{c}"' for c, v in zip(columns, extra))
    return f"""WITH {STEPS}
SELECT round(threshold, 6) + 0.0 AS threshold, {picked} FROM points
UNION ALL SELECT CAST(NULL AS DOUBLE) AS threshold, {added}"""


def _metric_rows() -> str:
    named = [("accuracy", "accuracy"), ("precision", '"precision"'), ("recall", "recall"),
             ("f1_score", "f1")]
    rows = " UNION ALL ".join(
        f"SELECT '{n}' AS metric, round({c}, 6) + 0.0 AS value FROM m" for n, c in named
    )
    return f"""WITH {CLS_METRICS}, {AREAS.split(JUDGED + ', ')[1]}
{rows} UNION ALL SELECT 'roc_auc', round(roc_auc, 6) + 0.0 FROM areas"""


def _long(part: str, item: str, threshold: str, measures: Sequence[str], source: str) -> str:
    """Rows of one table of a report, a row per measure."""
    return " UNION ALL ".join(
        f"SELECT '{part}' AS part, {item} AS item, round(CAST({threshold} AS DOUBLE), 6) + 0.0 AS threshold, "
        f"'{m}' AS measure, round(CAST(\"{m}\" AS DOUBLE), 6) + 0.0 AS value FROM {source}" for m in measures)


def _class_tables(sql: dict[str, str]) -> str:
    return " UNION ALL ".join((
        _long("metrics", "metric", "NULL", ("value",), f"({sql['evaluation_cls']})"),
        _long("confusion", "label || '/' || prediction", "NULL", ("rows",), f"({sql['confusion']})"),
        _long("class_report", '"class"', "NULL", ("precision", "recall", "f1", "support"), f"({sql['class_report']})"),
        _long("roc_points", "CAST(NULL AS VARCHAR)", "threshold", ("fpr", "tpr"), f"({sql['roc_points']})"),
        _long("pr_points", "CAST(NULL AS VARCHAR)", "threshold", ("precision", "recall"), f"({sql['pr_points']})"),
    ))


def _regression_tables(sql: dict[str, str]) -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{m}' AS metric, {m} AS value FROM ({sql['metrics_reg']})" for m in ("mae", "mse", "rmse", "r2"))
    return " UNION ALL ".join((
        _long("metrics", "metric", "NULL", ("value",), f"({rows})"),
        _long("residual_histogram", "CAST(bin AS VARCHAR)", "NULL", ("bin_low", "bin_high", "rows"),
              f"({sql['residual_hist']})"),
    ))


def _trailing() -> str:
    """Features over the monthly means, for months the watermark has closed."""
    return f"""{MONTHLY}, rows_ AS (
  SELECT *, ndvi_raw AS value, row_number() OVER (PARTITION BY location_id ORDER BY date) AS pos
  FROM monthly),
wide AS (SELECT *, {rolling('ndvi_raw')}, {lags('ndvi_raw')} FROM rows_),
newest AS (SELECT max(CAST(date_trunc('month', date) AS DATE)) AS m FROM obs)"""


def oracle_sql() -> dict[str, str]:
    scaled = "(CASE WHEN l_partkey % 11 <> 0 THEN l_discount * 400000 - 15000 END)"
    unclean = f"""stored AS (
  SELECT CASE WHEN l_linenumber <> 7 THEN {LAT.format(k='l_suppkey')} END AS latitude,
         {LON.format(k='l_suppkey')} AS longitude, CAST(l_shipdate AS DATE) AS date,
         {scaled} AS v, {TIES} FROM lineitem),
cleaned AS (
  SELECT {KEY} AS location_id, latitude, longitude, date, {TIES},
         greatest(CAST(-1 AS DOUBLE), least(CAST(1 AS DOUBLE),
           CASE WHEN (SELECT max(v) FROM stored) > 1 THEN v * 0.0001 ELSE v END)) AS ndvi_raw
  FROM stored WHERE latitude IS NOT NULL AND v IS NOT NULL)"""
    short = "(round_even(({0}) * 10000, 0) / 10000)"
    compact = f"""{RAW}, moved AS (
  SELECT CAST({short.format('latitude * CAST(0.9 AS DOUBLE) + l_partkey * CAST(0.000125 AS DOUBLE)')} AS VARCHAR) || '_' ||
         CAST({short.format('longitude')} AS VARCHAR) AS location_id, ndvi_raw FROM raw),
grouped AS (SELECT location_id, count(*) AS rows, avg(ndvi_raw) AS mean FROM moved GROUP BY 1)"""
    outlier = f"""{OBS}, s AS (
  SELECT *, count(*) OVER p AS n, avg(ndvi_raw) OVER p AS m, stddev_pop(ndvi_raw) OVER p AS sd
  FROM obs WINDOW p AS (PARTITION BY location_id)),
f AS (SELECT *, n >= 3 AND sd <> 0 AND abs((ndvi_raw - m) / sd) > 1.8 AS is_outlier FROM s)"""
    seasonal = f"""{OBS}, s AS (
  SELECT *, count(*) OVER (PARTITION BY location_id) AS n, count(*) OVER p AS k,
         avg(ndvi_raw) OVER p AS m, stddev_pop(ndvi_raw) OVER p AS sd
  FROM obs WINDOW p AS (PARTITION BY location_id, month(date))),
f AS (SELECT *, n >= 12 AND k >= 3 AND sd <> 0 AND coalesce(abs((ndvi_raw - m) / nullif(sd, 0)) > 2,
      false) AS is_seasonal_outlier FROM s)"""
    cloudy = "(ndvi_raw < 0.1 OR quality < 2)"
    gap_series = ("location_id", "date"), ("latitude", "longitude", "ndvi_raw")
    smooth_series = ("location_id", "date"), ("latitude", "longitude", "ndvi_raw", "ndvi_smoothed")
    wide = ("mean", "std", "min", "max")
    feature_plain = (*BASE, *CALENDAR_INTS, "is_peak", "days_since_peak", *CLIMATE_INTS)
    feature_doubles = (
        "latitude", "longitude", "ndvi_raw", "ndvi_smoothed", *CALENDAR_DOUBLES,
        *rolling_names(), *lag_names(), "latitude_abs", *INTERACTIONS,
    )
    raw_calendar = CALENDAR.replace(
        ", CAST(weekofyear(date) AS INTEGER) AS week_of_year", "")

    sql = {
        "clean_scale_clip": out(
            unclean, "cleaned", ("location_id", "date", TIES),
            ("latitude", "longitude", "ndvi_raw")),
        "clean_compact_key": out(compact, "grouped", ("location_id", "rows"), ("mean",)),
        "lenient_dates": "SELECT event_id, CAST(ts AS DATE) AS date, round(value, 6) + 0.0 AS value "
                         "FROM events WHERE event_id % 5 <> 0",
        "coordinate_check": out(
            REQUESTS, "req", ("request_id", "start_date", "end_date",
                              "latitude BETWEEN -90 AND 90 AS accepted"), PLACES),
        "cloud_mask": out(
            f"{EVENTS}, m AS (SELECT event_id, location_id, date, CASE WHEN {cloudy} THEN NULL "
            "ELSE ndvi_raw END AS ndvi_raw FROM ev)", "m", ("event_id", *BASE), ("ndvi_raw",)),
        "cloud_flag": out(EVENTS, "ev", ("event_id", *BASE, f"{cloudy} AS is_cloud")),
        "outlier_global": out(outlier, "f", (*BASE, TIES, "is_outlier"), ("ndvi_raw",)),
        "outlier_seasonal": out(seasonal, "f", (*BASE, TIES, "is_seasonal_outlier"), ("ndvi_raw",)),
        "consistency_filter": out(
            f"{OBS}, {filtered('obs', 'kept')}", "kept", (*BASE, TIES), ("ndvi_raw",)),
        "resample_month": out(MONTHLY, "monthly", *gap_series),
        "resample_quarter": out(
            f"{OBS}, {resampled('obs', 'q', 'quarter', '3 MONTHS')}", "q", *gap_series),
        "resample_week": out(
            f"{EVENTS}, {resampled('ev', 'w', 'week', '7 DAYS')}", "w", *gap_series),
        "resample_day": out(f"{EVENTS}, {resampled('ev', 'd', 'day', '1 DAY')}", "d", *gap_series),
        "interpolate_linear": out(f"{GAPPY}, {interpolated('position', LINE)}", "filled", *gap_series),
        "interpolate_time": out(f"{GAPPY}, {interpolated('time', LINE)}", "filled", *gap_series),
        "interpolate_nearest": out(
            f"{GAPPY}, {interpolated('position', NEAREST)}", "filled", *gap_series),
        "savgol_5_2": out(
            f"{GAPPY}, {smoothed('gappy', 'sm', SAVGOL_5_2, 35)}", "sm", *smooth_series),
        "savgol_7_3": out(f"{GAPPY}, {smoothed('gappy', 'sm', SAVGOL_7_3, 42)}", "sm", *smooth_series),
        "preprocess_series": out(PROCESSED, "processed", *smooth_series),
        "preprocess_filled": out(
            f"{MONTHLY}, gappy AS (SELECT * FROM monthly), {interpolated('position', LINE)}, "
            f"{smoothed('filled', 'sm', SAVGOL_5_2, 35)}", "sm", *smooth_series),
        "calendar_features": out(
            f"{MONTHLY}, f AS (SELECT *, {CALENDAR} FROM monthly)", "f",
            (*BASE, *CALENDAR_INTS), CALENDAR_DOUBLES),
        "climate_features": out(
            f"{MONTHLY}, f AS (SELECT *, {CLIMATE} FROM monthly)", "f",
            (*BASE, *CLIMATE_INTS), ("latitude_abs",)),
        "interaction_features": out(
            f"""{UNSMOOTHED}, p AS (SELECT *, row_number() OVER (
  PARTITION BY location_id ORDER BY date) AS pos FROM series),
r AS (SELECT *, {rolling('ndvi_smoothed', (3,), ('mean', 'slope'))} FROM p),
f AS (SELECT location_id, date, ndvi_smoothed * month(date) AS ndvi_month_interaction,
  ndvi_smoothed * latitude AS ndvi_lat_interaction,
  ndvi_mean_3 * ndvi_slope_3 AS mean_slope_interaction FROM r)""", "f", BASE, INTERACTIONS),
        "rolling_stats": out(
            f"{GAPPY}, f AS (SELECT *, {rolling('ndvi_raw', WINDOWS, wide)} FROM gappy)", "f",
            BASE, rolling_names(WINDOWS, wide)),
        "rolling_slope": out(
            f"""{GAPPY}, p AS (SELECT *, row_number() OVER (
  PARTITION BY location_id ORDER BY date) AS pos FROM gappy),
f AS (SELECT *, {rolling('ndvi_raw', WINDOWS, ('slope',))} FROM p)""", "f", BASE,
            rolling_names(WINDOWS, ("slope",))),
        "lags_diffs": out(
            f"{GAPPY}, f AS (SELECT *, {lags('ndvi_raw')} FROM gappy)", "f", BASE, lag_names()),
        "peak_features": out(
            f"{GAPPY}, {peaks('gappy', 'f', 'ndvi_raw')}", "f",
            (*BASE, "is_peak", "days_since_peak")),
        "all_features": out(
            f"{PROCESSED}, {full_features('processed', 'feats')}", "feats", feature_plain,
            feature_doubles, "missing < 23.5"),
        "scoring_features": out(
            f"""{UNSMOOTHED}, p AS (SELECT *, row_number() OVER (
  PARTITION BY location_id ORDER BY date) AS pos FROM series),
f AS (SELECT *, {CALENDAR}, {rolling('ndvi_smoothed')}, {lags('ndvi_smoothed', (1,))} FROM p)""",
            "f", (*BASE, *CALENDAR_INTS),
            ("latitude", "longitude", "ndvi_raw", "ndvi_smoothed", *CALENDAR_DOUBLES,
             *rolling_names(), *lag_names((1,)))),
        "request_model_inputs": out(
            f"""{UNSMOOTHED}, {REQUESTS}, asked AS (
  SELECT request_id, {KEY} AS place, latitude, longitude, start_date, end_date
  FROM req WHERE latitude BETWEEN -90 AND 90),
steps AS (
  SELECT a.request_id, a.place, a.request_id AS location_id, a.latitude, a.longitude, s.date,
         s.ndvi_raw, s.ndvi_smoothed
  FROM asked a LEFT JOIN series s
    ON s.location_id = a.place AND s.date BETWEEN a.start_date AND a.end_date),
p AS (SELECT *, row_number() OVER (PARTITION BY location_id ORDER BY date) AS pos FROM steps),
f AS (SELECT *, {CALENDAR}, {rolling('ndvi_smoothed')}, {lags('ndvi_smoothed', (1,))} FROM p)""",
            "f", ("request_id", "place AS location_id", "date", *CALENDAR_INTS),
            ("latitude", "longitude", "ndvi_raw", "ndvi_smoothed", *CALENDAR_DOUBLES,
             *rolling_names(), *lag_names((1,)))),
        "raw_features": out(
            f"{UNSMOOTHED}, f AS (SELECT *, {raw_calendar}, "
            f"{rolling('ndvi_raw', WINDOWS, ('mean', 'std'))}, {lags('ndvi_raw', (1, 2, 3))} "
            "FROM series)", "f", (*BASE, *[c for c in CALENDAR_INTS if c != "week_of_year"]),
            ("latitude", "longitude", "ndvi_raw", "ndvi_smoothed", *CALENDAR_DOUBLES,
             *rolling_names(WINDOWS, ("mean", "std")), *lag_names((1, 2, 3)))),
        "profile_nulls":
            f"WITH {UNSMOOTHED}, {full_features('series', 'feats')} {counted_features()}",
        "label_phenology": out(
            phenology_labels(False), "labels_",
            ("location_id", "year", "onset_date", "onset_doy", "peak_doy", "data_source"),
            ("label_quality_score", *PLACES)),
        "label_phenology_epoch": out(
            phenology_labels(True), "labels_",
            ("location_id", "year", "onset_date", "onset_doy", "peak_doy", "data_source"),
            ("label_quality_score", *PLACES)),
        "label_spring_jump": out(
            f"{MONTHLY}, {JUMPS}", "jumps", ("location_id", "year", "onset_date", "onset_index"),
            ("label_quality_score", *PLACES)),
        "onset_from_candidates": out(
            f"{GAPPY}, {candidates(False)}", "onsets", ONSET_PLAIN, ONSET_DOUBLES),
        "onset_per_year": out(
            f"{GAPPY}, {candidates(True)}", "onsets", ONSET_PLAIN, ONSET_DOUBLES),
        "label_summary": f"""WITH {MONTHLY}, {JUMPS}
SELECT count(*) AS labels, count(DISTINCT location_id) AS locations, min(year) AS first_year,
       max(year) AS last_year, round(avg(label_quality_score), 6) + 0.0 AS mean_quality FROM jumps""",
        "train_set_cls": out(
            TRAIN_CLS, "cls", (*BASE, "year", "bloom_label"), ("ndvi_mean_3", "label_quality_score")),
        "train_set_reg": out(
            TRAIN_REG, "reg", (*BASE, "year", "onset_date", "onset_doy"),
            ("ndvi_mean_3", "label_quality_score")),
        "class_balance": f"""WITH {TRAIN_CLS}
SELECT count(*) AS samples, CAST(sum(bloom_label) AS BIGINT) AS positives,
       round(avg(bloom_label), 6) + 0.0 AS positive_share FROM cls""",
        "target_range": f"""WITH {TRAIN_REG}
SELECT count(*) AS samples, min(onset_doy) AS lowest, max(onset_doy) AS highest FROM reg""",
        "score_rule": out(
            SCORED, "scored", (*BASE, "bloom_predicted"), ("bloom_probability", "ndvi")),
        "onset_first": f"""WITH {SCORED} SELECT location_id,
  min(date) FILTER (bloom_probability > 0.5) AS predicted_onset_date FROM scored GROUP BY 1""",
        "onset_first_flag": f"""WITH {SCORED} SELECT location_id,
  min(date) FILTER (bloom_predicted) AS predicted_onset_date FROM scored GROUP BY 1""",
        "onset_nearest_doy": f"""WITH {UNSMOOTHED}, g AS (
  SELECT location_id, date, abs(dayofyear(date) - first_value(round(ndvi_raw * 120, 3) + 60) OVER (
    PARTITION BY location_id ORDER BY date)) AS away FROM series),
r AS (SELECT *, row_number() OVER (PARTITION BY location_id ORDER BY away, date) AS rank FROM g)
SELECT location_id, date AS predicted_onset_date FROM r WHERE rank = 1""",
        "confidence": f"""WITH {SCORED} SELECT location_id,
  round(avg(bloom_probability), 6) + 0.0 AS confidence FROM scored GROUP BY 1""",
        "bloom_events": f"""WITH {UNSMOOTHED} SELECT location_id,
  count(*) FILTER (ndvi_smoothed > 0.6 AND month(date) IN (3, 4, 5, 6)) AS bloom_events,
  count(*) AS series_rows FROM series GROUP BY 1""",
        "location_peak": f"""WITH {GAPPY}, p AS (
  SELECT *, row_number() OVER (PARTITION BY location_id ORDER BY date) - 1 AS place,
         max(ndvi_raw) OVER (PARTITION BY location_id) AS peak FROM gappy),
r AS (SELECT *, row_number() OVER (PARTITION BY location_id ORDER BY date) AS rank
      FROM p WHERE ndvi_raw = peak)
SELECT location_id, round(peak, 6) + 0.0 AS peak_ndvi, CAST(place AS INTEGER) AS peak_index,
       date AS peak_date FROM r WHERE rank = 1""",
        "score_requests": f"""WITH {REQUESTED}
SELECT request_id, location_id, round(latitude, 6) + 0.0 AS latitude,
       round(longitude, 6) + 0.0 AS longitude, CAST(count(date) AS INTEGER) AS n_predictions,
       round(CASE WHEN count(date) = count(ndvi) THEN coalesce(sum(ndvi), 0.0) END, 6) + 0.0
         AS ndvi_sum,
       max(date) AS last_date, min(date) FILTER (bloom_probability > 0.5) AS predicted_onset_date,
       round(avg(bloom_probability) FILTER (date IS NOT NULL), 6) + 0.0 AS confidence
FROM answered GROUP BY request_id, location_id, latitude, longitude""",
        "prediction_rows": f"""WITH {REQUESTED}
SELECT request_id, date, round(latitude, 6) + 0.0 AS latitude,
       round(longitude, 6) + 0.0 AS longitude, round(coalesce(ndvi, 0.0), 6) + 0.0 AS ndvi,
       round(bloom_probability, 6) + 0.0 AS bloom_probability,
       bloom_probability > 0.6 AS bloom_predicted, CAST(0 AS DOUBLE) AS predicted_onset_doy
FROM answered WHERE date IS NOT NULL""",
        "timeseries_overlay": f"""WITH {SCORED}, {JUMPS},
few AS (SELECT DISTINCT location_id FROM scored ORDER BY 1 LIMIT 5),
o AS (SELECT location_id, count(DISTINCT onset_date) AS n, min(onset_date) AS first_onset
      FROM jumps GROUP BY 1)
SELECT s.location_id, s.date, round(s.ndvi, 6) + 0.0 AS ndvi,
       round(s.bloom_probability, 6) + 0.0 AS bloom_probability,
       CAST(coalesce(o.n, 0) AS INTEGER) AS n_onsets, o.first_onset
FROM scored s JOIN few USING (location_id) LEFT JOIN o ON o.location_id = s.location_id""",
        "metrics_cls": out(CLS_METRICS, "m", (), ("accuracy", '"precision"', "recall", "f1")),
        "class_report": _report(),
        "curve_areas": out(AREAS, "areas", (), ("roc_auc", "pr_auc")),
        "confusion": f"""WITH {COUNTS}
SELECT 0 AS label, 0 AS prediction, CAST(tn AS BIGINT) AS rows FROM c
UNION ALL SELECT 0, 1, CAST(fp AS BIGINT) FROM c
UNION ALL SELECT 1, 0, CAST(fn AS BIGINT) FROM c UNION ALL SELECT 1, 1, CAST(tp AS BIGINT) FROM c""",
        "roc_points": _curve(("fpr", "tpr"), ("CAST(0 AS DOUBLE)", "CAST(0 AS DOUBLE)")),
        "pr_points": _curve(("precision", "recall"), ("CAST(1 AS DOUBLE)", "CAST(0 AS DOUBLE)")),
        "evaluation_cls": _metric_rows(),
        "metrics_reg": out(REG_METRICS, "m", (), ("mae", "mse", "rmse", "r2", "mape")),
        "residual_hist": _histogram(),
        "residual_rows": out(GUESSED, "guessed", (*BASE, "label"), ("prediction", "residual")),
        "bbox_date_filter": out(
            OBS, "obs", (*BASE, TIES), (*PLACES, "ndvi_raw"),
            "longitude BETWEEN -120 AND 60 AND latitude BETWEEN -45.5 AND 45.5 "
            "AND date >= DATE '1996-01-01' AND date < DATE '1999-07-01'"),
        "band_select": out(
            f"{PIXELS}, b AS (SELECT latitude, longitude, date, NDVI * 0.0001 AS ndvi_raw "
            "FROM pixels WHERE product = 'MOD13A2')", "b", ("date",), (*PLACES, "ndvi_raw")),
        "grid_points": out(
            f"{PIXELS}, {grid('pixels', 'g')}", "g", ("grid_x", "grid_y"), PLACES),
        "sample_nearest": out(
            f"""{PIXELS}, {grid('pixels', 'g')}, band AS (
  SELECT latitude, longitude, date, NDVI * 0.0001 AS ndvi_raw FROM pixels
  WHERE product = 'MOD13A2'), {nearest('band', 'g', 3000, ['ndvi_raw'])}""", "offers", ("date",),
            (*PLACES, "ndvi_raw"), "rank = 1"),
        "sample_phenology": out(
            f"""{PHENOLOGY}, {grid('phen', 'g')}, image AS (
  SELECT * FROM phen WHERE date = (SELECT min(date) FROM phen)),
{nearest('image', 'g', 4000, PHENOLOGY_BANDS)}""", "offers", ("date",),
            (*PLACES, *PHENOLOGY_BANDS), "rank = 1"),
        "sample_distance": out(
            f"{POLAR}, {within('polar', 'points', 3000, ['ndvi_raw'])}", "served", ("date",),
            (*PLACES, "metres", "ndvi_raw"), "rank = 1"),
        "sample_phenology_distance": out(
            f"""{PHENOLOGY}, {grid('phen', 'g')}, image AS (
  SELECT * FROM phen WHERE date = (SELECT min(date) FROM phen)),
{within('image', 'g', 4000, PHENOLOGY_BANDS)}""", "served", ("date",),
            (*PLACES, "metres", *PHENOLOGY_BANDS), "rank = 1"),
        "union_normalise": """SELECT CAST(l_shipdate AS DATE) AS date, NULL AS quality,
  CAST(l_suppkey AS DOUBLE) AS latitude, CAST(l_partkey AS DOUBLE) AS longitude,
  round(l_discount * 100000 * 0.0001, 6) + 0.0 AS ndvi_raw FROM lineitem
UNION ALL SELECT CAST(o_orderdate AS DATE), o_orderstatus, CAST(o_custkey AS DOUBLE),
  CAST(o_orderkey AS DOUBLE), round(o_totalprice / 53 * 0.0001, 6) + 0.0 FROM orders""",
        "summary": f"""WITH {MONTHLY}, {smoothed('monthly', 'sm', SAVGOL_5_2, 35)}
SELECT count(*) AS records, count(DISTINCT location_id) AS locations, min(date) AS first_date,
       max(date) AS last_date, round(min(ndvi_smoothed), 6) + 0.0 AS lowest,
       round(max(ndvi_smoothed), 6) + 0.0 AS highest, round(avg(ndvi_smoothed), 6) + 0.0 AS mean
FROM sm""",
        "summary_years": f"""WITH {MONTHLY}, {smoothed('monthly', 'sm', SAVGOL_5_2, 35)}
SELECT CASE WHEN grouping(year) = 0 THEN 'year' ELSE 'all' END AS part, CAST(year AS INTEGER) AS year,
       count(*) AS records, count(DISTINCT location_id) AS locations, min(date) AS first_date,
       max(date) AS last_date, round(min(ndvi_smoothed), 6) + 0.0 AS lowest,
       round(max(ndvi_smoothed), 6) + 0.0 AS highest, round(avg(ndvi_smoothed), 6) + 0.0 AS mean,
       true AS estimate_holds
FROM (SELECT *, year(date) AS year FROM sm) GROUP BY GROUPING SETS ((year), ())""",
        "doy_dates": """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS round_trip,
  CASE WHEN year(d) = year(o_orderdate) THEN d END AS some_day
FROM (SELECT *, make_date(CAST(year(o_orderdate) AS BIGINT), 1, 1)
                + CAST(o_custkey % 366 AS INTEGER) AS d FROM orders)""",
        "demo_bloom": f"""WITH {MONTHLY} SELECT location_id, date,
  coalesce(ndvi_raw > 0.6, false) AND month(date) IN (3, 4, 5, 6) AS is_bloom FROM monthly""",
        "stream_score": out(
            f"""{EVENTS}, s AS (SELECT event_id, location_id, date, ndvi_raw AS ndvi,
  {rule('ndvi_raw')} AS bloom_probability, {rule('ndvi_raw')} > 0.6 AS bloom_predicted
  FROM ev WHERE ndvi_raw IS NOT NULL)""", "s", ("event_id", *BASE, "bloom_predicted"),
            ("bloom_probability", "ndvi")),
        "stream_month": f"""WITH {OBS}
SELECT location_id, CAST(date_trunc('month', date) AS DATE) AS month,
       round(avg(ndvi_raw), 6) + 0.0 AS month_mean, count(*) AS month_rows
FROM obs GROUP BY 1, 2""",
        "stream_features": out(
            _trailing(), "wide, newest", BASE, ("value", *rolling_names(), *lag_names()),
            "date <= m - INTERVAL 62 DAYS AND date <= (SELECT max(date_trunc('month', o.date)) "
            "FROM obs o WHERE o.location_id = wide.location_id "
            "AND date_trunc('month', o.date) <= m - INTERVAL 62 DAYS)"),
        "stream_features_latest": out(
            _trailing(), "wide", BASE, ("value", *rolling_names(), *lag_names())),
    }
    sql["series_roundtrip"] = out(
        PROCESSED, "processed", (*BASE, "CAST(year(date) AS INTEGER) AS year"), smooth_series[1])
    sql["evaluation_tables"] = _class_tables(sql)
    sql["evaluation_reg"] = _regression_tables(sql)
    sql["labels_roundtrip"] = sql["label_phenology_epoch"]
    sql["features_roundtrip"] = sql["all_features"]
    sql["stream_compacted"] = sql["stream_month"]
    sql["stream_model_scores"] = f"""SELECT f.location_id, f.date, CAST(j.year IS NOT NULL AS INTEGER) AS label,
       CASE WHEN year(f.date) < 1997 THEN 1 ELSE 2 END AS model_version, true AS scored
FROM ({sql['series_roundtrip']}) f
LEFT JOIN ({sql['label_spring_jump']}) j ON j.location_id = f.location_id AND j.year = f.year"""
    lines = f"""{RAW}, lines AS (
  SELECT CASE WHEN l_linenumber % 2 = 1 THEN 'service' ELSE 'own' END AS layout,
         CAST(l_orderkey AS BIGINT) AS l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
         CAST(l_partkey AS BIGINT) AS l_partkey,
         CASE WHEN l_partkey % 13 = 0 OR (l_linenumber % 2 = 0 AND l_partkey % 23 = 0) THEN 'malformed'
              WHEN l_partkey % 17 = 0 THEN 'missing latitude'
              WHEN l_partkey % 19 = 0 THEN 'off the globe' END AS rejected_for,
         latitude, longitude, date, floor(ndvi_raw * 10000) * CAST(0.0001 AS DOUBLE) AS ndvi_raw,
         CASE WHEN l_linenumber % 2 = 0 THEN CAST(quality AS INTEGER) END AS quality
  FROM raw)"""
    doubles = ", ".join(
        f"CASE WHEN rejected_for IS NULL THEN round({c}, 6) + 0.0 END AS {c}"
        for c in ("latitude", "longitude", "ndvi_raw"))
    sql["extract_roundtrip"] = f"""WITH {lines}
SELECT layout, {TIES}, rejected_for, {doubles},
       CASE WHEN rejected_for IS NULL THEN date END AS date,
       CASE WHEN rejected_for IS NULL THEN quality END AS quality FROM lines"""
    sql["extract_counts"] = f"""WITH {lines}
SELECT layout, count(*) FILTER (rejected_for IS NULL) AS accepted,
       count(*) FILTER (rejected_for IS NOT NULL) AS rejected FROM lines GROUP BY 1"""
    sql["clean_counts"] = f"""WITH {unclean}
SELECT count(*) AS rows, count(*) FILTER (latitude IS NULL OR v IS NULL) AS removed FROM stored"""
    inputs = [c for c in (*feature_plain, *feature_doubles) if c not in NOT_FEATURES]
    cells = f"""feats_long AS (
  UNPIVOT (SELECT date, {', '.join(f'floor(CAST({c} AS DOUBLE) * 100000.0::DOUBLE) / 100000.0::DOUBLE AS {c}' for c in inputs)} FROM whole)
  ON {', '.join(inputs)} INTO NAME feature VALUE value)"""
    sql["model_medians"] = f"""WITH whole AS ({sql['all_features']}), {cells}
SELECT feature, count(*) AS n, round(median(value), 6) + 0.0 AS median FROM feats_long GROUP BY 1"""
    sql["fold_statistics"] = f"""WITH whole AS ({sql['all_features']}), {cells},
folds AS (SELECT DISTINCT CAST(year(date) % 5 AS INTEGER) AS without FROM whole)
SELECT feature, without, count(*) AS n, round(avg(value), 6) + 0.0 AS mean,
       round(stddev_samp(value), 6) + 0.0 AS deviation, round(median(value), 6) + 0.0 AS median
FROM feats_long, folds WHERE year(date) % 5 <> without GROUP BY 1, 2"""
    return sql
