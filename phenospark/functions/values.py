"""Row-local expressions on observation values, coordinates and scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the observation model.
SCALE_FACTOR = 0.0001
VALID_RANGE = (-1.0, 1.0)
CLOUD_THRESHOLD = 0.1
GOOD_QUALITY = 2
SPRING_MONTHS = (3, 4, 5, 6)
TROPIC_EDGE = 23.5
POLAR_EDGE = 66.5


def null_if_nan(value: Column) -> Column:
    """NULL is the only missing marker downstream (NaN sorts above every number in Spark)."""
    return F.when(~F.isnan(value), value)


def _short(degrees: Column) -> Column:
    """Four decimals, half to even, printed without needless zeros."""
    rounded = F.rint(degrees * 10000) / 10000
    # a cast prints numbers under a thousandth with an exponent
    tiny = (F.abs(rounded) < 0.001) & (rounded != 0)
    return F.when(tiny, F.format_string("%.4f", rounded)).otherwise(rounded.cast("string"))


def _fixed(degrees: Column) -> Column:
    """Text of ``%.4f``, from whole numbers wherever rounding and sign are beyond doubt.

    Formatting every row costs more than all the rest of cleaning; only values next to a
    rounding tie, zeros and values off the globe still take that way.
    """
    scaled = F.abs(degrees) * 10000
    units = F.floor(scaled + 0.5)
    plain = (
        (F.abs(scaled - F.floor(scaled) - 0.5) > 1e-6) & (degrees != 0) & (scaled < 1e8)
    )
    text = F.concat(
        F.when(degrees < 0, "-").otherwise(""),
        F.floor(units / 10000).cast("string"),
        F.lit("."),
        F.substring((units % 10000 + 10000).cast("string"), 2, 4),
    )
    return F.when(plain, text).otherwise(F.format_string("%.4f", degrees))


def location_key(latitude: Column, longitude: Column, style: str = "canonical") -> Column:
    """``canonical`` prints four decimals; ``compact`` prints the half-even rounded doubles."""
    if style == "canonical":
        # format_string prints "null" for a missing coordinate; keep the key missing instead
        key = F.concat(_fixed(latitude), F.lit("_"), _fixed(longitude))
        return F.when(latitude.isNotNull() & longitude.isNotNull(), key)
    if style == "compact":
        return F.concat(_short(latitude), F.lit("_"), _short(longitude))
    raise ValueError(f"unknown key style: {style}")


def clip(value: Column, low: float = VALID_RANGE[0], high: float = VALID_RANGE[1]) -> Column:
    """Clamp to [low, high]; NULL stays NULL (``greatest`` would skip it)."""
    return F.when(value < low, low).when(value > high, high).otherwise(value)


def cloud_flag(value: Column, reliability: Column | None = None) -> Column:
    """True for low values or poor reliability; missing inputs are not clouds."""
    flag = F.coalesce(value < CLOUD_THRESHOLD, F.lit(False))
    if reliability is not None:
        flag = flag | F.coalesce(reliability < GOOD_QUALITY, F.lit(False))
    return flag


def cloud_mask(
    value: Column, quality: Column | None = None, threshold: float = CLOUD_THRESHOLD
) -> Column:
    """The value, or NULL where it is under the threshold or its quality is poor."""
    cloudy = F.coalesce(value < threshold, F.lit(False))
    if quality is not None:
        cloudy = cloudy | F.coalesce(quality < GOOD_QUALITY, F.lit(False))
    return F.when(~cloudy, value)


def in_spring(month: Column) -> Column:
    return month.isin(*SPRING_MONTHS)


def rule_probability(ndvi: Column, month: Column) -> Column:
    """Rule score in [0.1, 0.9]; a missing value scores the floor."""
    bonus = F.when(in_spring(month), 0.2).otherwise(0.0)
    return F.least(F.lit(0.9), F.greatest(F.lit(0.1), ndvi * 0.8 + bonus))


def rule_flag(probability: Column) -> Column:
    return probability > 0.6


def demo_bloom_flag(ndvi: Column, month: Column) -> Column:
    """Greenness above 0.6 in a spring month; missing greenness is no bloom."""
    return F.coalesce(ndvi > 0.6, F.lit(False)) & in_spring(month)


def increase_quality(increase: Column) -> Column:
    return F.least(F.lit(1.0), increase / F.lit(0.3))


def climate_columns(latitude: Column) -> dict[str, Column]:
    distance = F.abs(latitude)
    return {
        "latitude_abs": distance,
        "is_tropical": F.coalesce((distance < TROPIC_EDGE).cast("int"), F.lit(0)),
        "is_temperate": F.coalesce(
            ((distance >= TROPIC_EDGE) & (distance < POLAR_EDGE)).cast("int"), F.lit(0)
        ),
        "is_polar": F.coalesce((distance >= POLAR_EDGE).cast("int"), F.lit(0)),
        "elevation": F.lit(0),
    }
