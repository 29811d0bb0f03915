"""Raw observations to a processed series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..operators.clean import clean
from ..operators.consistency import consistency_filter
from ..operators.gapfill import interpolate
from ..operators.resample import resample
from ..operators.smooth import apply_smoothing


def preprocess(
    raw: DataFrame,
    scale: str = "auto",
    key_style: str = "canonical",
    frequency: str = "month",
    window: int = 5,
    polyorder: int = 2,
    quality_filter: bool = True,
    fill_after_resample: bool = False,
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """Clean, filter, resample and smooth.

    Cleaning and the filter both drop rows without a value, so there is nothing to fill
    before resampling; ``fill_after_resample`` fills the periods it finds empty.
    """
    rows = clean(raw, scale, key_style)
    if quality_filter:
        rows = consistency_filter(rows, tie_break=tie_break)
    series = resample(rows, frequency)
    if fill_after_resample:
        series = interpolate(series)
    return apply_smoothing(series, window, polyorder)
