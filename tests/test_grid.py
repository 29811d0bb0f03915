import datetime as dt
import json
import math
import random

import pytest

from phenospark.operators import grid
from phenospark.schema import PHENOLOGY_BANDS
from .conftest import column


def test_areas(tmp_path):
    assert grid.area_bounds(" -120, 30,-110 ,40") == grid.Bounds(-120, 30, -110, 40)
    with pytest.raises(ValueError):
        grid.area_bounds("1,2,3")
    ring = [[[0, 0], [2, 0], [2, 1], [0, 1], [0, 0]]]
    shape = {"type": "Polygon", "coordinates": ring}
    many = {"type": "FeatureCollection", "features": [
        {"geometry": shape}, {"geometry": {"coordinates": [[[9, 9]]]}}]}
    path = tmp_path / "area.geojson"
    path.write_text(json.dumps(many))
    for given in (shape, many, str(path)):
        assert grid.area_bounds(given) == grid.Bounds(0, 0, 2, 1)


def test_grid_has_both_ends(spark):
    out = grid.grid_points(spark, grid.Bounds(0.0, 10.0, 0.3, 10.2))
    assert out.count() == 4 * 3
    assert sorted({round(r["longitude"], 9) for r in out.collect()}) == [0.0, 0.1, 0.2, 0.3]
    assert sorted({round(r["latitude"], 9) for r in out.collect()}) == [10.0, 10.1, 10.2]


def test_filters_reach_the_scan(spark, tmp_path, capsys):
    rows = [(float(i), float(i), dt.date(2020, 1, 1 + i), 0.5) for i in range(5)]
    df = spark.createDataFrame(rows, "latitude double, longitude double, date date, ndvi_raw double")
    df.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    inside = grid.within_bounds(stored, grid.Bounds(1, 1, 3, 3))
    out = grid.within_dates(inside, "2020-01-02", "2020-01-04")
    assert column(out, "latitude", "date") == [1.0, 2.0]  # the end is not included
    out.explain("formatted")
    plan = capsys.readouterr().out
    assert "GreaterThanOrEqual(latitude,1.0)" in plan and "LessThan(date,2020-01-04)" in plan


def test_band_and_first_image(spark):
    rows = [("A", 1.0, 2.0, dt.date(2020, 1, 1), 5000.0), ("B", 1.0, 2.0, dt.date(2020, 1, 1), 1.0),
            ("A", 1.0, 2.0, dt.date(2020, 2, 1), 6000.0)]
    df = spark.createDataFrame(
        rows, "product string, latitude double, longitude double, date date, NDVI double")
    out = grid.select_band(df, "A")
    assert column(out, "ndvi_raw", "date") == pytest.approx([0.5, 0.6])
    assert grid.first_image(df).count() == 2


def test_nearest_pixel_against_loop(spark):
    rng = random.Random(0)
    pixels = [(10 + rng.random() * 0.5, 20 + rng.random() * 0.5, dt.date(2020, 1, 1 + rng.randrange(2)),
               rng.random()) for _ in range(300)]
    pixels += [(10.101, 20.101, dt.date(2020, 1, 1), 0.77)] * 150  # copies crowd one place
    df = spark.createDataFrame(
        pixels, "latitude double, longitude double, date date, ndvi_raw double")
    box = grid.Bounds(20.0, 10.0, 20.5, 10.5)
    scale = 4000.0
    reach = scale / grid.METRES_PER_DEGREE
    wanted = {}
    for j in range(6):
        for i in range(6):
            lat, lon = 10.0 + j * 0.1, 20.0 + i * 0.1
            for day in {p[2] for p in pixels}:
                near = [
                    ((p[0] - lat) ** 2 + ((p[1] - lon) * math.cos(math.radians(lat))) ** 2, p[3])
                    for p in pixels
                    if p[2] == day and abs(p[0] - lat) <= reach and abs(p[1] - lon) <= reach]
                if near:
                    wanted[round(lat, 6), round(lon, 6), day] = min(near)[1]
    got = {(round(r["latitude"], 6), round(r["longitude"], 6), r["date"]): r["ndvi_raw"]
           for r in grid.sample_nearest(df, box, scale=scale).collect()}
    assert got == wanted and len(got) > 20


def test_phenology_sampling_takes_one_image(spark):
    names = ["latitude", "longitude", "date", *PHENOLOGY_BANDS]
    schema = ", ".join(f"{n} {'date' if n == 'date' else 'double'}" for n in names)
    rows = [(10.0, 20.0, dt.date(2019, 1, 1), *[1.0] * 28), (10.0, 20.0, dt.date(2020, 1, 1), *[2.0] * 28)]
    df = spark.createDataFrame(rows, schema)
    box = grid.Bounds(20.0, 10.0, 20.0, 10.0)
    assert column(grid.sample_phenology(df, box), "Greenup_1", "date") == [1.0]
    assert column(grid.sample_phenology(df, box, all_years=True), "Peak_4", "date") == [1.0, 2.0]
