import datetime as dt
import math
import random

import pytest

from phenospark.operators import nearby
from phenospark.operators.grid import Bounds

PIXELS = "latitude double, longitude double, date date, ndvi_raw double"
DAY = dt.date(2020, 1, 1)


def metres(lat1, lon1, lat2, lon2):
    """Angle between two unit vectors, another way than the operator's."""
    def unit(lat, lon):
        lat, lon = math.radians(lat), math.radians(lon)
        return math.cos(lat) * math.cos(lon), math.cos(lat) * math.sin(lon), math.sin(lat)

    a, b = unit(lat1, lon1), unit(lat2, lon2)
    cross = (a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0])
    return nearby.EARTH_RADIUS * math.atan2(math.hypot(*cross), sum(x * y for x, y in zip(a, b)))


def by_loop(pixels, box, step, reach):
    east = box.east + (360 if box.east < box.west else 0)
    nx, ny = (int(math.floor((e - s) / step + 1e-9)) + 1 for s, e in ((box.west, east), (box.south, box.north)))
    found = {}
    for j in range(ny):
        for i in range(nx):
            lat, lon = j * step + box.south, i * step + box.west
            for day in {p[2] for p in pixels}:
                near = [(round(metres(lat, lon, p[0], p[1]), 3), *p[:2], p[3]) for p in pixels if p[2] == day]
                near = [n for n in near if n[0] <= reach]
                if near:
                    found[round(lat, 6), round(lon - 360 if lon > 180 else lon, 6), day] = min(near)[3]
    return found


@pytest.mark.parametrize("box, step, reach", [
    (Bounds(10.0, 62.0, 11.0, 62.5), 0.1, 9000.0),  # beyond 60 degrees
    (Bounds(179.5, -1.0, -179.5, 0.0), 0.1, 7000.0),  # across 180
    (Bounds(178.0, 70.0, -178.0, 71.0), 0.25, 30000.0),  # both
    (Bounds(-180.0, 88.0, 180.0, 90.0), 10.0, 60000.0),  # around the pole, the line twice
    (Bounds(-180.0, -90.0, 180.0, -89.0), 0.5 * 30, 150000.0),
    (Bounds(170.0, 80.0, 180.0, 90.0), 2.0, 3e7),  # all the globe in reach
])
def test_nearest_by_distance_against_loop(spark, box, step, reach):
    rng = random.Random(7)
    east = box.east + (360 if box.east < box.west else 0)
    pixels = []
    for _ in range(120):
        lon = box.west - 0.3 + rng.random() * (east - box.west + 0.6)
        lon = (lon + 180) % 360 - 180
        lat = min(90.0, max(-90.0, box.south - 0.2 + rng.random() * (box.north - box.south + 0.4)))
        pixels.append((lat, lon, DAY + dt.timedelta(rng.randrange(2)), rng.random()))
    pixels += [(pixels[0][0], pixels[0][1], DAY, 0.5)] * 60  # copies crowd one place
    wanted = by_loop(pixels, box, step, reach)
    got = {
        (round(r["latitude"], 6), round(r["longitude"], 6), r["date"]): r["ndvi_raw"]
        for r in nearby.sample_within(spark.createDataFrame(pixels, PIXELS), box, step=step, reach=reach).collect()
    }
    assert got == wanted and got


def test_places_off_the_globe_or_missing_serve_nothing(spark):
    rows = [(None, 0.0, DAY, 1.0), (0.0, None, DAY, 1.0), (91.0, 0.0, DAY, 1.0), (0.0, 200.0, DAY, 1.0),
            (float("nan"), 0.0, DAY, 1.0)]
    box = Bounds(0.0, 0.0, 0.2, 0.2)
    assert nearby.sample_within(spark.createDataFrame(rows, PIXELS), box, reach=1e7).count() == 0
    assert nearby.sample_within(spark.createDataFrame([], PIXELS), box).count() == 0


def test_a_box_in_degrees_would_miss_this_pixel(spark):
    box = Bounds(20.0, 70.0, 20.0, 70.0)
    pixel = spark.createDataFrame([(70.0, 20.02, DAY, 0.4)], PIXELS)  # 761 m east
    row = nearby.sample_within(pixel, box, reach=1000.0).first()
    assert 700 < row["metres"] < 800 and row["ndvi_raw"] == 0.4
