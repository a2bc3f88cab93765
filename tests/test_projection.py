"""The projection both ways: a published control point, arcs by numeric integration, round trips, and the area of use."""

import math

import pytest
from pyspark.sql import functions as F

from sedimenta.operators import geo as G

BELT = G.MODIFIED_CENTRAL_BELT
BRITAIN = G.TransverseMercator(6377563.396, 299.3249646, 49.0, -2.0, 0.9996012717, 400000.0, -100000.0, (0,) * 7)


def one(spark, transform, a, b):
    out = transform(F.lit(a), F.lit(b))
    return tuple(spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(out)]).first())


def test_published_control_point(spark):
    """The worked example of the public guidance on the method: 50 30 N, 0 30 E."""
    assert one(spark, BRITAIN.project, 0.5, 50.5) == pytest.approx((577274.99, 69740.50), abs=0.01)
    assert one(spark, BRITAIN.unproject, 577274.99, 69740.50) == pytest.approx((0.5, 50.5), abs=2e-7)


def test_northings_on_the_meridian_are_arcs(spark):
    f = 1 / BELT.inverse_flattening
    e2 = f * (2 - f)
    step = lambda phi: BELT.a * (1 - e2) / (1 - e2 * math.sin(phi) ** 2) ** 1.5
    for lat in (33.0, 36.5, 38.0, 39.5):
        a, b, n = math.radians(38.0), math.radians(lat), 2000
        h = (b - a) / n
        arc = h / 3 * sum((1 if i in (0, n) else 4 if i % 2 else 2) * step(a + i * h) for i in range(n + 1))
        assert one(spark, BELT.project, BELT.lon0, lat) == pytest.approx((200000.0, 500000.0 + arc), abs=1e-4)


def test_round_trips_over_the_whole_country(spark):
    west, south, east, north = G.COUNTRY_BOX
    grid = spark.range(81 * 81).select((west + (F.col("id") % 81) * (east - west) / 80).alias("lon"), (south + F.floor(F.col("id") / 81) * (north - south) / 80).alias("lat"))
    for there, back in ((BELT.project, BELT.unproject), (BELT.from_wgs84, BELT.to_wgs84)):
        x, y = there(F.col("lon"), F.col("lat"))
        moved = grid.withColumns({"x": x, "y": y})
        lon, lat = back(F.col("x"), F.col("y"))
        off = moved.withColumns({"u": lon, "v": lat}).agg(F.max(F.hypot((F.col("u") - F.col("lon")) * F.cos(F.radians("lat")), F.col("v") - F.col("lat"))).alias("d")).first().d
        assert off * 111_320 < 0.001


def test_origin_shift_and_nulls(spark):
    assert one(spark, BELT.unproject, 200000.0, 500000.0) == pytest.approx((BELT.lon0, 38.0), abs=1e-12)
    lon, lat = one(spark, BELT.to_wgs84, 200000.0, 500000.0)
    assert 0.001 < BELT.lon0 - lon + 0.005 < 0.01 and abs(lat - 38.0) < 0.01
    assert one(spark, BELT.to_wgs84, None, None) == (None, None)
    assert all(math.isnan(v) for v in one(spark, BELT.to_wgs84, float("nan"), 1.0)[:1])


def test_area_of_use(spark):
    rows = spark.createDataFrame([(127.0, 37.0), (126.0, 33.96), (129.0, 37.0), (127.0, 39.0), (None, 37.0), (float("nan"), 37.0)], "lon double, lat double")
    assert [r[0] for r in rows.select(G.in_area(F.col("lon"), F.col("lat"))).collect()] == [True, True, False, False, False, False]


@pytest.mark.parametrize("probe, verdict", [((0, 0, 0, 0, 0, 0), "INSUFFICIENT_SAMPLE"), ((200, 190, 10, 100, 90, 50), "X_IS_EASTING"), ((200, 10, 190, 100, 50, 90), "X_IS_NORTHING"), ((200, 190, 80, 99, 99, 0), "X_IS_EASTING"), ((200, 100, 100, 100, 89, 0), "AMBIGUOUS")])
def test_axis_verdicts(spark, probe, verdict):
    row = spark.createDataFrame([probe], "sampled long, xy_inside long, yx_inside long, eligible long, xy_region long, yx_region long")
    assert G.assess_axes(row).first().assessment == verdict
