"""Nearest points against all distances."""

import math
import random

import pytest

from plumbline.functions import joins
from plumbline.operators import nearest


def kilometres(a, b):
    (la, oa), (lb, ob) = ((math.radians(x) for x in p) for p in (a, b))
    inner = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin((ob - oa) / 2) ** 2
    return 2 * 6371.0088 * math.asin(math.sqrt(min(inner, 1.0)))


def check(spark, rows, points):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "k long, lat double, lon double").repartition(3)
    spots = spark.createDataFrame(points, "latitude double, longitude double")
    found = {r["k"]: r["d"] for r in nearest.nearest_point(df, "lat", "lon", spots, output="d").collect()}
    assert len(found) == len(rows)
    valid = [p for p in points if None not in p]
    for k, row in enumerate(rows):
        if None in row or not valid:
            assert found[k] is None
        else:
            assert found[k] == pytest.approx(min(kilometres(row, p) for p in valid), abs=1e-6)


def around(rng, count, centre=None, width=180.0):
    if centre is None:
        return [(math.degrees(math.asin(rng.uniform(-1, 1))), rng.uniform(-180, 180)) for _ in range(count)]
    return [(centre[0] + rng.uniform(-width, width), centre[1] + rng.uniform(-width, width)) for _ in range(count)]


@pytest.mark.parametrize("broadcast", [500_000, 0])
def test_clusters_poles_and_the_date_line(spark, monkeypatch, broadcast):
    monkeypatch.setattr(joins, "BROADCAST_ROWS", broadcast)
    monkeypatch.setattr(nearest, "FEW_POINTS", 4)
    rng = random.Random(3)
    rows = around(rng, 150) + around(rng, 60, (10.0, 20.0), 0.05) + [(90.0, 0.0), (-90.0, 50.0), (0.0, 180.0), (0.0, -180.0)]
    rows += [(10.01, 20.01)] * 40 + [(None, 1.0), (1.0, None), (None, None)]
    points = around(rng, 60) + around(rng, 300, (10.0, 20.0), 0.1) + [(0.5, 179.99), (89.9, 123.0)] + [(10.0, 20.0)] * 50
    check(spark, rows, [*points, (None, 3.0)])


def test_few_points_one_place_and_none(spark):
    rng = random.Random(4)
    rows = around(rng, 20)
    check(spark, rows, [(1.0, 2.0)])
    check(spark, rows, [(1.0, 2.0)] * 500)
    check(spark, [(5.0, 5.0)] * 30, around(rng, 200))
    check(spark, rows, [])
    check(spark, [(None, None)], around(rng, 5))


def test_many_points_closer_than_the_finest_cube(spark, monkeypatch):
    monkeypatch.setattr(nearest, "FEW_POINTS", 2)
    rng = random.Random(5)
    check(spark, around(rng, 10, (0.0, 0.0), 1e-6) + [(40.0, 40.0)], around(rng, 30, (0.0, 0.0), 1e-7))
