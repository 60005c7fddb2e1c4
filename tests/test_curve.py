from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from geoledger import constants as K
from geoledger.operators import curve


def km(a, b):
    p1, p2 = math.radians(a[0]), math.radians(b[0])
    h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return round(2 * K.EARTH_RADIUS_KM * math.asin(min(1.0, math.sqrt(h))), 6)


def tables(spark, queries, points):
    asked = spark.createDataFrame([(n, *q) for n, q in enumerate(queries)], "query long, lat double, lon double")
    placed = spark.createDataFrame([(n, *p) for n, p in enumerate(points)], "position long, lat double, lon double")
    return asked, placed


def brute(queries, points, k, max_km=None):
    out = []
    for n, q in enumerate(queries):
        near = sorted((km(q, p), m) for m, p in enumerate(points))
        near = [x for x in near if max_km is None or x[0] <= max_km][:k]
        out += [(n, place, m, d) for place, (d, m) in enumerate(near, 1)]
    return out


def spots(rng, n):
    """Points all over, on a grid with ties, on one spot, at the poles and on both sides of the date line."""
    made = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(n)]
    made += [(float(rng.randint(-3, 3)), float(rng.randint(-3, 3))) for _ in range(n // 4)]
    made += [(10.5, 20.25)] * 9 + [(90.0, rng.uniform(-180, 180)), (-90.0, 5.0)]
    return made + [(rng.uniform(-1, 1), side * (180 - rng.random() / 5)) for side in (-1, 1) for _ in range(20)]


@pytest.mark.parametrize("k, max_km", [(1, None), (4, 700.0), (40, None)])
def test_equals_brute_force(spark, k, max_km):
    rng = random.Random(k)
    points = spots(rng, 400)
    queries = spots(rng, 30) + [(90.0, 0.0), (-90.0, 77.0), (0.0, 180.0), (0.0, -180.0), (0.0, 540.0)]
    got = curve.nearest_on_globe(*tables(spark, queries, points), k=k, max_km=max_km).collect()
    assert sorted(map(tuple, got)) == sorted(brute(queries, points, k, max_km))


def test_a_crowd_beside_empty_space_makes_few_pairs(spark):
    rng = random.Random(9)
    points = [(10 + rng.gauss(0, 0.001), 20 + rng.gauss(0, 0.001)) for _ in range(6000)]
    points += [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(60)]
    queries = [(10.4, 20.0), (10.0, 20.9), (11.0, 21.0), (9.0, 19.5), (10.0, 20.0)]
    asked, placed = tables(spark, queries, points)
    axes = list(curve.AXES)
    asked = curve.with_axes(asked, "lat", "lon").select(*axes).distinct()
    placed = curve.with_axes(placed, "lat", "lon").drop("lat", "lon")
    pairs = curve.near_pairs(asked, placed, k=3).groupBy(*axes).count().collect()
    assert len(pairs) == len(queries) and max(r["count"] for r in pairs) <= 3 + 5


def test_ranges_hold_few_points_and_boxes_hold_their_points(spark):
    rng = random.Random(3)
    _, placed = tables(spark, [], spots(rng, 3000))
    rows = curve.with_axes(placed, "lat", "lon").withColumn("g", F.col("position") % 3)
    index = curve.point_ranges(rows, ["g"])
    assert index.points.count() == rows.count()
    assert index.points.groupBy("_box").count().agg(F.max("count")).first()[0] <= 1 << curve.STEP
    leaves = index.boxes.where("_level = 0")
    out = " OR ".join(f"{a} < _lo{a} OR {a} > _hi{a}" for a in curve.AXES)
    assert index.points.join(leaves, ["g", "_box"]).where(out).count() == 0
    top = index.boxes.where(F.col("_level") == index.levels - 1)
    assert top.count() == 3 and top.agg(F.sum("_n")).first()[0] == rows.count()


def test_nulls_and_empty_sides(spark):
    asked, placed = tables(spark, [(1.0, 2.0), (None, 3.0), (1.0, 2.0)], [(None, None), (1.0, 2.5), (1.0, None)])
    got = sorted(tuple(r)[:3] for r in curve.nearest_on_globe(asked, placed, k=2).collect())
    assert got == [(0, 1, 1), (2, 1, 1)]
    none = placed.where("false")
    assert curve.nearest_on_globe(asked, none).count() == 0
    assert curve.nearest_on_globe(none.withColumnRenamed("position", "query"), placed).count() == 0
