from __future__ import annotations

import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from geoledger import constants as K
from geoledger.operators import boundaries as B
from geoledger.operators.quality import DataRejected
from geoledger.plans.publish import boundary_job
from geoledger.registry.boundary import TOLERANCE, f17_simplify, f19_levels, features, rings
from geoledger.registry.views import view
from geoledger.sources.geojson import feature_lines, read_geojson

SMALL = "/root/testdata/sf0.001"
SQUARE = [[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]]
HOLE = [[1, 1], [1.1, 1], [1.1, 1.1], [1, 1.1], [1, 1]]
ISLAND = [[9, 9], [9.1, 9], [9.1, 9.1], [9, 9.1], [9, 9]]


def plain_simplify(points, tolerance):
    """The textbook recursion: split at the farthest point while it is farther than the tolerance."""
    if len(points) <= 3 or tolerance <= 0:
        return list(points)

    def away(p, a, b):
        if a == b:
            return math.hypot(p[0] - a[0], p[1] - a[1])
        cross = (b[1] - a[1]) * p[0] - (b[0] - a[0]) * p[1] + b[0] * a[1] - b[1] * a[0]
        return abs(cross) / math.hypot(b[1] - a[1], b[0] - a[0])

    def inner(first, last):
        spots = [(away(points[i], points[first], points[last]), -i) for i in range(first + 1, last)]
        if not spots or max(spots)[0] <= tolerance:
            return []
        middle = -max(spots)[1]
        return [*inner(first, middle), middle, *inner(middle, last)]

    return [points[i] for i in [0, *inner(0, len(points) - 1), len(points) - 1]]


def area(points):
    return 0.0 if len(points) < 3 else abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(points, points[1:]))) / 2


def test_batches_of_rings_against_the_recursion():
    rng = random.Random(11)
    shapes = []
    for count in [0, 1, 2, 3, 4, 5, 8, 30, 200] * 6:
        points = [(rng.choice([0, 1, 2, rng.uniform(0, 5)]), rng.choice([0, 1, rng.uniform(0, 5)])) for _ in range(count)]
        shapes.append((points + points[:1] if rng.random() < 0.5 else points, rng.choice([0.0, 0.2, 1.0, 2.5])))
    sizes = np.array([len(points) for points, _ in shapes])
    ends = np.cumsum(sizes)
    flat = np.array([p for points, _ in shapes for p in points], dtype=float)
    keep = B.kept_points(flat[:, 0], flat[:, 1], ends - sizes, ends - 1, np.array([t for _, t in shapes]))
    for (points, tolerance), end in zip(shapes, ends):
        got = [p for p, kept in zip(points, keep[end - len(points) : end]) if kept]
        assert got == plain_simplify(points, tolerance)


def frame(spark, shapes):
    rows = [(i, [(float(x), float(y)) for x, y in shape]) for i, shape in enumerate(shapes)]
    return spark.createDataFrame(rows, f"ring bigint, points {B.POINTS}")


def test_known_shapes(spark):
    spike = [[0, 0], [1, 0.001], [2, 0], [2, 5], [2.001, 0], [4, 0], [4, 4], [0, 0]]
    df = frame(spark, [SQUARE, spike, [[0, 0], [1, 1], [2, 0]], [[0, 0], [1, 1]]])
    got = [r["points"] for r in B.simplify_rings(df, 0.01).orderBy("ring").collect()]
    assert [(p["x"], p["y"]) for p in got[0]] == [tuple(map(float, p)) for p in SQUARE]
    assert [(p["x"], p["y"]) for p in got[1]] == [tuple(map(float, p)) for p in plain_simplify([tuple(p) for p in spike], 0.01)]
    assert len(got[2]) == 3 and len(got[3]) == 2
    assert [r[0] for r in df.orderBy("ring").select(B.ring_area("points")).collect()] == [16.0, area(spike), 1.0, 0.0]
    flat = B.quantise_rings(frame(spark, [[[1.23456, 2.5], [0.005, -7.125]]]), 2).first()["flat"]
    assert flat == [1.23, 2.5, 0.0, -7.12]


def collection(*geometries):
    return json.dumps(
        {"type": "FeatureCollection", "features": [{"type": "Feature", "properties": p, "geometry": g} for p, g in geometries]}
    )


NAMED = {"ISO_A2": "", "iso_a2": None, "ADM0_A3": "ABC", "NAME": "Here"}
WORLD = collection(
    (NAMED, {"type": "MultiPolygon", "coordinates": [[SQUARE, HOLE], [ISLAND, HOLE]]}),
    ({"ISO_A2": "-99"}, {"type": "Polygon", "coordinates": [SQUARE + [[1]]]}),
    ({"name": "only a dot"}, {"type": "Point", "coordinates": [1, 2]}),
    ({"name": "tiny"}, {"type": "Polygon", "coordinates": [ISLAND]}),
    ({"name": "none"}, None),
)


def test_features_and_levels(spark, write, tmp_path):
    path = write(WORLD, "world.geojson")
    found = read_geojson(spark, path)
    assert found.count() == 5
    names = {(r["i"], r["n"]) for r in found.select(B.feature_iso("properties").alias("i"), B.feature_name("properties").alias("n")).collect()}
    assert names == {("ABC", "Here"), ("-99", ""), ("", "only a dot"), ("", "tiny"), ("", "none")}
    built = B.build_levels(found, [("countries", "coarse", 0.02, 2.0, 2)]).collect()
    # The small island goes, its hole and the square's hole stay.
    assert sorted((r["iso"], r["polygon"], r["ring_index"], len(r["flat"])) for r in built) == [
        ("-99", 0, 0, 10), ("ABC", 0, 0, 10), ("ABC", 0, 1, 10), ("ABC", 1, 1, 10)
    ]
    manifest = boundary_job(spark, {("countries", "coarse"): path, ("districts", "fine"): path}, str(tmp_path / "out"))
    got = {(r["layer"], r["level"]): (r["features"], r["rings"], r["points"]) for r in manifest.collect()}
    assert got[("countries", "coarse")] == (2, 4, 20)
    assert got[("districts", "fine")] == (3, 6, 30)
    first = manifest.where("layer = 'countries'").first()
    assert (first["source"], first["tolerance"], first["decimals"]) == (path, 0.02, 2)
    assert 0 < first["stored_bytes"] and 0 < first["raw_bytes"] and first["path"].endswith("layer=countries/level=coarse")
    named = B.build_levels(found, [("countries", "coarse", 0.02, 2.0, 2)], label_field="ISO_A2")
    assert {r["name"] for r in named.collect()} != {r["name"] for r in built}


def test_other_documents_are_rejected(spark, write):
    with pytest.raises(DataRejected):
        read_geojson(spark, write('{"type": "Feature"}', "one.geojson"))


def test_broken_feature_lines_are_rejected_with_a_reason(spark, write):
    point = '{"type": "Feature", "properties": {"name": "a"}, "geometry": {"type": "Point", "coordinates": [1, 2]}}'
    bad = ['{"type": "Feature", "prop', '{"type": "Point", "coordinates": [1, 2]}', "{}", "[1]",
           '{"properties": {}, "geometry": {"coordinates": [1]}}', '{"properties": {}, "geometry": {"type": "Point"}}']
    unlocated = '{"type": "Feature", "properties": {"name": "b"}, "geometry": null}'
    path = write("\n".join([point, point, "", unlocated, *bad]) + "\n", "lines.geojsonl")
    good, rejects = feature_lines(spark, path)
    rows = good.collect()
    assert len(rows) == 3 and len({r["feature"] for r in rows}) == 3
    assert sorted((r["properties"]["name"], r["kind"], r["coordinates"]) for r in rows if r["kind"]) == [("a", "Point", "[1,2]")] * 2
    found = {r["line"]: r["reason"] for r in rejects.collect()}
    assert set(found) == set(bad)
    assert found[bad[0]] == "not a JSON object" and found[bad[1]] == found[bad[2]] == "not a feature"
    assert found[bad[4]] == "geometry without a kind" and found[bad[5]] == "geometry without coordinates"
    with pytest.raises(DataRejected, match="no feature"):
        read_geojson(spark, path, lines=True)
    assert read_geojson(spark, write(point + "\n", "good.geojsonl"), lines=True).count() == 1


def test_segments(spark):
    flats = [[0.0, 0.0, 10.0, 0.0, 10.0, 10.0, 0.0, 0.0], [0.0, 0.0], [0.0, 0.0, 10.0, 0.0]]
    df = spark.createDataFrame(list(enumerate(flats)), "ring bigint, flat array<double>")
    got = B.ring_segments(df).orderBy("ring", "segment").collect()
    assert [(r["ring"], r["segment"]) for r in got] == [(0, 0), (0, 1), (0, 2), (2, 0)]
    assert got[0]["start"]["z"] == pytest.approx(100.4) and got[0]["start"]["x"] == pytest.approx(0.0)


def test_registered_simplification_against_the_recursion(spark):
    v = lambda name: view(spark, SMALL, name)
    got = {r["ring"]: r for r in f17_simplify(v).collect()}
    given = rings(v).collect()
    assert len(got) == len(given) > 0
    for r in given:
        points = plain_simplify([(p["x"], p["y"]) for p in r["points"]], TOLERANCE)
        assert got[r["ring"]]["points"] == len(points)
        assert got[r["ring"]]["xs"] == " ".join(f"{x:.4f}" for x, _ in points)
    assert any(got[r["ring"]]["points"] < len(r["points"]) for r in given)


def test_registered_levels_against_a_loop(spark):
    v = lambda name: view(spark, SMALL, name)
    expected = set()
    for r in features(v).collect():
        shape = json.loads(r["coordinates"])
        for number, polygon in enumerate([shape] if r["kind"] == "Polygon" else shape):
            for index, ring in enumerate(polygon):
                points = [tuple(p) for p in ring if len(p) >= 2]
                for layer, level, tolerance, smallest, _ in K.LEVEL_SPECS:
                    if len(points) < 4 or (index == 0 and area(points) < smallest):
                        continue
                    kept = plain_simplify(points, tolerance)
                    if len(kept) >= 4:
                        expected.add((r["feature"], layer, level, number, index, 2 * len(kept)))
    got = f19_levels(v).select("feature", "layer", "level", "polygon", "ring_index", "numbers")
    assert {tuple(r) for r in got.collect()} == expected
    assert got.agg(F.count_distinct("layer", "level")).first()[0] == 6


def test_levels_round_to_the_decimals_of_their_spec(spark):
    ring = [[0.123456, 0.0], [10.123456, 0.0], [10.0, 10.123456], [0.0, 10.0], [0.123456, 0.0]]
    shape = spark.createDataFrame(
        [(1, {"NAME": "a"}, "Polygon", json.dumps([ring]))],
        "feature long, properties map<string,string>, kind string, coordinates string",
    )
    specs = [("x", "one", 0.0, 0.0, 1), ("x", "five", 0.0, 0.0, 5)]
    got = {r["level"]: r["flat"] for r in B.build_levels(shape, specs).collect()}
    assert got["one"][0] == 0.1 and got["five"][0] == 0.12346
    with pytest.raises(Exception, match="no such scale"):
        spark.range(1).select(B.quantise(F.array(F.struct(F.lit(1.0).alias("x"), F.lit(1.0).alias("y"))), F.col("id").cast("int"), [3])).collect()


def test_one_simplification_gives_all_tolerances():
    rng = random.Random(12)
    sizes = [1, 2, 3, 4, 5, 30, 400]
    x, y = (np.array([rng.gauss(0, 1) for _ in range(sum(sizes))]) for _ in range(2))
    ends = np.cumsum(sizes)
    first, last = ends - sizes, ends - 1
    limits = B.stay_limits(x, y, first, last, np.full(len(sizes), 0.05))
    for tolerance in (0.05, 0.2, 0.7, 1.5, 9.0):
        for a, b in zip(first, last):
            points = list(zip(x[a : b + 1], y[a : b + 1]))
            got = [p for p, limit in zip(points, limits[a : b + 1]) if limit > tolerance]
            assert got == plain_simplify(points, tolerance)


def test_levels_call_the_simplification_once_a_ring(spark):
    v = lambda name: view(spark, "/root/testdata/sf0.001", name)
    plan = f19_levels(v)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "Generate" in plan.split("ArrowEvalPython")[0]
