"""Simplified boundary rings per layer and level from geographic features."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as S

from geoledger import constants as K
from geoledger.functions import geo as G
from geoledger.functions import text as T
from geoledger.functions.text import _col
from geoledger.session import ship

POINTS = "array<struct<x:double,y:double>>"


def _first_property(properties: Column, names: Sequence[Column | str]) -> Column:
    keys = [name if isinstance(name, Column) else F.lit(name) for name in names]
    values = [T.blank_to_null(F.try_element_at(properties, key)) for key in keys]
    return F.coalesce(*values, F.lit(""))


def feature_iso(properties: Column | str) -> Column:
    """First non-empty country code property; `-99` is a value like any other."""
    return _first_property(_col(properties), K.ISO_PROPERTIES)


def feature_name(properties: Column | str, label_field: Column | str = K.NAME_PROPERTIES[0]) -> Column:
    """The label field's value, or the first non-empty name property behind it."""
    return _first_property(_col(properties), (label_field, *K.NAME_PROPERTIES[1:]))


def to_points(ring: Column) -> Column:
    """A coordinate ring as points; entries with fewer than two numbers are dropped."""
    whole = F.filter(ring, lambda pair: F.size(pair) >= 2)
    return F.transform(
        whole,
        lambda pair: F.struct(F.get(pair, F.lit(0)).alias("x"), F.get(pair, F.lit(1)).alias("y")),
    )


def explode_rings(features: DataFrame, label_field: str = K.NAME_PROPERTIES[0]) -> DataFrame:
    """One row per ring: feature, iso, name, polygon, ring_index, points.

    `features` holds (feature, properties MAP, kind, coordinates JSON text); a `layer` or `level`
    column stays with the rings. A `label_field` column names the property that holds the name, by
    feature; otherwise the argument does.
    """
    polygon = F.from_json("coordinates", "array<array<array<double>>>")
    multi = F.from_json("coordinates", "array<array<array<array<double>>>>")
    polygons = F.when(F.col("kind") == "Polygon", F.array(polygon)).when(
        F.col("kind") == "MultiPolygon", multi
    )
    kept = ["feature", *_source_keys(features)]
    per_polygon = features.select(
        *kept,
        feature_iso("properties").alias("iso"),
        feature_name("properties", F.col("label_field") if "label_field" in features.columns else label_field).alias("name"),
        F.posexplode(polygons).alias("polygon", "rings"),
    )
    per_ring = per_polygon.select(
        *kept, "iso", "name", "polygon", F.posexplode("rings").alias("ring_index", "ring")
    )
    return per_ring.withColumn("points", to_points(F.col("ring"))).drop("ring")


def _source_keys(features: DataFrame) -> list[str]:
    return [name for name in ("layer", "level") if name in features.columns]


def ring_area(points: Column | str) -> Column:
    """Shoelace area in square degrees, without closing the ring; 0 below three points."""
    ring = _col(points)
    steps = F.zip_with(
        F.slice(ring, F.lit(1), F.greatest(F.size(ring) - 1, F.lit(0))),
        F.slice(ring, F.lit(2), F.greatest(F.size(ring) - 1, F.lit(0))),
        lambda a, b: a["x"] * b["y"] - b["x"] * a["y"],
    )
    total = F.aggregate(steps, F.lit(0.0), lambda sum_, step: sum_ + step)
    return F.when(F.size(ring) < 3, F.lit(0.0)).otherwise(F.abs(total) / 2)


def stay_limits(x: np.ndarray, y: np.ndarray, first: np.ndarray, last: np.ndarray, least: np.ndarray) -> np.ndarray:
    """For each point the tolerance below which Douglas-Peucker keeps it, for many rings at once.

    Ring k fills the positions first[k] to last[k]. A span is split at its farthest point, which stays as long as the
    tolerance is below its distance and below the limits of the splits that led there. Spans are split down to the
    tolerance least[k]; points inside the others get 0. Each turn splits all open spans of all rings, so the number of
    turns is the depth of the deepest ring, whatever the number of tolerances asked of the result. Ends and rings of
    fewer than four points stay at any tolerance.
    """
    limits = np.full(len(x), np.inf)
    work = last - first >= 3
    first, last, least = first[work], last[work], least[work]
    inner = last - first - 1
    limits[np.repeat(first + 1 - np.cumsum(inner) + inner, inner) + np.arange(inner.sum())] = 0.0
    above = np.full(len(first), np.inf)
    while True:
        some = last - first > 1
        first, last, least, above = first[some], last[some], least[some], above[some]
        if not len(first):
            return limits
        inner = last - first - 1
        starts = np.cumsum(inner) - inner
        span = np.repeat(np.arange(len(first)), inner)
        at = first[span] + 1 + np.arange(len(span)) - starts[span]
        ax, ay, bx, by = x[first], y[first], x[last], y[last]
        dx, dy = bx - ax, by - ay
        length = np.hypot(dy, dx)
        closed = length == 0
        to_line = np.abs(dy[span] * x[at] - dx[span] * y[at] + bx[span] * ay[span] - by[span] * ax[span])
        to_point = np.hypot(x[at] - ax[span], y[at] - ay[span])
        away = np.where(closed[span], to_point, to_line / np.where(closed, 1.0, length)[span])
        farthest = np.maximum.reduceat(away, starts)
        tops = np.flatnonzero(away == farthest[span])
        _, earliest = np.unique(span[tops], return_index=True)
        middle = at[tops[earliest]]
        split = farthest > least
        first, last, least, middle = first[split], last[split], least[split], middle[split]
        above = np.minimum(above, farthest)[split] if len(split) else above
        limits[middle] = above
        first, last = np.concatenate([first, middle]), np.concatenate([middle, last])
        least, above = np.concatenate([least, least]), np.concatenate([above, above])


def kept_points(
    x: np.ndarray, y: np.ndarray, first: np.ndarray, last: np.ndarray, tolerance: np.ndarray
) -> np.ndarray:
    """Mask of the points that Douglas-Peucker keeps, for many rings at once; all of them at no tolerance."""
    limits = stay_limits(x, y, first, last, tolerance)
    whole = np.repeat(tolerance, last - first + 1)
    return (limits > whole) | (whole <= 0)


@F.arrow_udf(S.ArrayType(S.DoubleType()))
def _stay_limits(x: pa.Array, y: pa.Array, least: pa.Array) -> pa.Array:
    offsets = x.offsets.to_numpy()
    limits = stay_limits(
        x.values.to_numpy(zero_copy_only=False),
        y.values.to_numpy(zero_copy_only=False),
        offsets[:-1].astype(np.int64),
        offsets[1:].astype(np.int64) - 1,
        least.to_numpy(zero_copy_only=False),
    )
    return pa.ListArray.from_arrays(x.offsets, pa.array(limits))


def point_limits(points: Column | str, least: Column | float) -> Column:
    """The points of a ring with the tolerance below which each stays: struct<p, limit>. Exact from `least` on."""
    ring = _col(points)
    ship(SparkSession.active())
    down_to = least if isinstance(least, Column) else F.lit(float(least))
    limits = _stay_limits(F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"]), down_to)
    return F.zip_with(ring, limits, lambda p, limit: F.struct(p.alias("p"), limit.alias("limit")))


def points_at(limited: Column | str, tolerance: Column | float) -> Column:
    """The points that stay at a tolerance; all of them at none."""
    limit = tolerance if isinstance(tolerance, Column) else F.lit(float(tolerance))
    return F.transform(F.filter(_col(limited), lambda q: (q["limit"] > limit) | (limit <= 0)), lambda q: q["p"])


def simplify_points(points: Column | str, tolerance: Column | float) -> Column:
    """The points a ring keeps at a tolerance; ends always stay."""
    return points_at(point_limits(points, tolerance), tolerance)


def simplify_rings(rings: DataFrame, tolerance: Column | float) -> DataFrame:
    """Replace `points` by the simplified ring. One row is one ring; no grouping, no shuffle."""
    return rings.withColumn("points", simplify_points("points", tolerance))


def quantise(points: Column | str, decimals: Column | int, scales: Sequence[int] = ()) -> Column:
    """Rounded and flattened coordinates [x, y, x, y, ...].

    A scale that varies by row must be one of `scales`; another one is an error.
    """
    # bround takes a literal scale, so a scale that varies by row picks from the given ones.
    def rounded(value: Column) -> Column:
        if isinstance(decimals, int):
            return F.bround(value, decimals)
        result = F.raise_error(F.concat(F.lit("no such scale: "), decimals.cast("string"))).cast("double")
        for scale in sorted(set(scales)):
            result = F.when(decimals == scale, F.bround(value, scale)).otherwise(result)
        return result

    return F.flatten(F.transform(_col(points), lambda p: F.array(rounded(p["x"]), rounded(p["y"]))))


def quantise_rings(rings: DataFrame, decimals: int) -> DataFrame:
    return rings.withColumn("flat", quantise("points", decimals))


LevelSpec = tuple[str, str, float, float, int]


def _spec_array(specs: Sequence[LevelSpec]) -> Column:
    names = ("layer", "level", "tolerance", "min_area", "decimals")
    return F.array(
        *[F.struct(*[F.lit(value).alias(name) for name, value in zip(names, spec)]) for spec in specs]
    )


def build_levels(
    features: DataFrame,
    specs: Sequence[LevelSpec] = K.LEVEL_SPECS,
    label_field: str = K.NAME_PROPERTIES[0],
) -> DataFrame:
    """Rings worth drawing at each level: feature, iso, name, layer, level, polygon, ring_index, flat.

    Features that carry `layer` or `level` columns go to the levels that match them, others to
    every level. Short rings go, before and after simplifying; small outer rings go, while holes
    always stay. A feature without rings has no rows. The settings are literals, so nothing is
    joined or shuffled.
    """
    rings = explode_rings(features, label_field).where(F.size("points") >= 4)
    fits = F.filter(
        _spec_array(specs),
        lambda spec: reduce(
            lambda a, b: a & b,
            [F.col(name) == spec[name] for name in _source_keys(features)],
            (F.col("ring_index") > 0) | (F.col("area") >= spec["min_area"]),
        ),
    )
    wanted = rings.withColumn("area", ring_area("points")).withColumn("specs", fits).where(F.size("specs") > 0)
    # One simplification a ring, down to the finest of its levels; each level takes the points that stay at its own.
    least = F.array_min(F.filter(F.transform("specs", lambda s: s["tolerance"]), lambda t: t > 0))
    limited = wanted.withColumn("limited", point_limits("points", F.coalesce(least, F.lit(float("inf")))))
    levels = F.transform(
        "specs", lambda s: F.struct(s.alias("spec"), points_at(F.col("limited"), s["tolerance"]).alias("points"))
    )
    simple = limited.select("feature", "iso", "name", "polygon", "ring_index", F.inline(levels))
    return simple.where(F.size("points") >= 4).select(
        "feature",
        "iso",
        "name",
        "spec.layer",
        "spec.level",
        "polygon",
        "ring_index",
        quantise("points", F.col("spec.decimals"), [spec[4] for spec in specs]).alias("flat"),
    )


def level_stats(rings: DataFrame) -> DataFrame:
    """Features, rings and points per layer and level."""
    per_feature = rings.groupBy("layer", "level", "feature").agg(
        F.count(F.lit(1)).alias("rings"), F.sum(F.size("flat") / 2).cast("bigint").alias("points")
    )
    return per_feature.groupBy("layer", "level").agg(
        F.count(F.lit(1)).alias("features"),
        F.sum("rings").alias("rings"),
        F.sum("points").alias("points"),
    )


def ring_segments(rings: DataFrame, altitude: float = K.LAYER_ALTITUDE["countries"]) -> DataFrame:
    """Consecutive point pairs of each flat ring as globe positions, one row per segment."""
    keys = [name for name in rings.columns if name != "flat"]
    count = F.floor(F.size("flat") / 2) - 1
    numbers = F.when(count >= 1, F.sequence(F.lit(0).cast("bigint"), count - 1))
    at = lambda offset: F.get("flat", (F.col("segment") * 2 + offset).cast("int"))
    return (
        rings.select(*keys, "flat", F.explode(numbers).alias("segment"))
        .withColumns(
            {
                "start": G.globe_xyz(at(1), at(0), altitude),
                "end": G.globe_xyz(at(3), at(2), altitude),
            }
        )
        .drop("flat")
    )
