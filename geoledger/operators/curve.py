"""Nearest points on the globe by ranges of a space-filling curve.

Points are put in the order of a curve through earth-centred space, which has no date line and no poles, and cut into
ranges by count, so a crowd is split like any other points. Ranges have boxes, and so have groups of ranges, up to one
box for all. A query first goes straight down to the few ranges that look best and takes the distance of its k-th point
there as a bound. Then it goes down again into the boxes that are nearer than the bound, and meets the points of the
ranges that are left: some ranges around its answer, however many points are in reach.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoledger import constants as K
from geoledger.functions import geo as G
from geoledger.session import written

#: A range holds 16 points, a box 16 ranges or boxes.
STEP = 4
#: Boxes of a level that a query goes down into at first.
BEAM = 8
#: Bits of a row's number inside its partition, as Spark numbers rows.
ROW_BITS = 33
AXES = ("_x", "_y", "_z")
#: Bits of an axis in the curve: about 6 m on the globe. Rows with one key are ordered by their exact place.
AXIS_BITS = 21
#: Kilometres by which boxes are wider than computed, against rounding.
SLACK_KM = 1e-5
#: Digits of a distance in km that count when points are ranked: a millimetre.
KM_DIGITS = 6
_SPREAD = (
    (32, 0x1F00000000FFFF),
    (16, 0x1F0000FF0000FF),
    (8, 0x100F00F00F00F00F),
    (4, 0x10C30C30C30C30C3),
    (2, 0x1249249249249249),
)


def curve_key(axes: Sequence[Column]) -> Column:
    """The place of a point on the curve: the bits of its three axes in turn."""
    size = 2 * K.EARTH_RADIUS_KM
    parts = []
    for shift, axis in enumerate(axes):
        cell = F.floor((axis / size + 0.5) * (1 << AXIS_BITS))
        bits = F.greatest(F.least(cell, F.lit((1 << AXIS_BITS) - 1)), F.lit(0)).cast("long")
        for step, mask in _SPREAD:
            bits = bits.bitwiseOR(F.shiftleft(bits, step)).bitwiseAND(F.lit(mask))
        parts.append(F.shiftleft(bits, shift))
    return reduce(lambda a, b: a.bitwiseOR(b), parts)


@dataclass(frozen=True)
class PointRanges:
    """Points with the number of their range, and the boxes of all levels. Both are tables in the shared folder."""

    points: DataFrame
    boxes: DataFrame
    levels: int


def point_ranges(points: DataFrame, by: Sequence[str]) -> PointRanges:
    """Cut points into ranges of the curve, within equal `by`.

    Points have the axes of `with_axes`. The order is made by range partitions, so no task sees more than its share,
    also not of one value of `by`.
    """
    order = [*by, "_key", *AXES]
    numbered = (
        points.withColumn("_key", curve_key([F.col(a) for a in AXES]))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_row", F.monotonically_increasing_id())
        .drop("_key")
    )
    rows = written(numbered)
    inside = F.col("_row").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    most_rows, most_parts = rows.agg(F.max(inside), F.max(F.shiftright("_row", ROW_BITS))).first()
    shifts = [STEP]
    while (most_rows or 0) >> shifts[-1]:
        shifts.append(shifts[-1] + STEP)
    parts = 0
    while (most_parts or 0) >> parts:
        parts += STEP
        shifts.append(ROW_BITS + parts)

    def boxed(df: DataFrame, low: str, high: str, n: Column) -> DataFrame:
        sides = [f(F.col(f"{side}{a}")).alias(f"{name}{a}") for a in AXES for f, side, name in ((F.min, low, "_lo"), (F.max, high, "_hi"))]
        return df.groupBy(*by, "_level", "_box").agg(n.alias("_n"), *sides)

    leaves = boxed(
        rows.withColumns({"_level": F.lit(0), "_box": F.shiftright("_row", STEP)}), "", "", F.count(F.lit(1))
    )
    table = F.array(*[F.struct(F.lit(i).alias("_level"), F.lit(s - STEP).alias("_shift")) for i, s in enumerate(shifts)])
    above = leaves.drop("_level").select("*", F.inline(table))
    above = above.withColumn("_box", F.call_function("shiftright", "_box", "_shift"))
    boxes = boxed(above, "_lo", "_hi", F.sum("_n"))
    steps = F.array(*[F.lit(b - a) for a, b in zip(shifts, [*shifts[1:], shifts[-1]], strict=True)])
    parent = F.call_function("shiftright", "_box", F.get(steps, F.col("_level")))
    ranged = rows.withColumn("_box", F.shiftright("_row", STEP)).drop("_row")
    return PointRanges(ranged, written(boxes.withColumn("_parent", parent)), len(shifts))


def _gap(low: bool) -> Column:
    """Straight distance from a query to the nearest, or to the farthest place of a box."""
    total = F.lit(0.0)
    for a in AXES:
        below, beyond = F.col(f"_lo{a}") - F.col(a), F.col(a) - F.col(f"_hi{a}")
        side = F.greatest(below, beyond, F.lit(0.0)) if low else F.greatest(F.abs(below), F.abs(beyond))
        total = total + side * side
    return F.sqrt(total)


def _straight(prefix: str) -> Column:
    return F.sqrt(reduce(lambda a, b: a + b, [(F.col(a) - F.col(f"{prefix}{a}")) ** 2 for a in AXES]))


def near_pairs(
    queries: DataFrame, points: DataFrame, by: Sequence[str] = (), k: int = 1, radius: float | None = None
) -> DataFrame:
    """Pairs with equal `by` that hold, for every query, its `k` nearest points in `radius` km.

    Both sides have axes (`with_axes`); queries are distinct by `by` and axes, and points have further columns of names
    that queries do not have. The result has the columns of both; it may hold a few more pairs than asked for, which
    the caller ranks. Points at one spot count each, so the caller leaves no more than k of them. A group with fewer
    than k points gives them all.
    """
    by = [*by] or ["_all"]
    if by == ["_all"]:
        queries, points = (df.withColumn("_all", F.lit(0)) for df in (queries, points))
    index = point_ranges(points, by)
    own = [*by, *AXES]
    beam = max(BEAM, 2 * (-(-k // (1 << STEP))))
    asked = queries.select(*own).distinct()
    limit = F.lit(float("inf") if radius is None else float(radius))

    def level(number: int) -> DataFrame:
        return index.boxes.where(F.col("_level") == number).drop("_level")

    def down(df: DataFrame, number: int) -> DataFrame:
        inner = level(number).withColumnsRenamed({"_box": "_inner", "_parent": "_box"})
        return df.join(inner, [*by, "_box"]).drop("_box").withColumnRenamed("_inner", "_box")

    spots = index.points.select(*by, "_box", *[F.col(a).alias(f"_p{a}") for a in AXES])

    # Straight down to the ranges that look best.
    at = asked.join(level(index.levels - 1).drop("_parent"), by)
    for number in range(index.levels - 1, -1, -1):
        if number < index.levels - 1:
            at = down(at, number)
        seen = F.sort_array(F.collect_list(F.struct(_gap(True).alias("gap"), "_box")))  # of 16 boxes for each one above
        at = at.groupBy(*own).agg(F.slice(seen, 1, beam).alias("_best"))
        at = at.select(*own, F.explode("_best._box").alias("_box"))
    kth = F.get(F.sort_array(F.collect_list(_straight("_p"))), k - 1)
    bound = F.least(kth, limit) + SLACK_KM
    bounded = written(at.join(spots, [*by, "_box"]).groupBy(*own).agg(bound.alias("_bound")))

    # Down again into every box that may hold a nearer point.
    at = bounded.join(level(index.levels - 1).drop("_parent"), by)
    for number in range(index.levels - 1, -1, -1):
        if number < index.levels - 1:
            at = down(at, number)
        at = at.where(_gap(True) <= F.col("_bound")).select(*own, "_bound", "_box")
    found = index.points.withColumnsRenamed({a: f"_p{a}" for a in AXES})
    pairs = at.join(found, [*by, "_box"]).where(_straight("_p") <= F.col("_bound"))
    return queries.join(pairs.drop("_bound", "_box", *[f"_p{a}" for a in AXES]), own).drop("_all")


def with_axes(df: DataFrame, lat: str, lon: str) -> DataFrame:
    """Rows with their place in earth-centred space, in km. Any longitude will do, also beyond 180 degrees."""
    return df.withColumns(dict(zip(AXES, G.chord_km(F.col(lat), F.col(lon)), strict=True)))


def nearest_on_globe(queries: DataFrame, points: DataFrame, k: int = 1, max_km: float | None = None) -> DataFrame:
    """(query, place, position, km): the k nearest points of every query, by great-circle distance.

    Queries are (query, lat, lon) and points (position, lat, lon). Distances go across the date line and the poles.
    Points are ranked by their distance to the millimetre, then by position; `place` counts from one. Points beyond
    `max_km` do not count. Queries at one spot are answered once, and of the points at one spot the first k by
    position. Rows without a coordinate find nothing and are not found; an empty side gives no rows.
    """
    queries = queries.select("query", "lat", "lon").where("lat IS NOT NULL AND lon IS NOT NULL")
    spots = with_axes(queries.select("lat", "lon").distinct(), "lat", "lon")
    # Two coordinates may name one place: the poles, or longitudes a turn apart.
    first = Window.partitionBy("p_lat", "p_lon").orderBy("position")
    places = (
        points.select("position", F.col("lat").alias("p_lat"), F.col("lon").alias("p_lon"))
        .where("p_lat IS NOT NULL AND p_lon IS NOT NULL")
        .withColumn("_n", F.row_number().over(first))
        .where(F.col("_n") <= k)
        .drop("_n")
    )
    pairs = near_pairs(spots.select(*AXES).distinct(), with_axes(places, "p_lat", "p_lon"), k=k, radius=max_km)
    km = F.round(G.haversine_km(F.col("lat"), F.col("lon"), F.col("p_lat"), F.col("p_lon")), KM_DIGITS)
    ranked = spots.join(pairs, list(AXES)).select("lat", "lon", "position", km.alias("km"))
    if max_km is not None:
        ranked = ranked.where(F.col("km") <= max_km)
    place = F.row_number().over(Window.partitionBy("lat", "lon").orderBy("km", "position"))
    ranked = ranked.withColumn("place", place).where(F.col("place") <= k)
    return queries.join(ranked, ["lat", "lon"]).select("query", "place", "position", "km")
