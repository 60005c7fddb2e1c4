"""Grid neighbourhoods, nearest picks and globe positions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoledger import constants as K
from geoledger.functions import geo as G
from geoledger.operators.nearby import near_pairs


def build_grid(points: DataFrame, size: float = K.CELL_SIZE) -> DataFrame:
    """Occupied cells with their number of points and the first and last position."""
    return points.groupBy(
        G.cell("lat", size).alias("cell_lat"), G.cell("lon", size).alias("cell_lon")
    ).agg(
        F.count(F.lit(1)).alias("points"),
        F.min("position").alias("first_position"),
        F.max("position").alias("last_position"),
    )


def _around(queries: DataFrame, size: float, rings: int, wrap: bool) -> DataFrame:
    """Queries repeated for each of the (2r+1)² cells around them."""
    offsets = F.sequence(F.lit(-rings), F.lit(rings))
    spread = queries.select(
        "*",
        G.cell("lat", size).alias("_lat"),
        G.cell("lon", size).alias("_lon"),
        F.explode(offsets).alias("d_lat"),
    ).select("*", F.explode(offsets).alias("d_lon"))
    lon = F.col("_lon") + F.col("d_lon")
    if wrap:
        half, whole = round(180 / size), round(360 / size)
        lon = F.pmod(lon + half, F.lit(whole)) - half
    return spread.withColumns(
        {"cell_lat": F.col("_lat") + F.col("d_lat"), "cell_lon": lon}
    ).drop("_lat", "_lon")


def neighbour_cells(
    queries: DataFrame,
    points: DataFrame,
    size: float = K.CELL_SIZE,
    rings: int = 1,
    wrap: bool = False,
) -> DataFrame:
    """Occupied cells around each query: at most (2r+1)² rows per query, however full a cell is."""
    near = _around(queries.select("query", "lat", "lon"), size, rings, wrap)
    return near.join(build_grid(points, size), ["cell_lat", "cell_lon"]).select(
        "query", "d_lat", "d_lon", "points", "first_position", "last_position"
    )


def neighbour_counts(
    queries: DataFrame,
    points: DataFrame,
    size: float = K.CELL_SIZE,
    rings: int = 1,
    wrap: bool = False,
) -> DataFrame:
    """How many points lie in the cells around each query, zero included."""
    found = neighbour_cells(queries, points, size, rings, wrap).groupBy("query").agg(
        F.sum("points").alias("points"), F.count(F.lit(1)).alias("cells")
    )
    return queries.select("query").join(found, "query", "left").select(
        "query",
        F.coalesce("points", F.lit(0)).alias("points"),
        F.coalesce("cells", F.lit(0)).alias("cells"),
    )


def neighbour_pairs(
    queries: DataFrame,
    points: DataFrame,
    size: float = K.CELL_SIZE,
    rings: int = 1,
    wrap: bool = False,
) -> DataFrame:
    """(query, position) for every point in the cells around each query, with its cell offset.

    The result is as large as the neighbourhoods are full; nearest_pick and neighbour_counts
    answer their questions without it.
    """
    cells = points.select(
        "position", G.cell("lat", size).alias("cell_lat"), G.cell("lon", size).alias("cell_lon")
    )
    near = _around(queries.select("query", "lat", "lon"), size, rings, wrap)
    return near.join(cells, ["cell_lat", "cell_lon"]).select("query", "position", "d_lat", "d_lon")


def nearest_pick(
    queries: DataFrame,
    points: DataFrame,
    max_dist: float,
    size: float = K.CELL_SIZE,
    rings: Sequence[int] = K.PICK_RINGS,
) -> DataFrame:
    """(query, position, distance): the nearest point within a planar distance, limit included.

    The smallest ring of cells with a hit wins, then the shorter distance; on equal distance the
    later cell, then the later position. Queries at one spot are answered once, and points at one
    spot compete through their last position only.
    """
    spots = queries.select("lat", "lon").distinct()
    places = points.groupBy("lat", "lon").agg(F.max("position").alias("position"))
    places = places.withColumns({"p_lat": F.col("lat"), "p_lon": F.col("lon")})
    pairs = near_pairs(
        spots, places, by=[], axes=["lat", "lon"], radius=float(max_dist), first_size=2 * size
    )
    d_lat = G.cell("p_lat", size) - G.cell("lat", size)
    d_lon = G.cell("p_lon", size) - G.cell("lon", size)
    steps = F.greatest(F.abs(d_lat), F.abs(d_lon))
    ring = F.lit(None).cast("int")
    for count in sorted(rings, reverse=True):
        ring = F.when(steps <= count, count).otherwise(ring)
    dx, dy = F.col("p_lon") - F.col("lon"), F.col("p_lat") - F.col("lat")
    square = dx * dx + dy * dy
    limit = float(max_dist) * float(max_dist)
    found = (
        pairs.select(
            "lat",
            "lon",
            F.struct(
                ring.alias("ring"),
                square.alias("square"),
                (-d_lat).alias("a"),
                (-d_lon).alias("b"),
                (-F.col("position")).alias("c"),
            ).alias("rank"),
        )
        .where(F.col("rank.ring").isNotNull() & (F.col("rank.square") <= limit))
        .groupBy("lat", "lon")
        .agg(F.min("rank").alias("rank"))
    )
    return queries.join(found, ["lat", "lon"]).select(
        "query", (-F.col("rank.c")).alias("position"), F.sqrt("rank.square").alias("distance")
    )


def facing(df: DataFrame, camera: tuple[float, float, float]) -> DataFrame:
    """Points on the side of the globe the camera sees."""
    return df.where(G.is_facing("lat", "lon", camera))
