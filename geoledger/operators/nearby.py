"""Grid joins: points near other points without a nested loop."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLACK = 1 + 1e-6  # widens search boxes so that rounding never loses a point on the edge


def near_pairs(
    queries: DataFrame,
    points: DataFrame,
    by: Sequence[str],
    axes: Sequence[str],
    radius: float,
    enough: int = 1,
    first_size: float | None = None,
    levels: int = 8,
) -> DataFrame:
    """Pairs with equal `by` that hold, for every query, its `enough` nearest points in `radius`.

    Queries should be distinct by `by` and `axes`. A fixed grid would pair everything inside a
    crowded cell, so cell sizes halve over several levels. When a query's own cell of some level
    has enough points, its nearest ones lie within that cell's diagonal, and the search shrinks to
    that reach. Only queries in empty surroundings search the whole radius, where few points are.
    The result may hold more pairs than asked for; the caller ranks them by true distance.
    """
    by, axes = list(by), list(axes)
    widest = 2.0 * radius
    size = min(first_size or radius, radius) / 2
    sizes = [widest] + [size / 2**step for step in range(levels)]
    reaches = [radius] + [min(radius, cell * len(axes) ** 0.5) for cell in sizes[1:]]
    # A reach found at one level is searched on the grid one step coarser: few cells per axis.
    grids = [widest] + sizes[:-1]
    carried = [name for name in points.columns if name not in by and name not in axes]

    def pick(values: Sequence[float], level: Column) -> Column:
        return F.element_at(F.array(*[F.lit(float(value)) for value in values]), level + 1)

    def cells(size: Column, shift: Column | None = None) -> list[Column]:
        return [F.floor(F.col(axis) / size).alias(f"_c{axis}") for axis in axes]

    cell_names = [f"_c{axis}" for axis in axes]
    level_of = lambda first: F.explode(F.sequence(F.lit(first), F.lit(levels))).alias("_level")
    own_size = pick(sizes, F.col("_level"))

    crowded = (
        points.select(*by, *axes, level_of(1))
        .select(*by, "_level", *cells(own_size))
        .groupBy(*by, "_level", *cell_names)
        .count()
        .where(F.col("count") >= enough)
        .drop("count")
        .withColumn("_hit", F.lit(True))
    )
    deepest = (
        queries.select("*", level_of(0))
        .select("*", *cells(own_size))
        .join(crowded, [*by, "_level", *cell_names], "left")
        .groupBy(*queries.columns)
        .agg(F.max(F.when(F.col("_hit"), F.col("_level"))).alias("_level"))
        .withColumn("_level", F.coalesce(F.col("_level"), F.lit(0)))
    )

    grid, reach = pick(grids, F.col("_level")), pick(reaches, F.col("_level")) * SLACK
    searching = deepest.withColumn("_grid", F.greatest(F.col("_level") - 1, F.lit(0)))
    for axis in axes:
        low = F.floor((F.col(axis) - reach) / grid)
        high = F.floor((F.col(axis) + reach) / grid)
        searching = searching.withColumn(f"_c{axis}", F.explode_outer(F.sequence(low, high)))
    stored = (
        points.select(
            *by,
            *carried,
            *[F.col(axis).alias(f"_p{axis}") for axis in axes],
            F.explode(F.sequence(F.lit(0), F.lit(levels - 1))).alias("_grid"),
        )
    )
    stored_size = pick(sizes, F.col("_grid"))
    stored = stored.withColumns(
        {f"_c{axis}": F.floor(F.col(f"_p{axis}") / stored_size) for axis in axes}
    )
    in_reach = reduce(
        lambda a, b: a & b,
        [F.abs(F.col(axis) - F.col(f"_p{axis}")) <= reach for axis in axes],
    )
    return (
        searching.join(stored, [*by, "_grid", *cell_names])
        .where(in_reach)
        .select(*queries.columns, *carried)
    )
