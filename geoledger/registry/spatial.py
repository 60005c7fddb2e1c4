"""Grid neighbourhoods, nearest picks and globe positions."""

from __future__ import annotations

from pyspark.sql import functions as F

from geoledger import constants as K
from geoledger.functions import geo as G
from geoledger.operators import curve as C
from geoledger.operators import spatial as SP
from geoledger.registry import query

CAMERA = (120.0, 80.0, 260.0)


def points(v):
    return v("places").select(
        F.col("id").alias("position"), F.col("latitude_deg").alias("lat"), F.col("longitude_deg").alias("lon")
    )


def cursors(v):
    """Every entity coordinate is a place somebody points at."""
    return v("entities").select(F.col("qid").alias("query"), "lat", "lon")


def xyz_sql(lat: str, lon: str, altitude: float) -> dict[str, str]:
    radius = repr(K.GLOBE_RADIUS * (1 + altitude))
    phi, theta = f"((90.0e0 - {lat}) * pi() / 180)", f"((90.0e0 - {lon}) * pi() / 180)"
    return {
        "x": f"({radius}e0 * sin({phi}) * cos({theta}))",
        "y": f"({radius}e0 * cos({phi}))",
        "z": f"({radius}e0 * sin({phi}) * sin({theta}))",
    }


def rounded(value, name):
    return (F.round(value, 6) + F.lit(0.0)).alias(name)


_XYZ = xyz_sql("latitude_deg", "longitude_deg", K.POINT_ALTITUDE)
_GRID = """
cells as (
 select id as position, latitude_deg as lat, longitude_deg as lon,
  cast(floor(latitude_deg / 0.5e0) as bigint) as cell_lat, cast(floor(longitude_deg / 0.5e0) as bigint) as cell_lon
 from {places}
), asked as (
 select qid as query, lat, lon, cast(floor(lat / 0.5e0) as bigint) as cell_lat,
  cast(floor(lon / 0.5e0) as bigint) as cell_lon from {entities}
)"""


@query("f12_cell_key", """
select id, cast(cast(floor(latitude_deg / 0.5e0) as bigint) as varchar(20)) || ':'
 || cast(cast(floor(longitude_deg / 0.5e0) as bigint) as varchar(20)) as cell from {places}
""")
def _f12(v):
    return v("places").select("id", G.cell_key("latitude_deg", "longitude_deg").alias("cell"))


@query("j7_build_grid", f"""
with {_GRID} select cell_lat, cell_lon, count(*) as points, min(position) as first_position,
 max(position) as last_position from cells group by cell_lat, cell_lon
""")
def j7_grid(v):
    return SP.build_grid(points(v))


@query("j7_neighbour_counts", f"""
with {_GRID} select query, count(position) as points, count(distinct c.cell_lat * 100000 + c.cell_lon) as cells
from asked a left join cells c on abs(a.cell_lat - c.cell_lat) <= 2 and abs(a.cell_lon - c.cell_lon) <= 2
group by query
""")
def _j7_counts(v):
    return SP.neighbour_counts(cursors(v), points(v), rings=2)


@query("j7_neighbour_pairs", f"""
with {_GRID} select query, position, c.cell_lat - a.cell_lat as d_lat, c.cell_lon - a.cell_lon as d_lon
from asked a join cells c on abs(a.cell_lat - c.cell_lat) <= 1 and abs(a.cell_lon - c.cell_lon) <= 1
""")
def _j7_pairs(v):
    pairs = SP.neighbour_pairs(cursors(v), points(v))
    return pairs.withColumns({"d_lat": F.col("d_lat").cast("bigint"), "d_lon": F.col("d_lon").cast("bigint")})


@query("j8_nearest_pick", f"""
with {_GRID}, hits as (
 select query, position, c.cell_lat - a.cell_lat as d_lat, c.cell_lon - a.cell_lon as d_lon,
  (c.lon - a.lon) * (c.lon - a.lon) + (c.lat - a.lat) * (c.lat - a.lat) as square,
  greatest(abs(c.cell_lat - a.cell_lat), abs(c.cell_lon - a.cell_lon)) as steps
 from asked a join cells c on abs(a.cell_lat - c.cell_lat) <= 4 and abs(a.cell_lon - c.cell_lon) <= 4
)
select query, position, round(sqrt(square), 6) as distance from hits where square <= 1.5e0 * 1.5e0
qualify row_number() over (partition by query order by case when steps <= 1 then 1 when steps <= 2 then 2 else 4 end,
 square, d_lat desc, d_lon desc, position desc) = 1
""")
def j8_nearest(v):
    found = SP.nearest_pick(cursors(v), points(v), 1.5)
    return found.withColumn("distance", F.round("distance", 6))


def seekers(v):
    """Every entity coordinate as it is, moved to the date line, and moved to the poles."""
    asked = cursors(v)
    line = asked.select(F.concat("query", F.lit("-line")), "lat", F.when(F.col("lon") < 0, -180.0).otherwise(180.0) - F.col("lon") / 900)
    poles = asked.select(F.concat("query", F.lit("-pole")), F.when(F.col("lat") < 0, -90.0).otherwise(90.0), "lon")
    return asked.union(line).union(poles)


@query("j8_nearest_on_globe", f"""
with asked as (
 select qid as query, lat, lon from {{entities}}
 union all select qid || '-line', lat, (case when lon < 0 then -180.0e0 else 180.0e0 end) - lon / 900 from {{entities}}
 union all select qid || '-pole', case when lat < 0 then -90.0e0 else 90.0e0 end, lon from {{entities}}
), far as (
 select query, id as position, round(2 * {K.EARTH_RADIUS_KM!r}e0 * asin(least(1.0e0, sqrt(
   sin((radians(latitude_deg) - radians(lat)) / 2) * sin((radians(latitude_deg) - radians(lat)) / 2)
   + cos(radians(lat)) * cos(radians(latitude_deg)) * sin(radians(longitude_deg - lon) / 2)
     * sin(radians(longitude_deg - lon) / 2)))), 6) as km
 from asked cross join {{places}}
)
select query, cast(row_number() over w as integer) as place, position, km from far where km <= 1500
window w as (partition by query order by km, position) qualify row_number() over w <= 3
""")
def j8_globe(v):
    return C.nearest_on_globe(seekers(v), points(v), k=3, max_km=1500.0)


@query("f11_globe_xyz", f"""
select id, {', '.join(f'round({value}, 6) + 0.0e0 as {name}' for name, value in _XYZ.items())} from {{places}}
""")
def _f11(v):
    point = G.globe_xyz("latitude_deg", "longitude_deg", K.POINT_ALTITUDE)
    return v("places").select("id", *[rounded(point[name], name) for name in ("x", "y", "z")])


@query("f13_facing", f"""
select id as position from {{places}}
where {_XYZ['x']} * 120.0e0 + {_XYZ['y']} * 80.0e0 + {_XYZ['z']} * 260.0e0 >= 9200.0e0
""")
def _f13(v):
    return SP.facing(points(v), CAMERA).select("position")
