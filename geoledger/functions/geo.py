"""Column functions on coordinates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from geoledger import constants as K


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance."""
    phi1, phi2 = F.radians(lat1), F.radians(lat2)
    half_lat = F.sin((phi2 - phi1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    root = F.sqrt(half_lat * half_lat + F.cos(phi1) * F.cos(phi2) * half_lon * half_lon)
    return F.lit(2 * K.EARTH_RADIUS_KM) * F.asin(F.least(F.lit(1.0), root))


def chord_km(lat: Column, lon: Column) -> tuple[Column, Column, Column]:
    """Earth-centred x, y, z in km; straight distance never exceeds the great-circle distance."""
    phi, theta = F.radians(lat), F.radians(lon)
    radius = F.lit(K.EARTH_RADIUS_KM)
    return (
        radius * F.cos(phi) * F.cos(theta),
        radius * F.cos(phi) * F.sin(theta),
        radius * F.sin(phi),
    )


def globe_xyz(lat: Column | str, lon: Column | str, altitude: float = 0.0) -> Column:
    """Position on the display globe (y up) as STRUCT<x, y, z>."""
    phi = (F.lit(90.0) - _col(lat)) * F.lit(3.141592653589793) / F.lit(180.0)
    theta = (F.lit(90.0) - _col(lon)) * F.lit(3.141592653589793) / F.lit(180.0)
    radius = F.lit(K.GLOBE_RADIUS * (1 + altitude))
    return F.struct(
        (radius * F.sin(phi) * F.cos(theta)).alias("x"),
        (radius * F.cos(phi)).alias("y"),
        (radius * F.sin(phi) * F.sin(theta)).alias("z"),
    )


def cell(value: Column | str, size: float = K.CELL_SIZE) -> Column:
    """Grid cell number along one axis."""
    return F.floor(_col(value) / F.lit(float(size)))


def cell_key(lat: Column | str, lon: Column | str, size: float = K.CELL_SIZE) -> Column:
    return F.concat_ws(":", cell(lat, size).cast("string"), cell(lon, size).cast("string"))


def is_facing(
    lat: Column | str,
    lon: Column | str,
    camera: tuple[float, float, float],
    altitude: float = K.POINT_ALTITUDE,
) -> Column:
    """Whether a point lies on the side of the globe the camera sees."""
    point = globe_xyz(lat, lon, altitude)
    dot = (
        point["x"] * F.lit(float(camera[0]))
        + point["y"] * F.lit(float(camera[1]))
        + point["z"] * F.lit(float(camera[2]))
    )
    return dot >= F.lit(K.GLOBE_RADIUS * K.GLOBE_RADIUS * K.FACING_FACTOR)


def format_coordinates(lat: Column | str, lon: Column | str) -> Column:
    """`40.0801° N, 116.5846° E`."""
    lat, lon = _col(lat), _col(lon)
    return F.concat(
        F.format_string("%.4f", F.abs(lat)),
        F.when(lat >= 0, "° N, ").otherwise("° S, "),
        F.format_string("%.4f", F.abs(lon)),
        F.when(lon >= 0, "° E").otherwise("° W"),
    )


def format_elevation(feet: Column | str) -> Column:
    """`116 ft / 35 m`, a dash when unknown; metres round half up."""
    feet = _col(feet)
    metres = F.floor(feet * F.lit(K.METRES_PER_FOOT) + F.lit(0.5))
    return F.coalesce(
        F.concat(F.format_number(feet, 0), F.lit(" ft / "), F.format_number(metres, 0), F.lit(" m")),
        F.lit("—"),
    )
