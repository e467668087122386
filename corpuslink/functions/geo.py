"""Distances on the sphere as native Column arithmetic."""

from __future__ import annotations

import math

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Sphere radius in kilometres and walking speed in metres per second.
EARTH_RADIUS_KM = 6367
WALKING_SPEED = 1.1


def great_circle_metres(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Haversine distance in metres between two points given in degrees."""
    half_lat = (F.radians(lat2) - F.radians(lat1)) / 2
    half_lon = (F.radians(lon2) - F.radians(lon1)) / 2
    chord = F.pow(F.sin(half_lat), 2) + (
        F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(half_lon), 2)
    )
    return 2 * F.asin(F.sqrt(chord)) * EARTH_RADIUS_KM * 1000


def walking_minutes(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Minutes needed to walk between two points."""
    return great_circle_metres(lon1, lat1, lon2, lat2) / (WALKING_SPEED * 60)


def register_time_between(spark: SparkSession, name: str = "time_between") -> None:
    """Offer walking minutes to SQL users as a temporary SQL function (no Python at run time)."""
    spark.sql(
        f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(lon1 DOUBLE, lat1 DOUBLE, lon2 DOUBLE, lat2 DOUBLE)
        RETURNS DOUBLE
        RETURN 2 * asin(sqrt(
            power(sin((radians(lat2) - radians(lat1)) / 2), 2)
            + cos(radians(lat1)) * cos(radians(lat2))
              * power(sin((radians(lon2) - radians(lon1)) / 2), 2)
        )) * {EARTH_RADIUS_KM} * 1000 / ({WALKING_SPEED} * 60)
        """
    )


def reach_cells(lon: Column, lat: Column, minutes: float) -> tuple[Column, Column]:
    """Grid cells for an equi join of points at most ``minutes`` of walking apart: the cell of a point
    (``band``, ``cell``) and the cells, at most nine, in which all points in its reach lie.

    Bands of latitude are as high as the reach. Cells of a band are at least as wide as the reach is,
    in degrees of longitude, at the latitude of the band or its neighbours that is nearest to a pole;
    they go round the sphere, so reach across the date line is found as well."""
    angle = min(max(minutes * WALKING_SPEED * 60 / (EARTH_RADIUS_KM * 1000) * (1 + 1e-9), 1e-9), math.pi)
    high = math.degrees(angle) * (1 + 1e-9)

    def n_cells(band: Column) -> Column:
        farthest = F.least(F.greatest(F.abs((band - 1) * high - 90), F.abs((band + 2) * high - 90)), F.lit(90.0))
        least_cos = F.cos(F.radians(farthest))
        wide = 2 * F.degrees(F.asin(F.least(F.lit(1.0), math.sin(angle / 2) / least_cos))) * (1 + 1e-9)
        whole = (least_cos < 1e-12) | F.lit(angle >= math.pi / 2)
        return F.when(whole, 1).otherwise(F.greatest(F.lit(1), F.floor(360 / wide))).cast("long")

    def cell_in(band: Column) -> Column:
        n = n_cells(band)
        return F.least(F.floor(F.pmod(lon, F.lit(360.0)) / (F.lit(360.0) / n)), n - 1)

    def cells_near(band: Column) -> Column:
        n = n_cells(band)
        around = F.array(*[F.pmod(cell_in(band) + d, n) for d in (-1, 0, 1)])
        return F.transform(F.array_distinct(around), lambda c: F.struct(band.alias("band"), c.alias("cell")))

    own = F.floor((lat + 90) / high)
    near = F.flatten(F.array(*[cells_near(own + d) for d in (-1, 0, 1)]))
    return F.struct(own.alias("band"), cell_in(own).alias("cell")), near
