"""Distance on the sphere and the grid cells that make it an equi-join."""

from __future__ import annotations

import math
from itertools import product

from pyspark.sql import Column, DataFrame, functions as F

# Mean earth radius, km.
EARTH_RADIUS_KM = 6371.0088

# Cells along a radius. Finer ones follow the circle more closely, but a point needs more of them.
FINENESS = 2


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    a = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def _in_cells(lat: Column, lon: Column, size_km: float) -> dict[str, Column]:
    """The point in space, from the centre of the earth, in edges of a cell."""
    scale = EARTH_RADIUS_KM / size_km
    flat = F.cos(F.radians(lat)) * scale
    return {"x": flat * F.cos(F.radians(lon)), "y": flat * F.sin(F.radians(lon)), "z": F.sin(F.radians(lat)) * scale}


def _cell(point: dict[str, Column]) -> Column:
    return F.struct(*[F.floor(v).cast("int").alias(n) for n, v in point.items()])


def space_cell(lat: Column, lon: Column, size_km: float) -> Column:
    """Cube of edge ``size_km`` that holds the point, counted from the centre of the earth.

    A chord is never longer than its arc, so cubes say nothing wrong about distance at the poles or
    across the date line.
    """
    return _cell(_in_cells(lat, lon, size_km))


def covering_cells(points: DataFrame, lat: str, lon: str, radius_km: float, name: str, fineness: int = FINENESS) -> DataFrame:
    """Every point once for each cell, of edge ``radius_km / fineness``, that holds a place within the radius.

    Of the cells around a point, those that the ball of the radius does not reach are left out, and
    those that the surface of the earth does not pass through.
    """
    edge = radius_km / fineness
    reach = 2 * EARTH_RADIUS_KM * math.sin(min(math.pi, radius_km / EARTH_RADIUS_KM) / 2) / edge
    earth = EARTH_RADIUS_KM / edge
    around = F.array(*[F.struct(*[F.lit(d).alias(n) for n, d in zip("xyz", shift)]) for shift in product(range(-fineness, fineness + 1), repeat=3)])
    columns = points.columns
    at = points.withColumn("_at", F.struct(*[v.alias(n) for n, v in _in_cells(F.col(lat), F.col(lon), edge).items()]))
    shifted = at.withColumn("_shift", F.explode(around))
    low = {n: F.floor(F.col("_at")[n]) + F.col("_shift")[n] for n in "xyz"}
    gap, near, far = F.lit(0.0), F.lit(0.0), F.lit(0.0)
    for n, start in low.items():
        outside = F.greatest(start - F.col("_at")[n], F.col("_at")[n] - start - 1, F.lit(0.0))
        inner = F.greatest(start.cast("double"), -start - 1.0, F.lit(0.0))
        outer = F.greatest(F.abs(start), F.abs(start + 1))
        gap, near, far = gap + outside * outside, near + inner * inner, far + outer * outer
    slack = 1e-6
    touched = (gap <= (reach + slack) ** 2) & (near <= (earth + slack) ** 2) & (far >= (earth - slack) ** 2)
    cell = F.struct(*[v.cast("int").alias(n) for n, v in low.items()])
    return shifted.filter(touched).select(*[F.col(f"`{c}`") for c in columns], cell.alias(name))
