"""Distances over the earth: the nearest place of each point, and roads estimated from them."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairground import storage

#: Kilometres of the earth's radius, of a road for one through the air, an hour's drive, and up to each band.
RADIUS, ROAD, SPEED = 6371.0088, 1.3, 55.0
BANDS = {"A": 50, "B": 75, "C": 100}
#: Cells of a level are 360 / 2**level degrees wide; the finest have so many levels beyond one place a cell, were they dealt
#: evenly over the earth, since they are not.
BEYOND, FINEST = 3, 12


def haversine(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column) -> Column:
    """Kilometres between two points through the air."""
    a, b = F.radians(lat_a), F.radians(lat_b)
    h = F.pow(F.sin((b - a) / 2), 2) + F.cos(a) * F.cos(b) * F.pow(F.sin((F.radians(lon_b) - F.radians(lon_a)) / 2), 2)
    return 2 * RADIUS * F.asin(F.sqrt(F.least(F.lit(1.0), h)))


def by_road(air: Column) -> dict[str, Column]:
    """``km``, ``minuti`` and ``fascia`` (none beyond 100 km) of a distance through the air."""
    km = air * ROAD
    band = F.lit(None).cast("string")
    for name, upto in sorted(BANDS.items(), reverse=True):
        band = F.when(km <= upto, name).otherwise(band)
    return {"km": km, "minuti": km / SPEED * 60, "fascia": band}


def _cell(lat: Column, lon: Column, level: int) -> tuple[Column, Column]:
    size = 360 / 2**level
    return F.floor((lat + 90) / size), F.pmod(F.floor((lon + 180) / size), F.lit(2**level))


def _sure(lat: Column, level: int) -> Column:
    """Kilometres within which all is in the cell of a point or one next to it."""
    size = min(90.0, 360 / 2**level)
    return RADIUS * F.least(F.lit(math.radians(size)), F.asin(F.least(F.lit(1.0), F.cos(F.radians(lat)) * math.sin(math.radians(size)))))


def nearest(points: DataFrame, places: DataFrame, name: str = "comune") -> DataFrame:
    """``points`` with the ``name`` of the nearest of ``places`` and its distance through the air, ``aria``; ties by name.

    Both have ``lat`` and ``lon``. Points meet the places of their cell and the eight around it; where the nearest found is
    surely the nearest of all it is taken, the others go on with cells four times as wide, over the poles and the date line too.
    Points of one place are looked up once. Without coordinates, or without places, there is none.
    """
    valid = (F.col("lat").between(-90, 90)) & (F.col("lon").between(-180, 180))
    where = storage.stored(points.where(valid).select("lat", "lon").distinct(), "points")
    known = storage.stored(places.where(valid & F.col(name).isNotNull()).select(F.col(name).alias("_name"), F.col("lat").alias("_lat"), F.col("lon").alias("_lon")).distinct(), "places")
    found, left = [], where
    finest = min(FINEST, BEYOND + math.ceil(math.log2(max(1, known.count())) / 2))
    for level in [*range(finest, 1, -2), 1]:
        y, x = _cell(F.col("_lat"), F.col("_lon"), level)
        cells = known.select("*", y.alias("_y"), x.alias("_x"))
        py, px = _cell(F.col("lat"), F.col("lon"), level)
        around = F.array_distinct(F.array(*(F.struct((py + i).alias("_y"), F.pmod(px + j, F.lit(2**level)).alias("_x")) for i in (-1, 0, 1) for j in (-1, 0, 1))))
        met = left.select("lat", "lon", F.inline(around)).join(cells, ["_y", "_x"])
        air = haversine(F.col("lat"), F.col("lon"), F.col("_lat"), F.col("_lon"))
        best = met.groupBy("lat", "lon").agg(F.min(F.struct(air.alias("aria"), F.col("_name").alias("_name"))).alias("_b")).select("lat", "lon", "_b.*")
        # At the widest levels the cells around a point are the whole earth.
        sure = F.lit(True) if level <= 1 else F.col("aria") <= _sure(F.col("lat"), level)
        took = storage.stored(best.where(sure), "nearest")
        found.append(took)
        left = storage.stored(left.join(took, ["lat", "lon"], "left_anti"), "left")
        if left.isEmpty():
            break
    every = found[0]
    for part in found[1:]:
        every = every.unionByName(part)
    every = every.select(F.col("lat").alias("_plat"), F.col("lon").alias("_plon"), F.col("_name").alias(name), "aria")
    return points.join(every, (F.col("lat") == F.col("_plat")) & (F.col("lon") == F.col("_plon")), "left").drop("_plat", "_plon")
