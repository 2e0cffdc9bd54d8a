"""Plane geometry on columns.

A polygon is ``ARRAY<ARRAY<STRUCT<x, y>>>``: all its rings, holes included, under the even-odd
rule. A line has the same type, one inner array per part.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

GEOMETRY = "array<array<struct<x:double,y:double>>>"

# Lambert-93 on the GRS80 ellipsoid.
SEMI_MAJOR = 6378137.0
INVERSE_FLATTENING = 298.257222101
ORIGIN_LATITUDE = 46.5
ORIGIN_LONGITUDE = 3.0
FIRST_PARALLEL = 49.0
SECOND_PARALLEL = 44.0
FALSE_EASTING = 700000.0
FALSE_NORTHING = 6600000.0


def lambert93_constants() -> dict[str, float]:
    """Cone constants of the conformal conic projection with two standard parallels."""
    flattening = 1.0 / INVERSE_FLATTENING
    ecc = math.sqrt(flattening * (2.0 - flattening))

    def radius_ratio(lat: float) -> float:
        phi = math.radians(lat)
        return math.cos(phi) / math.sqrt(1.0 - (ecc * math.sin(phi)) ** 2)

    def isometric(lat: float) -> float:
        phi = math.radians(lat)
        s = ecc * math.sin(phi)
        return math.log(math.tan(math.pi / 4 + phi / 2)) + ecc / 2 * math.log((1 - s) / (1 + s))

    cone = math.log(radius_ratio(FIRST_PARALLEL) / radius_ratio(SECOND_PARALLEL)) / (
        isometric(SECOND_PARALLEL) - isometric(FIRST_PARALLEL)
    )
    scale = SEMI_MAJOR * radius_ratio(FIRST_PARALLEL) * math.exp(cone * isometric(FIRST_PARALLEL)) / cone
    north = FALSE_NORTHING + scale * math.exp(-cone * isometric(ORIGIN_LATITUDE))
    return {"ecc": ecc, "cone": cone, "scale": scale, "north": north}


def to_lambert93(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Degrees to metres (easting, northing)."""
    k = lambert93_constants()
    phi = F.radians(lat)
    s = F.lit(k["ecc"]) * F.sin(phi)
    isometric = F.ln(F.tan(F.lit(math.pi / 4) + phi / 2)) + F.lit(k["ecc"] / 2) * F.ln((1 - s) / (1 + s))
    radius = F.lit(k["scale"]) * F.exp(F.lit(-k["cone"]) * isometric)
    angle = F.lit(k["cone"]) * F.radians(lon - F.lit(ORIGIN_LONGITUDE))
    return F.lit(FALSE_EASTING) + radius * F.sin(angle), F.lit(k["north"]) - radius * F.cos(angle)


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def ring(*corners: tuple[Column, Column]) -> Column:
    """Closed ring through the given corners."""
    return F.array(*[point(x, y) for x, y in (*corners, corners[0])])


def map_points(parts: Column, change) -> Column:
    """Apply ``change(x, y) -> (x, y)`` to every vertex."""
    return F.transform(parts, lambda part: F.transform(part, lambda p: point(*change(p["x"], p["y"]))))


def project_lambert93(parts: Column) -> Column:
    return map_points(parts, to_lambert93)


def bounds(parts: Column) -> Column:
    """Bounding box as STRUCT<minx, miny, maxx, maxy>."""
    points = F.flatten(parts)
    xs = F.transform(points, lambda p: p["x"])
    ys = F.transform(points, lambda p: p["y"])
    return F.struct(
        F.array_min(xs).alias("minx"),
        F.array_min(ys).alias("miny"),
        F.array_max(xs).alias("maxx"),
        F.array_max(ys).alias("maxy"),
    )


def edges(parts: Column) -> Column:
    """Every consecutive vertex pair as STRUCT<x1, y1, x2, y2>."""

    def of_part(part: Column) -> Column:
        count = F.greatest(F.size(part) - 1, F.lit(0))
        return F.zip_with(
            F.slice(part, F.lit(1), count),
            F.slice(part, F.lit(2), count),
            lambda a, b: F.struct(
                a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")
            ),
        )

    return F.flatten(F.transform(parts, of_part))


def _side(e: Column, x: Column, y: Column) -> Column:
    """Positive when (x, y) lies left of the directed edge, 0 on its line."""
    return (e["x2"] - e["x1"]) * (y - e["y1"]) - (e["y2"] - e["y1"]) * (x - e["x1"])


def on_boundary(zone_edges: Column, x: Column, y: Column) -> Column:
    return F.exists(
        zone_edges,
        lambda e: (_side(e, x, y) == 0)
        & x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
        & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"])),
    )


def covers(zone_edges: Column, x: Column, y: Column) -> Column:
    """Point inside or on the boundary: on an edge, or an odd number of edges to its right."""
    to_the_right = F.filter(
        zone_edges,
        lambda e: ((e["y1"] > y) != (e["y2"] > y)) & ((_side(e, x, y) > 0) == (e["y2"] > e["y1"])),
    )
    return on_boundary(zone_edges, x, y) | (F.size(to_the_right) % 2 == 1)


def length(parts: Column) -> Column:
    """Total length of a line."""
    return F.aggregate(
        edges(parts),
        F.lit(0.0),
        lambda acc, e: acc
        + F.sqrt((e["x2"] - e["x1"]) * (e["x2"] - e["x1"]) + (e["y2"] - e["y1"]) * (e["y2"] - e["y1"])),
    )
