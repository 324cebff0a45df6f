"""Column expressions on bounds and on the nested ``geom`` value.

``geom`` is STRUCT<kind, srid, parts>, where parts nests polygons, rings and
points. A point or line is one part with one ring.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from waymark.functions.units import mercator_x, mercator_y, to_meters, to_units
from waymark.schema import SRID


class Box(NamedTuple):
    """A rectangle in Web Mercator meters; each side is a number or a column."""

    xmin: object
    ymin: object
    xmax: object
    ymax: object


def envelope(xmin, ymin, xmax, ymax) -> Box:
    return Box(*[F.lit(float(v)) for v in (xmin, ymin, xmax, ymax)])


def lonlat_envelope(lon_min, lat_min, lon_max, lat_max) -> Box:
    return Box(mercator_x(F.lit(float(lon_min))), mercator_y(F.lit(float(lat_min))),
               mercator_x(F.lit(float(lon_max))), mercator_y(F.lit(float(lat_max))))


def overlaps(box: Box) -> Column:
    """Inclusive overlap of the flat bounds columns with ``box``.

    Compared in integer grid units, so that Parquet min/max statistics of
    stored bounds can skip row groups. NULL bounds never overlap.
    """
    xmin, ymin, xmax, ymax = [to_units(side) for side in box]
    return ((F.col("xmin") <= xmax) & (F.col("xmax") >= xmin)
            & (F.col("ymin") <= ymax) & (F.col("ymax") >= ymin))


def point(x, y) -> Column:
    """Geometry of a node from its grid coordinates."""
    return _geom("Point", F.array(F.array(F.array(_meters(F.col(x), F.col(y))))))


def line(points: Column) -> Column:
    """Geometry of a linear way from its ordered STRUCT<x, y> grid points."""
    return _geom("LineString", F.array(F.array(_ring(points))))


def polygon(points: Column) -> Column:
    """Geometry of an area way: one ring, closed if it is not yet."""
    return _geom("Polygon", F.array(F.array(_ring(close_ring(points)))))


def multipolygon(polygons: Column) -> Column:
    """Geometry of an area relation from grid points nested polygon, ring, point."""
    return _geom("MultiPolygon", F.transform(polygons, lambda p: F.transform(p, _ring)))


def close_ring(points: Column) -> Column:
    first, last = F.element_at(points, 1), F.element_at(points, -1)
    return F.when(first == last, points).otherwise(F.concat(points, F.slice(points, 1, 1)))


def ring_contains(x, y, ring: Column) -> Column:
    """Ray casting toward +x with half-open edges; a boundary point may go either way."""
    def crosses(p, q):
        stabbed = ((p["y"] <= y) & (y < q["y"])) | ((q["y"] <= y) & (y < p["y"]))
        return F.when(stabbed, edge_is_right(x, y, p["x"], p["y"], q["x"], q["y"])).otherwise(False)

    shifted = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))
    hits = F.zip_with(ring, shifted, lambda p, q: F.when(crosses(p, q), 1).otherwise(0))
    odd = F.aggregate(hits, F.lit(0), lambda a, b: a + b) % 2 == 1
    return (F.size(ring) >= 3) & odd


def edge_is_right(x, y, x1, y1, x2, y2) -> Column:
    """Does the edge cross height ``y`` right of ``x``? Only for y1 != y2."""
    return x < (x2 - x1) * (y - y1) / F.nullif(y2 - y1, F.lit(0.0)) + x1


def area(geom="geom") -> Column:
    """Planar area: outer rings less holes; 0 for points and lines, NULL for NULL."""
    g = F.col(geom) if isinstance(geom, str) else geom
    total = F.aggregate(g["parts"], F.lit(0.0), lambda acc, p: acc + _polygon_area(p))
    return (F.when(g["kind"].isin("Polygon", "MultiPolygon"), total)
            .when(g["kind"].isNotNull(), F.lit(0.0)))


def _polygon_area(rings: Column) -> Column:
    outer = _ring_area(F.element_at(rings, 1))
    return F.aggregate(F.slice(rings, 2, F.size(rings)), outer, lambda acc, r: acc - _ring_area(r))


def _ring_area(ring: Column) -> Column:
    # Relative to the first point, so that small rings far out keep their digits.
    x0, y0 = F.element_at(ring, 1)["x"], F.element_at(ring, 1)["y"]
    doubled = F.aggregate(
        F.zip_with(ring, F.slice(ring, 2, F.size(ring)),
                   lambda p, q: F.coalesce((p["x"] - x0) * (q["y"] - y0)
                                           - (q["x"] - x0) * (p["y"] - y0), F.lit(0.0))),
        F.lit(0.0), lambda a, b: a + b)
    return F.abs(doubled) / 2


def _ring(points: Column) -> Column:
    return F.transform(points, lambda p: _meters(p["x"], p["y"]))


def _meters(x: Column, y: Column) -> Column:
    return F.struct(to_meters(x).alias("x"), to_meters(y).alias("y"))


def _geom(kind: str, parts: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), F.lit(SRID).alias("srid"), parts.alias("parts"))
