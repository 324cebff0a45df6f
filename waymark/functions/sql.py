"""SQL names for the geometry expressions, as temporary SQL functions."""

from __future__ import annotations

from pyspark.sql import SparkSession

from waymark.schema import (BBOX, EARTH_RADIUS, GEOMETRY, MAX_UNIT, METERS_PER_UNIT, MIN_UNIT,
                            UNITS_PER_METER)

_RING_AREA = """abs(aggregate(zip_with(r, slice(r, 2, size(r)), (p, q) -> coalesce(
    (p.x - r[0].x) * (q.y - r[0].y) - (q.x - r[0].x) * (p.y - r[0].y), 0D)), 0D, (a, b) -> a + b)) / 2"""


def unit_side(meters: str) -> str:
    """SQL text for a box side in grid units, as ``units.to_units`` states it."""
    return (f"CAST(least(greatest({meters} * {UNITS_PER_METER!r}D, {MIN_UNIT}D), {MAX_UNIT}D)"
            f" AS INT)")


def register_functions(spark: SparkSession) -> None:
    """Define geom_area, box_overlaps, to_meters, lon_to_meters and lat_to_meters.

    All are expanded into the query, so they are optimized like hand-written
    expressions.
    """
    for definition in (
        f"""geom_area(g {GEOMETRY.simpleString()}) RETURNS DOUBLE
            RETURN CASE WHEN g.kind IN ('Polygon', 'MultiPolygon') THEN
                aggregate(transform(g.parts, rings -> transform(rings, r -> {_RING_AREA})), 0D,
                          (total, areas) -> total + 2 * areas[0]
                              - aggregate(areas, 0D, (a, b) -> a + b))
                WHEN g.kind IS NOT NULL THEN 0D END""",
        f"""box_overlaps(b {BBOX.simpleString()}, xmin DOUBLE, ymin DOUBLE, xmax DOUBLE, ymax DOUBLE)
            RETURNS BOOLEAN
            RETURN b.xmin <= {unit_side('xmax')} AND b.xmax >= {unit_side('xmin')}
               AND b.ymin <= {unit_side('ymax')} AND b.ymax >= {unit_side('ymin')}""",
        f"to_meters(units INT) RETURNS DOUBLE RETURN CAST(units AS DOUBLE) * {METERS_PER_UNIT!r}D",
        f"lon_to_meters(lon DOUBLE) RETURNS DOUBLE RETURN radians(lon) * {EARTH_RADIUS!r}D",
        f"""lat_to_meters(lat DOUBLE) RETURNS DOUBLE
            RETURN ln(tan(0.7853981633974483D + radians(lat) / 2)) * {EARTH_RADIUS!r}D""",
    ):
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {definition}")
