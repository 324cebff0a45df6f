"""Grid units, meters, and points packed into one BIGINT.

A packed point is one fixed-width value: it can be an equi-join key, and
``min_by``/``max_by`` over it stay in hash aggregation (a struct buffer would
force sort aggregation).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from waymark.schema import EARTH_RADIUS, MAX_UNIT, METERS_PER_UNIT, MIN_UNIT, UNITS_PER_METER


def to_meters(units) -> Column:
    return _col(units).cast("double") * F.lit(METERS_PER_UNIT)


def to_units(meters) -> Column:
    """Meters to grid units: truncated toward zero, clamped to the map."""
    scaled = _col(meters) * F.lit(UNITS_PER_METER)
    return F.least(F.greatest(scaled, F.lit(float(MIN_UNIT))), F.lit(float(MAX_UNIT))).cast("int")


def mercator_x(lon) -> Column:
    return F.radians(_col(lon)) * F.lit(EARTH_RADIUS)


def mercator_y(lat) -> Column:
    return F.log(F.tan(F.lit(0.7853981633974483) + F.radians(_col(lat)) / 2)) * F.lit(EARTH_RADIUS)


# The helpers below build SQL text: they are nested deep, and text costs one
# parse where columns cost a round trip to the JVM per operator.

def pack(x: str, y: str) -> str:
    return f"(shiftleft(CAST({x} AS BIGINT), 32) | (CAST({y} AS BIGINT) & 4294967295))"


def packed_x(point: str) -> str:
    return f"CAST(shiftright({point}, 32) AS INT)"


def packed_y(point: str) -> str:
    return f"CAST(shiftright(shiftleft({point}, 32), 32) AS INT)"


def packed(point: str) -> tuple[str, str]:
    return packed_x(point), packed_y(point)


def cross_halves(a: tuple[str, str], b: tuple[str, str]) -> tuple[str, str]:
    """The cross product a x b of grid points as (high, low): exactly high * 65536 + low.

    Each half of a product of 32-bit numbers fits a BIGINT, and so a sum over
    halves stays in narrow decimals.
    """
    (ax, ay), (bx, by) = [[f"CAST({v} AS BIGINT)" for v in p] for p in (a, b)]
    return (f"CAST({ax} * shiftright({by}, 16) - {bx} * shiftright({ay}, 16) AS DECIMAL(18, 0))",
            f"CAST({ax} * ({by} & 65535) - {bx} * ({ay} & 65535) AS DECIMAL(18, 0))")


def cross(a: tuple[str, str], b: tuple[str, str]) -> str:
    """The cross product a x b of grid points, exactly."""
    high, low = cross_halves(a, b)
    return f"({high} * 65536 + {low})"


def _col(value) -> Column:
    if isinstance(value, Column):
        return value
    return F.col(value) if isinstance(value, str) else F.lit(value)
