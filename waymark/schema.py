"""Fixed values and column types shared by the whole package."""

from __future__ import annotations

from pyspark.sql import types as T

# The data model prescribes them.
NODE, WAY, RELATION = 0, 1, 2
TYPE_NAMES = {NODE: "node", WAY: "way", RELATION: "relation"}
SRID = 3857
# Coordinates are 32-bit integers that span the square Web Mercator map.
METERS_PER_UNIT = 40075016.68558 / 4294967294.9999
UNITS_PER_METER = 4294967294.9999 / 40075016.68558
MIN_UNIT, MAX_UNIT = -2147483648, 2147483647
EARTH_RADIUS = 6378137.0
# Ring ends closer than this, on both axes, are joined by one more point.
MAX_GAP_UNITS = 100

TAGS = T.MapType(T.StringType(), T.StringType())
POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
RING = T.ArrayType(POINT)
GEOMETRY = T.StructType([
    T.StructField("kind", T.StringType()),
    T.StructField("srid", T.IntegerType()),
    T.StructField("parts", T.ArrayType(T.ArrayType(RING))),
])
MEMBERS = T.ArrayType(T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("id", T.StringType()),
    T.StructField("role", T.StringType()),
]))
PARENTS = T.ArrayType(T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("id", T.StringType()),
]))
BBOX = T.StructType([T.StructField(c, T.IntegerType()) for c in ("xmin", "ymin", "xmax", "ymax")])

# Every column the feature view can produce.
FEATURE_TYPES = {
    "fid": T.LongType(),
    "type": T.IntegerType(),
    "tags": TAGS,
    "geom": GEOMETRY,
    "is_area": T.BooleanType(),
    "members": MEMBERS,
    "parents": PARENTS,
    "bbox": BBOX,
    "xmin": T.IntegerType(),
    "ymin": T.IntegerType(),
    "xmax": T.IntegerType(),
    "ymax": T.IntegerType(),
    "members_truncated": T.LongType(),
    "parents_truncated": T.LongType(),
}
