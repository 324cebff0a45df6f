"""Features stored in zones, with a catalog that prunes them for any tag and any box.

features/   partitioned by (type, zone); a zone is a run of about ``zone_rows`` features in Z-order
zones/      one row per type and zone: number of features, of areas, bounds
postings/   one row per tag of a zone: type, zone, key, value, number of features; sorted by key and value

A tag test or a box first picks zones from the catalog, and dynamic partition
pruning then opens only their files. No key needs a column of its own. Counts,
extents and the list of keys come from the catalog alone.

What is broadcast is a list of (type, zone), at most one row per ``zone_rows``
features: 10**12 features in zones of a million are 16 MB.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.functions.geometry import Box, overlaps
from waymark.functions.sql import unit_side
from waymark.functions.tags import tag_exists, tag_in
from waymark.operators.features import BOUNDS, features
from waymark.sources.store import STORED_COLUMNS, z_order
from waymark.sources.tables import OsmTables

ZONE_ROWS = 1_000_000
_ZONE = ["type", "zone"]
_PARTS = ("features", "zones", "postings")


def write_zones(tables: OsmTables, path: str, columns: Iterable[str] = STORED_COLUMNS,
                zone_rows: int = ZONE_ROWS, mode: str = "errorifexists") -> None:
    """Write features and catalog. Add ``geom``, ``members`` or ``parents`` to store them too."""
    columns = list(dict.fromkeys([*STORED_COLUMNS, *columns]))
    zones = max(1, -(-features(tables, ["fid"]).count() // zone_rows))
    order = ["type", "cell", "fid"]
    (features(tables, columns).withColumn("cell", F.expr(z_order("xmin", "ymin")))
     .repartitionByRange(zones, *order).sortWithinPartitions(*order)
     .withColumn("zone", F.spark_partition_id()).drop("cell")
     .write.mode(mode).partitionBy(*_ZONE).parquet(f"{path}/features"))
    write_catalog(tables.spark, path, mode)


def write_catalog(spark: SparkSession, path: str, mode: str = "errorifexists") -> None:
    """The catalog of what is stored, read from it; also after zones were added."""
    stored = spark.read.parquet(f"{path}/features")
    stored.groupBy(*_ZONE).agg(
        F.count("*").alias("n"), F.count_if("is_area").alias("areas"),
        F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"),
        F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax"),
    ).write.mode(mode).parquet(f"{path}/zones")
    # A tag is counted within its zone's files first, so only one row per tag and zone is shuffled.
    (stored.select(*_ZONE, F.explode("tags")).groupBy(*_ZONE, "key", "value").agg(F.count("*").alias("n"))
     .repartitionByRange("key", "value", "zone").sortWithinPartitions("key", "value", "zone")
     .write.mode(mode).parquet(f"{path}/postings"))


def read_zones(spark: SparkSession, path: str, tags: Mapping[str, Iterable[str] | None] | None = None,
               box: Box | None = None, where: Column | None = None) -> DataFrame:
    """Stored features that have all of ``tags`` and overlap ``box``, from the zones that can hold any.

    ``tags`` names the values wanted of each key, None for any value. ``where``
    is a further predicate on stored columns.
    """
    rows = spark.read.parquet(f"{path}/features")
    for key, values in (tags or {}).items():
        held = spark.read.parquet(f"{path}/postings").where(F.col("key") == key)
        if values is not None:
            held = held.where(F.col("value").isin(values := list(values)))
        rows = _within(rows, held).where(tag_exists(key) if values is None else tag_in(key, values))
    if box is not None:
        rows = _within(rows, spark.read.parquet(f"{path}/zones").where(overlaps(box))).where(overlaps(box))
    return rows if where is None else rows.where(where)


def _within(rows, zones):
    return rows.join(F.broadcast(zones.select(*_ZONE).distinct()), _ZONE, "left_semi").select(rows.columns)


def stored_counts(spark: SparkSession, path: str) -> DataFrame:
    """(type, n, areas) and the bounds of each type, from the catalog alone."""
    return spark.read.parquet(f"{path}/zones").groupBy("type").agg(
        F.sum("n").alias("n"), F.sum("areas").alias("areas"), F.min("xmin").alias("xmin"),
        F.min("ymin").alias("ymin"), F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax"))


def stored_keys(spark: SparkSession, path: str) -> DataFrame:
    """(key, n, n_values): how many features have each key, with how many values; from the catalog alone."""
    by_value = spark.read.parquet(f"{path}/postings").groupBy("key", "value").agg(F.sum("n").alias("n"))
    return by_value.groupBy("key").agg(F.sum("n").alias("n"), F.count("*").alias("n_values"))


def register_zones(spark: SparkSession, name: str, path: str) -> None:
    """The views ``name`` (all stored features), ``name_zones`` and ``name_postings``, and a table function.

    ``name_search(letters, key, value, west, south, east, north)`` gives the
    stored features of the types in ``letters`` (n, w, a, r or ``*``) that have
    the tag and overlap the box, in meters; a NULL key, value or side does not
    restrict. It reads only files of zones that can hold such features.
    """
    for part in _PARTS:
        spark.read.parquet(f"{path}/{part}").createOrReplaceTempView(name if part == "features" else f"{name}_{part}")
    stored = spark.table(name)
    search, columns = f"{name}_search", ", ".join(f"s.`{c}`" for c in stored.columns)
    result = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stored.schema)
    tagged = f"key = {search}.tag_key AND ({search}.tag_value IS NULL OR value = {search}.tag_value)"
    # Of the two sources of zones that can hold the tag, constant folding leaves one.
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION {search}(letters STRING, tag_key STRING, tag_value STRING,
            west DOUBLE, south DOUBLE, east DOUBLE, north DOUBLE) RETURNS TABLE ({result}) RETURN
        SELECT /*+ BROADCAST(z) */ {columns} FROM {name} s
        LEFT SEMI JOIN (SELECT DISTINCT b.type, b.zone
                        FROM (SELECT type, zone FROM {name}_zones WHERE {_in_box(search)}) b
                        LEFT SEMI JOIN (SELECT type, zone FROM {name}_postings WHERE {tagged}
                                        UNION ALL
                                        SELECT type, zone FROM {name}_zones WHERE {search}.tag_key IS NULL) t
                        ON b.type = t.type AND b.zone = t.zone) z
        ON s.type = z.type AND s.zone = z.zone
        WHERE {_of_type(search)} AND {_in_box(search)} AND ({search}.tag_key IS NULL OR
              (tags[{search}.tag_key] IS NOT NULL AND
               ({search}.tag_value IS NULL OR tags[{search}.tag_key] = {search}.tag_value)))""")


def _of_type(search: str) -> str:
    tests = {"n": "s.type = 0", "w": "(s.type = 1 AND NOT is_area)", "a": "is_area", "r": "(s.type = 2 AND NOT is_area)"}
    either = " OR ".join(f"({test} AND contains({search}.letters, '{letter}'))" for letter, test in tests.items())
    return f"({either} OR contains({search}.letters, '*'))"


def _in_box(search: str) -> str:
    sides = (("xmin", "<=", "east"), ("xmax", ">=", "west"), ("ymin", "<=", "north"), ("ymax", ">=", "south"))
    return " AND ".join(f"({search}.{side} IS NULL OR {bound} {sign} {unit_side(f'{search}.{side}')})"
                        for bound, sign, side in sides)
