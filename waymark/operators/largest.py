"""The largest areas of all, ways and relations alike, with exact areas for candidates only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.operators.features import features
from waymark.operators.large_groups import checkpointed
from waymark.operators.multipolygons import area_relations, relation_measures
from waymark.operators.rings import relation_ways
from waymark.operators.ways import bounds_of, merged_bounds, square_meters, way_area, way_points
from waymark.schema import RELATION, WAY
from waymark.sources.tables import OsmTables

# So many times k features of the highest limits are measured for the first threshold.
_FIRST = 4
_AREA2 = "decimal(38,0)"


def area_limits(tables: OsmTables, chosen: DataFrame) -> DataFrame:
    """(type, fid, limit2): twice the area that each area of ``chosen`` (type, fid) can have at most.

    A closed path of n edges winds less than n / 2 times around any point, so
    it encloses at most its bounds (n - 1) DIV 2 times. The edges of a
    relation's outer ways and those that close its rings are no more than the
    points of these ways. So nothing is stitched and no point is ordered; an
    area without located points has no row.
    """
    ways, relations = _by_type(chosen)
    outer = relation_ways(tables, relations.withColumnRenamed("fid", "relation_id")).where("outer").select(
        "relation_id", "way_id")
    wanted = ways.select(F.col("fid").alias("way_id")).union(outer.select("way_id")).distinct()
    sizes = way_points(tables, wanted).groupBy("way_id").agg(F.count("*").alias("n"), *bounds_of())
    of_ways = sizes.withColumnRenamed("way_id", "fid").join(ways, "fid", "left_semi").select(
        F.lit(WAY).alias("type"), "fid", _limit("2 * ((n - 1) DIV 2)"))
    of_relations = outer.join(sizes, "way_id").groupBy(F.col("relation_id").alias("fid")).agg(
        F.sum("n").alias("n"), *merged_bounds()).select(F.lit(RELATION).alias("type"), "fid", _limit("n - 1"))
    return of_ways.unionByName(of_relations)


def _limit(times: str) -> Column:
    sides = [f"CAST(CAST({c}max AS BIGINT) - {c}min AS DECIMAL(10, 0))" for c in "xy"]
    return F.expr(f"CAST({sides[0]} * {sides[1]} * CAST({times} AS DECIMAL(17, 0)) AS {_AREA2}) AS limit2")


def _by_type(chosen: DataFrame) -> list[DataFrame]:
    return [chosen.where(F.col("type") == t).select("fid") for t in (WAY, RELATION)]


def exact_areas(tables: OsmTables, chosen: DataFrame) -> DataFrame:
    """(type, fid, area2): twice the exact area of each area of ``chosen`` that has a geometry."""
    ways, relations = _by_type(chosen)
    of_ways = way_area(way_points(tables, ways.withColumnRenamed("fid", "way_id")))
    of_relations = relation_measures(area_relations(tables, relations.withColumnRenamed("fid", "relation_id"),
                                                    materialize=True))
    return of_ways.select(F.lit(WAY).alias("type"), F.col("way_id").alias("fid"), "area2").unionByName(
        of_relations.select(F.lit(RELATION).alias("type"), F.col("relation_id").alias("fid"), "area2"))


def largest_areas(tables: OsmTables, k: int, where: Column | None = None) -> DataFrame:
    """(type, fid, area2, area_m2) of the ``k`` largest areas, equal ones by type and fid.

    ``where`` is a predicate on fid, type, tags and is_area. The k-th exact
    area among features of the highest limits is a threshold that none of the
    result lies below; only features whose limit reaches it are measured.
    Limits, threshold and candidates are written once, as slim rows.
    """
    is_area = F.col("is_area") if where is None else F.col("is_area") & where
    chosen = features(tables, ["type", "fid"], where=is_area, types=[WAY, RELATION])
    limits = checkpointed(area_limits(tables, chosen))
    return _top(exact_areas(tables, checkpointed(candidates(tables, limits, k))), k).withColumn("area_m2", square_meters("area2"))


def candidates(tables: OsmTables, limits: DataFrame, k: int) -> DataFrame:
    """(type, fid) of features that may be among the ``k`` largest."""
    first = checkpointed(limits.orderBy(F.col("limit2").desc(), "type", "fid").limit(_FIRST * k))
    floor = checkpointed(_top(exact_areas(tables, first), k).agg(
        F.when(F.count("*") >= k, F.min("area2")).otherwise(0).cast(_AREA2).alias("floor")))
    return limits.join(F.broadcast(floor), F.col("limit2") >= F.col("floor")).select("type", "fid")  # floor: one row


def _top(areas: DataFrame, k: int) -> DataFrame:
    return areas.orderBy(F.col("area2").desc(), "type", "fid").limit(k)
