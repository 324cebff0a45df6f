"""Rings of area relations: member ways joined at their shared ends.

Only way ends take part in joining, so every row here is a fixed-size way
summary; no coordinates travel through Python.
"""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymark.functions.units import cross, packed
from waymark.operators import chains
from waymark.operators.large_groups import split_large
from waymark.operators.ways import merged_bounds, way_summary
from waymark.schema import MAX_GAP_UNITS, WAY
from waymark.sources.tables import OsmTables

# Open ways of one relation and role that one Python call may hold.
TASK_WAYS = 500_000

_GROUP = ["relation_id", "outer"]

_RING_TYPES = (T.LongType(), T.LongType(), T.BooleanType(), T.StringType(), T.LongType(),
               T.LongType())
_RING_FIELDS = [T.StructField(n, t) for n, t in zip(chains.RING_COLUMNS, _RING_TYPES)]

cloudpickle.register_pickle_by_value(chains)


def relation_ways(tables: OsmTables, relation_ids: DataFrame | None = None,
                  area_only: bool = True) -> DataFrame:
    """(relation_id, outer, slot, way_id, is_area): member ways that exist.

    Only the roles ``outer`` and ``inner`` count. ``slot`` is the member's
    place in its relation.
    """
    edges = _role_members(tables, relation_ids, area_only)
    ways = tables.ways.select(F.col("id").alias("way_id"), "is_area")
    return edges.join(ways, "way_id").select("relation_id", "outer", "slot", "way_id", "is_area")


def _role_members(tables, relation_ids, area_only):
    edges = tables.relation_members.where(
        (F.col("member_type") == WAY) & F.col("role").isin("outer", "inner"))
    if area_only:
        areas = tables.relations.where("is_area").select(F.col("id").alias("relation_id"))
        edges = edges.join(areas, "relation_id", "left_semi")
    if relation_ids is not None:
        edges = edges.join(relation_ids, "relation_id", "left_semi")
    return edges.select("relation_id", (F.col("role") == "outer").alias("outer"),
                        F.col("seq").alias("slot"), F.col("member_id").alias("way_id"))


def ring_pieces(member_ways: DataFrame, points: DataFrame) -> DataFrame:
    """Member ways with their summary. An area way left open is closed here.

    ``raw_last`` keeps the last stored point.
    """
    gap = F.col("is_area") & (F.col("first") != F.col("last"))
    mended = f"area2 + {cross(packed('last'), packed('first'))}"
    return member_ways.join(way_summary(points), "way_id").select(
        "relation_id", "outer", "slot", "way_id",
        (F.col("n_points") + F.when(gap, 1).otherwise(0)).alias("n_points"),
        "first", F.when(gap, F.col("first")).otherwise(F.col("last")).alias("last"),
        F.col("last").alias("raw_last"), "first_span", "last_span",
        F.when(gap, F.expr(mended)).otherwise(F.col("area2")).cast("decimal(38,0)").alias("area2"),
        "xmin", "ymin", "xmax", "ymax")


def ring_ways(pieces: DataFrame, max_gap: int = MAX_GAP_UNITS,
              task_ways: int | None = None) -> DataFrame:
    """Each member way with its ring: (…, ring_slot, pos, reversed, status, ring_first, ring_last).

    The ring is named by the slot of the way it grew from. Status is
    ``closed``, ``gap_closed`` or ``discarded``. The plan is lazy, and joins
    the open ways of one group in one task. With ``task_ways``, groups of more
    open ways are split by distributed steps first: cycles are ranked by
    joins, and only connected ways with branches or loose ends meet in one
    call. Those steps run at once, so ``pieces`` should be a written table.
    """
    alone, open_ways = _closed(pieces), pieces.where(~_is_closed())
    if task_ways is None:
        return alone.unionByName(_join_ends(open_ways, _GROUP, max_gap))
    small, cycles, rest = split_large(open_ways, task_ways, max_gap)
    joined = alone.unionByName(_join_ends(small, _GROUP, max_gap))
    if cycles is None:
        return joined
    by_component = _join_ends(rest, [*_GROUP, "component"], max_gap).drop("component")
    return joined.unionByName(cycles).unionByName(by_component)


def _is_closed():
    return (F.col("n_points") >= 4) & (F.col("first") == F.col("last"))


def _closed(pieces: DataFrame) -> DataFrame:
    """Closed ways: each is a ring of its own, in place, without a shuffle."""
    return pieces.where(_is_closed()).select(
        "*", F.col("slot").alias("ring_slot"), F.lit(0).cast("long").alias("pos"), F.lit(False).alias("reversed"),
        F.lit("closed").alias("status"), F.col("first").alias("ring_first"), F.col("last").alias("ring_last"))


def _join_ends(open_ways: DataFrame, group: list[str], max_gap: int) -> DataFrame:
    """Join the open ways of each group: one shuffle; thousands of small groups share one Python call."""
    schema = T.StructType([*open_ways.schema.fields, *_RING_FIELDS])
    return (open_ways.repartition(*group).sortWithinPartitions(*group, "slot")
            .mapInArrow(chains.ring_joiner(group, max_gap), schema))


def rings(ring_ways: DataFrame) -> DataFrame:
    """One row per kept ring: status, n_points, bounds, area2 (twice its area, exactly), ring_first, ring_last."""
    closing = cross(packed("max(ring_last)"), packed("max(ring_first)"))
    return (ring_ways.where("status != 'discarded'")
            .groupBy("relation_id", "outer", "ring_slot")
            .agg(F.max(F.when(F.col("status") == "gap_closed", 1).otherwise(0)).alias("gap"),
                 (F.sum(F.col("n_points") - 1) + 1).alias("n_joined"),
                 F.expr(f"CAST(abs(sum(if(reversed, -area2, area2)) + {closing}) AS DECIMAL(38, 0))").alias("area2"),
                 F.max("ring_first").alias("ring_first"), F.max("ring_last").alias("ring_last"),
                 *merged_bounds())
            .withColumn("status", F.when(F.col("gap") == 1, "gap_closed").otherwise("closed"))
            .withColumn("n_points", F.col("n_joined") + F.col("gap")).drop("gap", "n_joined"))
