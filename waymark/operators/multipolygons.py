"""Area relations: holes, measures and geometry, from rings to multipolygons."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.functions.geometry import edge_is_right, multipolygon
from waymark.functions.units import packed_x, packed_y, to_meters
from waymark.operators.large_groups import checkpointed
from waymark.operators.rings import TASK_WAYS, relation_ways, ring_pieces, ring_ways, rings
from waymark.operators.ways import (merged_bounds, square_meters, way_chunks, way_edges,
                                    way_points)
from waymark.schema import MAX_GAP_UNITS
from waymark.sources.tables import OsmTables

_RING = ["relation_id", "outer", "ring_slot"]
# After every way of a ring.
_END = 1 << 62
# Grid levels 0..8: a cell of level k is 16^k units wide.
_LEVELS = 9
_LEVEL_BITS = 4


@dataclass(frozen=True)
class AreaRelations:
    """The intermediate tables all multipolygon results share."""

    tables: OsmTables
    members: DataFrame
    ring_ways: DataFrame

    @property
    def rings(self) -> DataFrame:
        return rings(self.ring_ways)


def area_relations(tables: OsmTables, relation_ids: DataFrame | None = None,
                   max_gap: int = MAX_GAP_UNITS, task_ways: int = TASK_WAYS,
                   materialize: bool = False) -> AreaRelations:
    """Stitch the rings of all area relations, or of those in ``relation_ids``.

    By default nothing runs: the result is one lazy plan, with one task for the
    open ways of each relation and role. ``materialize`` writes the pieces and
    the stitched ways (one slim row each), so that holes, measures and geometry
    all read one table, and splits groups of more than ``task_ways`` open ways
    by distributed steps on the way.
    """
    members = relation_ways(tables, relation_ids)
    pieces = ring_pieces(members, way_points(tables, members.select("way_id").distinct()))
    if not materialize:
        return AreaRelations(tables, members, ring_ways(pieces, max_gap))
    return AreaRelations(tables, members, checkpointed(ring_ways(checkpointed(pieces), max_gap, task_ways)))


def hole_assignment(areas: AreaRelations) -> DataFrame:
    """(relation_id, hole_slot, outer_slot): each hole in the first outer ring around it.

    A hole is tested by its first point. Outer rings are candidates only where
    their bounds hold that point, found by an equi-join on grid cells; the
    candidates' edges are then met by an equi-join on height bands. No step
    pairs all holes with all outer rings or edges of a relation.
    """
    around = _candidates(areas.rings)
    bands = _banded(_outer_edges(areas))
    hits = (_by_height(around).join(bands, ["relation_id", "outer_slot", "level", "band"])
            .where((F.least("y1", "y2") <= F.col("py")) & (F.col("py") < F.greatest("y1", "y2")))
            .where(edge_is_right(*[to_meters(c) for c in ("px", "py", "x1", "y1", "x2", "y2")])))
    return (hits.groupBy("relation_id", "hole_slot", "outer_slot").agg(F.count("*").alias("hits"))
            .where(F.col("hits") % 2 == 1)
            .groupBy("relation_id", "hole_slot").agg(F.min("outer_slot").alias("outer_slot")))


def _candidates(all_rings: DataFrame) -> DataFrame:
    """(relation_id, hole_slot, outer_slot, px, py) where the outer bounds hold the point."""
    holes = all_rings.where("NOT outer").selectExpr(
        "relation_id", "ring_slot AS hole_slot",
        f"{packed_x('ring_first')} AS px", f"{packed_y('ring_first')} AS py")
    hole_cells = _at_levels(holes).selectExpr("*", f"{_cell('px')} AS cx", f"{_cell('py')} AS cy")
    width = "greatest(CAST(xmax AS BIGINT) - xmin, CAST(ymax AS BIGINT) - ymin)"
    outer_cells = (all_rings.where("outer")
                   .selectExpr("relation_id", "ring_slot AS outer_slot", "xmin", "ymin", "xmax",
                               "ymax", f"{_level(width)} AS level")
                   .selectExpr("*", f"explode(sequence({_cell('xmin')}, {_cell('xmax')})) AS cx")
                   .selectExpr("*", f"explode(sequence({_cell('ymin')}, {_cell('ymax')})) AS cy"))
    return (hole_cells.join(outer_cells, ["relation_id", "level", "cx", "cy"])
            .where("px BETWEEN xmin AND xmax AND py BETWEEN ymin AND ymax")
            .select("relation_id", "hole_slot", "outer_slot", "px", "py"))


def _outer_edges(areas: AreaRelations) -> DataFrame:
    """Directed edges of outer rings in relations with holes, closing edges included."""
    holed = areas.members.where("NOT outer").select("relation_id").distinct()
    placed = (areas.ring_ways.where("outer AND status != 'discarded'")
              .join(holed, "relation_id", "left_semi"))
    turned = {"x1": "x2", "y1": "y2", "x2": "x1", "y2": "y1"}
    along = placed.select("relation_id", "ring_slot", "way_id", "reversed").join(
        way_edges(way_points(areas.tables, placed.select("way_id").distinct())), "way_id").selectExpr(
        "relation_id", "ring_slot", *[f"if(reversed, {b}, {a}) AS {a}" for a, b in turned.items()])
    closing = f"""explode(filter(array(
        if(raw_last != last, {_segment('raw_last', 'last')}, NULL),
        if(slot = ring_slot AND ring_first != ring_last, {_segment('ring_last', 'ring_first')}, NULL)
        ), c -> c IS NOT NULL)) AS c"""
    return along.unionByName(placed.selectExpr("relation_id", "ring_slot", closing)
                             .select("relation_id", "ring_slot", "c.*"))


def _segment(start: str, end: str) -> str:
    return (f"named_struct('x1', {packed_x(start)}, 'y1', {packed_y(start)}, "
            f"'x2', {packed_x(end)}, 'y2', {packed_y(end)})")


def _banded(edges: DataFrame) -> DataFrame:
    low, high = _cell("least(y1, y2)"), _cell("greatest(y1, y2)")
    return (edges.where("y1 != y2").withColumnRenamed("ring_slot", "outer_slot")
            .selectExpr("*", f"{_level('abs(CAST(y1 AS BIGINT) - y2)')} AS level")
            .selectExpr("*", f"explode(sequence({low}, {high})) AS band"))


def _by_height(points: DataFrame) -> DataFrame:
    return _at_levels(points).selectExpr("*", f"{_cell('py')} AS band")


def _at_levels(df: DataFrame) -> DataFrame:
    return df.selectExpr("*", f"explode(sequence(0, {_LEVELS - 1})) AS level")


def _level(extent: str) -> str:
    """The finest level whose cells are at least ``extent`` wide: at most 2 cells per axis.

    16^k >= extent exactly when extent - 1 has at most k hex digits.
    """
    return f"if({extent} <= 1, 0, length(hex({extent} - 1)))"


def _cell(value: str) -> str:
    return f"shiftright(CAST({value} AS BIGINT), level * {_LEVEL_BITS})"


def relation_measures(areas: AreaRelations) -> DataFrame:
    """(relation_id, n_polygons, n_holes, orphan_holes, n_points, area2, area_units, area_m2, bounds).

    A relation without a kept outer ring has no geometry and no row.
    """
    rows = _with_polygon(areas.rings, areas)
    is_hole = ~F.col("outer") & F.col("polygon_slot").isNotNull()
    kept = F.col("polygon_slot").isNotNull()
    area2 = F.sum(F.when(F.col("outer"), F.col("area2")).when(is_hole, -F.col("area2")).otherwise(0))
    # Bounds are those of the outer rings; min and max skip the NULLs of holes.
    outer_bounds = [f(F.when(F.col("outer"), F.col(c))).alias(c) for f, c in (
        (F.min, "xmin"), (F.min, "ymin"), (F.max, "xmax"), (F.max, "ymax"))]
    return rows.groupBy("relation_id").agg(
        F.count_if("outer").alias("n_polygons"),
        F.count_if(is_hole).alias("n_holes"),
        F.count_if(~kept).alias("orphan_holes"),
        F.sum(F.when(kept, F.col("n_points"))).alias("n_points"),
        area2.cast("decimal(38,0)").alias("area2"),
        *outer_bounds).where(F.col("n_polygons") > 0).withColumns({
            "area_units": F.col("area2").cast("double") / 2, "area_m2": square_meters("area2")})


def _with_polygon(ring_rows: DataFrame, areas: AreaRelations) -> DataFrame:
    """Add ``polygon_slot``: the outer ring a ring belongs to, NULL for an orphan hole."""
    assigned = hole_assignment(areas).select(
        "relation_id", F.lit(False).alias("outer"), F.col("hole_slot").alias("ring_slot"),
        "outer_slot")
    return ring_rows.join(assigned, ["relation_id", "outer", "ring_slot"], "left").withColumn(
        "polygon_slot", F.when(F.col("outer"), F.col("ring_slot")).otherwise(F.col("outer_slot")))


def relation_bounds(areas: AreaRelations) -> DataFrame:
    return areas.rings.where("outer").groupBy("relation_id").agg(*merged_bounds())


def ring_chunks(areas: AreaRelations) -> DataFrame:
    """(relation_id, polygon_slot, outer, ring_slot, pos, step, points): every kept ring, in pieces.

    A chunk holds the grid points of one span of one way in the direction of
    the ring, without the point it shares with the way before. Ordered by
    (pos, step), the chunks of a ring are its closed path. No row is larger
    than a span, whatever the size of the way, ring or relation.
    """
    kept = areas.ring_ways.where("status != 'discarded'")
    chunks = way_chunks(way_points(areas.tables, kept.select("way_id").distinct()))
    slim = kept.select("relation_id", "outer", "ring_slot", "way_id", "pos", "reversed", "first_span", "last_span",
                       "first", (F.col("raw_last") != F.col("last")).alias("mended"))
    turned = F.col("reversed")
    along = slim.join(chunks, "way_id").select(
        *_RING, "pos", F.when(turned, -F.col("span")).otherwise(F.col("span")).alias("step"),
        F.when(turned, F.reverse("points")).otherwise(F.col("points")).alias("points"),
        ((F.col("pos") > 0) & F.when(turned, (F.col("span") == F.col("last_span")) & ~F.col("mended"))
         .otherwise(F.col("span") == F.col("first_span"))).alias("shared"))
    # An area way left open returns to its first point; backwards that point comes first, and is shared.
    back = slim.where("mended AND NOT (reversed AND pos > 0)").select(
        *_RING, "pos", F.when(turned, -F.col("last_span") - 1).otherwise(F.col("last_span") + 1).alias("step"),
        _points("first"), F.lit(False).alias("shared"))
    # A gap is closed by the first point; so is a ring that goes out and back over three points.
    end = kept.where("status = 'gap_closed' AND slot = ring_slot").select(
        *_RING, F.lit(_END).alias("pos"), F.lit(0).cast("long").alias("step"), _points("ring_first"),
        F.lit(False).alias("shared"))
    rows = along.unionByName(back).unionByName(end).withColumn(
        "points", F.when(F.col("shared"), F.slice("points", 2, F.greatest(F.size("points"), F.lit(1))))
        .otherwise(F.col("points"))).drop("shared").where(F.size("points") > 0)
    return _with_polygon(rows, areas).drop("outer_slot").where(F.col("polygon_slot").isNotNull())


def _points(point: str):
    return F.expr(f"array(named_struct('x', {packed_x(point)}, 'y', {packed_y(point)}))").alias("points")


def relation_geometry(areas: AreaRelations) -> DataFrame:
    """(relation_id, geom): the MultiPolygon, polygons and holes in slot order.

    One shuffle by relation, in which the chunks fold into rings, rings into
    polygons and polygons into the value. The array is the feature's own
    value; use ``ring_chunks`` or ``relation_measures`` for relations too large
    for one.
    """
    by_relation = ring_chunks(areas).repartition("relation_id")
    path = F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("pos", "step", "points"))),
                                 lambda c: c["points"]))
    ring = by_relation.groupBy("relation_id", "polygon_slot", "outer", "ring_slot").agg(path.alias("points"))
    polygons = ring.groupBy("relation_id", "polygon_slot").agg(F.transform(
        F.sort_array(F.collect_list(F.struct(~F.col("outer"), "ring_slot", "points"))),
        lambda r: r["points"]).alias("polygon"))
    return polygons.groupBy("relation_id").agg(multipolygon(F.transform(
        F.sort_array(F.collect_list(F.struct("polygon_slot", "polygon"))),
        lambda p: p["polygon"])).alias("geom"))
