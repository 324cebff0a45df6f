"""Ways as rows of points: coordinates, bounds, summaries and edges.

Nothing here gathers a way into one value except ``way_shapes``, whose array
is the geometry itself. Lengths, ends, bounds and areas come from aggregates
over rows; order matters only inside spans of ``seq``, and spans are combined
from one slim row each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waymark.functions.units import cross, cross_halves, pack, packed, packed_x, packed_y
from waymark.schema import METERS_PER_UNIT
from waymark.sources.tables import OsmTables


def way_points(tables: OsmTables, way_ids: DataFrame | None = None) -> DataFrame:
    """(way_id, span, seq, x, y) for every way node whose node exists.

    ``way_ids`` (one column ``way_id``, without repeats) restricts the ways
    before the node join, which is the widest shuffle of the engine.
    """
    refs = tables.way_nodes
    if way_ids is not None:
        refs = refs.join(way_ids, "way_id", "left_semi")
    if "x" in refs.columns:
        located = refs.where(F.col("x").isNotNull())
    else:
        nodes = tables.nodes.select(F.col("id").alias("node_id"), "x", "y")
        located = refs.join(nodes, "node_id")
    return located.selectExpr("way_id", f"seq DIV {tables.seq_span} AS span", "seq", "x", "y")


def bounds_of(x="x", y="y") -> list:
    return [F.min(x).alias("xmin"), F.min(y).alias("ymin"),
            F.max(x).alias("xmax"), F.max(y).alias("ymax")]


def merged_bounds() -> list:
    return [F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"),
            F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax")]


def way_bounds(points: DataFrame) -> DataFrame:
    return points.groupBy("way_id").agg(*bounds_of())


def way_shapes(points: DataFrame) -> DataFrame:
    """Bounds and the ordered points of each way, one row per way."""
    ordered = F.sort_array(F.collect_list(F.struct("seq", "x", "y")))
    return points.groupBy("way_id").agg(
        *bounds_of(),
        F.transform(ordered, lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y")))
        .alias("points"))


def way_chunks(points: DataFrame) -> DataFrame:
    """(way_id, span, points): the ordered points of each span, so no value holds a whole long way."""
    ordered = F.sort_array(F.collect_list(F.struct("seq", "x", "y")))
    return points.groupBy("way_id", "span").agg(
        F.transform(ordered, lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"))).alias("points"))


def way_summary(points: DataFrame) -> DataFrame:
    """One fixed-size row per way: n_points, first/last point and span, bounds, area2.

    ``area2`` is the exact sum of x1 y2 - x2 y1 over the way's edges, without a
    closing edge. Sums of edges merge in any order to the same value, so rings
    get twice their signed area without their points being gathered.
    """
    bridge = f"coalesce({cross(packed('last'), packed('next_first'))}, 0)"
    return (_linked(_span_summary(points))
            .groupBy("way_id")
            .agg(F.sum("n_points").alias("n_points"),
                 F.min_by("first", "span").alias("first"),
                 F.max_by("last", "span").alias("last"),
                 F.min("span").alias("first_span"), F.max("span").alias("last_span"),
                 F.expr(f"CAST(sum(area2 + {bridge}) AS DECIMAL(38, 0))").alias("area2"),
                 *merged_bounds()))


def way_area(points: DataFrame) -> DataFrame:
    """(way_id, area2, area_m2) enclosed by each way, closed by a straight edge if it is open.

    ``area2`` is twice the area in grid units, exactly.
    """
    closed = f"CAST(abs(area2 + {cross(packed('last'), packed('first'))}) AS DECIMAL(38, 0)) AS area2"
    return way_summary(points).selectExpr("way_id", closed).withColumn("area_m2", square_meters("area2"))


def square_meters(area2: str):
    """Square meters of a doubled area in grid units, rounded once."""
    return F.col(area2).cast("double") / 2 * METERS_PER_UNIT * METERS_PER_UNIT


def way_edges(points: DataFrame) -> DataFrame:
    """(way_id, x1, y1, x2, y2), one row per pair of consecutive points."""
    inner = (_with_neighbours(points).where("nx IS NOT NULL")
             .selectExpr("way_id", "x AS x1", "y AS y1", "nx AS x2", "ny AS y2"))
    between = (_linked(_span_summary(points)).where("next_first IS NOT NULL")
               .selectExpr("way_id", f"{packed_x('last')} AS x1", f"{packed_y('last')} AS y1",
                           f"{packed_x('next_first')} AS x2", f"{packed_y('next_first')} AS y2"))
    return inner.unionByName(between)


def _with_neighbours(points: DataFrame) -> DataFrame:
    in_span = Window.partitionBy("way_id", "span").orderBy("seq")
    return points.select("way_id", "span", "seq", "x", "y",
                         F.lead("x").over(in_span).alias("nx"), F.lead("y").over(in_span).alias("ny"))


def _span_summary(points: DataFrame) -> DataFrame:
    point = pack("x", "y")
    high, low = cross_halves(("x", "y"), ("nx", "ny"))
    return _with_neighbours(points).groupBy("way_id", "span").agg(
        F.count("*").alias("n_points"),
        F.expr(f"min_by({point}, seq)").alias("first"),
        F.expr(f"max_by({point}, seq)").alias("last"),
        F.expr(f"coalesce(sum({high}) * 65536 + sum({low}), 0)").alias("area2"),
        *bounds_of())


def _linked(spans: DataFrame) -> DataFrame:
    """Each span with the first point of its way's next span."""
    along = Window.partitionBy("way_id").orderBy("span")
    return spans.select("*", F.lead("first").over(along).alias("next_first"))
