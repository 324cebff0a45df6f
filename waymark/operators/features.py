"""The feature view: one row per node, way and relation."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.functions.geometry import line, point, polygon
from waymark.functions.units import to_meters
from waymark.operators.graph import member_arrays, member_counts, parent_arrays, parent_counts
from waymark.operators.multipolygons import area_relations, relation_bounds, relation_geometry
from waymark.operators.ways import way_points, way_shapes
from waymark.schema import FEATURE_TYPES, NODE, RELATION, WAY
from waymark.sources.tables import OsmTables, read_tables, tags_or_empty

ALL_TYPES = (NODE, WAY, RELATION)
FEATURE_COLUMNS = ("fid", "type", "tags", "geom", "is_area", "members", "parents", "bbox")
BOUNDS = ("xmin", "ymin", "xmax", "ymax")
# Other names a column is known by.
_ALIASES = {"way": "geom"}


def features(tables: OsmTables, columns: Iterable[str] = ("fid", "type", "tags", "is_area"),
             where: Column | None = None, types: Iterable[int] = ALL_TYPES,
             max_members: int | None = None, max_parents: int | None = None,
             declared: Mapping[str, str] | None = None) -> DataFrame:
    """Features with the named columns; a name nobody knows gives NULL.

    ``where`` is a predicate on fid, type, tags and is_area. It is applied
    before geometry, members and parents are put together, so a selective
    filter shrinks those joins as well. ``types`` leaves out whole branches.
    ``declared`` gives the types of unknown columns (default STRING).
    Everything is lazy.
    """
    columns, types = list(columns), set(types)
    wanted = {_ALIASES.get(c, c) for c in columns}
    build = {NODE: _node_branch, WAY: _way_branch, RELATION: _relation_branch}
    branches = [build[t](tables, wanted, where, max_members, max_parents)
                for t in ALL_TYPES if t in types]
    rows = reduce(DataFrame.unionByName, branches)
    return rows.select(*[_output(c, declared or {}) for c in columns])


def register_features(spark: SparkSession, name: str, source: str | OsmTables,
                      columns: Iterable[str] = FEATURE_COLUMNS, where: Column | None = None,
                      **options) -> DataFrame:
    """Make the feature view known to SQL under ``name``, replacing any earlier one.

    ``where`` makes it a pre-filtered table. Columns a query does not read
    cost nothing: the optimizer drops the joins behind them.
    """
    tables = read_tables(spark, source) if isinstance(source, str) else source
    view = features(tables, columns, where, **options)
    view.createOrReplaceTempView(name)
    return view


def extent(df: DataFrame) -> DataFrame:
    """Extent of all rows with bounds, in meters."""
    return df.agg(*[to_meters(f("x" + e)).alias("x" + e) for f, e in ((F.min, "min"), (F.max, "max"))],
                  *[to_meters(f("y" + e)).alias("y" + e) for f, e in ((F.min, "min"), (F.max, "max"))]
                  ).select(*BOUNDS)


def dataset_extent(tables: OsmTables) -> DataFrame:
    """Extent of every feature, from the nodes alone: all geometry is made of nodes."""
    return extent(tables.nodes.select(F.col("x").alias("xmin"), F.col("y").alias("ymin"),
                                      F.col("x").alias("xmax"), F.col("y").alias("ymax")))


def _output(name, declared):
    source = _ALIASES.get(name, name)
    if source == "bbox":
        return F.when(F.col("xmin").isNotNull(), F.struct(*BOUNDS)).alias(name)
    if source in FEATURE_TYPES:
        return F.col(source).alias(name)
    return F.lit(None).cast(declared.get(name, "string")).alias(name)


def _base(df, code, is_area, where, extra=()):
    rows = df.select(F.col("id").alias("fid"), F.lit(code).alias("type"),
                     tags_or_empty().alias("tags"), is_area.alias("is_area"), *extra)
    return rows if where is None else rows.where(where)


def _node_branch(tables, wanted, where, max_members, max_parents):
    rows = _base(tables.nodes, NODE, F.lit(False), where, ["x", "y"])
    ids = None if where is None else rows.select("fid")
    rows = rows.select("fid", "type", "tags", "is_area", point("x", "y").alias("geom"),
                       F.col("x").alias("xmin"), F.col("y").alias("ymin"),
                       F.col("x").alias("xmax"), F.col("y").alias("ymax"))
    return _finish(_with_parents(rows, tables, NODE, wanted, ids, max_parents), wanted)


def _way_branch(tables, wanted, where, max_members, max_parents):
    rows = _base(tables.ways, WAY, F.col("is_area"), where)
    ids = None if where is None else rows.select("fid")
    if wanted & {"geom", "bbox", *BOUNDS}:
        chosen = None if ids is None else ids.withColumnRenamed("fid", "way_id")
        shapes = way_shapes(way_points(tables, chosen)).withColumnRenamed("way_id", "fid")
        rows = rows.join(shapes, "fid", "left").withColumn("geom", F.when(
            F.col("points").isNotNull(),
            F.when(F.col("is_area"), polygon(F.col("points"))).otherwise(line(F.col("points")))))
    return _finish(_with_parents(rows, tables, WAY, wanted, ids, max_parents), wanted)


def _relation_branch(tables, wanted, where, max_members, max_parents):
    rows = _base(tables.relations, RELATION, F.col("is_area"), where)
    ids = None if where is None else rows.select("fid")
    chosen = None if ids is None else ids.withColumnRenamed("fid", "relation_id")
    if wanted & {"geom", "bbox", *BOUNDS}:
        areas = area_relations(tables, chosen)
        if "geom" in wanted:
            rows = _left(rows, relation_geometry(areas))
        if wanted & {"bbox", *BOUNDS}:
            rows = _left(rows, relation_bounds(areas))
    if "members" in wanted:
        rows = _left(rows, member_arrays(tables, max_members, chosen))
    if "members_truncated" in wanted:
        counts = member_counts(tables, max_members, chosen)
        rows = _left(rows, counts.select("relation_id", "members_truncated"))
    return _finish(_with_parents(rows, tables, RELATION, wanted, ids, max_parents), wanted)


def _left(rows, by_relation):
    return rows.join(by_relation.withColumnRenamed("relation_id", "fid"), "fid", "left")


def _with_parents(rows, tables, code, wanted, ids, max_parents):
    if "parents" in wanted:
        rows = rows.join(parent_arrays(tables, code, max_parents, ids), "fid", "left")
    if "parents_truncated" in wanted:
        counts = parent_counts(tables, code, max_parents, ids)
        rows = rows.join(counts.select("fid", "parents_truncated"), "fid", "left")
    return rows


def _finish(rows, wanted):
    """The same columns in every branch, NULL where the branch has none."""
    names = ["fid", "type", "tags", "is_area"]
    names += [c for c in FEATURE_TYPES if c in wanted and c not in (*names, "bbox")]
    names += [c for c in BOUNDS if "bbox" in wanted and c not in names]
    return rows.select(*[
        (F.col(c) if c in rows.columns else F.lit(None)).cast(FEATURE_TYPES[c]).alias(c)
        for c in names])
