"""The feature view as a SQL table function, so that predicates stand before geometry in SQL too.

A view can only be filtered from outside, above its joins. A table function
takes types, tag and box as arguments and puts them where they belong: types
fold whole branches away, tags restrict the ways whose points are joined, and
the box meets bounds before anything else is read.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from waymark.functions.sql import unit_side
from waymark.operators.features import BOUNDS
from waymark.operators.multipolygons import area_relations, relation_bounds
from waymark.operators.ways import way_points
from waymark.sources.tables import OsmTables, read_tables, tags_or_empty

_ARGUMENTS = ("letters STRING, tag_key STRING, tag_value STRING, "
              "west DOUBLE, south DOUBLE, east DOUBLE, north DOUBLE")
_RESULT = ("fid BIGINT, type INT, tags MAP<STRING, STRING>, is_area BOOLEAN, "
           "xmin INT, ymin INT, xmax INT, ymax INT")


def register_search(spark: SparkSession, name: str, source: str | OsmTables) -> None:
    """Define ``name(letters, key, value, west, south, east, north)`` and the views it reads.

    It gives fid, type, tags, is_area and bounds of features of the types in
    ``letters`` (n, w, a, r, or ``*`` for all) that have the tag and overlap
    the box, in meters. A NULL key, value or side does not restrict. Nothing
    runs until a query does.
    """
    tables = read_tables(spark, source) if isinstance(source, str) else source
    for part, df in (("nodes", tables.nodes.withColumn("tags", tags_or_empty())),
                     ("ways", tables.ways.withColumn("tags", tags_or_empty())),
                     ("relations", tables.relations.withColumn("tags", tags_or_empty())),
                     ("points", way_points(tables)),
                     ("areas", relation_bounds(area_relations(tables)))):
        df.createOrReplaceTempView(f"{name}__{part}")
    bounds = ", ".join(BOUNDS)
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION {name}({_ARGUMENTS}) RETURNS TABLE ({_RESULT}) RETURN
        SELECT id, 0, tags, false, x, y, x, y FROM {name}__nodes
        WHERE {_wanted(name, 'n')} AND {_tagged(name)} AND {_in_box(name, 'x', 'y', 'x', 'y')}
        UNION ALL
        SELECT id, 1, tags, is_area, {bounds}
        FROM (SELECT * FROM {name}__ways WHERE {_chosen_way(name)})
        JOIN (SELECT way_id, min(x) AS xmin, min(y) AS ymin, max(x) AS xmax, max(y) AS ymax
              FROM {name}__points LEFT SEMI JOIN (SELECT id FROM {name}__ways WHERE {_chosen_way(name)}) ON way_id = id
              GROUP BY way_id) ON way_id = id
        WHERE {_in_box(name, *BOUNDS)}
        UNION ALL
        SELECT id, 2, tags, is_area, {bounds}
        FROM (SELECT * FROM {name}__relations WHERE is_area AND {_wanted(name, 'a')} AND {_tagged(name)})
        JOIN {name}__areas ON relation_id = id
        WHERE {_in_box(name, *BOUNDS)}""")


def _wanted(name: str, letter: str) -> str:
    return f"(contains({name}.letters, '{letter}') OR contains({name}.letters, '*'))"


def _tagged(name: str) -> str:
    return (f"({name}.tag_key IS NULL OR (tags[{name}.tag_key] IS NOT NULL AND "
            f"({name}.tag_value IS NULL OR tags[{name}.tag_key] = {name}.tag_value)))")


def _chosen_way(name: str) -> str:
    return f"((is_area AND {_wanted(name, 'a')}) OR (NOT is_area AND {_wanted(name, 'w')})) AND {_tagged(name)}"


def _in_box(name: str, xmin: str, ymin: str, xmax: str, ymax: str) -> str:
    sides = [f"({name}.{side} IS NULL OR {bound} {sign} {unit_side(f'{name}.{side}')})" for bound, sign, side in (
        (xmin, "<=", "east"), (xmax, ">=", "west"), (ymin, "<=", "north"), (ymax, ">=", "south"))]
    return " AND ".join(sides)
