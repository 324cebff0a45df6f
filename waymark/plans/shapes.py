"""Geometry: points, lines, polygons, rings, holes, multipolygons, areas."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from waymark.functions.geometry import area as geom_area
from waymark.functions.geometry import envelope, overlaps, ring_contains
from waymark.functions.tags import selector, tag, tag_equals, tag_exists
from waymark.functions.units import packed_x, packed_y, to_meters, to_units
from waymark.operators.features import BOUNDS, features
from waymark.operators.largest import largest_areas
from waymark.operators.multipolygons import (area_relations, hole_assignment, relation_geometry,
                                             relation_measures, ring_chunks)
from waymark.operators.rings import relation_ways
from waymark.operators.search import register_search
from waymark.operators.ways import way_area, way_bounds, way_points, way_summary
from waymark.plans.filters import BOX
from waymark.plans.oracle import METERS, UNITS, overlap, units, with_tables
from waymark.schema import NODE, RELATION, WAY
from waymark.sources.derived import (FAR, LINE_SPAN, SLOT_FACTOR, SLOT_PRIME, WIDTH_FACTOR, WIDTH_LIMIT,
                                     derived_tables, large_ring_tables, region_tables, ring_tables)

# A fixed five-cornered test ring, in meters.
TEST_RING = [(-9000000.0, -8000000.0), (11000000.0, -6000000.0), (3000000.0, 1000000.0),
             (9000000.0, 9000000.0), (-7000000.0, 7000000.0)]


def node_meters(spark, path):
    nodes = derived_tables(spark, path).nodes
    return nodes.select(
        "id", F.round(to_meters("x"), 3).alias("x_m"), F.round(to_meters("y"), 3).alias("y_m"),
        to_units(F.round(to_meters("x"), 3)).alias("x_back"))


def point_geom(spark, path):
    p = F.col("geom")["parts"][0][0][0]
    return features(derived_tables(spark, path), ["fid", "geom"], types=[NODE]).select(
        "fid", "geom.kind", "geom.srid", F.size("geom.parts").alias("n_parts"),
        F.round(p["x"], 3).alias("x"), F.round(p["y"], 3).alias("y"))


def _way_geometry(spark, path, is_area):
    ring = F.col("geom")["parts"][0][0]
    first, last = F.element_at(ring, 1), F.element_at(ring, -1)
    return (features(derived_tables(spark, path), ["fid", "geom"], types=[WAY],
                     where=F.col("is_area") == is_area)
            .select("fid", "geom.kind", F.size(ring).alias("n_points"),
                    F.round(first["x"], 3).alias("first_x"), F.round(first["y"], 3).alias("first_y"),
                    F.round(last["x"], 3).alias("last_x"), F.round(last["y"], 3).alias("last_y")))


def way_line(spark, path):
    return _way_geometry(spark, path, False)


def way_polygon(spark, path):
    return _way_geometry(spark, path, True)


def way_coords(spark, path):
    points = way_points(derived_tables(spark, path))
    # In the derived tables seq starts with the line number.
    return points.selectExpr("way_id", f"CAST(seq DIV {LINE_SPAN} AS INT) AS line", "x", "y")


def way_ends(spark, path):
    ends = way_summary(way_points(derived_tables(spark, path)))
    return ends.selectExpr(
        "way_id", "n_points", f"{packed_x('first')} AS first_x", f"{packed_y('first')} AS first_y",
        f"{packed_x('last')} AS last_x", f"{packed_y('last')} AS last_y", *BOUNDS)


def _areas(spark, path, predicate):
    """Area ways that pass, with their area; only they take part in the node join."""
    tables = derived_tables(spark, path)
    chosen = features(tables, types=[WAY], where=F.col("is_area") & predicate)
    points = way_points(tables, chosen.select(F.col("fid").alias("way_id")))
    return chosen, points, way_area(points).withColumnRenamed("way_id", "fid")


def area(spark, path):
    _, _, areas = _areas(spark, path, F.lit(True))
    return areas.select("fid", F.col("area2").cast("string").alias("area2"),
                        F.round(F.col("area_m2") / 1e6, 3).alias("area_km2"))


def top_parks(spark, path):
    chosen, _, areas = _areas(spark, path, tag_equals("leisure", "park"))
    return (chosen.join(areas, "fid")
            .orderBy(F.col("area_m2").desc(), "fid").limit(10)
            .select("fid", tag("name").alias("name"),
                    F.round(F.col("area_m2") / 1e6, 3).alias("area_km2")))


def buildings_in_box_area(spark, path):
    tables = derived_tables(spark, path)
    chosen = features(tables, types=[WAY], where=tag_exists("building"))
    points = way_points(tables, chosen.select(F.col("fid").alias("way_id")))
    inside = way_bounds(points).where(overlaps(envelope(*BOX)))
    areas = way_area(points)
    # A linear building has area 0.
    size = F.when(F.col("is_area"), F.round(F.col("area_m2") / 1e6, 3)).otherwise(0.0)
    return (chosen.join(inside.withColumnRenamed("way_id", "fid"), "fid")
            .join(areas.withColumnRenamed("way_id", "fid"), "fid")
            .select("fid", tag("name").alias("name"), size.alias("area_km2")))


def point_in_ring(spark, path):
    corner = [F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in TEST_RING]
    nodes = derived_tables(spark, path).nodes
    return nodes.select("id", ring_contains(to_meters("x"), to_meters("y"), F.array(*corner))
                        .alias("inside"))


def derived_relation_ways(spark, path):
    return relation_ways(derived_tables(spark, path), area_only=False).select(
        "relation_id", F.when(F.col("outer"), "outer").otherwise("inner").alias("role"), "way_id")


def _role():
    return F.when(F.col("outer"), "outer").otherwise("inner").alias("role")


def ring_membership(spark, path):
    return area_relations(ring_tables(spark, path)).ring_ways.select(
        "relation_id", _role(), "slot", "ring_slot", "pos", "reversed", "status")


def ring_count(spark, path):
    return (area_relations(ring_tables(spark, path)).rings
            .groupBy("relation_id", _role(), "status")
            .agg(F.count("*").alias("n_rings"), F.sum("n_points").alias("n_points"),
                 (F.sum("area2") / 2).cast("long").alias("area_units")))


def holes(spark, path):
    return hole_assignment(area_relations(ring_tables(spark, path), materialize=True))


def multipolygons(spark, path):
    areas = area_relations(ring_tables(spark, path), materialize=True)
    return relation_measures(areas).select(
        "relation_id", "n_polygons", "n_holes", "orphan_holes", "n_points",
        F.col("area_units").cast("long").alias("area_units"),
        F.round("area_m2", 3).alias("area_m2"), *BOUNDS)


def relation_geoms(spark, path):
    """The MultiPolygon value itself: its shape, its ends and its area."""
    areas = area_relations(ring_tables(spark, path), materialize=True)
    outer, rings = F.col("geom")["parts"][0][0], F.flatten("geom.parts")
    ends = {"first": F.element_at(outer, 1), "last": F.element_at(outer, -1)}
    return relation_geometry(areas).select(
        "relation_id", "geom.kind", "geom.srid", F.size("geom.parts").alias("n_polygons"),
        F.size(rings).alias("n_rings"),
        F.aggregate(rings, F.lit(0), lambda n, r: n + F.size(r)).alias("n_points"),
        *[F.round(p[c], 3).alias(f"{end}_{c}") for end, p in ends.items() for c in ("x", "y")],
        F.round(geom_area("geom"), 3).alias("area_m2"))


def ring_pieces_in_order(spark, path):
    """Rings as rows of ordered chunks: the points of each, numbered along the ring."""
    chunks = ring_chunks(area_relations(ring_tables(spark, path), materialize=True))
    along = Window.partitionBy("relation_id", "polygon_slot", "outer", "ring_slot").orderBy("pos", "step", "place")
    return chunks.select("*", F.posexplode("points").alias("place", "p")).select(
        "relation_id", "polygon_slot", _role(), F.row_number().over(along).alias("place"),
        F.col("p.x").alias("x"), F.col("p.y").alias("y"))


def large_ring(spark, path):
    """One ring of as many ways as there are customers, stitched by the distributed steps."""
    areas = area_relations(large_ring_tables(spark, path), task_ways=64, materialize=True)
    return areas.ring_ways.select("way_id", "ring_slot", "pos", "reversed", "status")


def sql_search(spark, path):
    """Types, tag and box through SQL alone, by the table function."""
    register_search(spark, "osm_search", derived_tables(spark, path))
    xmin, ymin, xmax, ymax = BOX
    return spark.sql(f"""SELECT fid, type, is_area, tags['name'] AS name
        FROM osm_search('nwa', 'name', NULL, {xmin}D, {ymin}D, {xmax}D, {ymax}D)
        UNION ALL
        SELECT fid, type, is_area, tags['building']
        FROM osm_search('wa', 'building', 'yes', NULL, NULL, NULL, {ymin}D)""")


def sql_search_areas(spark, path):
    """Area relations by name and box through the table function."""
    register_search(spark, "ring_search", ring_tables(spark, path))
    return spark.sql("""SELECT fid, xmin, ymin, xmax, ymax
        FROM ring_search('a', 'type', 'multipolygon', 0D, 0D, 30000D, 300D)""")


def way_alias(spark, path):
    """``way`` is another name of the geometry column."""
    ring = F.col("way")["parts"][0][0]
    return features(derived_tables(spark, path), ["fid", "type", "way"], types=[NODE, WAY]).where("way IS NOT NULL").select(
        "fid", "type", "way.kind", F.size(ring).alias("n_points"))


def multipolygon_bounds(spark, path):
    return (features(ring_tables(spark, path), ["fid", *BOUNDS], types=[RELATION])
            .where(overlaps(envelope(0, 0, 30000, 300))).select("fid"))


def _largest(spark, path, where=None):
    return largest_areas(region_tables(spark, path), 25, where).select(
        "type", "fid", F.col("area2").cast("string").alias("area2"), F.round(F.col("area_m2") / 1e6, 3).alias("area_km2"))


def top_areas(spark, path):
    """The largest of all areas, ways and relations alike."""
    return _largest(spark, path)


def top_area_parks(spark, path):
    return _largest(spark, path, tag_equals("leisure", "park"))


def parks_of_both_types(spark, path):
    """The selector for areas meets ways and relations."""
    return features(region_tables(spark, path), ["fid", "type", "tags"],
                    where=selector("a", tag_equals("leisure", "park"))).select("fid", "type", tag("name").alias("name"))


def area_of_geom(spark, path):
    """Area by the geometry value itself, of area ways and area relations in one query."""
    return (features(region_tables(spark, path), ["fid", "type", "geom"], types=[WAY, RELATION],
                     where=selector("a", tag_equals("leisure", "park")))
            .where("geom IS NOT NULL")
            .select("fid", "type", "geom.kind", F.round(geom_area("geom") / 1e6, 0).alias("area_km2")))


QUERIES = {
    "q_node_meters": node_meters,
    "q_point_geom": point_geom,
    "q_way_line": way_line,
    "q_way_polygon": way_polygon,
    "q_way_coords": way_coords,
    "q_way_ends": way_ends,
    "q_area": area,
    "q_top_parks": top_parks,
    "q_buildings_in_box_area": buildings_in_box_area,
    "q_point_in_ring": point_in_ring,
    "q_relation_ways": derived_relation_ways,
    "q_ring_ways": ring_membership,
    "q_ring_count": ring_count,
    "q_hole_assignment": holes,
    "q_multipolygon": multipolygons,
    "q_multipolygon_bbox": multipolygon_bounds,
    "q_relation_geom": relation_geoms,
    "q_ring_chunks": ring_pieces_in_order,
    "q_ring_large": large_ring,
    "q_top_areas": top_areas,
    "q_top_area_parks": top_area_parks,
    "q_area_selector": parks_of_both_types,
    "q_area_of_geom": area_of_geom,
    "q_way_alias": way_alias,
    "q_sql_view": sql_search,
    "q_sql_view_areas": sql_search_areas,
}


def _way_sql(kind, is_area, closing):
    return with_tables(f"""
        SELECT id AS fid, CASE WHEN n > 0 THEN '{kind}' END AS kind,
               CAST({closing} AS INTEGER) AS n_points,
               round(fx * {METERS}, 3) AS first_x, round(fy * {METERS}, 3) AS first_y,
               round({'fx' if is_area else 'lx'} * {METERS}, 3) AS last_x,
               round({'fy' if is_area else 'ly'} * {METERS}, 3) AS last_y
        FROM ways LEFT JOIN (
            SELECT way_id, count(*) AS n, arg_min(x, seq) AS fx, arg_min(y, seq) AS fy,
                   arg_max(x, seq) AS lx, arg_max(y, seq) AS ly
            FROM way_points GROUP BY way_id) ON way_id = id
        WHERE is_area = {str(is_area).lower()}""", "ways", "way_points")


def _crosses(p, q):
    (x1, y1), (x2, y2) = p, q
    return (f"CASE WHEN (({y1} <= y AND y < {y2}) OR ({y2} <= y AND y < {y1})) AND "
            f"x < ({x2} - {x1}) * (y - {y1}) / ({y2} - {y1}) + {x1} THEN 1 ELSE 0 END")


def _doubles(point):
    return [f"({v!r}::DOUBLE)" for v in point]


_CORNERS = [_doubles(p) for p in TEST_RING]
_CROSSINGS = " + ".join(_crosses(p, q) for p, q in zip(_CORNERS, _CORNERS[1:] + _CORNERS[:1]))

# The generated rings in closed form: pieces of the outline, its gap, its hole.
_RINGS = """
    rings AS (SELECT c_custkey AS k,
                     CASE c_custkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 4 END AS pieces,
                     CASE WHEN c_custkey % 11 = 0 THEN 500 WHEN c_custkey % 7 = 0 THEN 50
                          ELSE 0 END AS gap,
                     c_custkey % 5 = 0 AS holed,
                     (c_custkey % 1000) * 5000 AS x0, (c_custkey // 1000 % 400000) * 5000 AS y0
              FROM customer)"""
def _at(units):
    return f"round({units} * {METERS}, 3)"


_REGIONS = f"""
    regions AS (SELECT c_custkey - {FAR} AS fid, c_name AS name, c_custkey % 4 = 1 AS park, c_custkey % 11 = 0 AS broken,
                       (2 * (1000000 - CASE c_custkey % 5 WHEN 0 THEN 40000 ELSE 0 END))::HUGEINT
                       * (c_custkey * {WIDTH_FACTOR} % {WIDTH_LIMIT} + 1) * (c_custkey * {WIDTH_FACTOR} % {WIDTH_LIMIT} + 1) AS area2
                FROM customer)"""


def _largest_sql(ways, relations):
    return with_tables(f"""
        , {_REGIONS}
        SELECT type, fid, CAST(area2 AS VARCHAR) AS area2, round(area2::DOUBLE / 2 * {METERS} * {METERS} / 1e6, 3) AS area_km2
        FROM (SELECT 1 AS type, fid, area2 FROM areas JOIN ways ON id = fid WHERE {ways}
              UNION ALL SELECT 2, fid, area2 FROM regions WHERE NOT broken AND {relations})
        ORDER BY area2::HUGEINT DESC, type, fid LIMIT 25""", "areas")


_OUTLINE_STATUS = "CASE gap WHEN 0 THEN 'closed' WHEN 50 THEN 'gap_closed' ELSE 'discarded' END"

ORACLES = {
    "q_node_meters": with_tables(f"""
        SELECT id, x_m, y_m, CAST(trunc(x_m * {UNITS}) AS INTEGER) AS x_back
        FROM (SELECT id, round(x * {METERS}, 3) AS x_m, round(y * {METERS}, 3) AS y_m
              FROM nodes)""", "nodes"),
    "q_point_geom": with_tables(f"""
        SELECT id AS fid, 'Point' AS kind, 3857 AS srid, 1 AS n_parts,
               round(x * {METERS}, 3) AS x, round(y * {METERS}, 3) AS y FROM nodes""", "nodes"),
    "q_way_line": _way_sql("LineString", False, "n"),
    "q_way_polygon": _way_sql("Polygon", True, "n + (fx <> lx OR fy <> ly)::INT"),
    "q_way_coords": with_tables("SELECT way_id, line, x, y FROM way_points", "way_points"),
    "q_way_ends": with_tables("""
        SELECT way_id, count(*) AS n_points, arg_min(x, seq) AS first_x, arg_min(y, seq) AS first_y,
               arg_max(x, seq) AS last_x, arg_max(y, seq) AS last_y,
               min(x) AS xmin, min(y) AS ymin, max(x) AS xmax, max(y) AS ymax
        FROM way_points GROUP BY way_id""", "way_points"),
    "q_area": with_tables("""
        SELECT fid, CAST(area2 AS VARCHAR) AS area2, round(area_m2 / 1e6, 3) AS area_km2 FROM areas""", "areas"),
    "q_top_parks": with_tables("""
        SELECT fid, name, round(area_m2 / 1e6, 3) AS area_km2
        FROM areas JOIN ways ON id = fid WHERE leisure = 'park'
        ORDER BY area_m2 DESC, fid LIMIT 10""", "areas"),
    "q_buildings_in_box_area": with_tables(f"""
        SELECT id AS fid, name,
               CASE WHEN is_area THEN round(area_m2 / 1e6, 3) ELSE 0.0 END AS area_km2
        FROM ways JOIN bounds b ON b.fid = id AND b.type = 1 LEFT JOIN areas a ON a.fid = id
        WHERE building IS NOT NULL AND {overlap(*BOX)}""", "bounds", "areas"),
    "q_point_in_ring": with_tables(f"""
        SELECT id, ({_CROSSINGS}) % 2 = 1 AS inside
        FROM (SELECT id, x * {METERS} AS x, y * {METERS} AS y FROM nodes)""", "nodes"),
    "q_relation_ways": with_tables("""
        SELECT relation_id, role, member_id AS way_id FROM relation_members
        WHERE member_type = 1 AND role IN ('outer', 'inner')
          AND member_id IN (SELECT id FROM ways)""", "relation_members", "ways"),
    "q_ring_ways": f"""WITH {_RINGS}
        SELECT k AS relation_id, 'outer' AS role, i AS slot, CAST(0 AS BIGINT) AS ring_slot,
               i AS pos, (pieces > 1 AND k % 2 = 1 AND i = 1) AS reversed,
               {_OUTLINE_STATUS} AS status
        FROM rings, range(4) t(i) WHERE i < pieces
        UNION ALL
        SELECT k, 'inner', pieces, pieces, 0, false, 'closed' FROM rings WHERE holed""",
    "q_ring_count": f"""WITH {_RINGS}
        SELECT k AS relation_id, 'outer' AS role, {_OUTLINE_STATUS} AS status,
               CAST(1 AS BIGINT) AS n_rings, CAST(5 + (gap > 0)::INT AS BIGINT) AS n_points,
               CAST(1000000 AS BIGINT) AS area_units FROM rings WHERE gap < 100
        UNION ALL
        SELECT k, 'inner', 'closed', 1, 5, 40000 FROM rings WHERE holed""",
    "q_hole_assignment": f"""WITH {_RINGS}
        SELECT k AS relation_id, CAST(pieces AS BIGINT) AS hole_slot,
               CAST(0 AS BIGINT) AS outer_slot FROM rings WHERE holed AND gap < 100""",
    "q_multipolygon": f"""WITH {_RINGS}
        SELECT k AS relation_id, CAST(1 AS BIGINT) AS n_polygons,
               CAST(holed::INT AS BIGINT) AS n_holes, CAST(0 AS BIGINT) AS orphan_holes,
               CAST(5 + (gap > 0)::INT + 5 * holed::INT AS BIGINT) AS n_points,
               CAST(1000000 - 40000 * holed::INT AS BIGINT) AS area_units,
               round((1000000 - 40000 * holed::INT) * {METERS} * {METERS}, 3) AS area_m2,
               CAST(x0 AS INTEGER) AS xmin, CAST(y0 AS INTEGER) AS ymin,
               CAST(x0 + 1000 AS INTEGER) AS xmax, CAST(y0 + 1000 AS INTEGER) AS ymax
        FROM rings WHERE gap < 100""",
    "q_multipolygon_bbox": f"""WITH {_RINGS}
        SELECT k AS fid FROM (SELECT k, x0 AS xmin, y0 AS ymin, x0 + 1000 AS xmax,
                                     y0 + 1000 AS ymax FROM rings WHERE gap < 100)
        WHERE {overlap(0, 0, 30000, 300)}""",
    "q_relation_geom": f"""WITH {_RINGS}
        SELECT k AS relation_id, 'MultiPolygon' AS kind, 3857 AS srid, 1 AS n_polygons,
               1 + holed::INT AS n_rings, 5 + (gap > 0)::INT + 5 * holed::INT AS n_points,
               {_at('x0')} AS first_x, {_at('y0')} AS first_y, {_at('x0')} AS last_x, {_at('y0')} AS last_y,
               round((1000000 - 40000 * holed::INT) * {METERS} * {METERS}, 3) AS area_m2
        FROM rings WHERE gap < 100""",
    "q_ring_chunks": f"""WITH {_RINGS},
        outline AS (SELECT * FROM (VALUES (1, 0, 0), (2, 1000, 0), (3, 1000, 1000), (4, 0, 1000), (5, 0, -1), (6, 0, 0))
                                  AS t(place, dx, dy)),
        hole AS (SELECT * FROM (VALUES (1, 400, 400), (2, 600, 400), (3, 600, 600), (4, 400, 600), (5, 400, 400))
                               AS t(place, dx, dy))
        SELECT k AS relation_id, CAST(0 AS BIGINT) AS polygon_slot, 'outer' AS role, place,
               CAST(x0 + dx AS INTEGER) AS x, CAST(y0 + CASE WHEN dy < 0 THEN gap ELSE dy END AS INTEGER) AS y
        FROM rings, outline WHERE gap < 100 AND (place < 6 OR gap > 0)
        UNION ALL
        SELECT k, 0, 'inner', place, CAST(x0 + dx AS INTEGER), CAST(y0 + dy AS INTEGER)
        FROM rings, hole WHERE gap < 100 AND holed""",
    "q_ring_large": f"""
        WITH w AS (SELECT c_custkey AS k, c_custkey * {SLOT_FACTOR} % {SLOT_PRIME} AS slot, c_custkey % 2 = 1 AS odd,
                          row_number() OVER (ORDER BY c_custkey) AS place, count(*) OVER () AS n FROM customer),
             lead AS (SELECT slot, odd, place FROM w ORDER BY slot LIMIT 1)
        SELECT k AS way_id, lead.slot AS ring_slot,
               (CASE WHEN lead.odd THEN lead.place - w.place ELSE w.place - lead.place END + n) % n AS pos,
               w.odd <> lead.odd AS reversed, 'closed' AS status FROM w, lead""",
    "q_top_areas": _largest_sql("true", "true"),
    "q_top_area_parks": _largest_sql("leisure = 'park'", "park"),
    "q_area_selector": with_tables(f"""
        , {_REGIONS}
        SELECT id AS fid, 1 AS type, name FROM ways WHERE is_area AND leisure = 'park'
        UNION ALL SELECT fid, 2, name FROM regions WHERE park""", "ways"),
    "q_area_of_geom": with_tables(f"""
        , {_REGIONS}
        SELECT fid, 1 AS type, 'Polygon' AS kind, round(area_m2 / 1e6, 0) AS area_km2
        FROM areas JOIN ways ON id = fid WHERE leisure = 'park'
        UNION ALL
        SELECT fid, 2, 'MultiPolygon', round(area2::DOUBLE / 2 * {METERS} * {METERS} / 1e6, 0) FROM regions
        WHERE park AND NOT broken""", "areas"),
    "q_way_alias": with_tables("""
        SELECT id AS fid, 0 AS type, 'Point' AS kind, 1 AS n_points FROM nodes
        UNION ALL
        SELECT id, 1, CASE WHEN is_area THEN 'Polygon' ELSE 'LineString' END,
               CAST(n + (is_area AND (fx <> lx OR fy <> ly))::INT AS INTEGER)
        FROM ways JOIN (SELECT way_id, count(*) AS n, arg_min(x, seq) AS fx, arg_min(y, seq) AS fy,
                               arg_max(x, seq) AS lx, arg_max(y, seq) AS ly
                        FROM way_points GROUP BY way_id) ON way_id = id""", "nodes", "ways", "way_points"),
    "q_sql_view": with_tables(f"""
        SELECT f.fid, f.type, is_area, name FROM features f JOIN bounds b ON b.fid = f.fid AND b.type = f.type
        WHERE f.type < 2 AND name IS NOT NULL AND {overlap(*BOX)}
        UNION ALL
        SELECT f.fid, f.type, is_area, building FROM features f JOIN bounds b ON b.fid = f.fid AND b.type = f.type
        WHERE f.type = 1 AND building = 'yes' AND ymin <= {units(BOX[1])}""", "features", "bounds"),
    "q_sql_view_areas": f"""WITH {_RINGS}
        SELECT k AS fid, CAST(xmin AS INTEGER) AS xmin, CAST(ymin AS INTEGER) AS ymin,
               CAST(xmax AS INTEGER) AS xmax, CAST(ymax AS INTEGER) AS ymax
        FROM (SELECT k, x0 AS xmin, y0 AS ymin, x0 + 1000 AS xmax, y0 + 1000 AS ymax FROM rings WHERE gap < 100)
        WHERE {overlap(0, 0, 30000, 300)}""",
}
