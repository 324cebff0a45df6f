"""SQL text shared by the check queries: the derived tables, restated for DuckDB."""

from __future__ import annotations

METERS = "(40075016.68558 / 4294967294.9999::DOUBLE)"
UNITS = "(4294967294.9999::DOUBLE / 40075016.68558)"

_TABLES = {
    "nodes": """
        SELECT p_partkey AS id,
               CAST((p_partkey * 2654435761) % 4294967296 - 2147483648 AS INTEGER) AS x,
               CAST((p_partkey * 2246822519) % 4294967296 - 2147483648 AS INTEGER) AS y,
               p_name AS name, p_brand AS brand, CAST(p_size AS VARCHAR) AS size,
               CASE p_type WHEN 'PROMO' THEN 'restaurant' WHEN 'LARGE' THEN 'school' END AS amenity
        FROM part""",
    "ways": """
        SELECT o_orderkey AS id,
               o_orderstatus = 'F' AND coalesce(d.n, 0) >= 3 AS is_area,
               CASE WHEN o_orderpriority = '1-URGENT' THEN 'yes' END AS building,
               CASE o_orderpriority WHEN '2-HIGH' THEN 'primary'
                                    WHEN '3-MEDIUM' THEN 'residential' END AS highway,
               CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'park' END AS leisure,
               CASE WHEN o_orderkey % 3 = 0 THEN 'w' || o_orderkey END AS name
        FROM orders LEFT JOIN (SELECT l_orderkey, count(DISTINCT l_partkey) AS n
                               FROM lineitem GROUP BY l_orderkey) d ON d.l_orderkey = o_orderkey""",
    "way_nodes": """
        SELECT l_orderkey AS way_id, l_linenumber AS line, l_partkey AS node_id,
               row_number() OVER (PARTITION BY l_orderkey
                                  ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS seq
        FROM lineitem""",
    "relations": """
        SELECT c_custkey AS id, 'route' AS kind, c_name AS name, c_mktsegment AS network
        FROM customer
        UNION ALL
        SELECT -1 - r_regionkey, 'boundary', r_name, NULL FROM region""",
    "relation_members": """
        SELECT c_custkey AS relation_id, 0 AS seq, 0 AS member_type, c_custkey AS member_id,
               'label' AS role FROM customer
        UNION ALL
        SELECT o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey), 1,
               o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'outer' WHEN 'O' THEN 'inner' ELSE '' END
        FROM orders
        UNION ALL
        SELECT c_custkey, 1000000000000, 1, -c_custkey, 'outer'
        FROM customer WHERE c_custkey % 13 = 0
        UNION ALL
        SELECT -1 - r_regionkey, 0, 0, r_regionkey, 'admin_centre' FROM region
        UNION ALL
        SELECT -1 - n_regionkey,
               row_number() OVER (PARTITION BY n_regionkey ORDER BY c_custkey), 2, c_custkey,
               'subarea'
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "features": """
        SELECT id AS fid, 0 AS type, false AS is_area, name, brand, size, amenity,
               CAST(NULL AS VARCHAR) AS building, CAST(NULL AS VARCHAR) AS highway,
               CAST(NULL AS VARCHAR) AS leisure, CAST(NULL AS VARCHAR) AS kind,
               CAST(NULL AS VARCHAR) AS network FROM nodes
        UNION ALL
        SELECT id, 1, is_area, name, NULL, NULL, NULL, building, highway, leisure, NULL, NULL
        FROM ways
        UNION ALL
        SELECT id, 2, false, name, NULL, NULL, NULL, NULL, NULL, NULL, kind, network
        FROM relations""",
    "way_points": """
        SELECT way_id, line, seq, x, y FROM way_nodes JOIN nodes ON node_id = id""",
    "bounds": """
        SELECT id AS fid, 0 AS type, x AS xmin, y AS ymin, x AS xmax, y AS ymax FROM nodes
        UNION ALL
        SELECT way_id, 1, min(x), min(y), max(x), max(y) FROM way_points GROUP BY way_id""",
    "areas": f"""
        SELECT way_id AS fid, area2, area2::DOUBLE / 2 * {METERS} * {METERS} AS area_m2 FROM (
        SELECT way_id, abs(sum(coalesce(x::HUGEINT * ny - nx::HUGEINT * y, 0))) AS area2
        FROM (SELECT way_id, x, y,
                     coalesce(lead(x) OVER w, first_value(x) OVER w) AS nx,
                     coalesce(lead(y) OVER w, first_value(y) OVER w) AS ny
              FROM way_points WINDOW w AS (PARTITION BY way_id ORDER BY seq))
        WHERE way_id IN (SELECT id FROM ways WHERE is_area)
        GROUP BY way_id)""",
    "members": """
        SELECT relation_id, seq, member_type, member_id, role,
               CASE member_type WHEN 0 THEN 'node' WHEN 1 THEN 'way' ELSE 'relation' END AS mtype,
               row_number() OVER (PARTITION BY relation_id ORDER BY seq) AS rn,
               count(*) OVER (PARTITION BY relation_id) AS total
        FROM relation_members m
        WHERE (member_type = 0 AND member_id IN (SELECT id FROM nodes))
           OR (member_type = 1 AND member_id IN (SELECT id FROM ways))
           OR (member_type = 2 AND member_id IN (SELECT id FROM relations))""",
    "parents": """
        SELECT child_type, child_id, parent_type, parent_id,
               CASE parent_type WHEN 1 THEN 'way' ELSE 'relation' END AS ptype,
               row_number() OVER (PARTITION BY child_type, child_id
                                  ORDER BY parent_type, parent_id) AS rn,
               count(*) OVER (PARTITION BY child_type, child_id) AS total
        FROM (SELECT 0 AS child_type, node_id AS child_id, 1 AS parent_type, way_id AS parent_id
              FROM way_nodes
              UNION
              SELECT member_type, member_id, 2, relation_id FROM relation_members) e
        WHERE (child_type = 0 AND child_id IN (SELECT id FROM nodes))
           OR (child_type = 1 AND child_id IN (SELECT id FROM ways))
           OR (child_type = 2 AND child_id IN (SELECT id FROM relations))""",
}

_NEEDS = {
    "way_points": ["nodes", "way_nodes"],
    "bounds": ["way_points"],
    "areas": ["way_points", "ways"],
    "features": ["nodes", "ways", "relations"],
    "members": ["relation_members", "nodes", "ways", "relations"],
    "parents": ["relation_members", "way_nodes", "nodes", "ways", "relations"],
}


def with_tables(body: str, *names: str) -> str:
    """``body`` with the derived tables it names, and those they need, as CTEs."""
    chosen: list[str] = []

    def add(name):
        for need in _NEEDS.get(name, []):
            add(need)
        if name not in chosen:
            chosen.append(name)

    for name in names:
        add(name)
    return "WITH " + ",\n".join(f"{n} AS ({_TABLES[n]})" for n in chosen) + "\n" + body


def units(meters: float | str) -> str:
    """A query box side in grid units, truncated and clamped like the engine does."""
    return (f"CAST(trunc(least(greatest(({meters}) * {UNITS}, -2147483648.0), 2147483647.0))"
            f" AS BIGINT)")


def overlap(xmin, ymin, xmax, ymax) -> str:
    return (f"xmin <= {units(xmax)} AND xmax >= {units(xmin)}"
            f" AND ymin <= {units(ymax)} AND ymax >= {units(ymin)}")


def mercator_x(lon: float) -> str:
    return f"(radians({lon}) * 6378137.0)"


def mercator_y(lat: float) -> str:
    return f"(ln(tan(0.7853981633974483 + radians({lat}) / 2)) * 6378137.0)"
