"""The SQL table function: lazy to register, selective before geometry; the ring chunks behind MultiPolygon values."""

from fixtures import square
from waymark.functions.geometry import area
from waymark.operators.features import features, register_features
from waymark.operators.multipolygons import area_relations, relation_geometry, relation_measures, ring_chunks
from waymark.operators.search import register_search
from waymark.operators.ways import way_area, way_points


def small_map(build):
    build.way(1, square(0, 0, 100), {"building": "yes"}, is_area=True).way(2, [(0, 0), (500, 500)], {"highway": "x"})
    build.way(3, square(9000, 9000, 10), {"building": "no"}, is_area=True).node(7, 5, 5, {"name": "n"})
    return build.relation(9, [("w", 1, "outer"), ("w", 3, "outer")], {"building": "yes"}, is_area=True).tables()


def test_registration_starts_no_job(spark, build):
    tables = small_map(build)
    spark.sparkContext.setJobGroup("registration", "")
    register_search(spark, "quiet_search", tables)
    register_features(spark, "quiet_view", tables)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("registration")
    spark.sparkContext.setJobGroup("other", "")
    assert list(jobs) == []


def test_arguments_restrict(spark, build):
    register_search(spark, "find", small_map(build))

    def found(*arguments):
        text = ", ".join("NULL" if a is None else f"'{a}'" if isinstance(a, str) else f"{a}D" for a in arguments)
        return sorted((r.type, r.fid) for r in spark.sql(f"SELECT * FROM find({text})").collect())

    everywhere = [None] * 4
    assert found("*", "building", None, *everywhere) == [(1, 1), (1, 3), (2, 9)]
    assert found("a", "building", "yes", *everywhere) == [(1, 1), (2, 9)]
    assert found("w", None, None, *everywhere) == [(1, 2)]
    assert found("n", "name", "n", *everywhere) == [(0, 7)]
    # Boxes are in meters: way 3 lies at 84.
    assert found("wa", None, None, 80.0, 80.0, 90.0, 90.0) == [(1, 3), (2, 9)]
    assert found("wa", None, None, 50.0, 50.0, 60.0, 60.0) == [(2, 9)]
    assert found("q", None, None, *everywhere) == []


def test_tag_restricts_points_before_their_join(spark, build):
    register_search(spark, "planned", small_map(build))
    plan = spark.sql("SELECT fid FROM planned('a', 'building', 'yes', 0D, 0D, 1D, 1D)")._jdf.queryExecution() \
        .optimizedPlan().toString()
    assert "LeftSemi" in plan and "Join Inner" in plan
    # types that are not asked for leave no branch
    nodes = spark.sql("SELECT fid FROM planned('n', NULL, NULL, NULL, NULL, NULL, NULL)")._jdf.queryExecution() \
        .optimizedPlan().toString()
    assert "Join" not in nodes and "Union" not in nodes


def test_chunks_are_bounded_and_fold_into_the_value(spark, build):
    ring = [(k * 10, k * k) for k in range(40)]
    build.way(1, ring[:25]).way(2, [ring[0], *ring[:23:-1]])
    build.way(3, square(20, 200, 20), is_area=True).way(4, square(20, 200, 20)[:4], is_area=True)
    build.relation(5, [("w", 1, "outer"), ("w", 2, "outer"), ("w", 3, "inner")], is_area=True)
    build.relation(6, [("w", 4, "outer")], is_area=True)
    tables = build.tables(seq_span=4)
    areas = area_relations(tables)
    chunks = ring_chunks(areas).collect()
    assert max(len(r.points) for r in chunks) <= 4
    path = {}
    for r in sorted(chunks, key=lambda r: (r.pos, r.step)):
        path.setdefault((r.relation_id, r.ring_slot), []).extend((p.x, p.y) for p in r.points)
    assert path[5, 0] == [*ring, ring[0]] and path[6, 0] == square(20, 200, 20)
    whole = {r.relation_id: r for r in relation_geometry(areas).select("relation_id", area("geom").alias("m2")).collect()}
    for r in relation_measures(areas).collect():
        assert abs(whole[r.relation_id].m2 - r.area_m2) < 1e-9 * max(r.area_m2, 1)
    view = {r.fid: r.geom for r in features(tables, ["fid", "geom"], types=[2]).collect()}
    assert view[5].kind == "MultiPolygon" and len(view[5].parts[0][0]) == 41


def test_areas_are_exact_at_the_edges_of_the_map(build):
    low, high = -(1 << 31), (1 << 31) - 1
    build.way(1, [(low, low), (high, low), (high, high), (low, high), (low, low)], is_area=True)
    build.way(2, [(high, high), (high - 1, high), (high, high - 1)], is_area=True)
    for span in (1, 2, 4096):
        got = {r.way_id: int(r.area2) for r in way_area(way_points(build.tables(span))).collect()}
        assert got == {1: 2 * (high - low) ** 2, 2: 1}
