"""Units, bounds, box overlap, lines, polygons, areas and the ring test."""

import math
import random

import pytest
from fixtures import square
from pyspark.sql import functions as F

from waymark.functions.geometry import (area, envelope, lonlat_envelope, overlaps, ring_contains)
from waymark.functions.tags import tag_equals
from waymark.functions.units import (mercator_x, mercator_y, pack, packed_x, packed_y, to_meters,
                                     to_units)
from waymark.operators.features import BOUNDS, dataset_extent, extent, features
from waymark.operators.ways import way_area, way_bounds, way_edges, way_points, way_summary
from waymark.schema import MAX_UNIT, METERS_PER_UNIT, MIN_UNIT, WAY

EDGES = [MIN_UNIT, -1, 0, 1, MAX_UNIT]


def test_packing_keeps_every_point(spark):
    points = spark.createDataFrame([(x, y) for x in EDGES for y in EDGES], "x int, y int")
    back = points.selectExpr("x", "y", f"{pack('x', 'y')} AS p").selectExpr(
        "x", "y", f"{packed_x('p')} AS px", f"{packed_y('p')} AS py", "p")
    rows = back.collect()
    assert all((r.x, r.y) == (r.px, r.py) for r in rows) and len({r.p for r in rows}) == 25


def test_units_truncate_toward_zero_and_clamp(spark):
    df = spark.createDataFrame([(v,) for v in (-1e300, -0.01, 0.0, 0.01, 1e300)], "m double")
    assert [r[0] for r in df.select(to_units("m")).collect()] == [MIN_UNIT, -1, 0, 1, MAX_UNIT]
    assert spark.range(1).select(to_meters(F.lit(100))).first()[0] == 100 * METERS_PER_UNIT


def test_lon_lat_to_mercator(spark):
    row = spark.range(1).select(mercator_x(F.lit(180.0)), mercator_y(F.lit(60.0))).first()
    assert row[0] == pytest.approx(math.pi * 6378137)
    assert row[1] == pytest.approx(6378137 * math.log(math.tan(math.pi / 4 + math.radians(30))))


def ids(df):
    return sorted(r.fid for r in df.select("fid").collect())


def test_box_edges_are_inclusive_and_parts_are_anded(build):
    m = 107  # 107 units are just under a meter
    build.node(1, m, m, {"k": "v"}).node(2, m + 1, m, {"k": "v"}).node(3, 0, 0)
    build.way(7, [(0, 0), (1000, 1000)], {"k": "v"}).relation(9, [("w", 7, "outer")], {"k": "v"})
    rows = features(build.tables(), ["fid", "type", "tags", *BOUNDS])
    edge = (m + 0.5) * METERS_PER_UNIT
    box = overlaps(envelope(-50, -50, edge, edge))
    assert ids(rows.where(box & tag_equals("k", "v"))) == [1, 7]
    assert ids(rows.where(box & tag_equals("k", "v") & (F.col("type") == WAY))) == [7]
    far = overlaps(envelope(5, 5, 1e12, 1e12))
    assert ids(rows.where(far)) == [7] + ids(rows.where("xmin = 1000"))
    assert ids(rows.where(far & box)) == [7]
    assert ids(rows.where(overlaps(lonlat_envelope(-90, -60, 90, 60)) & tag_equals("k", "v"))) == [
        1, 2, 7]


def test_bounds_and_extent(build):
    build.node(1, -5, 8).way(2, [(0, 0), (30, -40)]).way_of_nodes(3, [77])
    tables = build.tables()
    rows = {(r.type, r.fid): r.bbox for r in features(tables, ["fid", "type", "bbox"]).collect()}
    assert tuple(rows[1, 2]) == (0, -40, 30, 0) and tuple(rows[0, 1]) == (-5, 8, -5, 8)
    assert rows[1, 3] is None
    want = [v * METERS_PER_UNIT for v in (-5, -40, 30, 8)]
    for got in (dataset_extent(tables), extent(features(tables, BOUNDS))):
        assert list(got.first()) == pytest.approx(want)


def test_line_and_polygon(build):
    build.way(1, [(0, 0), (3, 3), (9, 1)]).way(2, square(0, 0, 10)[:-1], is_area=True)
    build.way(3, square(0, 0, 10), is_area=True).way_of_nodes(4, [77])
    rows = {r.fid: r for r in features(build.tables(), ["fid", "geom"], types=[WAY])
            .select("fid", "geom", area().alias("area")).collect()}
    xs = {f: [round(p.x / METERS_PER_UNIT) for p in r.geom.parts[0][0]]
          for f, r in rows.items() if r.geom}
    assert xs == {1: [0, 3, 9], 2: [0, 10, 10, 0, 0], 3: [0, 10, 10, 0, 0]}
    assert [rows[f].geom.kind for f in (1, 2, 3)] == ["LineString", "Polygon", "Polygon"]
    assert rows[4].geom is None and rows[4].area is None and rows[1].area == 0
    assert rows[2].area == rows[3].area == pytest.approx(100 * METERS_PER_UNIT ** 2)


def test_selected_ways_give_the_same_rows(build):
    rng = random.Random(2)
    for way in range(30):
        points = [(rng.randrange(999), rng.randrange(999)) for _ in range(rng.randrange(2, 9))]
        build.way(way, points, {"k": str(way % 3)}, is_area=way % 2 == 0)
    columns = ["fid", "type", "geom", "bbox", "members", "parents", "tags"]
    every = features(build.tables(), columns).where(tag_equals("k", "1"))
    chosen = features(build.tables(), columns, where=tag_equals("k", "1"))
    assert sorted(map(str, chosen.collect())) == sorted(map(str, every.collect()))


@pytest.mark.parametrize("span", [1, 3, 4096])
def test_way_summary_does_not_depend_on_spans(build, span):
    rng = random.Random(8)
    shapes = {w: [(rng.randrange(-10**9, 10**9), rng.randrange(-10**9, 10**9))
                  for _ in range(rng.randrange(1, 20))] for w in range(12)}
    for way, points in shapes.items():
        build.way(way, points)
    points = way_points(build.tables(span))
    edges = {}
    for r in way_edges(points).collect():
        edges.setdefault(r.way_id, []).append(((r.x1, r.y1), (r.x2, r.y2)))
    areas = {r.way_id: r.area_m2 for r in way_area(points).collect()}
    bounds = {r.way_id: tuple(r)[1:] for r in way_bounds(points).collect()}
    for r in way_summary(points).collect():
        p = shapes[r.way_id]
        twice = sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(p, p[1:] + p[:1]))
        assert areas[r.way_id] == pytest.approx(abs(twice) / 2 * METERS_PER_UNIT ** 2, rel=1e-9)
        assert r.n_points == len(p)
        assert (r.first >> 32, r.last >> 32) == (p[0][0], p[-1][0])
        assert sorted(edges.get(r.way_id, [])) == sorted(zip(p, p[1:]))
        xs, ys = zip(*p)
        assert bounds[r.way_id] == (min(xs), min(ys), max(xs), max(ys))


def test_small_areas_far_from_the_origin_keep_their_digits(build):
    build.way(1, square(2_000_000_000, 2_000_000_000, 7), is_area=True)
    got = way_area(way_points(build.tables())).first().area_m2
    assert got == pytest.approx(49 * METERS_PER_UNIT ** 2, rel=1e-12)


def test_ring_contains(spark):
    ring = F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y"))
                     for x, y in [(0, 0), (10, 0), (10, 10), (5, 4), (0, 10), (0, 0)]])
    points = [(1, 1, True), (5, 3, True), (5, 5, False), (11, 1, False), (-1, 1, False),
              (2, 7, True), (0, 0, True), (10, 0, False), (5, 10, False)]
    df = spark.createDataFrame([(float(x), float(y), v) for x, y, v in points],
                               "x double, y double, want boolean")
    rows = df.select("want", ring_contains(F.col("x"), F.col("y"), ring).alias("got")).collect()
    assert [r.got for r in rows] == [r.want for r in rows]
    two = F.slice(ring, 1, 2)
    assert df.select(ring_contains(F.col("x"), F.col("y"), two)).distinct().collect() == [(False,)]
