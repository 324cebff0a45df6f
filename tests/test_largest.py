"""Top areas of both types: limits hold, candidates are few, results equal all areas sorted."""

import math
import random

from fixtures import square
from pyspark.sql import functions as F

from waymark.functions.tags import tag_equals
from waymark.operators.largest import area_limits, candidates, exact_areas, largest_areas
from waymark.schema import RELATION, WAY


def star(points, step, radius):
    """A path that winds ``step`` times around its middle."""
    turn = [2 * math.pi * n * step / points for n in range(points)]
    path = [(round(radius * math.cos(a)), round(radius * math.sin(a))) for a in turn]
    return [*path, path[0]]


def areas(build):
    rng = random.Random(4)
    for way in range(1, 41):
        path = [(rng.randrange(3000), rng.randrange(3000)) for _ in range(rng.randrange(3, 9))]
        build.way(way, path, {"kind": str(way % 2)}, is_area=True)
    build.way(50, star(5, 2, 9000), is_area=True).way(51, star(7, 3, 7000), is_area=True)
    build.way(52, square(0, 0, 9000)).way(53, [(0, 0), (9000, 9000)], is_area=True).way_of_nodes(54, [7], is_area=True)
    build.area(60, ("outer", square(0, 0, 8000)), ("inner", square(100, 100, 7000)))
    build.area(61, ("outer", square(0, 0, 5000)), ("outer", square(9000, 9000, 5000)))
    build.area(62, ("outer", [(0, 0), (99000, 0), (99000, 99000)]))  # open: no geometry
    build.area(63, ("outer", star(5, 2, 9000)))
    build.area(64, ("outer", square(20000, 0, 5000)), ("outer", square(30000, 0, 5000)))  # as large as 61
    return build.tables()


def chosen(tables):
    ways = tables.ways.where("is_area").select(F.lit(WAY).alias("type"), F.col("id").alias("fid"))
    return ways.union(tables.relations.select(F.lit(RELATION), "id"))


def test_limits_candidates_and_order(build):
    tables = areas(build)
    every = {(r.type, r.fid): int(r.area2) for r in exact_areas(tables, chosen(tables)).collect()}
    limit = {(r.type, r.fid): int(r.limit2) for r in area_limits(tables, chosen(tables)).collect()}
    assert len(every) == 47 and set(every) <= set(limit) and (WAY, 54) not in limit
    assert all(every[f] <= limit[f] for f in every)
    order = sorted(every, key=lambda f: (-every[f], f))
    assert order.index((RELATION, 64)) == order.index((RELATION, 61)) + 1
    met = {tuple(r) for r in candidates(tables, area_limits(tables, chosen(tables)), 3).collect()}
    assert set(order[:3]) <= met and len(met) < len(limit) / 2
    got = [(r.type, r.fid, int(r.area2)) for r in largest_areas(tables, 8).collect()]
    assert got == [(*f, every[f]) for f in order[:8]]
    odd = [(r.type, r.fid) for r in largest_areas(tables, 2, tag_equals("kind", "1")).collect()]
    assert odd == [f for f in order if f[0] == WAY and f[1] <= 40 and f[1] % 2][:2]


def test_fewer_areas_than_asked_for(build):
    build.way(1, square(0, 0, 5), is_area=True).area(2, ("outer", [(0, 0), (9, 0)]))
    assert [(r.type, r.fid) for r in largest_areas(build.tables(), 10).collect()] == [(WAY, 1)]
    assert largest_areas(build.tables(), 10, F.lit(False)).count() == 0
