"""Stitching, holes and multipolygons against hand-made rings and brute force."""

import random

import pytest
from fixtures import square
from pyspark.sql import functions as F

from waymark.functions.geometry import area
from waymark.operators.chains import grow_chains
from waymark.operators.features import features
from waymark.operators.multipolygons import area_relations, hole_assignment, relation_measures
from waymark.schema import METERS_PER_UNIT, RELATION

A = [(0, 0), (1000, 0), (1000, 1000)]
B = [(1000, 1000), (0, 1000), (0, 0)]
SQ = square

# rings, then (slot, status, points) per outer ring, hole slots per outer, orphans, area
CASES = {
    1: ([("outer", SQ(0, 0, 1000))], [(0, "closed", 5)], {}, 0, 1000000),
    2: ([("outer", A), ("outer", B)], [(0, "closed", 5)], {}, 0, 1000000),
    3: ([("outer", A), ("outer", B[::-1])], [(0, "closed", 5)], {}, 0, 1000000),
    4: ([("outer", [(1000, 1000), (0, 1000)]), ("outer", [(0, 0), (1000, 0)]),
         ("outer", [(0, 0), (0, 1000)]), ("outer", [(1000, 1000), (1000, 0)])],
        [(0, "closed", 5)], {}, 0, 1000000),
    5: ([("outer", A), ("outer", [(1000, 1000), (0, 1000), (0, 50)])],
        [(0, "gap_closed", 6)], {}, 0, 1000000),
    6: ([("outer", A), ("outer", [(1000, 1000), (0, 1000), (0, 100)])], [], {}, 0, None),
    7: ([("outer", A)], [], {}, 0, None),
    8: ([("outer", [(0, 0), (1000, 0), (0, 0)])], [(0, "gap_closed", 4)], {}, 0, 0),
    9: ([("outer", SQ(0, 0, 1000)), ("inner", SQ(200, 200, 100))],
        [(0, "closed", 5)], {1: 0}, 0, 990000),
    10: ([("outer", SQ(0, 0, 1000)), ("outer", SQ(5000, 0, 1000)), ("inner", SQ(5200, 200, 100))],
         [(0, "closed", 5), (1, "closed", 5)], {2: 1}, 0, 1990000),
    11: ([("outer", SQ(0, 0, 1000)), ("inner", SQ(9000, 9000, 100))],
         [(0, "closed", 5)], {}, 1, 1000000),
    12: ([("", SQ(0, 0, 1000)), ("inner", SQ(200, 200, 100))], [], {}, 0, None),
    13: ([("outer", SQ(0, 0, 1000)), ("outer", SQ(100, 100, 500)), ("inner", SQ(200, 200, 100))],
         [(0, "closed", 5), (1, "closed", 5)], {2: 0}, 0, 1240000),
    14: ([("outer", A), ("outer", SQ(5000, 0, 1000)), ("outer", B)],
         [(0, "closed", 5), (1, "closed", 5)], {}, 0, 2000000),
    15: ([("outer", A), ("outer", [(950, 1000), (0, 1000), (0, 0)])],
         [(1, "gap_closed", 6)], {}, 0, 1000000),
}


@pytest.fixture(scope="module")
def tables(spark):
    from fixtures import Builder
    build = Builder(spark)
    for number, case in CASES.items():
        build.area(number, *case[0])
    return build.tables()


def test_hand_made_rings(tables):
    areas = area_relations(tables)
    found = {}
    for r in areas.rings.where("outer").collect():
        found.setdefault(r.relation_id, []).append((r.ring_slot, r.status, r.n_points))
    holes = {}
    for r in hole_assignment(areas).collect():
        holes.setdefault(r.relation_id, {})[r.hole_slot] = r.outer_slot
    measures = {r.relation_id: r for r in relation_measures(areas).collect()}
    for number, (_, rings, want_holes, orphans, units) in CASES.items():
        assert sorted(found.get(number, [])) == rings, number
        if units is None:
            assert number not in measures, number
            continue
        assert holes.get(number, {}) == want_holes, number
        m = measures[number]
        assert (m.n_polygons, m.n_holes, m.orphan_holes) == (len(rings), len(want_holes), orphans)
        assert m.area_units == units, number
        assert m.area_m2 == pytest.approx(units * METERS_PER_UNIT ** 2)


def test_geometry_of_hand_made_rings(tables):
    rows = features(tables, ["fid", "geom"], types=[RELATION]).select(
        "fid", "geom", area().alias("area")).collect()
    for r in rows:
        _, rings, holes, _, units = CASES[r.fid]
        if units is None:
            assert r.geom is None
            continue
        assert r.geom.kind == "MultiPolygon" and r.geom.srid == 3857
        assert [len(p[0]) for p in r.geom.parts] == [n for _, _, n in rings]
        assert sum(len(p) - 1 for p in r.geom.parts) == len(holes)
        assert all(ring[0] == ring[-1] for p in r.geom.parts for ring in p)
        assert r.area == pytest.approx(units * METERS_PER_UNIT ** 2)


def test_non_area_relation_has_no_geometry(build):
    build.way(1, SQ(0, 0, 1000)).relation(2, [("w", 1, "outer")])
    rows = features(build.tables(), ["geom", "bbox"], types=[RELATION]).collect()
    assert rows == [(None, None)]


def test_missing_member_way_is_skipped(build):
    build.way(1, SQ(0, 0, 1000)).relation(
        2, [("w", 99, "outer"), ("w", 1, "outer")], is_area=True)
    assert [r.ring_slot for r in area_relations(build.tables()).rings.collect()] == [1]


def test_area_way_without_closing_node_is_closed(build):
    build.way(1, SQ(0, 0, 1000)[:-1], is_area=True).way(2, SQ(200, 200, 10)).relation(
        5, [("w", 1, "outer"), ("w", 2, "inner")], is_area=True)
    areas = area_relations(build.tables())
    m = relation_measures(areas).first()
    assert (m.n_polygons, m.n_holes, m.area_units) == (1, 1, 1000000 - 100)


# -- what any result of the merging rule must fulfil --------------------------

def ends_open(first, last, count):
    return count < 4 or first != last


def check_chains(ways, chains):
    """Each way is in one chain; chains connect and count right; no tail is left with a partner; slot 0 chose first."""
    assert sorted(w for *_, path in chains for w, _ in path) == list(range(len(ways)))
    for first, last, count, closed, path in chains:
        turned = [(ways[w][1], ways[w][0]) if back else ways[w][:2] for w, back in path]
        assert all(a[1] == b[0] for a, b in zip(turned, turned[1:]))
        assert (first, last) == (turned[0][0], turned[-1][1]) and not path[0][1]
        assert count == sum(ways[w][2] for w, _ in path) - len(path) + 1
        assert closed == (not ends_open(first, last, count))
    loose = [c for c in chains if not c[3]]
    assert not [1 for a in loose for b in loose if a is not b and a[1] in b[:2]]
    if ends_open(*ways[0]):
        partners = [w for w, way in enumerate(ways) if w and ends_open(*way) and ways[0][1] in way[:2]]
        path = next(c[4] for c in chains if 0 in [w for w, _ in c[4]])
        at = [w for w, _ in path].index(0)
        beside = at - 1 if path[at][1] else at + 1
        if partners:
            assert path[beside][0] == min(partners)


def random_ways(rng, n, points):
    rows = [(rng.randrange(points), rng.randrange(points), rng.choice([2, 2, 3, 5]))
            for _ in range(n)]
    return [r if r[0] != r[1] or r[2] < 4 else (r[0], r[1], 3) for r in rows]


def test_chains_of_random_ways():
    rng = random.Random(1)
    for _ in range(2000):
        rows = random_ways(rng, rng.randrange(1, 14), rng.randrange(2, 9))
        check_chains(rows, list(grow_chains(*[list(c) for c in zip(*rows)])))


def test_lowest_slot_grows_first():
    # Slot 0 takes slot 1, not 2, at its tail; both that remain end where they began.
    assert sorted(grow_chains([0, 1, 1], [1, 2, 3], [2, 2, 2])) == [
        (0, 2, 3, False, [(0, False), (1, False)]), (1, 3, 2, False, [(2, False)])]
    # Slot 0 has no partner at its tail; slot 1 grows over slot 2 and then takes it.
    assert sorted(grow_chains([0, 5, 4], [1, 4, 0], [2, 2, 2])) == [
        (5, 1, 4, False, [(1, False), (2, False), (0, False)])]


def test_growing_long_chains_takes_linear_time():
    n = 200_000
    first, last = list(range(n)), list(range(1, n + 1))
    # Every chain is stuck at once and absorbed by the next: the worst order.
    chains = list(grow_chains(first[::-1], last[::-1], [2] * n))
    assert len(chains) == 1 and chains[0][2] == n + 1 and len(chains[0][4]) == n


# -- large groups -------------------------------------------------------------

def membership(areas):
    return sorted(tuple(r) for r in areas.ring_ways.select(
        "relation_id", "outer", "slot", "ring_slot", "pos", "reversed", "status",
        "ring_first", "ring_last").collect())


def cycle(rng, n, x0):
    """A closed run of n ways over n corners, ways in random order and direction."""
    corners = [(x0 + i, 7 * i * i % 1009) for i in range(n)]
    ways = [[corners[i], corners[(i + 1) % n]] for i in range(n)]
    ways = [w[::-1] if rng.random() < 0.5 else w for w in ways]
    rng.shuffle(ways)
    return ways


def test_large_groups_match_the_plain_plan(build):
    rng = random.Random(5)
    mixed = [w for n in (2, 3, 4, 17, 40) for w in cycle(rng, n, 10000 * n)]
    mixed += [[(5, 5), (6, 6)], [(6, 6), (7, 9)], [(300, 5), (5, 5)]]         # a dead end
    mixed += [[(50, 50), (60, 60), (50, 50)], [(50, 50), (70, 70)]]           # a loop
    star = [[(900000, 1), (900000 + i, 50 + i)] for i in range(1, 6)]         # a branch
    two_rings = [[(0, 900000), (9, 900009)], [(9, 900009), (0, 900005)], [(0, 900005), (0, 900000)],
                 [(0, 900000), (-9, 900009)], [(-9, 900009), (-5, 900000)],
                 [(-5, 900000), (0, 900000)]]                                 # touch in one point
    everything = mixed + star + two_rings
    rng.shuffle(everything)
    build.area(1, *[("outer", w) for w in everything])
    build.area(2, *[("outer", w) for w in cycle(rng, 30, 0)], ("inner", SQ(1, 1, 5)))
    build.area(3, ("outer", A), ("outer", B))
    tables = build.tables()
    plain = membership(area_relations(tables))
    assert membership(area_relations(tables, task_ways=20, materialize=True)) == plain
    assert membership(area_relations(tables, task_ways=1000, materialize=True)) == plain
    assert len(plain) == len(everything) + 31 + 2


# -- holes --------------------------------------------------------------------

def inside(x, y, ring):
    hits = 0
    for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
        if (y1 <= y < y2 or y2 <= y < y1) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            hits += 1
    return hits % 2 == 1


def test_holes_match_brute_force(build):
    rng = random.Random(3)
    rings = []
    for _ in range(60):
        x, y = rng.randrange(-40000, 40000), rng.randrange(-40000, 40000)
        w, h = rng.choice([30, 500, 9000, 60000]), rng.choice([30, 500, 9000, 60000])
        rings.append(("outer", [(x, y), (x + w, y + h // 3), (x + w // 2, y + h), (x, y)]))
    rings.append(("outer", SQ(-2_000_000_000, -2_000_000_000, 4_000_000_000)))
    for _ in range(80):
        x, y = rng.randrange(-90000, 90000), rng.randrange(-90000, 90000)
        rings.append(("inner", SQ(x, y, 7)))
    rng.shuffle(rings)
    build.area(1, *rings)
    got = {r.hole_slot: r.outer_slot
           for r in hole_assignment(area_relations(build.tables())).collect()}
    want = {}
    for slot, (role, hole) in enumerate(rings):
        if role == "inner":
            around = [s for s, (r, ring) in enumerate(rings)
                      if r == "outer" and inside(*hole[0], ring)]
            want[slot] = min(around)
    assert got == want and len(set(got.values())) > 3


def test_long_ring_split_over_spans(build):
    n = 50
    ring = [(i * 100, 0) for i in range(n)] + [(i * 100, 5000) for i in reversed(range(n))]
    build.area(1, ("outer", ring + ring[:1]), ("inner", SQ(200, 2500, 10)))
    build.area(2, ("outer", ring[:60]), ("outer", ring[59:] + ring[:1]), ("inner", SQ(200, 2500, 10)))
    for span in (1, 7, 4096):
        rows = relation_measures(area_relations(build.tables(span))).orderBy("relation_id").collect()
        assert [(r.n_points, r.n_holes, r.area_units) for r in rows] == [
            (106, 1, 4900 * 5000 - 100)] * 2


def test_rings_of_large_keys(spark, tmp_path):
    """Customer keys near ten thousand million give the closed-form areas."""
    from waymark.plans.catalog import QUERIES

    keys = [10_000_000_000 + n for n in range(30)]
    spark.createDataFrame([(k, f"c{k}") for k in keys], "c_custkey long, c_name string").write.parquet(
        str(tmp_path / "customer.parquet"))
    got = {(r.relation_id, r.role): r.area_units for r in QUERIES["q_ring_count"](spark, str(tmp_path)).collect()}
    assert got == {**{(k, "outer"): 1000000 for k in keys if k % 11}, **{(k, "inner"): 40000 for k in keys if k % 5 == 0}}
