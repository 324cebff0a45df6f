"""Features in zones: results equal the feature view, plans open only the files of zones that can match."""

import pytest

from waymark.functions.geometry import envelope, overlaps
from waymark.functions.tags import tag_equals, tag_exists, tag_in
from waymark.operators.features import BOUNDS, features
from waymark.sources.zones import read_zones, register_zones, stored_counts, stored_keys, write_zones

GRID = 4_000_000


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    from fixtures import Builder, square
    build = Builder(spark)
    for n in range(300):  # three hundred nodes over a wide grid, rare tags in one corner
        x, y = n % 20 * GRID, n // 20 * GRID
        tags = {"amenity": "bench"} if n % 3 == 0 else {}
        build.node(n + 10, x, y, tags | ({"rare": f"v{n}"} if x < 2 * GRID and y < 2 * GRID else {}))
    for n in range(60):
        build.way(n + 10, square(n % 10 * GRID, n // 10 * GRID, 500), {"building": "yes"} if n % 2 else None,
                  is_area=n % 4 == 0)
    build.node(9, 0, 0, None).relation(5, [("n", 9, "")], {"type": "route", "rare": "r"})
    build.area(70, ("outer", square(0, 0, 100)))
    tables = build.tables()
    path = str(tmp_path_factory.mktemp("zones") / "osm")
    write_zones(tables, path, zone_rows=40)
    return tables, path


def ids(df):
    return sorted((r.type, r.fid) for r in df.select("type", "fid").collect())


def opened(df):
    """Files opened by the scan of features, as the executed plan counts them."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    found, todo = [], [plan]
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            todo.append(node.plan())
        if node.nodeName().startswith("Scan parquet") and "is_area" in node.schema().simpleString():
            found.append(node.metrics().get("numFiles").get().value())
        todo += [node.children().apply(i) for i in range(node.children().size())]
    assert len(found) == 1
    return found[0]


def test_every_feature_is_stored(world, spark):
    tables, path = world
    assert ids(read_zones(spark, path)) == ids(features(tables))


@pytest.mark.parametrize("tags, test", [
    ({"amenity": ["bench"]}, lambda: tag_equals("amenity", "bench")),
    ({"rare": ["v0", "v1", "no"]}, lambda: tag_in("rare", ["v0", "v1", "no"])),
    ({"rare": None}, lambda: tag_exists("rare")),
    ({"rare": None, "amenity": ["bench"]}, lambda: tag_exists("rare") & tag_equals("amenity", "bench")),
    ({"nobody": None}, lambda: tag_exists("nobody")),
])
def test_tags(world, spark, tags, test):
    tables, path = world
    assert ids(read_zones(spark, path, tags)) == ids(features(tables).where(test()))


@pytest.mark.parametrize("box", [(-1, -1, 1, 1), (0, 0, 1e5, 1e5), (-5e6, -5e6, 5e6, 5e6), (1e7, 1e7, 1.1e7, 1.1e7)])
def test_boxes(world, spark, box):
    tables, path = world
    want = ids(features(tables, ["fid", "type", *BOUNDS]).where(overlaps(envelope(*box))))
    assert ids(read_zones(spark, path, box=envelope(*box))) == want
    register_zones(spark, "found", path)
    sides = ", ".join(f"{float(v)!r}D" for v in box)
    assert ids(spark.sql(f"SELECT * FROM found_search('*', NULL, NULL, {sides})")) == want


def test_search_takes_types_tags_and_no_side(world, spark):
    tables, path = world
    register_zones(spark, "asked", path)
    none = "NULL, NULL, NULL, NULL"
    rows = features(tables)
    for letters, key, value, where in (
            ("'n'", "'rare'", "NULL", "type = 0 AND tags['rare'] IS NOT NULL"),
            ("'wa'", "'building'", "'yes'", "tags['building'] = 'yes'"), ("'a'", "NULL", "NULL", "is_area"),
            ("'r'", "'type'", "'route'", "type = 2 AND NOT is_area"), ("'*'", "NULL", "NULL", "true"),
            ("'*'", "'rare'", "'v1'", "tags['rare'] = 'v1'"), ("'q'", "NULL", "NULL", "false")):
        got = spark.sql(f"SELECT * FROM asked_search({letters}, {key}, {value}, {none})")
        assert ids(got) == ids(rows.where(where)), (letters, key, value)


def test_only_files_of_matching_zones_are_opened(world, spark):
    tables, path = world
    register_zones(spark, "pruned", path)
    everything = opened(read_zones(spark, path).select("fid", "type", "is_area"))
    assert everything > 8
    keep = ["fid", "type", "is_area"]
    box = envelope(-1, -1, 1, 1)
    for df in (read_zones(spark, path, {"rare": ["v1"]}).select(keep), read_zones(spark, path, {"rare": None}).select(keep),
               read_zones(spark, path, {"rare": ["v0", "v1"]}).select(keep), read_zones(spark, path, box=box).select(keep),
               spark.sql("SELECT fid, type, is_area FROM pruned_search('n', 'rare', 'v1', NULL, NULL, NULL, NULL)"),
               spark.sql("SELECT fid, type, is_area FROM pruned_search('*', NULL, NULL, -1D, -1D, 1D, 1D)"),
               spark.sql("SELECT fid, type, is_area FROM pruned_search('n', 'rare', 'v1', -1D, -1D, 1D, 1D)")):
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "dynamicpruning" in text and "SortMergeJoin" not in text
        assert opened(df) <= everything / 2


def test_catalog_answers_without_features(world, spark):
    tables, path = world
    counts, keys = stored_counts(spark, path), stored_keys(spark, path)
    for df in (counts, keys):
        assert "osm/features" not in df._jdf.queryExecution().executedPlan().toString()
    rows = features(tables, ["fid", "type", "tags", "is_area", *BOUNDS])
    want = rows.groupBy("type").agg({"*": "count", "xmin": "min", "ymax": "max"}).collect()
    got = {r.type: r for r in counts.collect()}
    assert {r.type: (r["count(1)"], r["min(xmin)"], r["max(ymax)"]) for r in want} == {
        t: (r.n, r.xmin, r.ymax) for t, r in got.items()}
    assert {r.key: (r.n, r.n_values) for r in keys.collect()} == {
        r.key: (r.n, r.v) for r in rows.selectExpr("explode(tags)").groupBy("key").agg(
            {"*": "count"}).withColumnRenamed("count(1)", "n").join(
            rows.selectExpr("explode(tags)").groupBy("key").agg({"value": "approx_count_distinct"}).toDF("key", "v"),
            "key").collect()}
