"""What the plans must look like, so that they hold at scale."""

import re

import pytest
from pyspark.sql import functions as F

from waymark.functions.geometry import envelope, overlaps
from waymark.functions.tags import tag_equals
from waymark.operators.features import BOUNDS, FEATURE_COLUMNS, features, register_features
from waymark.operators.graph import first_n
from waymark.operators.multipolygons import area_relations, hole_assignment, relation_measures
from waymark.operators.ways import way_points
from waymark.sources.tables import TABLE_NAMES, bucketed_tables, read_tables, write_bucketed, write_tables

ANY_JOIN = re.compile(r"\b\w*Join\b")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    from fixtures import Builder, square
    build = Builder(spark)
    for n in range(40):
        build.way(n, square(n * 10, 0, 5), {"building": "yes"} if n % 2 else None, is_area=n % 4 == 0)
        build.node(5_000_000 + n, n, n)
    build.area(70, ("outer", square(0, 0, 100)), ("inner", square(5, 5, 5)))
    path = str(tmp_path_factory.mktemp("tables") / "osm")
    write_tables(build.tables(), path)
    return read_tables(spark, path)


def test_stored_tables_skip_the_node_join(stored):
    text = plan(features(stored, ["fid", "xmin"], types=[1]))
    assert "nodes" not in text.replace("way_nodes", "")
    assert features(stored, ["fid", "geom"]).where("geom IS NOT NULL").count() > 80


def test_unused_columns_cost_no_join(spark, stored):
    register_features(spark, "every_column", stored, FEATURE_COLUMNS)
    for sql in ("SELECT count(*) FROM every_column", "SELECT fid, type, tags FROM every_column",
                "SELECT type, is_area, count(*) FROM every_column GROUP BY ALL"):
        assert not ANY_JOIN.search(plan(spark.sql(sql))), sql


def test_type_filter_prunes_the_other_branches(spark, stored):
    register_features(spark, "every_column", stored, FEATURE_COLUMNS)
    text = plan(spark.sql("SELECT fid FROM every_column WHERE type = 2"))
    assert "relations" in text and "ways" not in text and "nodes" not in text


def test_fid_reaches_the_scan(stored):
    assert "EqualTo(id,7)" in plan(features(stored).where("fid = 7"))


def test_count_reads_no_column(stored):
    text = plan(features(stored, FEATURE_COLUMNS).agg(F.count("*")))
    assert text.count("ReadSchema: struct<>") == text.count("ReadSchema") == 3


def test_box_is_four_integer_comparisons(stored):
    text = plan(features(stored, ["fid", *BOUNDS], types=[0])
                .where(overlaps(envelope(0, 0, 10, 10))))
    for pushed in ("LessThanOrEqual(x,", "GreaterThanOrEqual(x,", "LessThanOrEqual(y,"):
        assert pushed in text


def test_selective_filter_runs_before_the_geometry_join(stored):
    text = plan(features(stored, ["fid", "geom"], types=[1], where=tag_equals("building", "yes")))
    assert "LeftSemi" in text


def test_top_n_is_cut_before_the_shuffle(spark):
    df = spark.range(100_000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    text = plan(first_n(df, ["k"], ["v"], 1000))
    assert "Partial" in text and "Final" in text and text.count("WindowGroupLimit") == 2


def test_no_pairing_join(stored):
    areas = area_relations(stored)
    for df in (hole_assignment(areas), relation_measures(areas)):
        assert not re.search("NestedLoop|Cartesian", plan(df))


def test_bucketed_tables_join_without_exchange(spark):
    from fixtures import Builder, square
    build = Builder(spark)
    for n in range(40):
        build.way(n, square(n * 10, 0, 5))
    tables = build.tables()
    write_bucketed(tables, "bucketed_osm", 4, mode="overwrite")
    bucketed = bucketed_tables(spark, "bucketed_osm")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        points = way_points(bucketed)
        text = plan(points)
        assert "SortMergeJoin" in text and "Exchange" not in text
        assert sorted(points.collect()) == sorted(way_points(tables).collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for name in TABLE_NAMES:
            spark.sql(f"DROP TABLE bucketed_osm_{name}")
