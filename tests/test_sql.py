"""The documented SQL, run on a registered view, and the stored layout."""

import pytest
from fixtures import square

from waymark.functions.geometry import envelope, overlaps
from waymark.functions.sql import register_functions
from waymark.operators.features import FEATURE_COLUMNS, register_features
from waymark.schema import METERS_PER_UNIT
from waymark.sources.store import read_features, stored_tag, write_features


@pytest.fixture(scope="module")
def tables(spark):
    from fixtures import Builder
    build = Builder(spark)
    build.node(1, 100, 100, {"amenity": "restaurant", "name": "Here", "cuisine": "thai"})
    build.node(2, 2_000_000_000, 0, {"amenity": "restaurant", "name": "Far"})
    build.way(3, square(0, 0, 1000), {"leisure": "park", "name": "Small"}, is_area=True)
    build.way(4, [(0, 0), (5, 5)], {"leisure": "park", "highway": "residential", "name": "Line"})
    build.area(5, ("outer", square(0, 0, 5000)), ("inner", square(10, 10, 1000)))
    build.relations[-1] = (5, True, {"leisure": "park", "name": "Big", "type": "multipolygon"})
    return build.tables()


@pytest.fixture(scope="module")
def osm(spark, tables):
    register_functions(spark)
    return register_features(spark, "osm_data", tables, FEATURE_COLUMNS)


def test_largest_parks(spark, osm):
    rows = spark.sql("""SELECT tags['name'] AS name, geom_area(geom) AS area_m2 FROM osm_data
        WHERE tags['leisure'] = 'park' AND is_area ORDER BY area_m2 DESC LIMIT 10""").collect()
    assert [r.name for r in rows] == ["Big", "Small"]
    assert [r.area_m2 / METERS_PER_UNIT ** 2 for r in rows] == pytest.approx([24e6, 1e6])


def test_restaurants_in_a_lonlat_box(spark, osm):
    rows = spark.sql("""SELECT fid, tags['cuisine'] AS cuisine FROM osm_data
        WHERE tags['amenity'] = 'restaurant' AND box_overlaps(bbox, lon_to_meters(-1),
            lat_to_meters(-1), lon_to_meters(1), lat_to_meters(1))""").collect()
    assert rows == [(1, "thai")]


def test_members_and_parents_unnested(spark, osm):
    rows = spark.sql("""SELECT r.fid, r.tags['name'], m.id, m.type, m.role
        FROM osm_data r, LATERAL explode(r.members) AS t(m)
        WHERE r.type = 2 AND r.tags['type'] = 'multipolygon' ORDER BY m.id""").collect()
    assert [tuple(r) for r in rows] == [(5, "Big", "500000", "way", "outer"),
                                       (5, "Big", "500001", "way", "inner")]
    rows = spark.sql("""SELECT f.fid, p.id, p.type, size(f.parents) AS n
        FROM osm_data f, LATERAL explode(f.parents) AS t(p) WHERE f.type = 1""").collect()
    assert sorted(map(tuple, rows)) == [(500000, "5", "relation", 1), (500001, "5", "relation", 1)]


def test_counts_and_keys(spark, osm):
    keys = spark.sql("SELECT DISTINCT explode(map_keys(tags)) AS key FROM osm_data ORDER BY key")
    assert [r.key for r in keys.collect()] == [
        "amenity", "cuisine", "highway", "leisure", "name", "type"]
    row = spark.sql("""SELECT count(*) AS n FROM osm_data
        WHERE tags['highway'] = 'residential' AND map_contains_key(tags, 'name')""").first()
    assert row.n == 1


def test_stored_features_skip_by_type_tag_and_box(spark, tables, osm, tmp_path):
    path = str(tmp_path / "features")
    write_features(tables, path)
    stored = read_features(spark, path)
    found = stored.where((stored.type == 0) & (stored_tag(stored, "amenity") == "restaurant")
                         & overlaps(envelope(-1, -1, 1000, 1000)))
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(type" in text and "EqualTo(tag_amenity,restaurant)" in text
    assert "LessThanOrEqual(xmin," in text
    assert [r.fid for r in found.collect()] == [1]
    assert stored.where(stored_tag(stored, "cuisine") == "thai").count() == 1
    assert stored.count() == osm.count()
    same = "fid", "type", "xmin", "ymax"
    view = osm.select("fid", "type", "bbox.xmin", "bbox.ymax")
    assert sorted(map(str, stored.select(*same).collect())) == sorted(map(str, view.collect()))
