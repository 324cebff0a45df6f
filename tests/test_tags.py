"""Tags, selectors, labels and JSON text."""

import pytest
from pyspark.sql import functions as F

from waymark.functions.tags import (selector, tag, tag_equals, tag_exists, tag_in, tags_contain,
                                    tags_json, type_name)
from waymark.operators.features import features, register_features
from waymark.sources.tables import tags_from_pairs, with_tags


def ids(df):
    return sorted(r.fid for r in df.select("fid").collect())


@pytest.fixture
def tables(build):
    build.node(1).node(2, tags={"k": "a,b"}).node(3, tags={"k": "*"}).node(4, tags={"k": "a"})
    build.way_of_nodes(10, [1, 2], tags={"k": "a", "building": "yes"})
    build.way_of_nodes(11, [1, 2, 3], tags={"building": "no"}, is_area=True)
    build.relation(20, tags={"building": "yes"}, is_area=True).relation(21, tags={"k": "z"})
    return build.tables()


def test_a_feature_without_tags_has_the_empty_map(tables):
    row = features(tables).where("fid = 1").first()
    assert row.tags == {} and row.is_area is False and row.type == 0


def test_values_are_compared_as_they_are(tables):
    rows = features(tables)
    assert ids(rows.where(tag_equals("k", "a,b"))) == [2]
    assert ids(rows.where(tag_in("k", ["a", "b"]))) == [4, 10]
    assert ids(rows.where(tag_equals("k", "*"))) == [3]
    assert ids(rows.where(tags_contain({"k": "a", "building": "yes"}))) == [10]
    assert ids(rows.where(~tags_contain({"k": "a"}))) == [1, 2, 3, 11, 20, 21]
    assert ids(rows.where(tag_exists("building") & (tag("building") != "no"))) == [10, 20]


@pytest.mark.parametrize("letters, expected", [
    ("n", [1, 2, 3, 4]), ("w", [10]), ("a", [11, 20]), ("r", [21]), ("wa", [10, 11, 20]),
    ("nr", [1, 2, 3, 4, 21]), ("*", [1, 2, 3, 4, 10, 11, 20, 21])])
def test_selector_letters(tables, letters, expected):
    assert ids(features(tables).where(selector(letters))) == expected
    assert ids(features(tables, where=selector(letters))) == expected


def test_selector_with_tests(tables):
    assert ids(features(tables, where=selector("wa", tag_exists("building")))) == [10, 11, 20]


@pytest.mark.parametrize("bad", ["", "x", "wx"])
def test_selector_refuses_unknown_letters(spark, bad):
    with pytest.raises(ValueError):
        selector(bad)


def test_repeated_tag_key_keeps_its_last_value(spark):
    pairs = spark.createDataFrame(
        [(1, 0, "k", "1"), (1, 1, "k", "2"), (1, 2, "j", "x")], "id long, seq int, k string, v string")
    owners = spark.createDataFrame([(1,), (2,)], "id long")
    rows = with_tags(owners, tags_from_pairs(pairs)).orderBy("id").collect()
    assert [r.tags for r in rows] == [{"j": "x", "k": "2"}, {}]


def test_json_orders_keys_by_length_then_bytes(spark):
    df = spark.sql("SELECT map('bb', '1', 'a', '\"q\"', 'aa', '2', 'é', '3') AS tags")
    assert df.select(tags_json()).first()[0] == '{"a":"\\"q\\"","aa":"2","bb":"1","é":"3"}'


def test_type_names(spark):
    rows = spark.range(4).select(type_name(F.col("id").cast("int"))).collect()
    assert [r[0] for r in rows] == ["node", "way", "relation", "unknown"]


def test_registered_view_is_replaced_and_filtered(spark, tables):
    register_features(spark, "osm", tables)
    assert spark.sql("SELECT count(*) FROM osm").first()[0] == 8
    sql = "SELECT fid FROM osm WHERE tags['building'] = 'yes' AND type = 1"
    assert [r.fid for r in spark.sql(sql).collect()] == [10]
    register_features(spark, "osm", tables, ["fid", "tags"],
                      where=selector("wa", tag_exists("building")))
    assert spark.table("osm").columns == ["fid", "tags"]
    assert spark.sql("SELECT count(*) FROM osm WHERE tags['building'] = 'yes'").first()[0] == 2


def test_columns_by_name(tables):
    rows = features(tables, ["nothing", "way", "fid", "elevation"], declared={"elevation": "double"})
    assert rows.columns == ["nothing", "way", "fid", "elevation"]
    assert dict(rows.dtypes)["elevation"] == "double"
    row = rows.where("fid = 4").first()
    assert row.nothing is None and row.elevation is None and row.way.kind == "Point"
