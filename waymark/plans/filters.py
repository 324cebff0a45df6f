"""Scans, projections, tag/type/box filters and counts over the feature view."""

from __future__ import annotations

from pyspark.sql import functions as F

from waymark.functions.geometry import envelope, lonlat_envelope, overlaps
from waymark.functions.tags import (selector, shape_label, tag, tag_equals, tag_exists, tag_in,
                                    tag_not_null, tags_contain, tags_json, type_label, type_name)
from waymark.operators.features import BOUNDS, dataset_extent, extent, features
from waymark.operators.graph import member_edges, parent_edges
from waymark.plans.oracle import METERS, mercator_x, mercator_y, overlap, with_tables
from waymark.schema import NODE, RELATION, WAY
from waymark.sources.derived import derived_tables

BOX = (-2000000.0, -1000000.0, 3000000.0, 4000000.0)
LONLAT_BOX = (-60.0, -40.0, 60.0, 60.0)


def _features(spark, path, *columns, **options):
    return features(derived_tables(spark, path), columns or ("fid", "type", "tags", "is_area"),
                    **options)


def _filtered(predicate, *keep):
    """A query from a predicate; both are built late, when a session exists."""
    def run(spark, path):
        columns = [c() if callable(c) else c for c in keep or ("fid", "type")]
        return _features(spark, path).where(predicate()).select(*columns)
    return run


def scan_features(spark, path):
    return _features(spark, path).select(
        "fid", "type", "is_area", F.size("tags").alias("n_tags"), tag("name").alias("name"))


def unknown_column_null(spark, path):
    return _features(spark, path, "type", "elevation", "fid", declared={"elevation": "double"})


def prefilter_buildings(spark, path):
    return _features(spark, path, where=selector("wa", tag_exists("building"))).select(
        "fid", "type", "is_area", tag("building").alias("building"))


def prefilter_named_nw(spark, path):
    return _features(spark, path, where=selector("nw", tag_exists("name"))).select(
        "fid", "type", tag("name").alias("name"))


def selector_union(spark, path):
    return _features(spark, path, where=selector("ar", tag_exists("name"))).select(
        "fid", "type", "is_area")


def feature_bounds(spark, path):
    return _features(spark, path, "fid", "type", "bbox").where("bbox IS NOT NULL").select(
        "fid", "type", *[F.col(f"bbox.{c}").alias(c) for c in BOUNDS])


def type_labels(spark, path):
    return _features(spark, path).select(
        "fid", type_label().alias("feature_type"), shape_label().alias("geometry_type"),
        type_name().alias("type_name"))


def bbox(spark, path):
    return (_features(spark, path, "fid", "type", *BOUNDS)
            .where(overlaps(envelope(*BOX))).select("fid", "type"))


def combined_filter(spark, path):
    # The tag test comes first, so only buildings take part in the node join.
    return (_features(spark, path, "fid", "type", *BOUNDS, types=[WAY],
                      where=tag_equals("building", "yes"))
            .where((F.col("type") == WAY) & overlaps(envelope(*BOX))).select("fid", "type"))


def lonlat_bbox(spark, path):
    return (_features(spark, path, "fid", "type", *BOUNDS)
            .where(overlaps(lonlat_envelope(2.3, 48.85, 2.35, 48.87))).select("fid", "type"))


def restaurants_in_box(spark, path):
    return (_features(spark, path, "fid", "tags", *BOUNDS,
                      where=tag_equals("amenity", "restaurant"))
            .where(overlaps(lonlat_envelope(*LONLAT_BOX)))
            .select("fid", tag("name").alias("name"), tag("cuisine").alias("cuisine")))


def has_members(spark, path):
    tables = derived_tables(spark, path)
    # distinct() folds the edges of a hot owner before they are shuffled.
    owners = member_edges(tables).select(F.col("relation_id").alias("fid")).distinct()
    return (features(tables, types=[RELATION]).join(owners, "fid", "left_semi")
            .select("fid", tag("name").alias("name")))


def has_parents(spark, path):
    tables = derived_tables(spark, path)
    found = [features(tables, types=[code]).join(
        parent_edges(tables, code, distinct=False).select("fid").distinct(), "fid", "left_semi")
        .select("fid", "type") for code in (NODE, WAY, RELATION)]
    return found[0].unionByName(found[1]).unionByName(found[2])


def tag_extract(spark, path):
    return _features(spark, path).select(
        "fid", "type", tag("name").alias("name"), tag("highway").alias("highway"),
        tag("no_such_key").alias("missing"))


def tags_as_json(spark, path):
    return _features(spark, path).select("fid", "type", tags_json().alias("tags_json"))


def count(spark, path):
    return _features(spark, path).agg(F.count("*").alias("n"))


def count_buildings(spark, path):
    return _features(spark, path).where(tag_exists("building")).agg(F.count("*").alias("n"))


def named_residential_count(spark, path):
    wanted = tags_contain({"highway": "residential"}) & tag_exists("name")
    return _features(spark, path).where(wanted).agg(F.count("*").alias("n"))


def count_by_type(spark, path):
    return (_features(spark, path).groupBy("type", "is_area").agg(F.count("*").alias("n"))
            .orderBy("type", "is_area")
            .select("type", type_label().alias("feature_type"),
                    shape_label().alias("geometry_type"), "n"))


def distinct_keys(spark, path):
    return (_features(spark, path).select(F.explode(F.map_keys("tags")).alias("key"))
            .distinct().orderBy("key"))


def relation_count(spark, path):
    return _features(spark, path).where(F.col("type") == RELATION).agg(F.count("*").alias("n"))


def rounded(df):
    return df.select(*[F.round(c, 3).alias(c) for c in BOUNDS])


def whole_extent(spark, path):
    return rounded(dataset_extent(derived_tables(spark, path)))


def extent_buildings(spark, path):
    return rounded(extent(_features(spark, path, *BOUNDS, where=tag_exists("building"))))


QUERIES = {
    "q_scan_features": scan_features,
    "q_unknown_column_null": unknown_column_null,
    "q_prefilter_buildings": prefilter_buildings,
    "q_prefilter_named_nw": prefilter_named_nw,
    "q_selector": selector_union,
    "q_feature_bounds": feature_bounds,
    "q_type_labels": type_labels,
    "q_tag_eq": _filtered(lambda: tag_equals("highway", "primary")),
    "q_tag_in": _filtered(lambda: tag_in("highway", ["primary", "residential"])),
    "q_tag_exists": _filtered(lambda: tag_exists("name")),
    "q_tag_not_null": _filtered(lambda: tag_not_null("amenity"), "fid",
                                lambda: tag("amenity").alias("amenity")),
    "q_tag_and": _filtered(lambda: tag_equals("building", "yes") & tag_exists("name")),
    "q_tag_contains": _filtered(lambda: tags_contain({"highway": "residential"})),
    "q_type_eq": _filtered(lambda: F.col("type") == WAY, "fid", "is_area"),
    "q_type_in": _filtered(lambda: F.col("type").isin(NODE, WAY)),
    "q_bbox": bbox,
    "q_combined_filter": combined_filter,
    "q_lonlat_bbox": lonlat_bbox,
    "q_restaurants_in_box": restaurants_in_box,
    "q_is_area": _filtered(lambda: F.col("is_area")),
    "q_area_ways": _filtered(lambda: (F.col("type") == WAY) & F.col("is_area"), "fid",
                             lambda: tag("building").alias("building")),
    "q_has_members": has_members,
    "q_has_parents": has_parents,
    "q_fid_eq": _filtered(lambda: F.col("fid") == 7, "fid", "type", "is_area"),
    "q_tag_extract": tag_extract,
    "q_tags_json": tags_as_json,
    "q_count": count,
    "q_count_buildings": count_buildings,
    "q_named_residential_count": named_residential_count,
    "q_count_by_type": count_by_type,
    "q_distinct_keys": distinct_keys,
    "q_relation_count": relation_count,
    "q_extent": whole_extent,
    "q_extent_buildings": extent_buildings,
}


def _simple(select, where="true"):
    return with_tables(f"SELECT {select} FROM features WHERE {where}", "features")


_LABEL = "CASE type WHEN 0 THEN 'Node' WHEN 1 THEN 'Way' ELSE 'Relation' END"
_SHAPE = "CASE WHEN is_area THEN 'Area' ELSE 'Linear' END"
_KEYS = {"name": "name", "brand": "brand", "size": "size", "amenity": "amenity",
         "building": "building", "highway": "highway", "leisure": "leisure", "type": "kind",
         "network": "network"}
_TAG_LIST = "[" + ", ".join(f"{{'k': '{k}', 'v': {c}}}" for k, c in _KEYS.items()) + "]"
_EXTENT = ", ".join(f"round({c[1:]}({c}) * {METERS}, 3) AS {c}" for c in BOUNDS)


def _box_sql(select, box_sql, where="true"):
    return with_tables(f"""SELECT {select} FROM features JOIN bounds USING (fid, type)
        WHERE {box_sql} AND {where}""", "features", "bounds")


_LONLAT_SQL = [f(v) for f, v in zip((mercator_x, mercator_y) * 2, LONLAT_BOX)]
_PARIS_SQL = [f(v) for f, v in zip((mercator_x, mercator_y) * 2, (2.3, 48.85, 2.35, 48.87))]

ORACLES = {
    "q_scan_features": _simple(
        "fid, type, is_area, CAST(" + " + ".join(f"({c} IS NOT NULL)::INT" for c in _KEYS.values())
        + " AS INTEGER) AS n_tags, name"),
    "q_unknown_column_null": _simple("type, CAST(NULL AS DOUBLE) AS elevation, fid"),
    "q_prefilter_buildings": _simple("fid, type, is_area, building",
                                     "building IS NOT NULL AND (type = 1 OR is_area)"),
    "q_prefilter_named_nw": _simple(
        "fid, type, name", "name IS NOT NULL AND (type = 0 OR (type = 1 AND NOT is_area))"),
    "q_selector": _simple(
        "fid, type, is_area", "name IS NOT NULL AND (is_area OR (type = 2 AND NOT is_area))"),
    "q_feature_bounds": with_tables("SELECT fid, type, xmin, ymin, xmax, ymax FROM bounds",
                                    "bounds"),
    "q_type_labels": _simple(
        f"fid, {_LABEL} AS feature_type, {_SHAPE} AS geometry_type, lower({_LABEL}) AS type_name"),
    "q_tag_eq": _simple("fid, type", "highway = 'primary'"),
    "q_tag_in": _simple("fid, type", "highway IN ('primary', 'residential')"),
    "q_tag_exists": _simple("fid, type", "name IS NOT NULL"),
    "q_tag_not_null": _simple("fid, amenity", "amenity IS NOT NULL"),
    "q_tag_and": _simple("fid, type", "building = 'yes' AND name IS NOT NULL"),
    "q_tag_contains": _simple("fid, type", "highway = 'residential'"),
    "q_type_eq": _simple("fid, is_area", "type = 1"),
    "q_type_in": _simple("fid, type", "type IN (0, 1)"),
    "q_bbox": _box_sql("fid, type", overlap(*BOX)),
    "q_combined_filter": _box_sql("fid, type", overlap(*BOX), "type = 1 AND building = 'yes'"),
    "q_lonlat_bbox": _box_sql("fid, type", overlap(*_PARIS_SQL)),
    "q_restaurants_in_box": _box_sql("fid, name, CAST(NULL AS VARCHAR) AS cuisine",
                                     overlap(*_LONLAT_SQL), "amenity = 'restaurant'"),
    "q_is_area": _simple("fid, type", "is_area"),
    "q_area_ways": _simple("fid, building", "type = 1 AND is_area"),
    "q_has_members": with_tables(
        "SELECT id AS fid, name FROM relations WHERE id IN (SELECT relation_id FROM members)",
        "members"),
    "q_has_parents": with_tables(
        "SELECT DISTINCT child_id AS fid, child_type AS type FROM parents", "parents"),
    "q_fid_eq": _simple("fid, type, is_area", "fid = 7"),
    "q_tag_extract": _simple("fid, type, name, highway, CAST(NULL AS VARCHAR) AS missing"),
    "q_tags_json": _simple(f"""fid, type, '{{' || coalesce(list_aggregate(list_transform(
        list_sort(list_transform(list_filter({_TAG_LIST}, lambda e: e.v IS NOT NULL),
                                 lambda e: {{'n': strlen(e.k), 'k': e.k, 'v': e.v}})),
        lambda e: '"' || e.k || '":"' || e.v || '"'), 'string_agg', ','), '') || '}}' AS tags_json"""),
    "q_count": _simple("count(*) AS n"),
    "q_count_buildings": _simple("count(*) AS n", "building IS NOT NULL"),
    "q_named_residential_count": _simple("count(*) AS n",
                                         "highway = 'residential' AND name IS NOT NULL"),
    "q_count_by_type": with_tables(
        f"""SELECT type, {_LABEL} AS feature_type, {_SHAPE} AS geometry_type, count(*) AS n
            FROM features GROUP BY type, is_area ORDER BY type, is_area""", "features"),
    "q_distinct_keys": with_tables(
        "SELECT DISTINCT key FROM (" + " UNION ALL ".join(
            f"SELECT '{k}' AS key FROM features WHERE {c} IS NOT NULL" for k, c in _KEYS.items())
        + ") ORDER BY key", "features"),
    "q_relation_count": _simple("count(*) AS n", "type = 2"),
    "q_extent": with_tables(f"SELECT {_EXTENT} FROM bounds", "bounds"),
    "q_extent_buildings": with_tables(
        f"""SELECT {_EXTENT} FROM bounds JOIN features USING (fid, type)
            WHERE building IS NOT NULL""", "features", "bounds"),
}
