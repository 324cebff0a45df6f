"""Relation members and parents, as arrays, as rows and as counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waymark.functions.tags import tag, tag_equals
from waymark.operators.features import ALL_TYPES, features
from waymark.operators.graph import (member_chunks, member_counts, parent_chunks, parent_counts, unnest_members,
                                     unnest_parents)
from waymark.plans.oracle import with_tables
from waymark.schema import RELATION
from waymark.sources.derived import derived_tables, ring_tables

#: Widths of chunks in the queries, in sequence numbers and in ids of the derived tables.
MEMBER_SPAN, PARENT_SPAN = 1000, 512


def _members(cap):
    def run(spark, path):
        rows = features(derived_tables(spark, path),
                        ["fid", "members", "members_truncated"], types=[RELATION], max_members=cap)
        text = F.transform("members", lambda m: F.concat_ws(":", m["type"], m["id"], m["role"]))
        return rows.where("members IS NOT NULL").select(
            "fid", F.size("members").alias("n"), F.concat_ws(",", text).alias("entries"),
            F.col("members_truncated").alias("truncated"))
    return run


def _parents(cap):
    def run(spark, path):
        rows = features(derived_tables(spark, path),
                        ["fid", "type", "parents", "parents_truncated"], max_parents=cap)
        text = F.transform("parents", lambda p: F.concat_ws(":", p["type"], p["id"]))
        return rows.where("parents IS NOT NULL").select(
            "fid", "type", F.size("parents").alias("n"), F.concat_ws(",", text).alias("entries"),
            F.col("parents_truncated").alias("truncated"))
    return run


def unnested_members(spark, path):
    tables = derived_tables(spark, path)
    names = features(tables, types=[RELATION]).select("fid", tag("name").alias("relation_name"))
    return names.join(unnest_members(tables), "fid").select(
        "fid", "relation_name", F.col("id").alias("member_id"), F.col("type").alias("member_type"),
        F.col("role").alias("member_role"))


def multipolygon_members(spark, path):
    tables = ring_tables(spark, path)
    wanted = features(tables, types=[RELATION], where=tag_equals("type", "multipolygon")).select(
        "fid", tag("name").alias("name"))
    rows = unnest_members(tables, relation_ids=wanted.select(F.col("fid").alias("relation_id")))
    return wanted.join(rows, "fid").select(
        "fid", "name", F.col("id").alias("member_id"), F.col("type").alias("member_type"),
        F.col("role").alias("member_role"))


def _by_type(tables, build) -> DataFrame:
    """Features of each type joined with their own rows, so no key needs the type."""
    parts = [features(tables, types=[code]).select(
        "fid", F.col("type").alias("feature_type"), tag("name").alias("feature_name"))
        .join(build(tables, code), "fid") for code in ALL_TYPES]
    return reduce(DataFrame.unionByName, parts)


def unnested_parents(spark, path):
    return _by_type(derived_tables(spark, path), unnest_parents).select(
        "fid", "feature_type", "feature_name", F.col("id").alias("parent_id"),
        F.col("type").alias("parent_type"))


def exploded_members(spark, path):
    """The array column unnested by the query itself, entry by entry in order."""
    rows = features(derived_tables(spark, path), ["fid", "tags", "members"], types=[RELATION])
    return rows.select("fid", tag("name").alias("relation_name"), F.posexplode("members").alias("place", "m")).select(
        "fid", "relation_name", (F.col("place") + 1).alias("place"), F.col("m.type").alias("member_type"),
        F.col("m.id").alias("member_id"), F.col("m.role").alias("member_role"))


def exploded_parents(spark, path):
    rows = features(derived_tables(spark, path), ["fid", "type", "parents"])
    return rows.select("fid", F.col("type").alias("feature_type"), F.posexplode("parents").alias("place", "p")).select(
        "fid", "feature_type", (F.col("place") + 1).alias("place"), F.col("p.type").alias("parent_type"),
        F.col("p.id").alias("parent_id"))


def chunked_members(spark, path):
    """Every entry with its place in the whole list, from chunks: one slim row a chunk gives the places before it."""
    rows = member_chunks(derived_tables(spark, path), span=MEMBER_SPAN)
    before = F.sum(F.size("members")).over(
        Window.partitionBy("relation_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1))
    starts = rows.select("relation_id", "chunk", F.coalesce(before, F.lit(0)).alias("before"))
    return rows.join(starts, ["relation_id", "chunk"]).select(
        F.col("relation_id").alias("fid"), "before", F.posexplode("members").alias("place", "m")).select(
        "fid", (F.col("before") + F.col("place") + 1).alias("place"), F.col("m.type").alias("member_type"),
        F.col("m.id").alias("member_id"), F.col("m.role").alias("member_role"))


def chunked_parents(spark, path):
    tables = derived_tables(spark, path)
    parts = [parent_chunks(tables, code, features(tables, ["fid"], types=[code]), PARENT_SPAN).select(
        "fid", F.lit(code).alias("type"), "parent_type", "chunk", F.size("parents").alias("n"),
        F.concat_ws(",", F.transform("parents", lambda p: F.concat_ws(":", p["type"], p["id"]))).alias("entries"))
        for code in ALL_TYPES]
    return reduce(DataFrame.unionByName, parts)


def member_count(spark, path):
    tables = derived_tables(spark, path)
    names = features(tables, types=[RELATION]).select("fid", tag("name").alias("name"))
    counts = member_counts(tables).withColumnRenamed("relation_id", "fid")
    return names.join(counts, "fid").select("fid", "name", "member_count")


def first_member_counts(spark, path):
    return member_count(spark, path).orderBy("fid").limit(10)


def parent_count(spark, path):
    return _by_type(derived_tables(spark, path), parent_counts).select(
        "fid", "feature_type", "feature_name", "parent_count")


QUERIES = {
    "q_members": _members(None),
    "q_members_capped": _members(100),
    "q_parents": _parents(None),
    "q_parents_capped": _parents(20),
    "q_unnest_members": unnested_members,
    "q_multipolygon_members": multipolygon_members,
    "q_unnest_parents": unnested_parents,
    "q_explode_members": exploded_members,
    "q_explode_parents": exploded_parents,
    "q_member_chunks": chunked_members,
    "q_parent_chunks": chunked_parents,
    "q_member_count": member_count,
    "q_member_count_limit": first_member_counts,
    "q_parent_count": parent_count,
}


def _members_sql(cap=1 << 62):
    return with_tables(f"""
        SELECT relation_id AS fid, CAST(count(*) AS INTEGER) AS n,
               string_agg(mtype || ':' || member_id || ':' || role, ',' ORDER BY seq) AS entries,
               greatest(max(total) - {cap}, 0) AS truncated
        FROM members WHERE rn <= {cap} GROUP BY relation_id""", "members")


def _parents_sql(cap=1 << 62):
    return with_tables(f"""
        SELECT child_id AS fid, child_type AS type, CAST(count(*) AS INTEGER) AS n,
               string_agg(ptype || ':' || parent_id, ',' ORDER BY rn) AS entries,
               greatest(max(total) - {cap}, 0) AS truncated
        FROM parents WHERE rn <= {cap} GROUP BY child_id, child_type""", "parents")


_MEMBER_COUNT = f"""
    SELECT id AS fid, name, n AS member_count FROM relations
    JOIN (SELECT relation_id, count(*) AS n FROM members GROUP BY relation_id) ON relation_id = id"""

ORACLES = {
    "q_members": _members_sql(),
    "q_members_capped": _members_sql(100),
    "q_parents": _parents_sql(),
    "q_parents_capped": _parents_sql(20),
    "q_unnest_members": with_tables(f"""
        SELECT id AS fid, name AS relation_name, CAST(member_id AS VARCHAR) AS member_id,
               mtype AS member_type, role AS member_role
        FROM members JOIN relations ON id = relation_id""", "members"),
    "q_multipolygon_members": """
        SELECT c_custkey AS fid, c_name AS name, CAST(c_custkey * 8 + i AS VARCHAR) AS member_id,
               'way' AS member_type, CASE WHEN i < pieces THEN 'outer' ELSE 'inner' END AS member_role
        FROM (SELECT *, CASE c_custkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 4 END AS pieces
              FROM customer), range(5) t(i)
        WHERE i < pieces + (c_custkey % 5 = 0)::INT""",
    "q_unnest_parents": with_tables(f"""
        SELECT child_id AS fid, child_type AS feature_type, name AS feature_name,
               CAST(parent_id AS VARCHAR) AS parent_id, ptype AS parent_type
        FROM parents JOIN features ON fid = child_id AND type = child_type""", "parents", "features"),
    "q_explode_members": with_tables("""
        SELECT id AS fid, name AS relation_name, CAST(rn AS INTEGER) AS place, mtype AS member_type,
               CAST(member_id AS VARCHAR) AS member_id, role AS member_role
        FROM members JOIN relations ON id = relation_id""", "members"),
    "q_explode_parents": with_tables("""
        SELECT child_id AS fid, child_type AS feature_type, CAST(rn AS INTEGER) AS place, ptype AS parent_type,
               CAST(parent_id AS VARCHAR) AS parent_id FROM parents""", "parents"),
    "q_member_chunks": with_tables("""
        SELECT relation_id AS fid, rn AS place, mtype AS member_type, CAST(member_id AS VARCHAR) AS member_id,
               role AS member_role FROM members""", "members"),
    "q_parent_chunks": with_tables(f"""
        SELECT child_id AS fid, child_type AS type, parent_type, CAST(floor(parent_id / {PARENT_SPAN}) AS BIGINT) AS chunk,
               CAST(count(*) AS INTEGER) AS n, string_agg(ptype || ':' || parent_id, ',' ORDER BY parent_id) AS entries
        FROM parents GROUP BY ALL""", "parents"),
    "q_member_count": with_tables(_MEMBER_COUNT, "members"),
    "q_member_count_limit": with_tables(_MEMBER_COUNT + " ORDER BY fid LIMIT 10", "members"),
    "q_parent_count": with_tables(f"""
        SELECT fid, type AS feature_type, name AS feature_name,
               n AS parent_count
        FROM features JOIN (SELECT child_id, child_type, count(*) AS n FROM parents
                            GROUP BY child_id, child_type)
          ON child_id = fid AND child_type = type""", "parents", "features"),
}
