"""The member graph: ordered relation members and inverse parents.

Edges stay narrow BIGINT rows until the last step. The row forms are the
scalable ones; chunks are arrays of bounded length; the array columns gather
all rows of a feature, or ``max_members`` / ``max_parents`` of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.functions.tags import type_name
from waymark.schema import NODE, RELATION, WAY
from waymark.sources.tables import OsmTables

_SALTS = 64
#: Width of a chunk in sequence numbers (members) or in ids (parents).
CHUNK_SPAN = 4096


def first_n(df: DataFrame, key: Sequence[str], order: Sequence[str], n: int | None) -> DataFrame:
    """The first ``n`` rows of each key; all of them without ``n``.

    Spark cuts each key to n rows per input partition before the shuffle, as
    long as n is within its group-limit threshold. Above that, a salted cut
    spreads a hot key first.
    """
    if n is None:
        return df
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if n > limit:
        salted = df.withColumn("salt", F.pmod(F.xxhash64(*order), F.lit(_SALTS)))
        df = _cut(salted, [*key, "salt"], order, n).drop("salt")
    return _cut(df, key, order, n)


def _cut(df, key, order, n):
    in_order = Window.partitionBy(*key).orderBy(*order)
    return (df.withColumn("row_in_key", F.row_number().over(in_order))
            .where(F.col("row_in_key") <= n).drop("row_in_key"))


# -- members ---------------------------------------------------------------

def member_edges(tables: OsmTables, relation_ids: DataFrame | None = None) -> DataFrame:
    """(relation_id, seq, member_type, member_id, role) of members that exist."""
    edges = tables.relation_members
    if relation_ids is not None:
        edges = edges.join(relation_ids, "relation_id", "left_semi")
    sources = {NODE: tables.nodes, WAY: tables.ways, RELATION: tables.relations}
    parts = []
    for code, source in sources.items():
        present = source.select(F.col("id").alias("member_id"))
        parts.append(edges.where(F.col("member_type") == code)
                     .join(present, "member_id", "left_semi")
                     .select("relation_id", "seq", F.lit(code).alias("member_type"),
                             "member_id", "role"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def unnest_members(tables: OsmTables, max_members: int | None = None,
                   relation_ids: DataFrame | None = None) -> DataFrame:
    """One row per entry of the members array, without building the array."""
    return (_first_members(member_edges(tables, relation_ids), max_members)
            .select(F.col("relation_id").alias("fid"), "seq", *_entry("member_type", "member_id"),
                    "role"))


def member_arrays(tables: OsmTables, max_members: int | None = None,
                  relation_ids: DataFrame | None = None) -> DataFrame:
    """(relation_id, members): entries in member order; only the first ``max_members`` if given."""
    rows = _first_members(member_edges(tables, relation_ids), max_members)
    entry = F.struct("seq", *_entry("member_type", "member_id"), "role")
    return rows.groupBy("relation_id").agg(
        F.transform(F.sort_array(F.collect_list(entry)),
                    lambda e: F.struct(e["type"].alias("type"), e["id"].alias("id"),
                                       e["role"].alias("role"))).alias("members"))


def member_chunks(tables: OsmTables, relation_ids: DataFrame | None = None, span: int = CHUNK_SPAN) -> DataFrame:
    """(relation_id, chunk, members): the members array in pieces, one for each ``span`` of sequence numbers.

    Chunks in order hold all entries in order, and none holds more entries than
    share its span, so the list of a relation with any number of members is
    spread over tasks and rows.
    """
    entry = F.struct("seq", *_entry("member_type", "member_id"), "role")
    return member_edges(tables, relation_ids).groupBy("relation_id", F.expr(f"seq DIV {span}").alias("chunk")).agg(
        F.transform(F.sort_array(F.collect_list(entry)),
                    lambda e: F.struct(e["type"].alias("type"), e["id"].alias("id"), e["role"].alias("role")))
        .alias("members"))


def member_counts(tables: OsmTables, max_members: int | None = None,
                  relation_ids: DataFrame | None = None) -> DataFrame:
    """(relation_id, member_count, members_truncated) from a plain count."""
    return _counts(member_edges(tables, relation_ids), ["relation_id"], max_members,
                   "member_count", "members_truncated")


def _first_members(edges, max_members):
    return first_n(edges, ["relation_id"], ["seq", "member_type", "member_id", "role"],
                   max_members)


# -- parents ---------------------------------------------------------------

def parent_edges(tables: OsmTables, child_type: int,
                 child_ids: DataFrame | None = None, distinct: bool = True) -> DataFrame:
    """(fid, parent_type, parent_id) of every feature of one type that has parents.

    ``child_ids`` has one column ``fid``. Ways are parents of their nodes,
    relations of any member; a parent counts once however often it refers to
    the child.
    """
    edges = tables.relation_members.where(F.col("member_type") == child_type).select(
        F.col("member_id").alias("fid"), F.lit(RELATION).alias("parent_type"),
        F.col("relation_id").alias("parent_id"))
    if child_type == NODE:
        edges = edges.unionByName(tables.way_nodes.select(
            F.col("node_id").alias("fid"), F.lit(WAY).alias("parent_type"),
            F.col("way_id").alias("parent_id")))
    if child_ids is not None:
        edges = edges.join(child_ids, "fid", "left_semi")
    return edges.distinct() if distinct else edges


def unnest_parents(tables: OsmTables, child_type: int, max_parents: int | None = None,
                   child_ids: DataFrame | None = None) -> DataFrame:
    """One row per entry of the parents array, without building the array."""
    return (_first_parents(parent_edges(tables, child_type, child_ids), max_parents)
            .select("fid", *_entry("parent_type", "parent_id")))


def parent_arrays(tables: OsmTables, child_type: int, max_parents: int | None = None,
                  child_ids: DataFrame | None = None) -> DataFrame:
    """(fid, parents): ordered by parent type and id; only the first ``max_parents`` if given."""
    rows = _first_parents(parent_edges(tables, child_type, child_ids), max_parents)
    return rows.groupBy("fid").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("parent_type", "parent_id"))),
                    lambda e: F.struct(*_entry(e["parent_type"], e["parent_id"])))
        .alias("parents"))


def parent_chunks(tables: OsmTables, child_type: int, child_ids: DataFrame | None = None,
                  span: int = CHUNK_SPAN) -> DataFrame:
    """(fid, parent_type, chunk, parents): the parents array in pieces, one for each ``span`` of parent ids.

    A parent counts once, so a chunk has at most ``span`` entries, however many
    parents a feature has. By parent type and chunk, all entries are in order.
    """
    edges = parent_edges(tables, child_type, child_ids)
    # Rounded down below zero as well, so that chunks are in the order of their ids.
    chunk = F.expr(f"(parent_id - pmod(parent_id, {span})) DIV {span}").alias("chunk")
    ids = edges.groupBy("fid", "parent_type", chunk).agg(F.sort_array(F.collect_list("parent_id")).alias("ids"))
    return ids.select("fid", "parent_type", "chunk", F.transform(
        "ids", lambda i: F.struct(*_entry(F.col("parent_type"), i))).alias("parents"))


def parent_counts(tables: OsmTables, child_type: int, max_parents: int | None = None,
                  child_ids: DataFrame | None = None) -> DataFrame:
    """(fid, parent_count, parents_truncated) from a plain count."""
    return _counts(parent_edges(tables, child_type, child_ids), ["fid"], max_parents,
                   "parent_count", "parents_truncated")


def _first_parents(edges, max_parents):
    return first_n(edges, ["fid"], ["parent_type", "parent_id"], max_parents)


# -- shared ----------------------------------------------------------------

def _counts(edges, key, cap, count_name, truncated_name):
    total = edges.groupBy(*key).agg(F.count("*").alias("total"))
    if cap is None:
        return total.select(*key, F.col("total").alias(count_name), F.lit(0).cast("long").alias(truncated_name))
    return total.select(*key, F.least("total", F.lit(cap)).alias(count_name),
                        F.greatest(F.col("total") - cap, F.lit(0)).alias(truncated_name))


def _entry(type_code, member_id) -> list[Column]:
    member_id = F.col(member_id) if isinstance(member_id, str) else member_id
    return [type_name(type_code).alias("type"), member_id.cast("string").alias("id")]
