"""The five base tables, how to read them, and how to lay them out for scale.

nodes             id, x, y, tags
ways              id, is_area, tags
way_nodes         way_id, seq, node_id [, x, y]
relations         id, is_area, tags
relation_members  relation_id, seq, member_type, member_id, role

``seq`` only orders the rows of one way or relation; gaps are fine. If
``way_nodes`` carries x and y, the node join is skipped everywhere.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLE_NAMES = ("nodes", "ways", "way_nodes", "relations", "relation_members")


class OsmTables:
    """The base tables, each opened when first used.

    Points of one way whose seq lies in the same span of length ``seq_span``
    are handled together, so no task ever holds a whole long way.
    """

    def __init__(self, spark: SparkSession, tables: Mapping[str, Callable[[], DataFrame]],
                 seq_span: int = 4096):
        self.spark = spark
        self.seq_span = seq_span
        self._tables = tables

    @cached_property
    def nodes(self) -> DataFrame:
        return self._tables["nodes"]()

    @cached_property
    def ways(self) -> DataFrame:
        return self._tables["ways"]()

    @cached_property
    def way_nodes(self) -> DataFrame:
        return self._tables["way_nodes"]()

    @cached_property
    def relations(self) -> DataFrame:
        return self._tables["relations"]()

    @cached_property
    def relation_members(self) -> DataFrame:
        return self._tables["relation_members"]()


def read_tables(spark: SparkSession, path: str, seq_span: int = 4096) -> OsmTables:
    def opener(name: str) -> Callable[[], DataFrame]:
        return lambda: spark.read.parquet(f"{path}/{name}")

    return OsmTables(spark, {name: opener(name) for name in TABLE_NAMES}, seq_span)


def write_tables(tables: OsmTables, path: str, mode: str = "errorifexists") -> None:
    """Write the base tables sorted by owner, with coordinates next to way nodes.

    The join of way nodes with nodes is paid once here, not in every query.
    Ranges are sampled on (owner, seq), so one huge way spreads over many files.
    """
    inlined = tables.way_nodes
    if "x" not in inlined.columns:
        # A node missing from the extract keeps its way_nodes row, without a point.
        nodes = tables.nodes.select(F.col("id").alias("node_id"), "x", "y")
        inlined = inlined.join(nodes, "node_id", "left")
    inlined = inlined.select("way_id", "seq", "node_id", "x", "y")
    layout = {
        "nodes": (tables.nodes, ["id"]),
        "ways": (tables.ways, ["id"]),
        "way_nodes": (inlined, ["way_id", "seq"]),
        "relations": (tables.relations, ["id"]),
        "relation_members": (tables.relation_members, ["relation_id", "seq"]),
    }
    for name, (df, keys) in layout.items():
        df.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode(mode).parquet(
            f"{path}/{name}")


def write_bucketed(tables: OsmTables, prefix: str, buckets: int, mode: str = "errorifexists") -> None:
    """Save nodes and way nodes as tables bucketed by node id, all else as plain tables.

    For data that change: nodes move without way nodes being written anew, and
    the join of both still needs no exchange, as equal buckets meet in place.
    Choose ``buckets`` so that one bucket of way nodes suits a task.
    """
    keys = {"nodes": ["id"], "way_nodes": ["node_id"]}
    for name in TABLE_NAMES:
        df = getattr(tables, name)
        if name in keys:
            # one file a bucket, as each task holds whole buckets
            df = df.repartition(buckets, *keys[name])
            df.write.mode(mode).bucketBy(buckets, *keys[name]).sortBy(*keys[name]).saveAsTable(f"{prefix}_{name}")
        else:
            df.write.mode(mode).saveAsTable(f"{prefix}_{name}")


def bucketed_tables(spark: SparkSession, prefix: str, seq_span: int = 4096) -> OsmTables:
    def opener(name: str) -> Callable[[], DataFrame]:
        return lambda: spark.table(f"{prefix}_{name}")

    return OsmTables(spark, {name: opener(name) for name in TABLE_NAMES}, seq_span)


def tags_from_pairs(pairs: DataFrame, owner: str = "id") -> DataFrame:
    """(owner, seq, k, v) rows to one tag map per owner; a repeated key keeps its last value."""
    last = pairs.groupBy(owner, "k").agg(F.max_by("v", "seq").alias("v"))
    return last.groupBy(owner).agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("k", "v")))).alias("tags"))


def with_tags(owners: DataFrame, tags: DataFrame, owner: str = "id") -> DataFrame:
    """Attach tag maps; an owner without tags gets the empty map."""
    return owners.join(tags, owner, "left").withColumn("tags", tags_or_empty())


def tags_or_empty(tags="tags") -> Column:
    return F.coalesce(F.col(tags), empty_tags())


def empty_tags() -> Column:
    return F.create_map().cast("map<string,string>")
