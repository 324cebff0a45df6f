"""Members and parents."""

from pyspark.sql import functions as F

from waymark.operators.features import features
from waymark.operators.graph import (first_n, member_arrays, member_chunks, member_counts, parent_arrays,
                                     parent_chunks, parent_counts, unnest_members, unnest_parents)
from waymark.schema import NODE, RELATION, WAY


def row(df, fid, code):
    return df.where(f"fid = {fid} AND type = {code}").first()


ALL = ["fid", "type", "members", "parents", "members_truncated", "parents_truncated"]


def test_members_keep_order_and_repeats(build):
    build.node(7).way_of_nodes(7, [7, 7]).relation(7)
    build.relation(8, [("w", 7, "a"), ("n", 7, "x"), ("w", 7, "b"), ("w", 99, "gone"), ("r", 7, "")])
    rows = features(build.tables(), ALL)
    assert row(rows, 7, RELATION).members is None      # no members
    assert row(rows, 7, WAY).members is None           # ways have none
    assert [tuple(m) for m in row(rows, 8, RELATION).members] == [
        ("way", "7", "a"), ("node", "7", "x"), ("way", "7", "b"), ("relation", "7", "")]


def test_parents_count_once_and_respect_the_type(build):
    build.node(7).way_of_nodes(7, [7, 5, 7]).way_of_nodes(4, [7]).relation(7)
    build.relation(8, [("w", 7, ""), ("w", 7, "again")]).relation(3, [("n", 7, "")])
    rows = features(build.tables(), ALL)
    assert [tuple(p) for p in row(rows, 7, NODE).parents] == [
        ("way", "4"), ("way", "7"), ("relation", "3")]
    assert [tuple(p) for p in row(rows, 7, WAY).parents] == [("relation", "8")]
    assert row(rows, 7, RELATION).parents is None and row(rows, 8, RELATION).parents is None


def test_whole_lists_and_caps(build):
    for way in range(101):
        build.way_of_nodes(way, [1_000_000])
    build.way(500, [(0, 0)])
    build.relation(1, [("w", n % 101, str(n)) for n in range(1001)])
    tables = build.tables()
    rows = features(tables, ALL)
    relation, node = row(rows, 1, RELATION), row(rows, 1_000_000, NODE)
    assert [m.role for m in relation.members] == [str(n) for n in range(1001)]
    assert len(node.parents) == 102
    assert relation.members_truncated == node.parents_truncated == 0
    assert member_counts(tables).first()[1:] == (1001, 0)
    assert parent_counts(tables, NODE).where("fid = 1000000").first()[1:] == (102, 0)
    rows = features(tables, ALL, max_members=1000, max_parents=100)
    relation, node = row(rows, 1, RELATION), row(rows, 1_000_000, NODE)
    assert len(relation.members) == 1000 and relation.members_truncated == 1
    assert [m.role for m in relation.members] == [str(n) for n in range(1000)]
    assert len(node.parents) == 100 and node.parents_truncated == 2
    assert [p.id for p in node.parents] == [str(n) for n in range(100)]
    assert member_counts(tables, 1000).first()[1:] == (1000, 1)
    assert parent_counts(tables, NODE, 100).where("fid = 1000000").first()[1:] == (100, 2)


def test_rows_and_arrays_agree(build):
    for way in range(12):
        build.way_of_nodes(way, [way % 4, way % 3])
    for node in range(4):
        build.node(node)
    for rel in range(5):
        build.relation(rel, [("w", (rel * n) % 12, "r") for n in range(7)])
    tables = build.tables()
    view = features(tables, ALL, max_members=4, max_parents=2)
    arrays = view.where("type = 2").select("fid", F.posexplode("members").alias("n", "m")).select(
        "fid", "m.*")
    rows = unnest_members(tables, 4).select("fid", "type", "id", "role")
    assert sorted(arrays.collect()) == sorted(rows.collect())
    for code in (NODE, WAY):
        arrays = view.where(f"type = {code}").select("fid", F.explode("parents").alias("p")).select(
            "fid", "p.*")
        assert sorted(arrays.collect()) == sorted(unnest_parents(tables, code, 2).collect())


def test_first_n_beyond_the_group_limit_is_salted_and_exact(spark):
    df = spark.range(5000).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"))
    got = first_n(df, ["k"], ["v"], 1500)
    assert "salt" in got._jdf.queryExecution().analyzed().toString()
    rows = got.groupBy("k").agg(F.count("*"), F.max("v")).orderBy("k").collect()
    assert rows == [(0, 1500, 2998), (1, 1500, 2999)]


def test_chunks_hold_the_whole_lists_in_order(spark, build):
    for n in range(50):
        build.node(n, n, n)
    hub = [("n", n % 50, f"r{n}") for n in range(230)]
    build.relation(1, hub).relation(2, [("n", 3, "")]).relation(-7, [("n", 3, "")])
    for n in range(40):
        build.relation(100 + n, [("n", 3, "x"), ("n", 3, "y")])
    tables = build.tables()
    rows = member_chunks(tables, span=32).collect()
    assert max(len(r.members) for r in rows) == 32 and len([r for r in rows if r.relation_id == 1]) == 8
    whole = {r.relation_id: r.members for r in member_arrays(tables).collect()}
    joined = {}
    for r in sorted(rows, key=lambda r: r.chunk):
        joined.setdefault(r.relation_id, []).extend(r.members)
    assert joined == whole

    rows = parent_chunks(tables, NODE, span=16).collect()
    assert max(len(r.parents) for r in rows) <= 16
    joined = {}
    for r in sorted(rows, key=lambda r: (r.parent_type, r.chunk)):
        joined.setdefault(r.fid, []).extend(r.parents)
    assert joined == {r.fid: r.parents for r in parent_arrays(tables, NODE).collect()}
    assert len(joined[3]) == 43
