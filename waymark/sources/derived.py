"""OSM-shaped tables derived from the star-schema Parquet tables by plain rules.

Nothing here ranks rows within an order or customer: ``seq`` is an
order-preserving number, so a hot key costs no window and no extra shuffle.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.schema import NODE, RELATION, WAY
from waymark.sources.tables import OsmTables, empty_tags

# Fixed values of the derivation rules.
X_FACTOR, Y_FACTOR = 2654435761, 2246822519
# Ids of regions and of ways that don't exist are negative, so no key of any size meets them.
REGION_BASE = -1
PRIORITY_TAGS = {
    "1-URGENT": ("building", "yes"),
    "2-HIGH": ("highway", "primary"),
    "3-MEDIUM": ("highway", "residential"),
    "4-NOT SPECIFIED": ("leisure", "park"),
}
PART_AMENITIES = {"PROMO": "restaurant", "LARGE": "school"}
# seq of a way node is line number * LINE_SPAN + part key. Spans of part keys
# within a line cut up an order that holds very many lines.
LINE_SPAN = 1 << 40
PART_SPAN = 1 << 24
LAST_SEQ = 1 << 62


@cache
def _schema(spark: SparkSession, file: str):
    return spark.read.parquet(file).schema


def _reader(spark: SparkSession, path: str):
    """Opens each table once, and looks into each file's footer once per session."""
    @cache
    def read(name: str) -> DataFrame:
        file = f"{path}/{name}.parquet"
        return spark.read.schema(_schema(spark, file)).parquet(file)

    return read


def derived_tables(spark: SparkSession, path: str) -> OsmTables:
    read = _reader(spark, path)
    return OsmTables(spark, {
        "nodes": lambda: _nodes(read("part")),
        "ways": lambda: _ways(read("orders"), read("lineitem")),
        "way_nodes": lambda: _way_nodes(read("lineitem")),
        "relations": lambda: _relations(read("customer"), read("region")),
        "relation_members": lambda: _members(read("orders"), read("customer"), read("nation"),
                                             read("region")),
    }, seq_span=PART_SPAN)


def _way_nodes(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        F.col("l_orderkey").alias("way_id"),
        (F.col("l_linenumber").cast("long") * LINE_SPAN + F.col("l_partkey")).alias("seq"),
        F.col("l_partkey").alias("node_id"))


def _nodes(part: DataFrame) -> DataFrame:
    base = [F.lit("name"), F.col("p_name"), F.lit("brand"), F.col("p_brand"),
            F.lit("size"), F.col("p_size").cast("string")]
    tags = F.create_map(*base)
    for kind, amenity in PART_AMENITIES.items():
        full = F.create_map(*base, F.lit("amenity"), F.lit(amenity))
        tags = F.when(F.col("p_type") == kind, full).otherwise(tags)
    return part.select(
        F.col("p_partkey").alias("id"),
        scattered(F.col("p_partkey"), X_FACTOR).alias("x"),
        scattered(F.col("p_partkey"), Y_FACTOR).alias("y"),
        tags.alias("tags"))


def scattered(key: Column, factor: int) -> Column:
    """(key * factor) mod 2^32 - 2^31, in 16-bit halves so that no product overflows."""
    low = F.pmod(key, F.lit(65536))
    high = F.pmod(F.shiftright(key, 16), F.lit(65536))
    product = low * factor + F.pmod(high * factor, F.lit(65536)) * 65536
    return (F.pmod(product, F.lit(4294967296)) - 2147483648).cast("int")


def _ways(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    distinct_nodes = (lineitem.groupBy("l_orderkey", "l_partkey").agg(F.lit(1).alias("one"))
                      .groupBy(F.col("l_orderkey").alias("o_orderkey"))
                      .agg(F.count("*").alias("n_distinct")))
    named = F.col("o_orderkey") % 3 == 0
    name = [F.lit("name"), F.concat(F.lit("w"), F.col("o_orderkey").cast("string"))]
    tags = F.when(named, F.create_map(*name)).otherwise(empty_tags())
    for priority, pair in PRIORITY_TAGS.items():
        kind = [F.lit(v) for v in pair]
        both = F.when(named, F.create_map(*kind, *name)).otherwise(F.create_map(*kind))
        tags = F.when(F.col("o_orderpriority") == priority, both).otherwise(tags)
    return orders.join(distinct_nodes, "o_orderkey", "left").select(
        F.col("o_orderkey").alias("id"),
        ((F.col("o_orderstatus") == "F")
         & (F.coalesce(F.col("n_distinct"), F.lit(0)) >= 3)).alias("is_area"),
        tags.alias("tags"))


def _relations(customer: DataFrame, region: DataFrame) -> DataFrame:
    routes = customer.select(
        F.col("c_custkey").alias("id"), F.lit(False).alias("is_area"),
        F.create_map(F.lit("type"), F.lit("route"), F.lit("name"), F.col("c_name"),
                     F.lit("network"), F.col("c_mktsegment")).alias("tags"))
    boundaries = region.select(
        (F.lit(REGION_BASE) - F.col("r_regionkey")).cast("long").alias("id"),
        F.lit(False).alias("is_area"),
        F.create_map(F.lit("type"), F.lit("boundary"),
                     F.lit("name"), F.col("r_name")).alias("tags"))
    return routes.unionByName(boundaries)


def _members(orders, customer, nation, region) -> DataFrame:
    def rows(df, relation, seq, kind, member, role):
        return df.select(relation.cast("long").alias("relation_id"),
                         seq.cast("long").alias("seq"), F.lit(kind).alias("member_type"),
                         member.cast("long").alias("member_id"), role.alias("role"))

    cust, order = F.col("c_custkey"), F.col("o_orderkey")
    status = F.col("o_orderstatus")
    way_role = F.when(status == "F", "outer").when(status == "O", "inner").otherwise("")
    region_id = F.lit(REGION_BASE) - F.col("r_regionkey")
    in_region = (customer
                 .join(nation, customer.c_nationkey == nation.n_nationkey)
                 .select("c_custkey", F.col("n_regionkey").alias("r_regionkey")))
    return (
        rows(customer, cust, F.lit(0), NODE, cust, F.lit("label"))
        .unionByName(rows(orders, F.col("o_custkey"), order + 1, WAY, order, way_role))
        .unionByName(rows(customer.where(cust % 13 == 0), cust, F.lit(LAST_SEQ), WAY,
                          -cust, F.lit("outer")))
        .unionByName(rows(region, region_id, F.lit(0), NODE, F.col("r_regionkey"),
                          F.lit("admin_centre")))
        .unionByName(rows(in_region, region_id, cust + 1, RELATION, cust, F.lit("subarea"))))


# The corners of an outline, and how a third of all keys each
# cuts it into ways. Corner e moves up by the gap. The second way is reversed
# for odd keys.
CORNERS = {"a": (0, 0), "b": (1000, 0), "c": (1000, 1000), "d": (0, 1000), "e": (0, 0),
           "p": (400, 400), "q": (600, 400), "r": (600, 600), "s": (400, 600)}
CUTS = {0: ["abcde"], 1: ["abc", "cde"], 2: ["ab", "bc", "cd", "de"]}
HOLE = "pqrsp"


def ring_tables(spark: SparkSession, path: str) -> OsmTables:
    """One area relation per customer whose area is known in closed form.

    The outline is a square of side 1000 (with a gap of 0, 50 or 500 before
    its start), cut into 1, 2 or 4 outer ways; every fifth has a square hole.
    """
    k = F.col("c_custkey")
    return _outlines(spark, path, x=(k % 1000) * 5000, y=F.expr("c_custkey DIV 1000 % 400000") * 5000)


def _outlines(spark: SparkSession, path: str, x: Column, y: Column, scale: Column | None = None) -> OsmTables:
    """Outlines with their lower left corner at x, y; ``scale`` stretches all but the gap."""
    k = F.col("c_custkey")
    read = _reader(spark, path)
    scale = F.lit(1) if scale is None else scale

    def customers() -> DataFrame:
        return read("customer").select("c_custkey", "c_name", (k % 3).alias("cut"), (k % 2).alias("odd"),
                               (k % 5 == 0).alias("holed"))

    def ways() -> DataFrame:
        return (customers().join(_ring_pattern(spark, points=False), ["cut", "odd"])
                .where(F.col("holed") | (F.col("role") == "outer"))
                .select("c_custkey", "seq", "role", (k * 8 + F.col("seq")).alias("way_id")))

    def points() -> DataFrame:
        gap = F.when(k % 11 == 0, 500).when(k % 7 == 0, 50).otherwise(0)
        moved = F.when(F.col("at_gap"), gap).otherwise(0)
        way_id = k * 8 + F.col("seq")
        return (customers().join(_ring_pattern(spark, points=True), ["cut", "odd"])
                .where(F.col("holed") | (F.col("role") == "outer"))
                .select(way_id.alias("way_id"), F.col("place").cast("long").alias("seq"),
                        (way_id * 8 + F.col("place")).alias("node_id"),
                        (x + F.col("dx") * scale).cast("int").alias("x"),
                        (y + F.col("dy") * scale + moved).cast("int").alias("y")))

    return OsmTables(spark, {
        "nodes": lambda: points().select(F.col("node_id").alias("id"), "x", "y",
                                         empty_tags().alias("tags")),
        "ways": lambda: ways().select(F.col("way_id").alias("id"), F.lit(False).alias("is_area"),
                                      empty_tags().alias("tags")),
        "way_nodes": lambda: points().select("way_id", "seq", "node_id"),
        "relations": lambda: customers().select(
            k.alias("id"), F.lit(True).alias("is_area"),
            F.create_map(F.lit("type"), F.lit("multipolygon"),
                         F.lit("name"), F.col("c_name")).alias("tags")),
        "relation_members": lambda: ways().select(
            k.alias("relation_id"), F.col("seq").cast("long").alias("seq"),
            F.lit(WAY).alias("member_type"), F.col("way_id").alias("member_id"), "role"),
    })


# Ids of the area relations below, their ways and nodes lie so far under all others.
FAR = 1 << 60
# How wide the outlines of area relations are, in thousands of grid units, and where they start.
WIDTH_FACTOR, WIDTH_LIMIT, CORNER = 48271, 2_000_000, -1_000_000_000


def region_tables(spark: SparkSession, path: str) -> OsmTables:
    """The derived tables and, besides their area ways, one area relation per customer.

    These have outlines like those of ``ring_tables``, as wide as area ways
    are; every fourth is a park.
    """
    k = F.col("c_custkey")
    plain = derived_tables(spark, path)
    width = k * WIDTH_FACTOR % WIDTH_LIMIT + 1
    added = _outlines(spark, path, F.lit(CORNER), F.lit(CORNER), width)

    def both(name: str, *ids: str, **more: Column):
        def rows() -> DataFrame:
            far = getattr(added, name).withColumns({c: F.col(c) - FAR for c in ids}).withColumns(more)
            return getattr(plain, name).unionByName(far)
        return rows

    park = F.create_map(F.lit("leisure"), F.lit("park"))
    tags = F.when(F.pmod(F.col("id"), F.lit(4)) == 1, F.map_concat("tags", park)).otherwise(F.col("tags"))
    return OsmTables(spark, {
        "nodes": both("nodes", "id"), "ways": both("ways", "id"),
        "way_nodes": both("way_nodes", "way_id", "node_id"), "relations": both("relations", "id", tags=tags),
        "relation_members": both("relation_members", "relation_id", "member_id"),
    }, seq_span=PART_SPAN)


# A prime that scatters the slots of the large ring's ways.
SLOT_FACTOR, SLOT_PRIME = 48271, 2147483647


def large_ring_tables(spark: SparkSession, path: str) -> OsmTables:
    """One area relation whose only ring is made of a way from each customer to the next.

    Customers are the corners of a fan: along a parabola in the order of their
    keys. Ways of odd keys run backwards, and slots are scattered, so ways that
    touch are far apart in the relation.
    """
    read = _reader(spark, path)
    k = F.col("c_custkey")

    def steps() -> DataFrame:
        """k and the next key; the last one's next is the first. One row per key, one pass for the ends."""
        keys = read("customer").select(k.alias("k"))
        ends = keys.agg(F.min("k").alias("low"), F.max("k").alias("high"))
        after = keys.select((F.col("k") - 1).alias("k"), F.col("k").alias("next"))
        return (keys.join(after, "k", "left").join(F.broadcast(ends))  # one row
                .select("k", F.coalesce("next", "low").alias("next"))
                .withColumn("odd", F.col("k") % 2 == 1))

    def points() -> DataFrame:
        both = F.array(*[F.struct(F.lit(n).cast("long").alias("seq"), c.alias("at")) for n, c in enumerate(
            (F.when(F.col("odd"), F.col("next")).otherwise(F.col("k")),
             F.when(F.col("odd"), F.col("k")).otherwise(F.col("next"))))])
        return steps().select(F.col("k").alias("way_id"), F.explode(both).alias("p")).select("way_id", "p.seq", "p.at")

    return OsmTables(spark, {
        "nodes": lambda: read("customer").select(
            k.alias("id"), (k * 16).cast("int").alias("x"), F.expr("CAST(c_custkey * c_custkey % 2000000000 AS INT)").alias("y"),
            empty_tags().alias("tags")),
        "ways": lambda: read("customer").select(k.alias("id"), F.lit(False).alias("is_area"), empty_tags().alias("tags")),
        "way_nodes": lambda: points().select("way_id", "seq", F.col("at").alias("node_id")),
        "relations": lambda: spark.range(1).select(
            F.lit(1).cast("long").alias("id"), F.lit(True).alias("is_area"), empty_tags().alias("tags")),
        "relation_members": lambda: read("customer").select(
            F.lit(1).cast("long").alias("relation_id"), (k * SLOT_FACTOR % SLOT_PRIME).alias("seq"),
            F.lit(WAY).alias("member_type"), k.alias("member_id"), F.lit("outer").alias("role")),
    })


def _ring_pattern(spark: SparkSession, points: bool) -> DataFrame:
    """The ways, or way points, of each kind of outline: a table of fixed size."""
    rows = []
    for cut, pieces in CUTS.items():
        for odd in (0, 1):
            for seq, corners in enumerate([*pieces, HOLE]):
                role = "outer" if seq < len(pieces) else "inner"
                flip = odd == 1 and seq == 1 and role == "outer"
                path = corners[::-1] if flip else corners
                for place, corner in enumerate(path if points else path[:1]):
                    dx, dy = CORNERS[corner]
                    at_gap = str(corner == "e").lower()
                    rows.append(f"({cut}, {odd}, {seq}, '{role}', {place}, {dx}, {dy}, {at_gap})")
    return spark.sql("SELECT * FROM VALUES " + ", ".join(rows)
                     + " AS t(cut, odd, seq, role, place, dx, dy, at_gap)")
