"""Very large groups of open ways, split exactly by joins before any task holds one.

Where exactly two open ways meet at every point of a ring, joining has only
one possible result: the ring starts at its lowest-slot way and runs in that
way's direction. Such plain cycles are found by pointer doubling: each round
doubles the stretch a row has seen, so n ways need about log2(n) joins. What
is left is split into connected components, which never influence each other.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_GROUP = ["relation_id", "outer"]


def split_large(open_ways: DataFrame, limit: int, max_gap: int):
    """(open ways of other groups, ways on plain cycles with their ring, the rest).

    Groups of at most ``limit`` ways are left alone. The rest has one more
    column, ``component``. The last two are None if no group is larger.
    """
    sizes = open_ways.groupBy(*_GROUP).agg(F.count("*").alias("group_size"))
    large = checkpointed(sizes.where(F.col("group_size") > limit))
    largest = large.agg(F.max("group_size")).first()[0]
    if largest is None:
        return open_ways, None, None
    keys = large.select(*_GROUP)
    ways = checkpointed(open_ways.join(keys, _GROUP, "left_semi"))
    rounds = int(largest).bit_length()
    on_cycle = checkpointed(_ranked(_led(_arcs(ways), rounds), rounds))
    rest = ways.join(on_cycle, [*_GROUP, "slot"], "left_anti")
    return (open_ways.join(keys, _GROUP, "left_anti"),
            _with_ring(ways.join(on_cycle, [*_GROUP, "slot"]), max_gap),
            _with_component(checkpointed(rest)))


def _arcs(ways: DataFrame) -> DataFrame:
    """Both directions of each way, with the arc that follows where just two ways meet.

    An arc is (slot, dir); dir 1 runs the way backwards. It enters a way at the
    end numbered like its dir and leaves at the other.
    """
    ends = ways.where(F.col("first") != F.col("last")).select(
        *_GROUP, "slot", F.explode(F.array(
            F.struct(F.lit(0).alias("end"), F.col("first").alias("at")),
            F.struct(F.lit(1).alias("end"), F.col("last").alias("at")))).alias("e")).select(
        *_GROUP, "slot", "e.end", "e.at")
    loops = ways.where(F.col("first") == F.col("last")).select(*_GROUP, F.col("first").alias("at"))
    here = F.struct("slot", "end")
    meeting = (ends.groupBy(*_GROUP, "at")
               .agg(F.count("*").alias("n"), F.min(here).alias("a"), F.max(here).alias("b"))
               .where((F.col("n") == 2) & (F.col("a.slot") != F.col("b.slot")))
               .join(loops, [*_GROUP, "at"], "left_anti"))

    def step(left, right):
        # Leaving `left` at its end means travelling towards that end.
        return meeting.select(*_GROUP, F.col(f"{left}.slot").alias("slot"),
                              (1 - F.col(f"{left}.end")).alias("dir"),
                              F.col(f"{right}.slot").alias("next_slot"),
                              F.col(f"{right}.end").alias("next_dir"))

    return step("a", "b").unionByName(step("b", "a"))


def _led(arcs: DataFrame, rounds: int) -> DataFrame:
    """Arcs on cycles that run in the direction of their lowest-slot way."""
    low = F.struct(F.col("slot").alias("slot"), F.col("dir").alias("dir"))
    walk = checkpointed(arcs.select("*", low.alias("low")))
    for _ in range(rounds):
        ahead = walk.select(*_GROUP, F.col("slot").alias("next_slot"),
                            F.col("dir").alias("next_dir"), F.col("low").alias("low_ahead"),
                            F.col("next_slot").alias("far_slot"),
                            F.col("next_dir").alias("far_dir"))
        # Inner join: an arc that runs into a dead end or a branch drops out.
        walk = checkpointed(walk.join(ahead, [*_GROUP, "next_slot", "next_dir"]).select(
            *_GROUP, "slot", "dir", F.col("far_slot").alias("next_slot"),
            F.col("far_dir").alias("next_dir"), F.least("low", "low_ahead").alias("low")))
    leaders = walk.where(F.col("low.dir") == 0).select(
        *_GROUP, "slot", "dir", F.col("low.slot").alias("ring_slot"))
    return leaders.join(arcs, [*_GROUP, "slot", "dir"])


def _ranked(arcs: DataFrame, rounds: int) -> DataFrame:
    """(group, slot, dir, ring_slot, pos): steps from the ring's first way."""
    last = F.col("next_slot") == F.col("ring_slot")
    walk = arcs.select(*_GROUP, "slot", "dir", "ring_slot",
                       F.when(~last, F.col("next_slot")).alias("next_slot"),
                       F.lit(1).cast("long").alias("left"))
    walk = checkpointed(walk)
    for _ in range(rounds):
        ahead = walk.select(*_GROUP, F.col("slot").alias("next_slot"),
                            F.col("next_slot").alias("far_slot"),
                            F.col("left").alias("left_ahead"))
        moved = walk.join(ahead, [*_GROUP, "next_slot"]).select(
            *_GROUP, "slot", "dir", "ring_slot", F.col("far_slot").alias("next_slot"),
            (F.col("left") + F.col("left_ahead")).alias("left"))
        arrived = walk.where(F.col("next_slot").isNull())
        walk = checkpointed(moved.unionByName(arrived))
    length = walk.where(F.col("slot") == F.col("ring_slot")).select(
        *_GROUP, "ring_slot", F.col("left").alias("length"))
    return walk.join(length, [*_GROUP, "ring_slot"]).select(
        *_GROUP, "slot", "dir", "ring_slot", (F.col("length") - F.col("left")).alias("pos"))


def _with_ring(ways: DataFrame, max_gap: int) -> DataFrame:
    """Add the ring columns to ways on cycles. Only two 2-point ways make a ring too short."""
    ring = ways.groupBy(*_GROUP, "ring_slot").agg(
        (F.sum(F.col("n_points") - 1) + 1).alias("size"),
        F.max(F.when(F.col("slot") == F.col("ring_slot"), F.col("first"))).alias("ring_first"))
    short = "gap_closed" if max_gap > 0 else "discarded"
    return (ways.join(ring, [*_GROUP, "ring_slot"])
            .withColumn("status", F.when(F.col("size") >= 4, "closed").otherwise(short))
            .withColumn("reversed", F.col("dir") == 1)
            .withColumn("ring_last", F.col("ring_first"))
            .drop("size", "dir"))


def _with_component(ways: DataFrame) -> DataFrame:
    """Label each way with the lowest slot it is connected to through shared end points.

    Ways that share a point are linked to one way of that point, never
    pairwise; alternating star steps then shrink all paths to one hop.
    """
    ends = ways.select(*_GROUP, "slot", F.explode(F.array("first", "last")).alias("at")).distinct()
    hub = ends.groupBy(*_GROUP, "at").agg(F.min("slot").alias("low"))
    links = checkpointed(ends.join(hub, [*_GROUP, "at"]).where(F.col("slot") != F.col("low"))
                         .select(*_GROUP, F.col("slot").alias("u"), F.col("low").alias("v"))
                         .distinct())
    state = _state(links)
    while True:
        links = checkpointed(_small_star(_large_star(links)))
        previous, state = state, _state(links)
        if state == previous:
            break
    labels = links.select(*_GROUP, F.col("u").alias("slot"), F.col("v").alias("component"))
    return ways.join(labels, [*_GROUP, "slot"], "left").withColumn(
        "component", F.coalesce("component", "slot"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(
        links.select(*_GROUP, F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy(*_GROUP, "u").agg(F.min("v").alias("low"))
    return (both.where(F.col("v") > F.col("u")).join(low, [*_GROUP, "u"])
            .select(*_GROUP, F.col("v").alias("u"), F.least("low", "u").alias("v")).distinct())


def _small_star(links: DataFrame) -> DataFrame:
    low = links.groupBy(*_GROUP, "u").agg(F.min("v").alias("low"))
    moved = (links.join(low, [*_GROUP, "u"]).where(F.col("v") != F.col("low"))
             .select(*_GROUP, F.col("v").alias("u"), F.col("low").alias("v")))
    return moved.unionByName(low.withColumnRenamed("low", "v")).distinct()


def _state(links: DataFrame):
    return links.agg(F.count("*"), F.sum(F.xxhash64("u", "v", *_GROUP).cast("decimal(38,0)"))).first()


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage: write ``df`` to the session's shared folder and read it back.

    A written table, not ``checkpoint()``: a checkpoint keeps the size estimate
    of its plan, and over many rounds of joins that estimate, a product each
    time, grows beyond all bounds and stalls planning.
    """
    path = f"{shared_folder(df.sparkSession)}/waymark-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shared_folder(spark: SparkSession) -> str:
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="waymark-checkpoint-"))
        folder = context.getCheckpointDir()
    return folder
