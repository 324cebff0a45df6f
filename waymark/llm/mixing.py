"""Mixing sources to target weights, by fitting each source's budget with whole documents.

Targets: sources share ``budget`` times all words by weight; a source stops at ``most`` times its own size and what it
can't take goes to the others by weight, until none is above. A source with target t and size s takes every document
``t div s`` times; the rest of its budget is a subset sum. Documents are counted by exact length; of every length the
same share is taken, and bounded-knapsack dynamic programming over the remaining lengths closes the gap. Which
documents of a length go is decided by a seeded hash of key, text and kept columns, so reruns agree on any cluster.

Nothing gathers documents: knapsacks see one row per length of a source, and the choice among documents of equal
length works on hash ranges, so a length that a third of all documents share is spread over ``RANGES`` groups.

Defined results: a null or empty text has size 0 and is never taken; a source without words has target 0; null is a
source of its own, after all others; equal rows are documents of their own; an empty table gives an empty result.
Other columns, whatever their names, are kept by ``mixed`` and not looked at; an input column with the name of an
added one is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.llm.tables import written

WEIGHTS = (3, 1, 2)
RANGES = 256
#: Budgets up to so many words are fitted by dynamic programming; what is above is filled with whole documents first.
DP_WORDS = 1 << 16
#: Reachable sums held at once where documents are longer than that budget.
SUMS = 1 << 22


def subset_sum(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many of each length to take so that the sum is as near to ``budget`` from below as can be.

    Counts are split into powers of two; a bit set of reachable sums grows item by item, and every sum remembers the
    item that reached it first, whose predecessor was reached by earlier items only.
    """
    taken = np.zeros(len(lengths), np.int64)
    budget = int(min(budget, int((lengths * counts).sum())))
    if budget <= 0:
        return taken
    items = []  # (weight, length index, copies)
    for k in np.argsort(lengths, kind="stable"):
        left, copies = int(min(counts[k], budget // lengths[k])), 1
        while left > 0:
            part = min(copies, left)
            items.append((int(lengths[k]) * part, k, part))
            left, copies = left - part, copies * 2
    mask, reach = (1 << (budget + 1)) - 1, 1
    first = np.full(budget + 1, -1, np.int32)
    for n, (weight, _, _) in enumerate(items):
        new = (reach << weight) & mask & ~reach
        if new:
            bits = np.unpackbits(np.frombuffer(new.to_bytes(budget // 8 + 1, "little"), np.uint8), bitorder="little")
            first[np.flatnonzero(bits[:budget + 1])] = n
            reach |= new
            if reach >> budget & 1:
                break
    at = reach.bit_length() - 1
    while at > 0:
        weight, k, copies = items[first[at]]
        taken[k] += copies
        at -= weight
    return taken


def fit_lengths(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """As ``subset_sum``, for any budget: an even share of all lengths, then the longest that fit, then the DP.

    Where that leaves words over, as documents may be longer than the DP's budget, sums of whole documents are tried
    over the whole budget, and the nearer fit is taken.
    """
    size = int((lengths * counts).sum())
    if budget <= 0 or size == 0:
        return np.zeros(len(lengths), np.int64)
    if budget >= size:
        return counts.copy()
    taken = np.array([int(c) * budget // size for c in counts], np.int64)
    left = budget - int((lengths * taken).sum())
    for k in np.argsort(-lengths, kind="stable"):
        if left <= DP_WORDS:
            break
        more = min(int(counts[k] - taken[k]), (left - DP_WORDS // 2) // int(lengths[k]))
        if more > 0:
            taken[k] += more
            left -= more * int(lengths[k])
    taken = taken + subset_sum(lengths, counts - taken, min(left, DP_WORDS * 2))
    if (lengths * taken).sum() < budget:
        other = sparse_sum(lengths, counts, budget)
        if (lengths * other).sum() > (lengths * taken).sum():
            return other
    return taken


def sparse_sum(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """As ``subset_sum`` over any budget: reachable sums as a sorted list instead of a bit set.

    Beyond its share of ``SUMS`` entries a list keeps the largest sum of each equal step of the budget; below, it is
    exact. So few long documents are fitted exactly, many of them to a small part of the budget.
    """
    taken = np.zeros(len(lengths), np.int64)
    items = []  # (weight, length index, copies)
    for k in np.argsort(-lengths, kind="stable"):
        left, copies = int(min(counts[k], budget // lengths[k])), 1
        while left > 0:
            part = min(copies, left)
            items.append((int(lengths[k]) * part, k, part))
            left, copies = left - part, copies * 2
    most = max(SUMS // max(len(items), 1), 256)
    layers = [np.zeros(1, np.int64)]
    for weight, _, _ in items:
        sums = np.union1d(layers[-1], layers[-1] + weight)
        sums = sums[sums <= budget]
        if len(sums) > most:
            step = sums // max(budget // most, 1)
            sums = sums[np.append(step[1:] != step[:-1], True)]
        layers.append(sums)
    at = int(layers[-1][-1])
    for (weight, k, copies), before in zip(reversed(items), reversed(layers[:-1]), strict=True):
        place = np.searchsorted(before, at)
        if place == len(before) or before[place] != at:
            taken[k] += copies
            at -= weight
    return taken


def _fit_source(rows: pd.DataFrame) -> pd.DataFrame:
    rest = int(rows["rest"].iloc[0])
    taken = fit_lengths(rows["size"].to_numpy(np.int64), rows["n"].to_numpy(np.int64), rest)
    return rows[["source_id", "size"]].assign(chosen=taken)


def source_targets(sources: DataFrame, weights=WEIGHTS, budget: float = 1.5, most: float = 2.0) -> DataFrame:
    """source, source_size and target of each source, from one row per source.

    Sources are ranked by code point through range partitions and per-partition counts; the shares are solved in
    rounds of one aggregation each, as capped sources return what they can't take.
    """
    ordered = sources.withColumn("__absent", F.col("source").isNull()).repartitionByRange("__absent", "source") \
        .sortWithinPartitions("__absent", "source").withColumn("__part", F.spark_partition_id()) \
        .withColumn("__seq", F.monotonically_increasing_id() - (F.col("__part").cast("long") * (1 << 33)))
    ordered = written(ordered, "sources")
    before = {}
    total = 0
    for row in ordered.groupBy("__part").count().orderBy("__part").collect():  # one row per partition
        before[row["__part"]], total = total, total + row["count"]
    offset = F.lit(0).cast("long")
    if before:
        pairs = [F.lit(x) for part, n in before.items() for x in (part, n)]
        offset = F.create_map(*pairs)[F.col("__part")].cast("long")
    place = ((F.col("__seq") + offset) % len(weights)).cast("int")
    ranked = ordered.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), place + 1))
    share = _level(ranked, budget, most)
    target = F.least(share * F.col("weight"), most * F.col("source_size"))
    return ranked.select("source", "source_size", target.cast("double").alias("target"))


def _level(ranked: DataFrame, budget: float, most: float) -> Column:
    """Words for a weight of 1, once no source is above its limit."""
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level = float("-inf")
    while True:
        capped = F.col("weight") * level > most * F.col("source_size")
        row = ranked.agg(F.sum(F.when(capped, most * F.col("source_size"))), F.sum(F.when(~capped, F.col("weight")))
                         ).first()
        if not row[1]:
            return F.lit(float("inf") if level > float("-inf") else 0.0)
        new = (budget * total - (row[0] or 0.0)) / row[1]
        if new <= level:
            return F.lit(level)
        level = new


def words_in(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def mixed(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights=WEIGHTS,
          budget: float = 1.5, most: float = 2.0, seed: int = 17, keep: list[str] | None = None) -> DataFrame:
    """``key`` (and the columns ``keep``) with size, source_size, target, times (a document is taken) and taken.

    ``keep`` travels through two shuffles; leave long columns out and join them by key where they are needed.
    """
    keep = [c for c in (keep or []) if c not in (key, "size", "source_size", "target", "times", "taken")]
    # all that tells rows apart draws, so rows with one key or none spread, and reruns take the same rows
    told = [c for c in dict.fromkeys([key, text, *keep]) if "map<" not in docs.schema[c].dataType.simpleString()]
    slim = docs.select(F.col(f"`{key}`").alias("__key"), *[F.col(f"`{c}`").alias(f"__k{n}") for n, c in enumerate(keep)],
                       F.col(f"`{source}`").cast("string").alias("__source"), words_in(text).alias("__size"),
                       F.xxhash64(*[F.col(f"`{c}`") for c in told], F.lit(seed)).alias("__draw"))
    slim = slim.withColumns({
        # null and any text have different ids, and joins need no null-safe test
        "__sid": F.coalesce(F.concat(F.lit("s"), F.col("__source")), F.lit("")),
    }).withColumn("__range", F.shiftright("__draw", 56).cast("int"))
    slim = written(slim, "sizes")
    cells = written(slim.groupBy("__sid", "__source", F.col("__size").alias("size"), "__range")
                    .agg(F.count("*").alias("n")), "cells")
    sources = cells.groupBy(F.col("__source").alias("source")).agg(
        F.sum(F.col("n") * F.col("size")).alias("source_size"))
    targets = written(source_targets(sources, weights, budget, most), "targets").withColumn(
        "source_id", F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit(""))).drop("source")
    targets = targets.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col(
        "source_size"))).otherwise(0).cast("long"))
    targets = targets.withColumn("rest", F.floor(F.col("target") - F.col("whole") * F.col("source_size")).cast("long"))
    lengths = cells.where("size > 0").groupBy(F.col("__sid").alias("source_id"), "size").agg(F.sum("n").alias("n"))
    chosen = lengths.join(targets.select("source_id", "rest"), "source_id") \
        .groupBy("source_id").applyInPandas(_fit_source, "source_id string, size long, chosen long")
    # within a length: whole hash ranges in order, and the lowest draws of the range in which the count runs out
    upto = Window.partitionBy("__sid", "size").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    quota = cells.withColumn("before", F.coalesce(F.sum("n").over(upto), F.lit(0))) \
        .join(chosen.withColumnRenamed("source_id", "__sid"), ["__sid", "size"], "left") \
        .join(targets.withColumnRenamed("source_id", "__sid"), "__sid") \
        .select("__sid", F.col("size").alias("__size"), "__range", "source_size", "target", "whole",
                F.greatest(F.coalesce("chosen", F.lit(0)) - F.col("before"), F.lit(0)).alias("quota"))
    nth = F.row_number().over(Window.partitionBy("__sid", "__size", "__range").orderBy(
        "__draw", "__key"))
    times = (F.col("whole") + (nth <= F.col("quota")).cast("long")).alias("times")
    return slim.join(quota, ["__sid", "__size", "__range"]).select(
        F.col("__key").alias(key), *[F.col(f"__k{n}").alias(c) for n, c in enumerate(keep)], F.col("__size").alias("size"), "source_size", "target",
        F.when(F.col("__size") > 0, times).otherwise(0).cast("long").alias("times")
    ).withColumn("taken", F.col("times") * F.col("size"))


def applied(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The mix itself: the rows of ``docs``, unchanged, as many times as each is taken."""
    names = docs.columns
    plain = docs.select(*[F.col(f"`{c}`").alias(f"__c{n}") for n, c in enumerate(names)])
    own = [f"__c{names.index(c)}" for c in (key, text, source)]
    taken = mixed(plain, *own, keep=plain.columns, **options).where("times > 0")
    return taken.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).select(
        *[F.col(f"__c{n}").alias(c) for n, c in enumerate(names)])
