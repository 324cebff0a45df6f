"""Ranked lexical search over document intervals, bounded by range-maximum queries on posting lists.

One pass over the documents counts their terms and keeps, for each, its length and how often the terms of the queries
are in it. From the totals follow the weights of terms. A shard of some thousand documents, ordered by key, holds one
posting list a query term: document positions and impacts, with a sparse table of the place of the largest impact in
every run of 1, 2, 4, ... postings, so that the maximum over any range of documents takes two lookups.

A query starts with the whole shard as one interval, whose bound is the sum over its terms of the largest impact. The
intervals of the highest bounds are split, best first and a batch at a time: the document of the largest impact in it
is scored exactly, and the parts before and after it become intervals of their own. What can't come among the best
``k`` any more goes; the bar stays from shard to shard of a task. Each task hands on at most ``k`` rows a query.

Queries are taken in blocks of at most ``BLOCK_BYTES`` of text, so what is broadcast is bounded whatever their number.

Defined results: a null text, of a document or a query, has no terms; such a query has no row. Equal queries, by key
or by text, are queries of their own, and so are equal documents; among equal scores null keys come last. An empty
table of either kind gives an empty result. Columns other than key and text, whatever their names, are not looked at.
"""

from __future__ import annotations

import bisect
import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from waymark.llm.tables import written
from waymark.llm.text import byte_set, chunks, owners, runs

BLOCK_BYTES = 4_000_000
SHARD_DOCS = 4096
SHARD_POSTINGS = 1_000_000
#: Intervals split at once.
WIDTH = 128
#: Bytes that end a term.
_OUTSIDE = byte_set((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))


@dataclass
class Block:
    """Some queries: all their terms as sorted hashes, and each query's terms as (place, repeats)."""

    terms: np.ndarray
    queries: list[tuple[np.ndarray, np.ndarray]]


def term_hashes(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, hashes of terms, where each document's begin) of the column's texts, chunk by chunk."""
    for chunk in chunks(column):
        begin, end, bounds = runs(chunk.lowered(), _OUTSIDE)
        yield chunk.first, chunk.hashes(begin, end), bounds


def block_of(texts: list[str | None]) -> Block:
    counted = [Counter() for _ in texts]
    for first, hashes, bounds in term_hashes(pa.array(texts, pa.string())):
        for n in range(len(bounds) - 1):
            counted[first + n].update(hashes[bounds[n]:bounds[n + 1]].tolist())
    terms = np.unique(np.array([t for c in counted for t in c], np.uint64))
    place = [(np.searchsorted(terms, np.array(list(c), np.uint64)), np.array(list(c.values()), np.int64)) for c in counted]
    return Block(terms, place)


def _poster(block):
    """The ``mapInArrow`` function from documents to their length and their counts of the block's terms."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = block.value.terms
        for batch in batches:
            for first, hashes, bounds in term_hashes(batch.column("text")):
                n = np.diff(bounds)
                place = np.minimum(np.searchsorted(terms, hashes), max(0, len(terms) - 1))
                wanted = terms[place] == hashes if len(terms) else np.zeros(len(hashes), bool)
                both = owners(bounds)[wanted] * max(1, len(terms)) + place[wanted]
                both, tf = np.unique(both, return_counts=True)
                cuts = np.searchsorted(both, np.arange(len(n) + 1) * max(1, len(terms)))
                place, tf = (both % max(1, len(terms))).astype(np.int32), tf.astype(np.int32)
                some = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").take(pa.array(first + some)), pa.array(n[some], pa.int64()),
                     pa.array([place[cuts[i]:cuts[i + 1]].tobytes() for i in some], pa.binary()),
                     pa.array([tf[cuts[i]:cuts[i + 1]].tobytes() for i in some], pa.binary())],
                    ["key", "n", "terms", "tf"])

    return run


def _frequencies(size: int):
    """The ``mapInArrow`` function that counts the documents of each term."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for batch in batches:
            df += np.bincount(np.frombuffer(b"".join(batch.column("terms").to_pylist()), np.int32), minlength=size)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], ["term", "df"])

    return run


class Shard:
    """Posting lists of some documents, ordered by key, one after the other, with one sparse table for all."""

    def __init__(self, keys: pa.Array, n: np.ndarray, terms: list[bytes], tf: list[bytes], n_docs: int, n_terms: int):
        order = pc.array_sort_indices(keys, null_placement="at_end").to_numpy()
        self.keys = keys.take(pa.array(order))
        self.ids = [k for k in self.keys.to_pylist() if k is not None]
        self.size = len(order)
        counts = np.array([len(t) // 4 for t in terms], np.int64)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        doc = np.repeat(rank, counts)
        term = np.frombuffer(b"".join(terms), np.int32).astype(np.int64)
        tf = np.frombuffer(b"".join(tf), np.int32).astype(np.int64)
        m = np.repeat(25 + (75 * n * n_docs) // max(1, n_terms), counts)
        at = np.argsort(term * self.size + doc)
        self.place = (term * self.size + doc)[at]  # sorted: lists by term, documents within
        self.impact = ((1_000_000_000 * tf) // (1000 * tf + 8 * m))[at]
        longest = int(np.bincount(term).max(initial=1))
        # one more, empty posting, so that ends of ranges are places too
        self.place, self.impact = np.append(self.place, np.iinfo(np.int64).max), np.append(self.impact, 0)
        best = np.arange(len(self.impact), dtype=np.int32)
        self.table = [best]
        for level in range(1, longest.bit_length()):
            step, best = 1 << (level - 1), best.copy()
            left, right = self.table[-1][:-step], self.table[-1][step:]
            best[:-step] = np.where(self.impact[left] >= self.impact[right], left, right)
            self.table.append(best)
        self.table = np.stack(self.table)

    def largest(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place and value of the largest impact in each range of postings, the first of equals; 0 in empty ones."""
        length = high - low
        some = length > 0
        level = np.where(some, np.frexp(np.maximum(length, 1).astype(float))[1] - 1, 0)
        left = self.table[level, low]
        right = self.table[level, np.where(some, high - (1 << level), low)]
        at = np.where(self.impact[left] >= self.impact[right], left, right)
        return at, np.where(some, self.impact[at], 0)

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int, bar: tuple[int, int]) -> tuple[list[int], list[int]]:
        """Positions and scores of the best ``k`` documents that beat the bar: a score, and a position equals must be before."""
        first, last = terms * self.size, (terms + 1) * self.size
        low, high = np.searchsorted(self.place, first)[None, :], np.searchsorted(self.place, last)[None, :]
        there = (high > low)[0]
        first, weights, low, high = first[there], weights[there], low[:, there], high[:, there]
        found: list[tuple[int, int]] = []  # (-score, position), sorted
        start, stop = np.zeros(1, np.int64), np.full(1, self.size, np.int64)
        at, value = self.largest(low, high)
        gain = value * weights
        bound = gain.sum(axis=1)
        width = 1
        while True:
            score, position = bar
            if len(found) >= k and (found[k - 1][0], found[k - 1][1]) < (-score, position):
                score, position = -found[k - 1][0], found[k - 1][1]
            open_ = (bound > score) | ((bound == score) & (start < position) & (bound > 0))
            if not open_.any():
                return [p for _, p in found], [-s for s, _ in found]
            start, stop, low, high, at, gain, bound = (x[open_] for x in (start, stop, low, high, at, gain, bound))
            chosen = np.argsort(-bound, kind="stable")
            now, later = chosen[:width], chosen[width:]
            width = min(2 * width, WIDTH)
            doc = self.place[at[now, gain[now].argmax(axis=1)]] % self.size
            split = np.searchsorted(self.place, first[None, :] + doc[:, None])
            hit = self.place[split] == first[None, :] + doc[:, None]
            exact = (np.where(hit, self.impact[split], 0) * weights).sum(axis=1)
            found = sorted([*found, *((-int(s), int(d)) for s, d in zip(exact, doc) if s > 0)])[:k]
            low_new, high_new = np.concatenate([low[now], split + hit]), np.concatenate([split, high[now]])
            at_new, value = self.largest(low_new, high_new)
            gain_new = value * weights
            start = np.concatenate([start[later], start[now], doc + 1])
            stop = np.concatenate([stop[later], doc, stop[now]])
            low, high = np.concatenate([low[later], low_new]), np.concatenate([high[later], high_new])
            at, gain = np.concatenate([at[later], at_new]), np.concatenate([gain[later], gain_new])
            bound = np.concatenate([bound[later], gain_new.sum(axis=1)])


class _Best:
    """A task's best rows of one query so far."""

    def __init__(self, k: int):
        self.k, self.rows = k, []  # (-score, key is null, key), sorted

    def bar(self, shard: Shard) -> tuple[int, int]:
        """The score to reach, and the position in the shard that an equal score must be before."""
        if len(self.rows) < self.k:
            return 0, 0
        score, absent, key = self.rows[-1]
        return -score, len(shard.ids) if absent else bisect.bisect_left(shard.ids, key)

    def add(self, shard: Shard, positions: list[int], scores: list[int]) -> None:
        keys = [shard.ids[p] if p < len(shard.ids) else None for p in positions]
        new = [(-s, key is None, key if key is not None else 0) for s, key in zip(scores, keys)]
        self.rows = sorted([*self.rows, *new])[:self.k]


def _shards(batches: Iterable[pa.RecordBatch], n_docs: int, n_terms: int, size_docs: int, size_postings: int
            ) -> Iterator[Shard]:
    """Shards of at most ``size_docs`` documents and about ``size_postings`` postings."""
    held, postings = [], 0

    def shard():
        rows = pa.Table.from_batches(held).combine_chunks()
        return Shard(rows.column("key").combine_chunks() if rows.num_rows else rows.column("key"),
                     rows.column("n").to_numpy(), rows.column("terms").to_pylist(), rows.column("tf").to_pylist(),
                     n_docs, n_terms)

    docs = 0
    for batch in batches:
        size = np.cumsum([len(t) // 4 for t in batch.column("terms").to_pylist()])
        first = 0
        while first < batch.num_rows:
            before = size[first - 1] if first else 0
            last = int(np.searchsorted(size, before + size_postings - postings, "right"))
            last = min(max(last, first + 1), first + size_docs - docs, batch.num_rows)
            held.append(batch.slice(first, last - first))
            docs, postings = docs + last - first, postings + int(size[last - 1] - before)
            if docs >= size_docs or postings >= size_postings:
                yield shard()
                held, docs, postings = [], 0, 0
            first = last
    if held:
        yield shard()


def _searcher(block, weights: np.ndarray, n_docs: int, n_terms: int, k: int, key_type: pa.DataType, size: tuple[int, int]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = block.value.queries
        best = [_Best(k) for _ in queries]
        for shard in _shards(batches, n_docs, n_terms, *size):
            for mine, (terms, repeats) in zip(best, queries):
                if len(terms):
                    mine.add(shard, *shard.search(terms, weights[terms] * repeats, k, mine.bar(shard)))
        rows = [(n, None if absent else key, -score) for n, mine in enumerate(best) for score, absent, key in mine.rows]
        columns = list(zip(*rows)) or [[], [], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int32(), key_type, pa.int64()))], ["query", "key", "score"])

    return run


def _blocks(items: DataFrame) -> Iterator[list]:
    block, size = [], 0
    for row in items.toLocalIterator():
        block.append(row)
        size += len(row["text"] or "")
        if size >= BLOCK_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def ranked(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
           item_text: str = "text", k: int = 10, shard_docs: int = SHARD_DOCS,
           shard_postings: int = SHARD_POSTINGS) -> DataFrame:
    """item_key, rank, key and score of each item's ``k`` documents of the highest scores above 0."""
    plain = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    queries = items.select(F.col(f"`{item_key}`").alias("item"), F.col(f"`{item_text}`").cast("string").alias("text"))
    results = [_ranked_block(plain, rows, queries.schema["item"].dataType, k, (shard_docs, shard_postings))
               for rows in _blocks(queries)]
    names = [item_key, "rank", key, "score"]
    if not results:
        types = [queries.schema["item"].dataType, "int", plain.schema["key"].dataType, "long"]
        return docs.sparkSession.range(0).select(*[F.lit(None).cast(t).alias(n) for n, t in zip(names, types)])
    return reduce(DataFrame.unionByName, results).toDF(*names)


def _ranked_block(plain: DataFrame, rows: list, item_type, k: int, shard: tuple[int, int]) -> DataFrame:
    spark = plain.sparkSession
    block = spark.sparkContext.broadcast(block_of([r["text"] for r in rows]))
    size, key_type = len(block.value.terms), plain.schema["key"].dataType
    schema = plain.select("key").schema.add("n", "long").add("terms", "binary").add("tf", "binary")
    postings = written(plain.mapInArrow(_poster(block), schema), "postings")
    totals = postings.agg(F.count("*"), F.sum("n")).first()
    n_docs, n_terms = totals[0], totals[1] or 0
    df = np.zeros(size, np.int64)
    for row in postings.select("terms").mapInArrow(_frequencies(size), "term long, df long") \
            .groupBy("term").agg(F.sum("df").alias("df")).collect():  # the block's terms at most
        df[row["term"]] = row["df"]
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)
    found = postings.mapInArrow(
        _searcher(block, weights, n_docs, n_terms, k, to_arrow_type(key_type), shard),
        spark.range(0).select(F.col("id").cast("int").alias("query"), F.lit(None).cast(key_type).alias("key"),
                              F.col("id").alias("score")).schema)
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.col("key").asc_nulls_last())
    names = spark.createDataFrame([(n, r["item"]) for n, r in enumerate(rows)],
                                  spark.range(0).select(F.col("id").cast("int").alias("query"),
                                                        F.lit(None).cast(item_type).alias("item")).schema)
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k) \
        .join(F.broadcast(names), "query").select("item", "rank", "key", "score")

